"""Dictionary lookup (enrichment) with a size-checked broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dictionary is broadcast only when a probe (row count and bytes, with the overhead of a row in
# memory) shows at most this many rows and no more bytes than the session broadcasts by itself
# (spark.sql.autoBroadcastJoinThreshold); beyond either limit the join is a shuffle join on the
# key, and AQE may still turn it into a broadcast join at run time from the measured shuffle size.
DEFAULT_MAX_BROADCAST_ROWS = 5_000_000
ROW_OVERHEAD_BYTES = 64


def session_broadcast_bytes(spark) -> int:
    """The session's broadcast threshold in bytes; below 0 means never."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def _payload_bytes(df: DataFrame) -> list:
    """Per-row byte estimate: string and binary values by their length, other types by a
    fixed 8 bytes (numbers, dates, flags)."""
    out = []
    for f in df.schema.fields:
        name = f.dataType.simpleString()
        if name in ("string", "binary"):
            out.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)))
        else:
            out.append(F.lit(8))
    return out


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """``broadcast(df)`` when ``df`` has at most ``max_rows`` rows and ``max_bytes`` (default: the
    session's threshold) in memory, else ``df`` unchanged (the planner then shuffles both sides on the key).

    The probe is one partial aggregation over ``df`` (the small side; no ``limit``, which
    would funnel rows into a single task)."""
    max_bytes = session_broadcast_bytes(df.sparkSession) if max_bytes is None else max_bytes
    if max_bytes < 0:
        return df, False
    width = F.lit(ROW_OVERHEAD_BYTES)
    for c in _payload_bytes(df):
        width = width + c
    probe = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    n, b = probe["n"], probe["b"] or 0
    ok = n <= max_rows and b <= max_bytes
    return (F.broadcast(df), True) if ok else (df, False)


def hot_keys(df: DataFrame, on: str, hot_fraction: float = 0.01, sample_fraction: float = 0.05,
             seed: int = 17) -> list:
    """Keys holding at least ``hot_fraction`` of the rows, estimated on a row sample.

    At most ``1 / hot_fraction`` keys can qualify, so the result is bounded whatever the data
    size; counting is a partial aggregate and only the top keys reach the driver."""
    sample = df.select(on).where(F.col(on).isNotNull()).sample(fraction=sample_fraction, seed=seed)
    total = sample.count()
    if total == 0:
        return []
    limit = int(1 / hot_fraction)
    top = (sample.groupBy(on).agg(F.count(F.lit(1)).alias("_c"))
           .where(F.col("_c") >= F.lit(hot_fraction * total)).orderBy(F.col("_c").desc()).limit(limit))
    return [r[0] for r in top.collect()]


def salted_join(left: DataFrame, right: DataFrame, on: str, how: str, keys: list, buckets: int = 32) -> DataFrame:
    """Equi-join on ``on`` that spreads each hot key over ``buckets`` tasks.

    Rows of ``left`` with a hot key get a salt in ``[0, buckets)`` from their place in the input
    (partition and number), so equal rows are spread as well; the numbered rows are checkpointed,
    so a recomputed task after a lost executor routes every row as before. The ``right`` rows of
    hot keys are repeated once per salt; every other row has salt 0. Each left row still meets
    exactly one copy of its right rows, so the result equals the plain join. ``right`` must be
    the side with few rows per key (here: one dictionary row per key)."""
    if not keys:
        return left.join(right, on=on, how=how)
    hot = F.col(on).isin(keys)
    from feedmetrics.session import work_dir

    work_dir(left.sparkSession)  # a checkpoint folder must be registered
    lsalt = F.when(hot, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(buckets)).cast("int")).otherwise(F.lit(0))
    rsalt = F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0))))
    l = left.withColumn("_salt", lsalt).checkpoint(eager=True)
    r = right.select("*", rsalt.alias("_salt"))
    return l.join(r, on=[on, "_salt"], how=how).drop("_salt")


def dedup_dictionary(dict_df: DataFrame, on: str, attrs: Sequence[str], on_duplicate: str = "error",
                     order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key.

    ``on_duplicate="last"``: the row with the greatest ``order_by`` wins (a later line of the
    file overrides an earlier one); ``"error"``: fail the job when a key repeats. Both are
    partial aggregations, so a key repeated on many rows is combined map-side.
    """
    packed = F.struct(*[F.col(a) for a in attrs])
    if on_duplicate == "last":
        if not order_by:
            raise ValueError("on_duplicate='last' needs order_by: Spark keeps no line order across splits")
        key_order = F.struct(*[F.col(c) for c in order_by])
        agg = dict_df.groupBy(on).agg(F.max_by(packed, key_order).alias("_v"))
    elif on_duplicate == "error":
        agg = dict_df.groupBy(on).agg(F.count(F.lit(1)).alias("_n"), F.first(packed).alias("_v"))
        agg = agg.withColumn("_v", F.when(F.col("_n") > 1, F.raise_error(
            F.concat(F.lit("duplicate dictionary key: "), F.col(on).cast("string")))).otherwise(F.col("_v")))
    else:
        raise ValueError(f"unknown on_duplicate={on_duplicate!r}")
    return agg.select(F.col(on), *[F.col("_v").getField(a).alias(a) for a in attrs])


def dictionary_lookup(df: DataFrame, dict_df: DataFrame, on: str = "ip",
                      attrs: Sequence[str] = ("region", "city", "isp"), default: str | None = "Unknown",
                      on_duplicate: str = "error", order_by: Sequence[str] | None = None,
                      max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      max_broadcast_bytes: int | None = None,
                      skew: str = "aqe", hot_fraction: float = 0.01, salt_buckets: int = 32) -> DataFrame:
    """Left lookup of ``attrs`` by ``on``; rows without a match get ``default`` in every
    attribute. A matched row keeps its attributes as they are, NULL included.

    A dictionary within the broadcast limits is broadcast (no shuffle of ``df``, hot keys
    cost nothing extra). A larger one is a shuffle join, and a key of ``df`` holding a large
    share of its rows is split over several tasks:

    - ``skew="aqe"``: the de-duplicated dictionary is checkpointed (one write of the small
      side into the shared checkpoint folder), so the join reads it as a plain shuffle and
      adaptive execution's skew join splits oversized partitions of ``df`` at run time. No
      extra pass over ``df``.
    - ``skew="salt"``: keys holding at least ``hot_fraction`` of ``df`` (found on a sample:
      one extra pass over ``df``) are salted over ``salt_buckets`` tasks; works without AQE.
    - ``skew="off"``: plain shuffle join."""
    d = dedup_dictionary(dict_df, on, attrs, on_duplicate, order_by)
    d = d.select(F.col(on), *[F.col(a).alias(f"_d_{a}") for a in attrs], F.lit(True).alias("_matched"))
    d, small = checked_broadcast(d, max_broadcast_rows, max_broadcast_bytes)
    if small or skew == "off":
        j = df.join(d, on=on, how="left")
    elif skew == "aqe":
        from feedmetrics.session import work_dir

        work_dir(df.sparkSession)  # a checkpoint folder must be registered
        j = df.join(d.checkpoint(eager=True), on=on, how="left")
    elif skew == "salt":
        j = salted_join(df, d, on, "left", hot_keys(df, on, hot_fraction), salt_buckets)
    else:
        raise ValueError(f"skew must be aqe, salt or off, not {skew!r}")
    out = [F.col(c) for c in df.columns if c not in attrs]
    for a in attrs:
        out.append(F.when(F.col("_matched").isNull(), F.lit(default)).otherwise(F.col(f"_d_{a}")).alias(a))
    return j.select(*out)


def enrich(records: DataFrame, dict_df: DataFrame, **kw) -> DataFrame:
    """Enriched log record: ip, region, city, isp, latency, zone token, size and cache status."""
    from feedmetrics.operators.logs import cache_status

    base = records.select("line_id", "ip", "latency", "zone", "size", cache_status().alias("cache_status"))
    out = dictionary_lookup(base, dict_df, **kw)
    return out.select("line_id", "ip", "region", "city", "isp", "latency", "zone", "size", "cache_status")
