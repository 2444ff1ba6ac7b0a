"""Access-log parsing and validation (line -> typed record)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmetrics.functions.columns import classify_suffix
from feedmetrics.functions.logtime import log_time_ms

# Content classes by name suffix and cache classes by status suffix, in the
# reference's order (first match wins). The content groups are kept exactly as given.
SERVICE_RULES = ((( ".mpd", ".m3u8"), "HLS"), ((".dash", ".ts"), "MPEG-DASH"))
SERVICE_DEFAULT = "Web Service"
CACHE_RULES = ((("HIT",), "HIT"), (("HIT1",), "HIT1"))
CACHE_DEFAULT = "MISS"

FIELD_COLUMNS = ("n_fields", "latency", "ip", "hit_status", "time_text", "zone", "content", "size_text", "size", "ok")


def _typed(t: Column, with_time: bool) -> Column:
    """Struct of typed fields from one token array ``t`` (a lambda variable)."""
    lat = F.get(t, 0).try_cast("double")
    status = F.get(t, 2)
    size_text = F.get(t, 6)
    all_digits = (F.length(size_text) > 0) & (F.length(F.translate(size_text, "0123456789", "")) == 0)
    size = F.when(all_digits, size_text.try_cast("bigint"))
    time_text = F.concat(F.get(t, 3), F.lit(" "), F.get(t, 4))
    ok = F.coalesce((F.size(t) == 7) & (lat >= 0) & ~F.isnan(lat) & (size > 0) & (status != F.lit("-")),
                    F.lit(False))
    fields = [F.size(t).alias("n_fields"), lat.alias("latency"), F.get(t, 1).alias("ip"), status.alias("hit_status"),
              time_text.alias("time_text"), F.get(t, 4).alias("zone"), F.get(t, 5).alias("content"),
              size_text.alias("size_text"), size.alias("size"), ok.alias("ok")]
    if with_time:
        fields.append(log_time_ms(time_text).alias("ts_ms"))
    return F.struct(*fields)


def parse_log(df: DataFrame, col: str = "value", with_time: bool = True, keep: str = "all") -> DataFrame:
    """Lines -> typed fields, ``ok`` (valid record, never NULL) and ``ts_ms`` (epoch ms or
    NULL; only when ``with_time``). ``keep``: ``"all"``, ``"valid"`` or ``"invalid"`` lines.

    Tokens: split on single spaces after dropping trailing spaces (a split on ' ' keeps no
    trailing empty token in the reference); inner double spaces give empty tokens, which
    make the line invalid. Missing positions give NULL (``get``), bad numbers NULL
    (``try_cast``). Valid: 7 fields, latency a number >= 0, size all digits and > 0, status
    not ``-``.

    The typed record is produced by a generator (``inline``) over a one-element array, which
    is empty for a line that is not kept. A plain filter on ``ok`` would be pushed below the
    projection and repeat the split (and the line's whole derivation) once per field.
    """
    cols = [F.col(c) for c in df.columns]
    tmp = df.select(*cols, F.split(F.rtrim(F.col(col)), " ").alias("_toks"))  # rtrim: trailing ' ' only
    rec = _typed(F.col("_toks"), with_time)
    if keep == "all":
        rows = F.array(rec)
    elif keep in ("valid", "invalid"):
        ok = rec.getField("ok")
        rows = F.when(ok if keep == "valid" else ~ok, F.array(rec))  # NULL array: no row
    else:
        raise ValueError(f"keep must be all, valid or invalid, not {keep!r}")
    return tmp.select(*cols, F.inline(rows))


def split_fields(df: DataFrame, col: str = "value") -> DataFrame:
    """Typed positional fields only (see ``parse_log``)."""
    return parse_log(df, col, with_time=False).drop("ok")


def valid_records(df: DataFrame) -> DataFrame:
    return df.where(F.col("ok"))


def invalid_records(df: DataFrame) -> DataFrame:
    return df.where(~F.col("ok"))


def with_service(df: DataFrame, col: str = "content") -> DataFrame:
    return df.withColumn("service", classify_suffix(col, SERVICE_RULES, SERVICE_DEFAULT))


def cache_status(col: str = "hit_status"):
    return classify_suffix(col, CACHE_RULES, CACHE_DEFAULT)


def with_cache_status(df: DataFrame, col: str = "hit_status") -> DataFrame:
    return df.withColumn("cache_status", cache_status(col))


def overview(parsed: DataFrame, approx_clients: bool = False) -> DataFrame:
    """Every global log figure in one aggregation over parsed lines (``parse_log(keep="all")``):
    line counts, valid records per service class and cache status, latency mean/max/min,
    traffic and distinct clients of the valid records.

    One scan instead of one per figure. The exact distinct count makes Spark expand the rows
    once for the distinct part; ``approx_clients=True`` uses a fixed-size sketch instead."""
    ok = F.col("ok")
    service = classify_suffix("content", SERVICE_RULES, SERVICE_DEFAULT)
    status = cache_status()
    lat = F.when(ok, F.col("latency"))
    ip = F.when(ok, F.col("ip"))
    aggs = [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(ok).alias("valid"),
        F.count_if(~ok).alias("invalid"),
        F.count_if(ok & (service == F.lit("HLS"))).alias("hls"),
        F.count_if(ok & (service == F.lit("MPEG-DASH"))).alias("mpeg_dash"),
        F.count_if(ok & (service == F.lit("Web Service"))).alias("web_service"),
        F.count_if(ok & (status == F.lit("HIT"))).alias("hit"),
        F.count_if(ok & (status == F.lit("HIT1"))).alias("hit1"),
        F.count_if(ok & (status == F.lit("MISS"))).alias("miss"),
        F.avg(lat).alias("latency_mean"),
        F.max(lat).alias("latency_max"),
        F.min(lat).alias("latency_min"),
        F.sum(F.when(ok, F.col("size"))).alias("traffic"),
        (F.approx_count_distinct(ip) if approx_clients else F.count_distinct(ip)).alias("unique_clients"),
    ]
    return parsed.agg(*aggs)
