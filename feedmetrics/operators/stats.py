"""Counts, summaries, order statistics and top-k.

All aggregates are partial (map-side combine), so a value that holds a large share of the
rows costs one row per task before the shuffle. Order statistics never gather a whole column
in one task: exact selection narrows the search to one bucket of distinct values first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmetrics.functions.columns import nan_as_null as nan_as_null_col
from feedmetrics.functions.columns import q
from feedmetrics.operators import sketches
from feedmetrics.session import work_dir


def count_rows(df: DataFrame, name: str = "records") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_by(df: DataFrame, col: str, name: str = "records") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, col: str, approx: bool = False, name: str | None = None,
                   rsd: float = 0.01) -> DataFrame:
    """Exact: a two-level aggregate (distinct keys per task, then counted). Approximate:
    HyperLogLog++ with relative error ``rsd`` and a fixed-size sketch."""
    c = F.approx_count_distinct(col, rsd) if approx else F.count_distinct(F.col(col))
    return df.agg(c.alias(name or f"distinct_{col}"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def traffic(df: DataFrame, cond: Column | None = None, col: str = "size", name: str = "traffic") -> DataFrame:
    """Sum of ``col`` over the rows matching ``cond``; NULL for no rows."""
    d = df if cond is None else df.where(cond)
    return d.agg(F.sum(col).alias(name))


def summary(df: DataFrame, col: str, prefix: str | None = None, nan_as_null: bool = False) -> DataFrame:
    """Mean, max and min. A NaN makes the mean NaN and sorts above every number (so it is the
    max); ``nan_as_null=True`` leaves NaN out like NULL."""
    p = prefix or col
    c = nan_as_null_col(F.col(col)) if nan_as_null else F.col(col)
    return df.agg(F.avg(c).alias(f"{p}_mean"), F.max(c).alias(f"{p}_max"), F.min(c).alias(f"{p}_min"))


#: Limbs of a fraction in ``exact_means``, of 32 bits each.
LIMBS = 3


def exact_means(df: DataFrame, columns: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """One row: the mean of each double column, the same to the last bit however the rows are partitioned or batched.

    Sums of doubles depend on their order, sums of whole numbers do not. A value is cut, without rounding, into its
    whole part and ``LIMBS`` limbs of 32 bits of its fraction (bits below 2^-96 are dropped, per value); limbs
    are summed as whole numbers and put together at the end. NaN, infinities and numbers from 2^63 on are counted apart:
    any NaN, or infinities of both signs, give NaN, else an infinity gives itself; a mean over numbers too large
    is NULL, as is one over nothing."""
    n, aggs, outs = len(columns), [], []
    rows = df.select(*[F.col(q(c)).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)])
    plain = [F.col(f"_x{i}").isNotNull() & ~F.isnan(f"_x{i}") & (F.abs(f"_x{i}") < float(2 ** 63)) for i in range(n)]
    # One projection a limb: each uses the rest that the one before left, which is then computed once.
    rows = rows.select("*", *[F.when(plain[i], F.floor(f"_x{i}")).alias(f"_w{i}") for i in range(n)], *[F.when(plain[i], F.col(f"_x{i}") - F.floor(f"_x{i}")).alias(f"_r{i}_0") for i in range(n)])
    for k in range(LIMBS):
        rows = rows.select("*", *[F.floor(F.col(f"_r{i}_{k}") * float(2 ** 32)).alias(f"_l{i}_{k}") for i in range(n)])
        rows = rows.select("*", *[(F.col(f"_r{i}_{k}") * float(2 ** 32) - F.col(f"_l{i}_{k}")).alias(f"_r{i}_{k + 1}") for i in range(n)])
    for i, name in enumerate(names or [f"{c}_mean" for c in columns]):
        x = F.col(f"_x{i}")
        aggs += [F.count(x).alias(f"_n{i}"), F.count_if(F.isnan(x)).alias(f"_nan{i}"), F.count_if(x == float("inf")).alias(f"_up{i}"),
                 F.count_if(x == float("-inf")).alias(f"_down{i}"), F.count_if(~F.isnan(x) & (F.abs(x) >= float(2 ** 63)) & (F.abs(x) != float("inf"))).alias(f"_large{i}"),
                 F.sum(F.col(f"_w{i}").cast("decimal(19,0)")).alias(f"_w{i}"), *[F.sum(F.col(f"_l{i}_{k}").cast("decimal(10,0)")).alias(f"_l{i}_{k}") for k in range(LIMBS)]]
        total = F.lit(0.0)
        for k in reversed(range(LIMBS)):
            total = (total + F.col(f"_l{i}_{k}").cast("double")) / float(2 ** 32)
        mean = (F.col(f"_w{i}").cast("double") + total) / F.col(f"_n{i}").cast("double")
        outs.append(F.when((F.col(f"_nan{i}") > 0) | ((F.col(f"_up{i}") > 0) & (F.col(f"_down{i}") > 0)), float("nan"))
                    .when(F.col(f"_up{i}") > 0, float("inf")).when(F.col(f"_down{i}") > 0, float("-inf"))
                    .when(F.col(f"_large{i}") == 0, mean).alias(name))
    return rows.agg(*aggs).select(*outs)


def first_k(df: DataFrame, order_by: Sequence[Column | str], k: int = 10) -> DataFrame:
    """First ``k`` rows in order (NULL keys last). Planned as TakeOrderedAndProject: each task
    keeps ``k`` rows, no full sort."""
    cols = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
    return df.orderBy(*cols).limit(k)


def kth_largest(df: DataFrame, col: str, k: int = 2, name: str | None = None) -> DataFrame:
    """The ``k`` largest values by position (ties repeat): rows ``(rank, value)``, fewer when
    there are fewer than ``k`` non-NULL values."""
    top = df.select(F.col(col)).where(F.col(col).isNotNull()).orderBy(F.col(col).desc()).limit(k)
    w = Window.orderBy(F.col(col).desc())  # over at most k rows
    return top.select(F.row_number().over(w).alias("rank"), F.col(col).alias(name or col))


def argmax_ties(df: DataFrame, col: str) -> DataFrame:
    """All rows whose ``col`` equals the maximum (ties kept). The maximum is one row, so
    the join broadcasts a relation of proven size 1."""
    m = df.agg(F.max(col).alias("_max"))
    return df.join(F.broadcast(m), F.col(col) == F.col("_max"), "inner").drop("_max")


def kth_smallest(df: DataFrame, col: str, rank: int | None = None, fraction: float | None = None,
                 max_range_rows: int = 1_000_000, sketch_k: int = sketches.KLL_K, stored: DataFrame | None = None,
                 name: str | None = None, buckets: int | None = None, max_bucket_rows: int | None = None) -> DataFrame:
    """Exact order statistic: the value at 0-based position ``rank`` of the ascending
    non-NULL values (or at position ``ceil(fraction * n) - 1``). One row; NULL when there
    is no such position. NaN sorts last.

    Distributed selection instead of sorting a column in one task:
      1. a KLL sketch (partial aggregates of a fixed size; or ``stored``, a table of
         ``sketches.value_sketches`` of the same rows) gives a narrow range of values around the rank;
      2. one more scan counts what is below the range and makes the range's histogram, which is
         partially aggregated, so hot values are single rows; a sketch that was off is noticed
         here, and the range is widened;
      3. while the range holds more than ``max_range_rows`` distinct values it is narrowed by a sketch of
         itself; then it is scanned in order.

    ``buckets`` and ``max_bucket_rows`` are the earlier names of ``sketch_k`` and ``max_range_rows``.
    """
    sketch_k, max_range_rows = buckets or sketch_k, max_bucket_rows or max_range_rows
    spark, out_name, kind = df.sparkSession, name or col, sketches.kll_kind(df.schema[col].dataType)
    if kind is None:
        raise ValueError(f"{col} is neither an integer nor a float column")
    work_dir(spark)  # a checkpoint folder must be registered
    values = df.select(F.col(col).cast(kind).alias("v")).where(F.col("v").isNotNull())
    vtype = df.schema[col].dataType
    found = _sketched(values, sketch_k) if stored is None else sketches.merged_values(stored, kind).checkpoint(eager=True)
    one = found.select("n", "nan").first()
    n, nan = one["n"], one["nan"]
    if rank is None:
        if fraction is None:
            raise ValueError("give rank or fraction")
        rank = max(int(math.ceil(fraction * (n + nan))) - 1, 0)
    if rank < 0 or rank >= n:
        value = F.lit(float("nan")) if 0 <= rank < n + nan else F.lit(None)
        return spark.range(1).select(value.cast(vtype).alias(out_name))
    values = values.where(~F.isnan("v")) if kind == "double" else values
    within, below, error = values, 0, 2 * sketches.kll_error(sketch_k)
    while True:
        lo, hi = sketches.value_range(found, kind, rank - below, n, error)
        rows = within if hi is None else within.where(F.col("v") <= F.lit(hi))
        low = F.lit(None) if lo is None else F.col("v") < F.lit(lo)
        hist = rows.groupBy(F.coalesce(low, F.lit(False)).alias("low"), F.when(~F.coalesce(low, F.lit(False)), F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("c")).checkpoint(eager=True)
        seen = hist.agg(F.sum(F.when(F.col("low"), F.col("c"))).alias("low"), F.sum(F.when(~F.col("low"), F.col("c"))).alias("own"), F.count_if(~F.col("low")).alias("d")).first()
        before, own = below + (seen["low"] or 0), seen["own"] or 0
        if not before <= rank < before + own:
            error *= 4  # the sketch was off: a wider range, at last all values
            continue
        below, within = before, rows if lo is None else rows.where(F.col("v") >= F.lit(lo))
        if seen["d"] <= max_range_rows or own == n:  # a range that does not get narrower is scanned as it is
            break
        found, n, error = _sketched(within, sketch_k), own, 2 * sketches.kll_error(sketch_k)
    # The remaining range is bounded: ordered running count within it, first row past the rank.
    w = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    picked = (hist.where(~F.col("low")).withColumn("_cum", F.sum("c").over(w))
              .where(F.col("_cum") > F.lit(rank - below)).orderBy("v").limit(1))
    return picked.select(F.col("v").cast(vtype).alias(out_name))


def _sketched(values: DataFrame, k: int) -> DataFrame:
    """One stored row (sketch, nan, n) of the column ``v``."""
    kind = sketches.kll_kind(values.schema["v"].dataType)
    return sketches.merged_values(sketches.value_sketches(values, "v", k=k), kind).checkpoint(eager=True)


def median_disc(df: DataFrame, col: str, approx: bool = False, accuracy: int = 10_000,
                name: str | None = None) -> DataFrame:
    """Lower median: the element at 0-based position ``(n + 1) / 2 - 1`` of the sorted values.

    ``approx=True`` uses ``percentile_approx`` (fixed memory, rank error ``n / accuracy``)."""
    out = name or f"{col}_median"
    if approx:
        return df.agg(F.percentile_approx(col, 0.5, accuracy).alias(out))
    # (n + 1) / 2 - 1 == ceil(n / 2) - 1
    return kth_smallest(df, col, fraction=0.5, name=out)
