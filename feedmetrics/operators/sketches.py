"""Sketches of a column that are stored per group and merged later: distinct counts (HLL) and quantiles (KLL).

A sketch has a fixed size whatever it has seen, so a table of one sketch per file, day or feed answers for
any union of them without the rows. A distinct count from sketches is an estimate; a quantile from sketches is
a range of values that is certain to be checked: ``stats.kth_smallest`` counts exactly within it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType

#: Registers of an HLL sketch as a power of two; its relative standard error is 1.04 / sqrt(2 ** HLL_LOG).
HLL_LOG = 14
#: Size of a KLL sketch.
KLL_K = 4096


def hll_error(log_registers: int = HLL_LOG) -> float:
    return 1.04 / math.sqrt(2 ** log_registers)


def distinct_sketches(df: DataFrame, col: str, by: Sequence[Column | str], log_registers: int = HLL_LOG, name: str = "sketch") -> DataFrame:
    """One HLL sketch of ``col`` per ``by``."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(col, log_registers).alias(name))


def merged_distinct(sketches: DataFrame, name: str = "distinct", sketch: str = "sketch") -> DataFrame:
    """The estimated number of distinct values over all sketches of a table; 0 for none."""
    return sketches.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(sketch)), F.lit(0)).alias(name))


def kll_kind(kind: DataType) -> str | None:
    """Which KLL functions hold values of a type exactly; None for none of them."""
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        return "bigint"
    return "double" if isinstance(kind, (FloatType, DoubleType)) else None


def kll_error(k: int = KLL_K) -> float:
    """Normalised rank error of a KLL sketch at 99 % confidence."""
    return 2.296 / k ** 0.9723


def value_sketches(df: DataFrame, col: str, by: Sequence[Column | str] = (), k: int = KLL_K, name: str = "sketch") -> DataFrame:
    """One KLL sketch of ``col`` per ``by``, with ``nan``: the NaN values, which sketches leave out."""
    kind = kll_kind(df.schema[col].dataType)
    if kind is None:
        raise ValueError(f"{col} is neither an integer nor a float column")
    return df.groupBy(*by).agg(getattr(F, f"kll_sketch_agg_{kind}")(F.col(col).cast(kind), k).alias(name), nans(df, col).alias("nan"))


def nans(df: DataFrame, col: str) -> Column:
    return F.count_if(F.isnan(col)) if kll_kind(df.schema[col].dataType) == "double" else F.lit(0).cast("bigint") + F.count_if(F.lit(False))


def merged_values(sketches: DataFrame, kind: str, sketch: str = "sketch") -> DataFrame:
    """One row (sketch, nan, n): all sketches of a table merged. ``n`` counts the values without NaN."""
    one = sketches.agg(getattr(F, f"kll_merge_agg_{kind}")(sketch).alias("sketch"), F.coalesce(F.sum("nan"), F.lit(0)).alias("nan"))
    return one.withColumn("n", F.coalesce(getattr(F, f"kll_sketch_get_n_{kind}")("sketch"), F.lit(0)))


def value_range(merged: DataFrame, kind: str, rank: int, n: int, error: float) -> tuple:
    """(low, high): values between which the value at 0-based ``rank`` of ``n`` lies, by the sketch; None where
    there is no bound."""
    at = (rank + 0.5) / n
    find = getattr(F, f"kll_sketch_get_quantile_{kind}")
    lo, hi = at - error, at + error
    row = merged.select(*[find("sketch", F.lit(float(min(max(x, 0.0), 1.0)))).alias(c) for c, x in (("lo", lo), ("hi", hi))]).first()
    return (row["lo"] if lo > 0 else None), (row["hi"] if hi < 1 else None)
