"""Cache status counts and hit rates (conditional counts, partial aggregation)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("HIT", "HIT1", "MISS")


def _counts(col: str) -> list[Column]:
    return [F.count_if(F.col(col) == F.lit(s)).alias(s.lower()) for s in STATUSES]


def _rate() -> Column:
    hits = F.col("hit") + F.col("hit1")
    return F.try_divide(hits.cast("double"), (hits + F.col("miss")).cast("double"))


def status_counts(df: DataFrame, col: str = "cache_status") -> DataFrame:
    """One row ``hit, hit1, miss``; a missing status counts 0."""
    return df.agg(*_counts(col))


def hit_rate(df: DataFrame, col: str = "cache_status") -> DataFrame:
    """``(HIT + HIT1) / (HIT + HIT1 + MISS)``; NULL when there are no records."""
    return status_counts(df, col).select(_rate().alias("hit_rate"))


def hit_rate_by(df: DataFrame, key: str, col: str = "cache_status") -> DataFrame:
    """Per ``key``: ``hit, hit1, miss`` and ``rate``."""
    return df.groupBy(key).agg(*_counts(col)).withColumn("rate", _rate())
