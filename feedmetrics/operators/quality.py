"""Out-of-range flags, durations, extremes and the text report, in one pass over the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmetrics.functions.columns import duration_parts, number_text, outside
from feedmetrics.functions.columns import nan_as_null as nan_as_null_col

# The ideal ranges the reference checks, and the units its report prints.
IDEAL_BOUNDS = {"Air_Temperature": (23.0, 28.0), "Air_Moisture": (60.0, 80.0), "Earth_pH": (5.5, 7.0)}
UNITS = {"Air_Temperature": "°C", "Air_Moisture": "%", "Earth_pH": ""}

Bounds = Mapping[str, tuple[float, float]]


def range_flags(df: DataFrame, bounds: Bounds = IDEAL_BOUNDS, suffix: str = "_Out") -> DataFrame:
    """Adds ``<col>_Out``: 1 outside ``[low, high]``, 0 inside or NULL."""
    return df.select("*", *[outside(c, lo, hi).alias(c + suffix) for c, (lo, hi) in bounds.items()])


def _any_outside(bounds: Bounds) -> Column:
    total = None
    for c, (lo, hi) in bounds.items():
        t = outside(c, lo, hi)
        total = t if total is None else total + t
    return total >= F.lit(1)


def any_out_of_range(df: DataFrame, bounds: Bounds = IDEAL_BOUNDS) -> DataFrame:
    return df.where(_any_outside(bounds))


def _duration(df: DataFrame, bounds: Bounds, minutes_per_record: int) -> list[Column]:
    n = F.count_if(_any_outside(bounds))
    h, m = duration_parts(n, minutes_per_record)
    return [(n * F.lit(minutes_per_record)).alias("minutes_out_of_range"), h.alias("hours"), m.alias("minutes")]


def _extremes(cols, nan_as_null: bool = False) -> list[Column]:
    out = []
    for c in cols:
        v = nan_as_null_col(c) if nan_as_null else F.col(c)
        out += [F.max(v).alias(f"Max_{c}"), F.min(v).alias(f"Min_{c}")]
    return out


def out_of_range_duration(df: DataFrame, bounds: Bounds = IDEAL_BOUNDS, minutes_per_record: int = 1) -> DataFrame:
    """One row: ``minutes_out_of_range`` (one record = ``minutes_per_record`` minutes), and
    the same as whole ``hours`` and remaining ``minutes``."""
    return df.agg(*_duration(df, bounds, minutes_per_record))


def min_max(df: DataFrame, cols, nan_as_null: bool = False) -> DataFrame:
    """One row: ``Max_<c>``, ``Min_<c>`` per column, one aggregation (NaN is the max unless
    ``nan_as_null``)."""
    return df.agg(*_extremes(cols, nan_as_null))


def range_stats(df: DataFrame, bounds: Bounds = IDEAL_BOUNDS, minutes_per_record: int = 1,
                nan_as_null: bool = False) -> DataFrame:
    """Duration and extremes together: one scan, one aggregation."""
    return df.agg(*_duration(df, bounds, minutes_per_record), *_extremes(bounds.keys(), nan_as_null))


def _text(c: Column, double: bool = False) -> Column:
    return F.coalesce(number_text(c) if double else c.cast("string"), F.lit("None"))


def report_lines(stats: DataFrame, bounds: Bounds = IDEAL_BOUNDS, units: Mapping[str, str] = UNITS) -> DataFrame:
    """``range_stats`` row -> report lines ``(line_no, line)``."""
    lines = [F.concat(F.lit("Average Time Out of Ideal: "), _text(F.col("hours")), F.lit(" hours "),
                      _text(F.col("minutes")), F.lit(" minutes"))]
    for c in bounds:
        label = c.replace("_", " ")
        for kind in ("Max", "Min"):
            lines.append(F.concat(F.lit(f"{kind} {label}: "), _text(F.col(f"{kind}_{c}"), stats.schema[f"{kind}_{c}"].dataType.typeName() in ("double", "float")), F.lit(units.get(c, ""))))
    arr = F.array(*[F.struct(F.lit(i + 1).alias("line_no"), ln.alias("line")) for i, ln in enumerate(lines)])
    return stats.select(F.inline(arr))


def aligned_range_stats(parts: Sequence[tuple[DataFrame, Bounds]], on: str = "Time", minutes_per_record: int = 1) -> DataFrame:
    """``range_stats`` of the inner join of ``parts`` on ``on``, without making its rows.

    ``parts``: (readings, bounds of their columns; none where they only take part in the join).
    Every part is summed up per key first: its rows, its rows within all bounds, and the extremes. Of the rows
    that the join would have for a key, those with no value outside are the product of the parts' rows within;
    an extreme over the join is the extreme over the keys that all parts have. So a key with many
    readings on every side is one row of the join, and nothing multiplies."""
    joined = None
    for i, (df, bounds) in enumerate(parts):
        out = _any_outside(bounds) if bounds else F.lit(False)
        own = df.where(F.col(on).isNotNull()).groupBy(on).agg(
            F.count(F.lit(1)).alias(f"_n{i}"), F.count_if(~out).alias(f"_in{i}"), *_extremes(bounds))
        joined = own if joined is None else joined.join(own, on)

    def product(name: str) -> Column:
        total = F.lit(1).cast("decimal(38,0)")
        for i in range(len(parts)):
            total = (total * F.col(f"{name}{i}").cast("decimal(19,0)")).cast("decimal(38,0)")
        return total

    n = F.coalesce(F.sum(product("_n") - product("_in")), F.lit(0)).cast("bigint")
    cols = [c for _, bounds in parts for c in bounds]
    ends = [f(f"{kind}_{c}").alias(f"{kind}_{c}") for c in cols for kind, f in (("Max", F.max), ("Min", F.min))]
    found = joined.agg(n.alias("_n"), *ends)
    h, m = duration_parts("_n", minutes_per_record)
    return found.select((F.col("_n") * F.lit(minutes_per_record)).alias("minutes_out_of_range"), h.alias("hours"), m.alias("minutes"),
                        *[f"{kind}_{c}" for c in cols for kind in ("Max", "Min")])


def range_report(df: DataFrame, bounds: Bounds = IDEAL_BOUNDS, minutes_per_record: int = 1) -> DataFrame:
    return report_lines(range_stats(df, bounds, minutes_per_record), bounds)
