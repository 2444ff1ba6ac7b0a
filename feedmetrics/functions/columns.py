"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``, so it stays
inside whole-stage codegen; nothing here triggers a job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def q(name: str) -> str:
    """Back-quote a column name so a dot (``PM2.5``) is part of the name, not a field access.

    ``q("PM2.5")`` -> "`PM2.5`". An alias-qualified name is two quoted parts:
    ``q("air") + "." + q("Station")``.
    """
    return "`" + name.replace("`", "``") + "`"


def classify_suffix(col: Column | str, rules: Sequence[tuple[Sequence[str], str]], default: str) -> Column:
    """First matching rule wins: ``rules = [(("a", "b"), "label"), ...]``; else ``default``.

    NULL input falls through to ``default`` (``endswith`` on NULL is NULL, never true).
    """
    c = F.col(col) if isinstance(col, str) else col
    out = None
    for suffixes, label in rules:
        cond = None
        for s in suffixes:
            t = c.endswith(s)
            cond = t if cond is None else (cond | t)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def outside(col: Column | str, low: float, high: float) -> Column:
    """1 when the value is strictly below ``low`` or strictly above ``high``, else 0.

    NULL compares as unknown and so counts as in range (0); NaN sorts above every number in
    Spark, so it is flagged as above ``high`` (1).
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.when((c < F.lit(low)) | (c > F.lit(high)), F.lit(1)).otherwise(F.lit(0))


def duration_parts(records: Column | str, minutes_per_record: int = 1) -> tuple[Column, Column]:
    """Record count -> (whole hours, remaining minutes), one record standing for
    ``minutes_per_record`` minutes."""
    c = F.col(records) if isinstance(records, str) else records
    total = (c * F.lit(minutes_per_record)).cast("bigint")
    return F.call_function("div", total, F.lit(60)), F.pmod(total, F.lit(60)).cast("bigint")


def number_text(col: Column | str) -> Column:
    """A double as text: decimal from 1e-4 up to 1e16 (``0.0005``, ``12345678.9``), else with an exponent of two
    digits or more (``1e-05``, ``1.5e+16``); ``nan``, ``inf``, ``-0.0``; NULL for NULL.

    The digits are the fewest that give the number back: 16 where they do, else 17, without zeros at the end."""
    def text(x: Column) -> Column:
        short = F.format_string("%.15e", F.abs(x))
        return F.when(short.try_cast("double") == F.abs(x), short).otherwise(F.format_string("%.16e", F.abs(x)))

    def parts(t: Column) -> Column:
        digits = F.regexp_replace(F.substring_index(t, "e", 1), r"\.?0+$", "")
        return F.struct(digits.alias("digits"), F.substring_index(t, "e", -1).try_cast("int").alias("exponent"))

    def moved(p: Column) -> Column:
        digits, exponent = p.getField("digits"), p.getField("exponent")
        whole, part = digits.substr(1, 1), digits.substr(3, 20)
        rest = F.coalesce(F.nullif(part.substr(exponent + 1, F.lit(20)), F.lit("")), F.lit("0"))
        large = F.concat(whole, F.rpad(part.substr(F.lit(1), exponent), exponent, "0"), F.lit("."), rest)
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), whole, part)
        power = F.lpad(F.abs(exponent).cast("string"), F.when(F.abs(exponent) > 99, 3).otherwise(2), "0")
        science = F.concat(digits, F.lit("e"), F.when(exponent < 0, "-").otherwise("+"), power)
        return F.when((exponent < -4) | (exponent > 15), science).when(exponent < 0, small).otherwise(large)

    def whole(x: Column) -> Column:
        sign = F.when(F.startswith(x.cast("string"), F.lit("-")), "-").otherwise("")
        return (F.when(F.isnan(x), "nan").when(F.abs(x) == float("inf"), F.concat(sign, F.lit("inf")))
                .otherwise(F.concat(sign, bound(text(x), lambda t: bound(parts(t), moved)))))

    return bound((F.col(col) if isinstance(col, str) else col).cast("double"), lambda x: F.when(x.isNotNull(), whole(x)))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def nan_as_null(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def coerce_numeric(text: Column, to: DataType | str) -> Column:
    """Text of a JSON scalar -> number, or NULL.

    A JSON number read into a string field keeps its literal text (``6.55``); a JSON string
    holding a number (``"120"``) arrives without quotes; the non-standard bare ``NaN`` token
    arrives re-quoted (``"NaN"``), hence the quote trim before the cast.
    """
    return F.btrim(text, F.lit('"')).try_cast(to)
