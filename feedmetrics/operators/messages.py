"""Rows <-> topic messages: JSON payloads, round-robin partitions, malformed payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, FloatType, MapType, NumericType, StringType

from feedmetrics.functions.columns import q


def to_messages(df: DataFrame, columns: Sequence[str] | None = None, blanks: str = "nan", booleans: str = "text") -> Column:
    """JSON object of the row: numbers stay JSON numbers, every other value (booleans, time
    stamps, dates, text) becomes a JSON string.

    ``blanks="nan"`` publishes a NULL float or double as NaN, as a CSV producer does that reads
    a blank cell as NaN (``to_json`` writes it as the string "NaN", which parses back to NaN);
    ``blanks="omit"`` leaves it out. Other NULL fields are left out. ``booleans="text"`` writes
    ``"True"`` / ``"False"``; ``booleans="json"`` keeps JSON booleans."""
    if blanks not in ("nan", "omit") or booleans not in ("text", "json"):
        raise ValueError("blanks is 'nan' or 'omit', booleans is 'text' or 'json'")
    fields = []
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        c = F.col(q(f.name))
        if isinstance(f.dataType, (FloatType, DoubleType)) and blanks == "nan":
            c = F.coalesce(c, F.lit(float("nan")))
        elif isinstance(f.dataType, BooleanType) and booleans == "text":
            c = F.when(c, "True").when(~c, "False")
        elif not isinstance(f.dataType, (NumericType, BooleanType, StringType)):
            c = c.cast("string")
        fields.append(c.alias(f.name))
    return F.to_json(F.struct(*fields))


def with_positions(df: DataFrame, order_by: Sequence[str], name: str = "position",
                   partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order_by`` order (keys should be unique), computed
    without moving all rows into one task:

    range-partition and sort by the keys, number rows inside each partition, count rows per
    partition (one row per partition), turn the counts into offsets, add them back (a
    broadcast of one row per partition).

    The numbered rows are checkpointed (reliable checkpoint in the shared
    ``spark.checkpoint.dir``) before they are counted: range bounds come from a seeded
    sample, so two evaluations of the range shuffle may cut at different keys, and a
    recomputation after a lost executor must not renumber anything. Since partition ids and
    row numbers are fixed in the same stage and then stored, adaptive execution may size the
    range partitions freely (merging neighbours keeps the order); ``partitions`` fixes the
    count instead.
    """
    from feedmetrics.session import work_dir

    spark = df.sparkSession
    work_dir(spark)  # makes sure a checkpoint folder is registered
    keys = [F.col(q(c)) for c in order_by]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    tagged = (ranged.sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    per = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = per.select("_pid", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    pos = (F.col("_off") + F.col("_mid") - F.col("_first")).alias(name)
    return tagged.join(F.broadcast(offsets), "_pid").select(*[F.col(q(c)) for c in df.columns], pos)


def with_file_positions(df: DataFrame, name: str = "position") -> DataFrame:
    """0-based position of each row of a file scan, in the order of file name and place in the file.

    No shuffle and no copy of the rows: a task reads a split's rows one after another, so a row's
    number within its split is its number in the task less the split's first; the rows before
    the split come from one aggregated row per split, which is broadcast. The scan is read twice
    (the first time without its columns); both reads cut the files into the same splits."""
    split = ["_file", "_start"]
    tagged = (df.withColumn("_file", F.col("_metadata.file_path")).withColumn("_start", F.col("_metadata.file_block_start"))
              .withColumn("_mid", F.monotonically_increasing_id()))
    per = tagged.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    offsets = per.select(*split, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    pos = (F.col("_off") + F.col("_mid") - F.col("_first")).alias(name)
    return tagged.join(F.broadcast(offsets), split).select(*[F.col(q(c)) for c in df.columns], pos)


def assign_partition(df: DataFrame, n: int, order_by: Sequence[str] | None, name: str = "partition") -> DataFrame:
    """Round robin over ``n`` partitions by row position: ``position mod n``. Without ``order_by``
    (``df`` is then a file scan) the position is the place in the files."""
    p = with_positions(df, order_by, "_position") if order_by is not None else with_file_positions(df, "_position")
    return p.withColumn(name, F.pmod(F.col("_position"), F.lit(n)).cast("int")).drop("_position")


def _is_object(text: Column) -> Column:
    """Whether ``text`` is exactly one JSON object, by one parse.

    The parser stops at the end of the first value and so would accept text after it. The payload is therefore
    parsed as the first element of a list whose second is a mark made from the payload's own hash: text
    that closes the list early never reaches the mark, and cannot hold it."""
    mark = F.xxhash64(text).cast("string")
    listed = F.from_json(F.concat(F.lit("["), text, F.lit(',{"mark":"'), mark, F.lit('"}]')), ArrayType(MapType(StringType(), StringType())),
                         {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})
    # The lambda's variable is the parsed list: it is looked at three times and parsed once.
    one = F.transform(F.array(listed), lambda x: (F.size(x) == 2) & F.get(x, F.lit(0)).isNotNull() & (F.try_element_at(F.get(x, F.lit(1)), F.lit("mark")) == mark))
    return F.coalesce(text.rlike(r"^\s*\{") & F.get(one, F.lit(0)), F.lit(False))


def malformed_flag(df: DataFrame, col: str = "value", name: str = "malformed") -> DataFrame:
    """Adds boolean ``malformed``: the payload is NULL, blank or not exactly one JSON object."""
    return df.withColumn(name, ~_is_object(F.col(col).cast("string")))


def reject_reason(df: DataFrame, col: str = "value", name: str = "reason") -> DataFrame:
    """Adds why a payload is rejected, NULL where it is not: ``missing`` (NULL), ``blank``, ``not an object`` (does not
    begin with a brace), ``trailing text`` (an object with something after it), ``cut off`` (does not end with
    a brace), ``malformed`` (anything else). Only rejected payloads are parsed a second time."""
    text = F.col(col).cast("string")
    first = F.from_json(text, MapType(StringType(), StringType()), {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})
    reason = (F.when(text.isNull(), "missing").when(_is_object(text), F.lit(None)).when(F.btrim(text, F.lit(" \t\r\n")) == "", "blank").when(~text.rlike(r"^\s*\{"), "not an object")
              .when(first.isNotNull(), "trailing text").when(~text.rlike(r"\}\s*$"), "cut off").otherwise("malformed"))
    return df.withColumn(name, reason)


MESSAGE_KEY = ("topic", "partition", "offset")


def replay(corrected: DataFrame, stored: DataFrame, rejected: DataFrame, col: str = "value", key: Sequence[str] = MESSAGE_KEY) -> DataFrame:
    """The corrected messages to store now: well-formed ones for places that were rejected and are not stored yet.

    Of several corrections of one place the latest (``timestamp``, then payload) counts. Storing the result and replaying
    again gives nothing, so a replay may be repeated after a failure."""
    keys = [F.col(q(k)) for k in key]
    # Only what is due is parsed and grouped: the places, a small part of all messages, come first.
    due = rejected.select(*keys).distinct().join(stored.select(*keys), list(key), "left_anti")
    good = malformed_flag(corrected.join(due, list(key), "left_semi"), col, "_bad").where(~F.col("_bad")).drop("_bad")
    order = [F.col(c) for c in ("timestamp", col) if c in corrected.columns]
    last = good.groupBy(*keys).agg(F.max(F.struct(*order, F.struct("*").alias("_row"))).alias("_last")).select("_last._row.*")
    return last.select(*corrected.columns)


def split_malformed(df: DataFrame, col: str = "value", path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(well-formed, malformed); the bad side is what a consumer reports instead of storing. With ``path`` the flagged
    messages are stored there first, so that both sides together make and parse each payload once."""
    t = malformed_flag(df, col, "_bad")
    if path is not None:
        t.write.parquet(path)
        t = df.sparkSession.read.schema(t.schema).parquet(path)
    return t.where(~F.col("_bad")).drop("_bad"), t.where(F.col("_bad")).drop("_bad")


def malformed_counts(df: DataFrame, by: str = "topic", col: str = "value") -> DataFrame:
    """Per ``by``: ``good`` and ``bad`` message counts, in one pass."""
    t = malformed_flag(df, col, "_bad")
    return t.groupBy(by).agg(F.count_if(~F.col("_bad")).alias("good"), F.count_if(F.col("_bad")).alias("bad"))
