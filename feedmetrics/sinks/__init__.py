"""Batch sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmetrics.sources.topics import TopicSpec


def write_documents(docs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines ``{"value": "<document json>"}``."""
    docs.select("value").write.mode(mode).json(path)


def write_report(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Report lines ``(line_no, line)`` as one text file, one line per row, in order.

    The report is a handful of rows, so one output file is bounded."""
    lines.orderBy("line_no").select("line").coalesce(1).write.mode(mode).text(path)


def route_to_csv(df: DataFrame, path: str, by: Sequence[str] = ("topic", "partition"), mode: str = "append",
                 rows_per_file: int | None = None) -> None:
    """One CSV folder per ``by`` value (``topic=AIR/partition=0/``), header in every file.

    ``mode="overwrite"`` starts clean; ``append`` adds files next to earlier runs. Every task writes a file into each folder it
    has rows for; with ``rows_per_file`` the rows are first dealt by folder, and a folder with more rows by a number
    within it, so that a folder has about one file per ``rows_per_file`` rows and a large one is still many tasks."""
    if rows_per_file:
        sizes = df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
        key = F.struct(*[F.col(c) for c in by])
        sizes = sizes.select(key.alias("_folder"), "_files")
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns], F.monotonically_increasing_id()), F.col("_files"))
        dealt = df.withColumn("_key", key).join(sizes, F.col("_key").eqNullSafe(F.col("_folder")), "left").drop("_key", "_folder")
        dealt = dealt.withColumn("_salt", F.coalesce(salt, F.lit(0)))
        df = dealt.repartition(*by, "_salt").select(df.columns)
    limit = {"maxRecordsPerFile": str(rows_per_file)} if rows_per_file else {}
    df.write.mode(mode).partitionBy(*by).options(header=True, **limit).csv(path)


def publish(messages: DataFrame, spec: TopicSpec) -> None:
    """Write ``(topic, partition, value[, key])`` rows to Kafka (needs the Kafka connector)."""
    cols = [c for c in ("key", "value", "topic", "partition") if c in messages.columns]
    (messages.select(*[F.col(c) for c in cols]).write.format("kafka")
     .option("kafka.bootstrap.servers", spec.bootstrap_servers).save())
