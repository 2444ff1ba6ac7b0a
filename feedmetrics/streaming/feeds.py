"""A running feed as topic messages: row positions carried over micro-batches.

The producer numbers a feed's rows as it reads them and deals them round robin. As a stream each micro-batch
holds some new files: a row's position is the rows of its feed in earlier batches, plus those of the
batch's earlier files and splits, plus its place in the split. Only row counts are carried, one per feed and
batch, in a table beside the output; a batch that is run again after a failure reads the counts of the
batches before it and so gives the same positions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedmetrics.functions.columns import q
from feedmetrics.streaming import AVAILABLE_NOW

COUNTS = "feed string, rows bigint, epoch bigint"
_TAGS = ("_feed", "_file", "_start")


def with_split(stream: DataFrame, feed: Column | str | None = None) -> DataFrame:
    """The rows of a file stream with the feed they belong to (one for all by default), their file and split."""
    name = F.lit("") if feed is None else F.col(feed) if isinstance(feed, str) else feed
    return stream.select("*", name.cast("string").alias("_feed"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))


def batch_positions(batch: DataFrame, before: DataFrame, name: str = "position") -> tuple[DataFrame, DataFrame]:
    """(the batch's rows with their positions, its number of rows per feed). ``before``: (feed, rows) of earlier batches.

    No shuffle of the rows: they are numbered per split as they are read, and joined with one row per split."""
    tagged = batch.withColumn("_mid", F.monotonically_increasing_id())
    per = tagged.groupBy(*_TAGS).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    earlier = F.sum("_n").over(Window.partitionBy("_feed").orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1))  # one row per split
    carried = before.groupBy(F.col("feed").alias("_feed")).agg(F.sum("rows").alias("_before"))
    offsets = (per.withColumn("_off", F.coalesce(earlier, F.lit(0))).join(carried, "_feed", "left")
               .select(*_TAGS, "_first", (F.col("_off") + F.coalesce("_before", F.lit(0))).alias("_off")))
    position = (F.col("_off") + F.col("_mid") - F.col("_first")).alias(name)
    rows = tagged.join(F.broadcast(offsets), list(_TAGS)).select(*[F.col(q(c)) for c in batch.columns if c not in _TAGS], position)
    return rows, per.groupBy(F.col("_feed").alias("feed")).agg(F.sum("_n").alias("rows"))


def store_messages(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that keeps each batch's messages in a folder of its own (written anew when the batch is run again)."""
    def write(messages: DataFrame, epoch_id: int) -> None:
        messages.write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")
    return write


def start_feed(stream: DataFrame, message: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, partitions: int = 2,
               feed: Column | str | None = None, sink: Callable[[DataFrame, int], None] | None = None,
               trigger: dict | None = None) -> StreamingQuery:
    """Publishes the rows of a file stream: ``partition`` = position in the feed mod ``partitions``; ``message`` makes the
    messages of rows with ``position`` and ``partition``; ``sink`` stores a batch of them (default:
    ``out``/messages; pass one that calls ``sinks.publish`` for Kafka)."""
    keep = sink or store_messages(f"{out}/messages")

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        before = counts_before(spark, f"{out}/counts", epoch_id)
        rows, counts = batch_positions(batch, before)
        counts.coalesce(1).write.mode("overwrite").parquet(f"{out}/counts/epoch={epoch_id}")  # a row per feed
        keep(message(rows.withColumn("partition", F.pmod("position", F.lit(partitions)).cast("int"))), epoch_id)

    return (with_split(stream, feed).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or AVAILABLE_NOW)).start())


def counts_before(spark: SparkSession, path: str, epoch_id: int) -> DataFrame:
    """(feed, rows) of the batches before ``epoch_id``."""
    if epoch_id == 0:
        return spark.createDataFrame([], COUNTS).select("feed", "rows")
    return spark.read.schema(COUNTS).parquet(path).where(F.col("epoch") < epoch_id).select("feed", "rows")
