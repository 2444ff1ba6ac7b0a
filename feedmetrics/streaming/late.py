"""Late rows kept aside, and what stateful queries drop made visible.

A watermark drops the rows that arrive too late without a trace. ``start_late_split`` decides before the stateful query:
each micro-batch is stored in three parts, ``on_time`` (what the query should read), ``late`` and ``untimed`` (no
readable time), so that the three add up to the input. The limit of a batch is the latest time of the batches
before it, less the delay, as for Spark's watermark; it is kept per batch, so a batch that is run again
is split the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import LongType, StringType, StructField, StructType

from feedmetrics.streaming import AVAILABLE_NOW

LIMITS = "latest timestamp, epoch bigint"
KINDS = ("on_time", "late", "untimed")


def start_late_split(stream: DataFrame, time: Column, delay: str, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Stores the rows of ``stream`` under ``out``/rows/epoch=<batch>/kind=<kind>. ``time`` is their event time (a
    timestamp), ``delay`` an interval (``"1 hour"``)."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        kind = F.when(time.isNull(), "untimed")
        limit = limit_before(spark, f"{out}/limits", epoch_id, delay)
        if limit is not None:
            kind = kind.when(time <= F.lit(limit), "late")
        path = f"{out}/rows/epoch={epoch_id}"
        batch.withColumn("kind", kind.otherwise("on_time")).write.mode("overwrite").partitionBy("kind").parquet(path)
        stored = spark.read.schema(batch.schema).parquet(path)
        stored.agg(F.max(time).alias("latest")).write.mode("overwrite").parquet(f"{out}/limits/epoch={epoch_id}")  # one row

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE_NOW)).start()


def limit_before(spark: SparkSession, path: str, epoch_id: int, delay: str):
    """The limit of a batch: the latest time before it less ``delay``; None for the first."""
    if epoch_id == 0:
        return None
    known = spark.read.schema(LIMITS).parquet(path).where(F.col("epoch") < epoch_id)
    return known.agg((F.max("latest") - F.expr(f"interval {delay}")).alias("limit")).first()["limit"]


def read_split(spark: SparkSession, out: str, schema: StructType, kind: str | None = None) -> DataFrame:
    """The stored rows, of one kind or of all with their ``kind``. A streaming session's ``readStream`` with the same
    layout can read ``out``/rows on."""
    if kind is not None and kind not in KINDS:
        raise ValueError(f"kind is one of {KINDS}")
    layout = StructType([*schema.fields, StructField("epoch", LongType()), StructField("kind", StringType())])
    rows = spark.read.schema(layout).parquet(f"{out}/rows").drop("epoch")
    return rows if kind is None else rows.where(F.col("kind") == kind).drop("kind")


class StateListener(StreamingQueryListener):
    """Tells ``record`` for every micro-batch how many rows its stateful operators dropped as late, how many rows of state they
    hold and the memory of these: ``{"query", "batch", "dropped", "state_rows", "state_bytes"}``."""

    def __init__(self, record: Callable[[dict], None]):
        self.record = record

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.record({"query": p.name or str(p.id), "batch": p.batchId, "dropped": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
                     "state_rows": sum(s.numRowsTotal for s in p.stateOperators), "state_bytes": sum(s.memoryUsedBytes for s in p.stateOperators)})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
