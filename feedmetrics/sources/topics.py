"""Topic sources: Kafka when the connector is on the class path, stored messages otherwise.

``TopicSpec`` only builds the reader options; the same spec drives a batch read of stored
messages (parquet with the Kafka column layout) so that tests run without a broker.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Column layout of the Kafka source (value and key are binary there; stored messages may
# carry them as text).
KAFKA_SCHEMA = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


@dataclass(frozen=True)
class TopicSpec:
    bootstrap_servers: str = ""
    subscribe: tuple[str, ...] = ()
    assign: dict[str, list[int]] = field(default_factory=dict)
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    max_records_per_partition: int | None = None

    def options(self) -> dict[str, str]:
        """Kafka reader options (``subscribe`` xor ``assign``)."""
        if bool(self.subscribe) == bool(self.assign):
            raise ValueError("give exactly one of subscribe or assign")
        opts = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.subscribe:
            opts["subscribe"] = ",".join(self.subscribe)
        else:
            parts = ",".join(f'"{t}":[{",".join(str(p) for p in ps)}]' for t, ps in sorted(self.assign.items()))
            opts["assign"] = "{" + parts + "}"
        if self.max_offsets_per_trigger is not None:
            opts["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        # More tasks than topic partitions: the reader splits offset ranges.
        if self.min_partitions is not None:
            opts["minPartitions"] = str(self.min_partitions)
        if self.max_records_per_partition is not None:
            opts["maxRecordsPerPartition"] = str(self.max_records_per_partition)
        return opts

    def restrict(self, messages: DataFrame) -> DataFrame:
        """Apply the spec to stored messages: topic list, or (topic, partition) pins."""
        if self.subscribe:
            return messages.where(F.col("topic").isin(list(self.subscribe)))
        cond = None
        for t, ps in sorted(self.assign.items()):
            c = (F.col("topic") == F.lit(t)) & F.col("partition").isin(list(ps))
            cond = c if cond is None else (cond | c)
        return messages.where(cond)


def read_topic(spark: SparkSession, spec: TopicSpec, stream: bool = True,
               stored: DataFrame | None = None) -> DataFrame:
    """Messages of the topics in ``spec``.

    With ``stored`` (a DataFrame of messages in the Kafka layout) the spec filters it, which is
    how tests and the registered queries run. Otherwise the Kafka source is used; it needs the
    ``spark-sql-kafka`` package on the class path.
    """
    if stored is not None:
        return spec.restrict(stored)
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**spec.options()).load()


def offset_gaps(messages: DataFrame, chunk: int = 1_000_000) -> DataFrame:
    """Runs of offsets that are missing between the messages of a topic's partition: ``topic, partition, first_missing,
    last_missing, missing``. With ``fail_on_data_loss`` off a reader goes on past lost offsets; this shows them.

    Offsets are taken in chunks of ``chunk``, so a partition with most messages is many tasks: gaps within a chunk come from its
    own neighbours, those across chunks from the first and last offset of each (a row per chunk)."""
    place = ["topic", "partition"]
    rows = messages.select(*place, "offset", F.floor(F.col("offset") / F.lit(chunk)).alias("chunk"))
    inside = rows.withColumn("before", F.lag("offset").over(Window.partitionBy(*place, "chunk").orderBy("offset")))
    ends = rows.groupBy(*place, "chunk").agg(F.min("offset").alias("offset"), F.max("offset").alias("last"))
    across = ends.withColumn("before", F.lag("last").over(Window.partitionBy(*place).orderBy("chunk")))
    both = inside.select(*place, "offset", "before").unionByName(across.select(*place, "offset", "before")).where("offset - before > 1")
    return both.select(*place, (F.col("before") + 1).alias("first_missing"), (F.col("offset") - 1).alias("last_missing"), (F.col("offset") - F.col("before") - 1).alias("missing"))
