"""Application D: a row feed published as topic messages, and messages routed to CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmetrics import streaming
from feedmetrics.operators import messages
from feedmetrics.plans.sensors import TOPICS
from feedmetrics.session import fresh_path
from feedmetrics.sinks import route_to_csv
from feedmetrics.sources.derived import sensor_messages
from feedmetrics.sources.files import read_feed, read_table
from feedmetrics.sources.topics import TopicSpec, read_topic
from feedmetrics.sources.topics import offset_gaps as find_offset_gaps
from feedmetrics.streaming import feeds

PARTITIONS = 2
FEED_TOPICS = ("view", "click", "purchase", "signup", "error")
FEED_SCHEMA = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed rows (``events``), each to be published on the topic named by its type."""
    return read_table(spark, sf_dir, "events")


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages, dealt round robin in the order of the feed's file, without a shuffle of the rows."""
    rows = messages.assign_partition(feed(spark, sf_dir), PARTITIONS, order_by=None)
    return as_messages(rows)


def as_messages(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("event_type").alias("topic"), "partition",
                       messages.to_messages(rows, ["event_id", "ts", "user_id", "event_type", "value", "props"])
                       .alias("value"))


def feed_to_messages(spark, sf_dir):
    return published(spark, sf_dir)


def feed_file_positions(spark, sf_dir):
    """Each row's place in the feed's file."""
    return messages.with_file_positions(feed(spark, sf_dir)).select("event_id", "position")


def partition_slice(spark, sf_dir):
    spec = TopicSpec(assign={t: [0] for t in FEED_TOPICS})
    return read_topic(spark, spec, stream=False, stored=published(spark, sf_dir))


def route_counts(spark, sf_dir):
    """Every message stored once as a CSV row under ``topic=<t>/partition=<p>/``, read back."""
    msgs = published(spark, sf_dir)
    rows = msgs.select("topic", "partition", F.from_json("value", FEED_SCHEMA).alias("m")).select(
        "topic", "partition", "m.*")
    path = fresh_path(spark, "routed")
    route_to_csv(rows, path, by=("topic", "partition"), mode="overwrite")
    back = read_feed(spark, path, FEED_SCHEMA + ", topic string, partition int")
    return back.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("records"))


def malformed_split(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    stored = None
    for t in TOPICS:
        m = sensor_messages(ev, t)
        stored = m if stored is None else stored.unionByName(m)
    return messages.malformed_counts(stored, by="topic")


def malformed_rows(spark, sf_dir):
    """Per message whether it is malformed: text after the object, single quotes, blank, two
    objects, cut off, NULL, and well-formed ones."""
    rows = feed(spark, sf_dir)
    good, k = messages.to_messages(rows, ["event_id", "user_id", "event_type"]), F.col("event_id") % 8
    value = (F.when(k == 0, F.concat(good, F.lit(" xyz"))).when(k == 1, F.lit("{'a': 1}")).when(k == 2, F.lit("  "))
             .when(k == 3, F.concat(good, good)).when(k == 4, F.substring(good, 1, 9)).when(k == 5, F.lit(None)).otherwise(good))
    return messages.malformed_flag(rows.select("event_id", value.alias("value"))).select("event_id", "malformed")


def feed_blank_cells(spark, sf_dir):
    """A CSV feed with blank cells: published as NaN, and read as NaN by the parser."""
    path, schema = fresh_path(spark, "blank-cells"), "event_id bigint, value double"
    blank = F.when(F.col("event_id") % 5 != 0, F.col("value"))
    feed(spark, sf_dir).select("event_id", blank.alias("value")).write.option("header", True).csv(path)
    rows = read_feed(spark, path, schema)
    read = rows.select(messages.to_messages(rows).alias("value")).select(F.from_json("value", schema).alias("m")).select("m.*")
    return read.select("event_id", F.isnan("value").alias("blank"), F.nanvl("value", F.lit(None).cast("double")).alias("value"))


def consume_roundtrip(spark, sf_dir):
    """The consumer end to end as a stream: one pinned partition, good and rejected messages
    stored as CSV and read back."""
    from feedmetrics.apps import consume_partition

    ss = streaming.stream_session(spark)
    stored = sensor_messages(streaming.table_stream(ss, sf_dir, "events"), "WATER")
    path, schema = fresh_path(spark, "consumed"), "Time string, Station string, pH double, DO double, Temperature double, Salinity double"
    streaming.run_all(consume_partition(ss, TopicSpec(assign={"WATER": [0]}), f"{path}/good", f"{path}/checkpoint",
                                        trigger=streaming.AVAILABLE_NOW, stored=stored, schema=schema, rejects_path=f"{path}/bad"))
    good = read_feed(spark, f"{path}/good", schema + ", topic string, partition int").select(F.lit("good").alias("kind"), "partition", "Time", "Station", "pH")
    bad = read_feed(spark, f"{path}/bad", "value string, topic string, partition int")
    return good.unionByName(bad.select(F.lit("bad").alias("kind"), "partition"), allowMissingColumns=True)


def overwrite_twice(spark, sf_dir):
    """A second run with ``mode="overwrite"``, with the rows dealt the other way, leaves only its own rows."""
    path = fresh_path(spark, "overwritten")
    rows = feed(spark, sf_dir).select("event_id", F.col("event_type").alias("topic"))
    for shift in (0, 1):
        partition = F.pmod(F.col("event_id") + shift, F.lit(PARTITIONS)).cast("int")
        route_to_csv(rows.withColumn("partition", partition), path, mode="overwrite")
    return read_feed(spark, path, "event_id bigint, topic string, partition int")


def reject_reasons(spark, sf_dir):
    """Why payloads are rejected, per reason, over messages of every kind of damage."""
    return messages.reject_reason(damaged(spark, sf_dir)).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


def damaged(spark, sf_dir):
    """Messages of the feed, most of them damaged in one of seven ways by the event's number."""
    rows = feed(spark, sf_dir)
    good, k = messages.to_messages(rows, ["event_id", "user_id", "event_type"]), F.col("event_id") % 8
    value = (F.when(k == 0, F.concat(good, F.lit(" xyz"))).when(k == 1, F.lit("{'a': 1}")).when(k == 2, F.lit("  "))
             .when(k == 3, F.concat(good, good)).when(k == 4, F.substring(good, 1, 9)).when(k == 5, F.lit(None)).when(k == 6, F.concat(F.lit("["), good, F.lit("]"))).otherwise(good))
    return rows.select("event_id", value.alias("value"))


def replay_once(spark, sf_dir):
    """Rejected sensor messages are corrected and replayed twice; each is stored once."""
    ev = read_table(spark, sf_dir, "events")
    sent = [sensor_messages(ev, t) for t in TOPICS]
    arrived = sent[0].unionByName(sent[1]).unionByName(sent[2])
    good, bad = messages.split_malformed(arrived, path=fresh_path(spark, "arrived"))
    whole = [sensor_messages(ev, t, truncated=False) for t in TOPICS]
    corrected = whole[0].unionByName(whole[1]).unionByName(whole[2])
    path, kept = fresh_path(spark, "replayed"), ["topic", "partition", "offset", "value"]
    good.select(kept).write.parquet(path)
    for _ in range(2):
        stored = spark.read.schema("topic string, partition int, offset bigint, value string").parquet(path)
        # An append to the folder that is being read: the plan's files are listed before it begins.
        messages.replay(corrected, stored, bad).select(kept).write.mode("append").parquet(path)
    return spark.read.parquet(path).select("topic", "partition", "offset", F.get_json_object("value", "$.Time").alias("time"))


def feed_stream_messages(spark, sf_dir):
    """The feed published as a stream, in two files that arrive one after another, with a restart in between."""
    path = fresh_path(spark, "feed-stream")
    ss, rows = streaming.stream_session(spark), feed(spark, sf_dir)
    half = rows.agg(F.expr("percentile_approx(event_id, 0.5, 1000)").alias("m")).first()["m"]
    for part in (F.col("event_id") <= half, F.col("event_id") > half):
        rows.where(part).sortWithinPartitions("event_id").coalesce(1).write.mode("append").parquet(f"{path}/feed")
        stream = ss.readStream.schema(rows.schema).parquet(f"{path}/feed")
        streaming.run_all([feeds.start_feed(stream, as_messages, path, f"{path}/checkpoint", PARTITIONS)])
    return spark.read.parquet(f"{path}/messages").drop("epoch")


def offset_gaps(spark, sf_dir):
    """Runs of offsets that a topic's partition lacks: topic and partition of the feed's events, the event's number as offset."""
    rows = feed(spark, sf_dir).select(F.col("event_type").alias("topic"), F.pmod("user_id", F.lit(PARTITIONS)).cast("int").alias("partition"), F.col("event_id").alias("offset"))
    return find_offset_gaps(rows, chunk=1000)


QUERIES = {f.__name__: f for f in (feed_stream_messages, offset_gaps, feed_to_messages, feed_file_positions, partition_slice, reject_reasons, replay_once, route_counts, malformed_split, malformed_rows,
                                   feed_blank_cells, consume_roundtrip, overwrite_twice)}
