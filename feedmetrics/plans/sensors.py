"""Applications B and C: sensor topics -> alignment -> documents -> out-of-range report."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmetrics import streaming
from feedmetrics.operators import quality, sensors
from feedmetrics.session import fresh_path, stored_rows
from feedmetrics.sinks import write_documents, write_report
from feedmetrics.sources.derived import sensor_messages
from feedmetrics.sources.files import TABLE_SCHEMAS, read_documents, read_table
from feedmetrics.sources.topics import TopicSpec, read_topic
from feedmetrics.streaming import late

TOPICS = ("AIR", "EARTH", "WATER")
ALIASES = {"AIR": "air", "EARTH": "earth", "WATER": "water"}

# Arrivals one after another, and how far behind a reading may be.
ARRIVALS, DELAY = 4, "1 hour"

# Range checks on driver tables beyond the documents (same operators, larger inputs).
EVENT_VALUE_BOUNDS = {"value": (5.0, 40.0)}
LINEITEM_BOUNDS = {"l_quantity": (5.0, 40.0), "l_discount": (0.02, 0.08)}


def topic_messages(spark: SparkSession, sf_dir: str, topic: str, events: DataFrame | None = None) -> DataFrame:
    ev = events if events is not None else read_table(spark, sf_dir, "events")
    return read_topic(spark, TopicSpec(subscribe=(topic,)), stored=sensor_messages(ev, topic))


def parsed(spark: SparkSession, sf_dir: str, topic: str, events: DataFrame | None = None,
           fields=None) -> DataFrame:
    return sensors.parse_envelope(topic_messages(spark, sf_dir, topic, events), sensors.SCHEMAS[topic],
                                  fields=fields)


def aligned(spark: SparkSession, sf_dir: str, fields: dict | None = None) -> DataFrame:
    """Three topics joined on Time; ``fields`` limits what is parsed per topic."""
    f = fields or {}
    return sensors.align_streams([(ALIASES[t], parsed(spark, sf_dir, t, fields=f.get(t))) for t in TOPICS],
                                 on=["Time"])


# What the out-of-range report reads from each topic (Time joins them).
REPORT_TOPIC_FIELDS = {"AIR": ["Time", "Temperature", "Moisture"], "EARTH": ["Time", "pH"], "WATER": ["Time"]}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensors.build_document(aligned(spark, sf_dir))


def report_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's readings, taken from the aligned rows. Equal to parsing the stored
    documents (``doc_roundtrip`` checks that path); only Time, Air Temperature and Moisture and
    Earth pH are parsed from the topic payloads."""
    return aligned(spark, sf_dir, REPORT_TOPIC_FIELDS).select(
        "Time", *[F.col(f"{a.lower()}_{f.split('.')[1]}").alias(n) for n, f in sensors.REPORT_FIELDS.items()
                  for a in [f.split(".")[0]]])


def report_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duration and extremes over the aligned readings, summed up per topic and time before the join."""
    parts = []
    for t in TOPICS:
        own = {n: f.split(".")[1] for n, f in sensors.REPORT_FIELDS.items() if f.split(".")[0].upper() == t}
        rows = parsed(spark, sf_dir, t, fields=REPORT_TOPIC_FIELDS[t]).select("Time", *[F.col(f).alias(n) for n, f in own.items()])
        parts.append((rows, {n: quality.IDEAL_BOUNDS[n] for n in own}))
    return quality.aligned_range_stats(parts)


def parse_air(spark, sf_dir):
    return parsed(spark, sf_dir, "AIR")


def parse_earth(spark, sf_dir):
    return parsed(spark, sf_dir, "EARTH")


def parse_water(spark, sf_dir):
    return parsed(spark, sf_dir, "WATER")


def align3(spark, sf_dir):
    return aligned(spark, sf_dir)


def doc_roundtrip(spark, sf_dir):
    """Documents stored as JSON lines, read back, only the report fields parsed."""
    path = fresh_path(spark, "documents")
    write_documents(documents(spark, sf_dir), path)
    return sensors.flatten(sensors.parse_document(read_documents(spark, path)))


def range_flags(spark, sf_dir):
    return quality.range_flags(report_input(spark, sf_dir))


def range_duration(spark, sf_dir):
    return report_stats(spark, sf_dir).select("minutes_out_of_range", "hours", "minutes")


def range_minmax(spark, sf_dir):
    return report_stats(spark, sf_dir).drop("minutes_out_of_range", "hours", "minutes")


def range_report(spark, sf_dir):
    return quality.report_lines(report_stats(spark, sf_dir))


def report_roundtrip(spark, sf_dir):
    """The report stored as a text file and read back."""
    path = fresh_path(spark, "report")
    write_report(range_report(spark, sf_dir), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def range_duration_events(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("value")
    return quality.out_of_range_duration(ev, EVENT_VALUE_BOUNDS)


def range_stats_lineitem(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(*LINEITEM_BOUNDS)
    s = quality.range_stats(li, LINEITEM_BOUNDS)
    # -0.0 and 0.0 are one value; adding 0.0 gives the extremes one sign for zero.
    return s.select(*[(F.col(c) + F.lit(0.0)).alias(c) if c.startswith(("Max_", "Min_")) else F.col(c)
                      for c in s.columns])


# ---- streams (file-backed topic stream, availableNow) -------------------------------------

def _stream_parsed(spark, sf_dir, topic, events=None):
    """Built in a private ``stream_session`` (state partitions = task slots)."""
    ss = events.sparkSession if events is not None else streaming.stream_session(spark)
    ev = events if events is not None else streaming.table_stream(ss, sf_dir, "events")
    return parsed(ss, sf_dir, topic, events=ev)


def _stream_means(spark, sf_dir, topic):
    means = sensors.running_means(_stream_parsed(spark, sf_dir, topic), sensors.MEAN_COLUMNS[topic])
    path = fresh_path(spark, f"means-{topic.lower()}")
    streaming.run_available_now(means, "table", path, path + "-checkpoint", output_mode="complete",
                                skip_final_cleanup=True)
    return streaming.read_result_table(spark, path)


def stream_means_air(spark, sf_dir):
    return _stream_means(spark, sf_dir, "AIR")


def stream_means_earth(spark, sf_dir):
    return _stream_means(spark, sf_dir, "EARTH")


def stream_means_water(spark, sf_dir):
    return _stream_means(spark, sf_dir, "WATER")


def _stream_aligned(spark, sf_dir):
    ss = streaming.stream_session(spark)
    ev = streaming.table_stream(ss, sf_dir, "events")  # one source feeds all three topics
    return sensors.align_streams([(ALIASES[t], _stream_parsed(spark, sf_dir, t, ev)) for t in TOPICS],
                                 on=["Time"])


def align3_stream(spark, sf_dir):
    path = fresh_path(spark, "aligned")
    streaming.run_available_now(_stream_aligned(spark, sf_dir), "parquet", path, path + "-checkpoint",
                                skip_final_cleanup=True)  # inner join: eviction emits nothing
    return spark.read.parquet(path)


def doc_stream_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "documents-stream")
    docs = sensors.build_document(_stream_aligned(spark, sf_dir))
    streaming.run_available_now(docs, "json", path, path + "-checkpoint", skip_final_cleanup=True)
    return sensors.flatten(sensors.parse_document(read_documents(spark, path)))


def arriving(spark: SparkSession, sf_dir: str, path: str) -> Iterator[DataFrame]:
    """The events in four arrivals in the folder ``path``, one after another, dealt by the event's number, so that every
    arrival spans all times. After each the stream of the folder is given, to be run on what is new: an arrival
    is one micro-batch, of as many files as its rows were read in."""
    ss, ev = streaming.stream_session(spark), read_table(spark, sf_dir, "events")
    for k in range(ARRIVALS):
        ev.where(F.pmod("event_id", F.lit(ARRIVALS)) == k).write.mode("append").parquet(path)
        yield ss.readStream.schema(TABLE_SCHEMAS["events"]).parquet(path)


def late_rows(spark, sf_dir):
    """Each reading of a topic in order of arrival: on time, late (an hour or more behind the latest of the arrivals before its
    own), or without a readable time. The three parts add up to the input."""
    path = fresh_path(spark, "arriving")
    out = path + "-split"
    for ev in arriving(spark, sf_dir, path):
        rows = sensors.parse_envelope(sensor_messages(ev, "WATER"), sensors.SCHEMAS["WATER"], fields=["Time"], keep=["offset"])
        streaming.run_all([late.start_late_split(rows, sensors.read_time(), DELAY, out, out + "-checkpoint")])
    return late.read_split(spark, out, rows.schema).select(F.col("offset").alias("event_id"), "kind")


def stream_reconciled(spark, sf_dir):
    """A stream with a watermark over readings that arrive out of order drops many; reconciling its stored documents
    with the stored readings, twice, gives each missing document once."""
    path = fresh_path(spark, "arriving")
    out = path + "-documents"
    for ev in arriving(spark, sf_dir, path):
        aligned_ = sensors.align_streams([(ALIASES[t], parsed(ev.sparkSession, sf_dir, t, events=ev)) for t in TOPICS], on=["Time"], watermark=DELAY)
        streaming.run_available_now(sensors.build_document(aligned_), "json", out, out + "-checkpoint", skip_final_cleanup=True)
    # A streaming sink's folder lists its own files only: what is added goes to a folder beside it.
    added = out + "-added"
    spark.createDataFrame([], "value string").write.json(added)
    readings = [(ALIASES[t], stored_rows(parsed(spark, sf_dir, t), f"readings-{ALIASES[t]}")) for t in TOPICS]
    for _ in range(2):
        stored = read_documents(spark, out).unionByName(read_documents(spark, added))
        write_documents(sensors.reconcile(readings, stored), added, mode="append")
    return sensors.flatten(sensors.parse_document(read_documents(spark, out).unionByName(read_documents(spark, added))))


def payload_drift(spark, sf_dir):
    """What the sensor payloads have beyond or besides their declared layouts: the feeds also publish a battery level that
    no layout knows, and the wind's direction as text."""
    ev = read_table(spark, sf_dir, "events")
    sent = None
    for t in TOPICS:
        m = sensor_messages(ev, t)
        more = F.concat(F.substring("value", 1, F.length("value") - 1), F.lit(',"Battery":'), (F.col("offset") % 100).cast("string"), F.lit("}"))
        m = m.select("topic", F.when(F.col("offset") % 97 == 0, F.col("value")).otherwise(more).alias("value")) if t == "EARTH" else m.select("topic", "value")
        sent = m if sent is None else sent.unionByName(m)
    return sensors.payload_drift(sent, sensors.SCHEMAS)


QUERIES = {f.__name__: f for f in (
    payload_drift, late_rows, stream_reconciled, parse_air, parse_earth, parse_water, align3, doc_roundtrip, range_flags, range_duration,
    range_minmax, range_report, report_roundtrip, range_duration_events, range_stats_lineitem,
    stream_means_air, stream_means_earth, stream_means_water, align3_stream, doc_stream_roundtrip)}
