"""The reference's four applications as functions over real inputs (files, topics).

The registered queries in ``feedmetrics.plans`` run the same operators on inputs derived from
the driver tables; these functions take the production inputs instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmetrics import streaming
from feedmetrics.operators import cache, logs, lookup, messages, quality, sensors, stats
from feedmetrics.sinks import publish, write_report
from feedmetrics.sources import TopicSpec, read_dictionary, read_documents, read_feed, read_log_lines, read_topic
from feedmetrics.streaming.environment import start_environment_queries


def log_report(spark: SparkSession, log_path: str, dictionary_path: str, cities: Sequence[str] = (),
               on_duplicate: str = "last", dictionary_order: str | None = None) -> dict[str, DataFrame]:
    """Application A over a log file and an IP dictionary file: every report as a DataFrame.

    The dictionary is ``ip,region,city,isp`` lines. With ``on_duplicate="last"`` a later line
    wins; Spark keeps no line order across file splits, so the order is the dictionary's
    ``dictionary_order`` column when given, else its file name and position in the file."""
    lines = read_log_lines(spark, log_path).withColumn("line_id", F.monotonically_increasing_id())
    timed = logs.parse_log(lines)  # only the first-10 figures read the time
    parsed = logs.parse_log(lines, with_time=False)
    valid = logs.valid_records(parsed)
    d = read_dictionary(spark, dictionary_path)
    if on_duplicate == "last" and dictionary_order is None:
        d = d.withColumn("_file", F.col("_metadata.file_path")).withColumn("_pos", F.monotonically_increasing_id())
        order = ["_file", "_pos"]
    else:
        order = [dictionary_order] if dictionary_order else None
    enriched = lookup.enrich(valid, d, on_duplicate=on_duplicate, order_by=order)
    with_status = logs.with_cache_status(valid)
    out = {
        # all global figures in one scan; the single-figure frames below are kept for parity
        "overview": logs.overview(parsed),
        "valid_count": stats.count_rows(valid),
        "invalid_count": stats.count_rows(logs.invalid_records(parsed)),
        "valid_first10": stats.first_k(logs.valid_records(timed).select("line_id", "ts_ms", F.col("value").alias("line")),
                                       ["ts_ms", "line_id"], 10),
        "invalid_first10": stats.first_k(logs.invalid_records(timed).select(
            "line_id", "ts_ms", F.col("value").alias("line")), ["ts_ms", "line_id"], 10),
        "service_counts": stats.count_by(logs.with_service(valid), "service"),
        "unique_clients": stats.distinct_count(valid, "ip", name="unique_clients"),
        "enriched": enriched,
        "providers": stats.distinct_values(enriched, "isp"),
        "latency_summary": stats.summary(valid, "latency"),
        "latency_median": stats.median_disc(valid, "latency"),
        "latency_top2": stats.kth_largest(valid, "latency", 2),
        "cache_counts": cache.status_counts(with_status),
        "hit_rate": cache.hit_rate(with_status),
        "isp_cache": cache.hit_rate_by(enriched, "isp"),
    }
    out["best_isp"] = stats.argmax_ties(out["isp_cache"], "rate").select("isp", "rate")
    for c in cities:
        sel = enriched.where(F.col("city") == F.lit(c))
        out[f"city_count:{c}"] = stats.count_rows(sel)
        out[f"city_traffic:{c}"] = stats.traffic(sel)
    return out


def environment_job(spark: SparkSession, topics: Mapping[str, TopicSpec], out_root: str, checkpoint_root: str,
                    trigger: dict | None = None, watermark: str | None = None, console: bool = False):
    """Application B: read the AIR, EARTH and WATER topics, keep running means and store the
    aligned documents. Returns the started queries; wait with ``streaming.run_all``."""
    own = streaming.stream_session(spark)  # state partitions fit the cluster, not batch shuffles
    frames = {name: read_topic(own, spec, stream=True) for name, spec in topics.items()}
    return start_environment_queries(frames, out_root, checkpoint_root, trigger=trigger, watermark=watermark,
                                     console=console)


def range_report_job(spark: SparkSession, documents_path: str, report_path: str | None = None,
                     bounds: Mapping[str, tuple[float, float]] = quality.IDEAL_BOUNDS, mode: str = "errorifexists") -> DataFrame:
    """Application C: the out-of-range report over stored documents (one scan, one
    aggregation). Written as text when ``report_path`` is given; the lines are returned."""
    flat = sensors.flatten(sensors.parse_document(read_documents(spark, documents_path)))
    lines = quality.range_report(flat, bounds)
    if report_path:
        write_report(lines, report_path, mode)
    return lines


def feed_messages(spark: SparkSession, csv_path: str, schema: str, topic: str, partitions: int = 2,
                  order_by: Sequence[str] | None = None) -> DataFrame:
    """Application D, producer side: CSV feed rows -> ``(topic, partition, value)`` messages,
    partition = row position mod ``partitions``. ``order_by`` gives the row order (default: the
    file and the position in it)."""
    rows = read_feed(spark, csv_path, schema)
    p = messages.assign_partition(rows, partitions, None if order_by is None else list(order_by))
    return p.select(F.lit(topic).alias("topic"), "partition", messages.to_messages(p, rows.columns).alias("value"))


def publish_feed(spark: SparkSession, csv_path: str, schema: str, topic: str, spec: TopicSpec,
                 partitions: int = 2) -> None:
    publish(feed_messages(spark, csv_path, schema, topic, partitions), spec)


def consume_partition(spark: SparkSession, spec: TopicSpec, out_path: str, checkpoint: str,
                      trigger: dict | None = None, stored: DataFrame | None = None, schema: str | None = None,
                      rejects_path: str | None = None):
    """Application D, consumer side: messages of the pinned partitions, well-formed ones
    stored as CSV under ``topic=<t>/partition=<p>/``, each exactly once (the checkpoint and the
    output live together). With ``schema`` the JSON payload becomes one CSV column per field;
    without it the payload is kept as JSON text in ``value``. Malformed messages are stored
    likewise under ``rejects_path`` (default: ``<out_path>_rejects``), as they came. Returns the
    two started queries: good and rejected messages."""
    msgs = read_topic(spark, spec, stream=True, stored=stored)
    good, bad = messages.split_malformed(msgs.select("topic", "partition", F.col("value").cast("string").alias("value")))
    if schema is not None:
        good = good.select("topic", "partition", F.from_json("value", schema).alias("m")).select("topic", "partition", "m.*")
    sink = {"kind": "csv", "trigger": trigger, "partition_by": ["topic", "partition"], "options": {"header": "true"}}
    stored_good = streaming.start_sink(good, path=out_path, checkpoint=checkpoint, **sink)
    try:
        return stored_good, streaming.start_sink(bad, path=rejects_path or f"{out_path}_rejects", checkpoint=f"{checkpoint}_rejects", **sink)
    except Exception:
        stored_good.stop()
        raise
