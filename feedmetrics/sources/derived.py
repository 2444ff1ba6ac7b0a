"""Inputs derived by Spark from the driver's tables.

The reference reads a CDN access log, an IP dictionary and three sensor CSV feeds; none of
them ships with it. These derivations build equivalent inputs from ``events``, ``supplier``,
``nation`` and ``region`` so that every registered query reads the given tables and grows
with them. Each is a single narrow projection over one scan (plus small dimension joins).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How event types map onto cache status tokens and sensor topics.
EVENT_STATUS = {"view": "TCP_HIT", "click": "TCP_HIT1", "purchase": "TCP_MISS", "signup": "EXPIRED"}
CONTENT_SUFFIXES = (".mpd", ".m3u8", ".dash", ".ts", ".html")


def _case(col: Column, mapping: dict, default) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))


def log_lines(events: DataFrame) -> DataFrame:
    """events -> ``(line_id, value)`` access-log lines, 7 space-separated tokens.

    Some lines are malformed on purpose: every 17th has 6 tokens, every 11th a zero size,
    every 13th a non-numeric size; ``error`` events carry the status ``-``.
    """
    eid = F.col("event_id")
    size = (F.when(eid % 17 == 0, F.lit(None).cast("string"))
            .when(eid % 11 == 0, F.lit("0"))
            .when(eid % 13 == 0, F.lit("abc"))
            .otherwise(((eid * 37) % 100000).cast("string")))
    suffix = _case(eid % 5, dict(enumerate(CONTENT_SUFFIXES[:4])), CONTENT_SUFFIXES[4])
    line = F.concat_ws(
        " ",
        F.col("value").cast("string"),
        F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")),
        _case(F.col("event_type"), EVENT_STATUS, "-"),
        F.concat(F.lit("["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")),
        F.lit("+0700]"),
        F.concat(F.lit("/v/"), (eid % 50).cast("string"), suffix),
        size,
    )
    return events.select(eid.alias("line_id"), line.alias("value"))


def ip_dictionary(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """``(ip, region, city, isp)``, one row per supplier; nation names play the cities."""
    return (supplier.select("s_suppkey", "s_nationkey")
            .join(nation.select("n_nationkey", "n_name", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.concat(F.lit("10.0.0."), F.col("s_suppkey").cast("string")).alias("ip"),
                    F.col("r_name").alias("region"),
                    F.col("n_name").alias("city"),
                    F.concat(F.lit("ISP_"), (F.col("s_suppkey") % 7).cast("string")).alias("isp"),
                    F.col("s_suppkey")))


def ip_dictionary_with_updates(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """The dictionary as a file with later lines overriding earlier ones.

    ``(batch, line)`` is the line order. Batch 0 is the base dictionary; batch 1 moves every
    4th supplier to another city and ISP; batch 2 truncates every 9th line to two fields
    (city and ISP NULL), which must stay NULL after the lookup.
    """
    base = ip_dictionary(supplier, nation, region)
    b0 = base.select("ip", "region", "city", "isp", F.lit(0).alias("batch"), F.col("s_suppkey").alias("line"))
    b1 = base.where(F.col("s_suppkey") % 4 == 0).select(
        "ip", "region", F.concat(F.col("city"), F.lit("_B")).alias("city"),
        F.concat(F.lit("ISP_"), ((F.col("s_suppkey") + 3) % 7).cast("string")).alias("isp"),
        F.lit(1).alias("batch"), F.col("s_suppkey").alias("line"))
    b2 = base.where(F.col("s_suppkey") % 9 == 0).select(
        "ip", "region", F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("isp"),
        F.lit(2).alias("batch"), F.col("s_suppkey").alias("line"))
    return b0.unionByName(b1).unionByName(b2)


def _k() -> Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def _time_text() -> Column:
    """``ts`` as text, to the microsecond (no time-zone involved)."""
    return F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sensor_rows(events: DataFrame, topic: str) -> DataFrame:
    """Typed sensor readings of one topic: every event yields one reading per topic at its own
    time, so an alignment on ``Time`` has about a row per event at any scale; measures are fixed functions of ``value`` and ``props.k``. The station is
    ``ST<user_id % 3>``. ``Wind_Direction`` is text, as a CSV producer that stringifies
    non-native integers would publish it."""
    v, k = F.col("value"), _k()
    kd = k.cast("double")
    head = [_time_text().alias("Time"),
            F.concat(F.lit("ST"), (F.col("user_id") % 3).cast("string")).alias("Station")]
    if topic == "AIR":
        body = [v.alias("Temperature"), kd.alias("Moisture"), (v * 10).alias("Light"),
                (kd / 10).alias("Total_Rainfall"), (v / 10).alias("Rainfall"),
                (k * 3).cast("string").alias("Wind_Direction"), (v / 2).alias("PM2.5"), v.alias("PM10"),
                (kd / 100).alias("CO"), (v / 5).alias("NOx"), (kd / 50).alias("SO2")]
    elif topic == "EARTH":
        body = [kd.alias("Moisture"), v.alias("Temperature"), (kd / 10).alias("Salinity"),
                (v / 20).alias("pH"), (v * 2).alias("Water_Root"), (kd * 2).alias("Water_Leaf"),
                (v + kd).alias("Water_Level"), (kd / 20).alias("Voltage")]
    else:
        body = [(v / 20).alias("pH"), (kd / 10).alias("DO"), v.alias("Temperature"), (kd / 100).alias("Salinity")]
    return events.select(F.col("event_id"), F.col("ts"), *head, *body)


def sensor_messages(events: DataFrame, topic: str, truncated: bool = True) -> DataFrame:
    """Stored topic messages in the Kafka column layout (value as text).

    Every 97th event is published as a truncated payload, i.e. malformed JSON, unless ``truncated`` is off."""
    rows = sensor_rows(events, topic)
    fields = [c for c in rows.columns if c not in ("event_id", "ts")]
    payload = F.to_json(F.struct(*[F.col(f"`{c}`") for c in fields]))
    value = F.when(F.col("event_id") % 97 == 0, F.substring(payload, 1, 20)).otherwise(payload) if truncated else payload
    return rows.select(
        F.col("event_id").cast("string").alias("key"),
        value.alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("event_id") % 2).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
