"""The applications over real files, compared with the registered queries on the same data."""

from feedmetrics import apps, streaming
from feedmetrics.plans import logs as log_plans
from feedmetrics.plans import sensors as sensor_plans
from feedmetrics.sources import TopicSpec
from feedmetrics.sources.derived import ip_dictionary, log_lines, sensor_messages

SF = "/root/testdata/sf0.01"


def test_log_report_from_files(spark, scratch):
    t = lambda n: spark.read.parquet(f"{SF}/{n}.parquet")
    log_lines(t("events")).select("value").write.text(scratch + "/log")
    ip_dictionary(t("supplier"), t("nation"), t("region")).drop("s_suppkey").write.csv(scratch + "/dict")
    r = apps.log_report(spark, scratch + "/log", scratch + "/dict", cities=["NATION_7"], on_duplicate="error")
    assert r["valid_count"].first()[0] == log_plans.log_valid(spark, SF).first()[0] == 6299
    assert r["invalid_count"].first()[0] == 3701
    got = sorted(tuple(x) for x in r["isp_cache"].collect())
    assert got == sorted(tuple(x) for x in log_plans.isp_cache(spark, SF).collect())
    assert r["city_traffic:NATION_7"].first()[0] == log_plans.city_traffic(spark, SF).first()[0]
    assert r["latency_median"].first()[0] == log_plans.latency_median(spark, SF).first()[0] == 34.8


def test_range_report_job(spark, scratch):
    from feedmetrics.sinks import write_documents

    write_documents(sensor_plans.documents(spark, SF), scratch + "/docs")
    lines = apps.range_report_job(spark, scratch + "/docs", scratch + "/report")
    want = sensor_plans.range_report(spark, SF)
    assert sorted(tuple(x) for x in lines.collect()) == sorted(tuple(x) for x in want.collect())
    assert spark.read.text(scratch + "/report").count() == 7


def test_feed_messages_from_csv(spark, scratch):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.select("event_id", "user_id", "event_type", "value").write.option("header", True).csv(scratch + "/feed")
    m = apps.feed_messages(spark, scratch + "/feed", "event_id long, user_id long, event_type string, value double",
                           "EVENTS", order_by=["event_id"])
    rows = m.collect()
    assert len(rows) == ev.count()
    import json
    assert all(r.partition == json.loads(r.value)["event_id"] % 2 for r in rows)


def test_consume_partition_stores_each_message_once(spark, scratch):
    ev = streaming.table_stream(spark, SF, "events")
    stored = sensor_messages(ev, "AIR").unionByName(sensor_messages(ev, "EARTH"))
    spec = TopicSpec(assign={"AIR": [0], "EARTH": [0]})
    q = apps.consume_partition(spark, spec, scratch + "/out", scratch + "/chk", trigger=streaming.AVAILABLE_NOW,
                               stored=stored)
    streaming.run_all(q, timeout=300)
    back = spark.read.schema("value string, topic string, partition int").option("header", True).csv(scratch + "/out")
    rejects = spark.read.schema("value string, topic string, partition int").option("header", True).csv(scratch + "/out_rejects")
    batch = spark.read.parquet(f"{SF}/events.parquet")
    want = sensor_messages(batch, "AIR").unionByName(sensor_messages(batch, "EARTH")).where("partition = 0")
    good = want.where("event_id % 97 <> 0" if "event_id" in want.columns else "offset % 97 <> 0")
    assert back.count() == good.count()
    assert rejects.count() == want.count() - good.count() > 0
    assert {r.partition for r in back.select("partition").distinct().collect()} == {0}


def test_default_orders_follow_the_file(spark, scratch):
    import json

    ev = spark.read.parquet(f"{SF}/events.parquet").where("event_id < 500")
    ev.select("event_id", "event_type").orderBy("event_id").coalesce(1).write.option("header", True).csv(scratch + "/feed")
    m = apps.feed_messages(spark, scratch + "/feed", "event_id long, event_type string", "EVENTS")
    assert all(r.partition == json.loads(r.value)["event_id"] % 2 for r in m.collect())

    with open(scratch + "/dict.csv", "w") as f:
        f.write("10.0.0.1,R,OLD,I1\n10.0.0.2,R,C2,I2\n10.0.0.1,R,NEW,I9\n")
    with open(scratch + "/log.txt", "w") as f:
        f.write("0.5 10.0.0.1 TCP_HIT [02/Dec/2018:00:00:01 +0700] /a.mpd 100\n")
    r = apps.log_report(spark, scratch + "/log.txt", scratch + "/dict.csv")
    assert r["enriched"].select("city", "isp").first() == ("NEW", "I9")


def test_overview_agrees_with_single_figures(spark):
    o = log_plans.log_overview(spark, SF).first()
    assert o.valid == log_plans.log_valid(spark, SF).first()[0]
    assert o.invalid == log_plans.log_invalid(spark, SF).first()[0]
    c = log_plans.cache_counts(spark, SF).first()
    assert (o.hit, o.hit1, o.miss) == (c.hit, c.hit1, c.miss)
    assert o.unique_clients == log_plans.unique_clients(spark, SF).first()[0]
    services = {r.service: r.records for r in log_plans.service_counts(spark, SF).collect()}
    assert (o.hls, o.mpeg_dash, o.web_service) == (services["HLS"], services["MPEG-DASH"], services["Web Service"])


def test_consume_partition_expands_fields(spark, scratch):
    ev = streaming.table_stream(spark, SF, "events")
    stored = sensor_messages(ev, "WATER")
    schema = "Time string, Station string, pH double, DO double, Temperature double, Salinity double"
    q = apps.consume_partition(spark, TopicSpec(assign={"WATER": [1]}), scratch + "/out", scratch + "/chk",
                               trigger=streaming.AVAILABLE_NOW, stored=stored, schema=schema)
    streaming.run_all(q, timeout=300)
    back = spark.read.schema(schema + ", topic string, partition int").option("header", True).csv(scratch + "/out")
    batch = sensor_plans.parse_water(spark, SF)
    want = sensor_messages(spark.read.parquet(f"{SF}/events.parquet"), "WATER").where("partition = 1 AND offset % 97 <> 0")
    assert back.count() == want.count() and back.where("pH IS NULL").count() == 0
    assert back.select("Station").distinct().count() == batch.where("Station IS NOT NULL").select("Station").distinct().count()
