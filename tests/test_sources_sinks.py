"""Readers and sinks on real files (text logs, dictionary CSV, feeds, documents, streams)."""

from pyspark.sql import functions as F

from feedmetrics import streaming
from feedmetrics.operators import logs, lookup
from feedmetrics.sources import read_dictionary, read_documents, read_log_lines
from feedmetrics.sources.derived import ip_dictionary, log_lines


def test_log_file_to_valid_records(spark, sf_dir, scratch):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    lines = log_lines(ev)
    lines.select("value").write.text(scratch + "/log")
    from_file = logs.parse_log(read_log_lines(spark, scratch + "/log"), keep="valid")
    direct = logs.parse_log(lines, keep="valid")
    assert from_file.count() == direct.count() > 0


def test_dictionary_csv_short_lines_stay_null(spark, scratch):
    path = scratch + "/dict.csv"
    with open(path, "w") as f:
        f.write("10.0.0.1,ASIA,NATION_1,ISP_1\n10.0.0.2,EUROPE\n")
    d = read_dictionary(spark, path)
    recs = spark.createDataFrame([("10.0.0.1",), ("10.0.0.2",), ("10.0.0.3",)], "ip string")
    got = {r.ip: (r.region, r.city, r.isp) for r in lookup.dictionary_lookup(recs, d).collect()}
    assert got == {"10.0.0.1": ("ASIA", "NATION_1", "ISP_1"), "10.0.0.2": ("EUROPE", None, None),
                   "10.0.0.3": ("Unknown", "Unknown", "Unknown")}


def test_dictionary_from_tables_is_one_row_per_supplier(spark, sf_dir):
    t = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    d = ip_dictionary(t("supplier"), t("nation"), t("region"))
    assert d.count() == t("supplier").count() == d.select("ip").distinct().count()


def test_documents_reader_reads_directory_only_committed(spark, scratch):
    docs = spark.createDataFrame([('{"Time":"t","Air":{"Temperature":25.0}}',)], "value string")
    docs.write.json(scratch + "/docs")
    back = read_documents(spark, scratch + "/docs")
    assert back.schema.simpleString() == "struct<value:string>" and back.count() == 1


def test_stream_route_to_csv_by_topic_and_partition(spark, sf_dir, scratch):
    from feedmetrics.sources.derived import sensor_messages

    stream = streaming.table_stream(spark, sf_dir, "events")
    msgs = sensor_messages(stream, "WATER").select("topic", "partition", "key", "value")
    q = streaming.start_sink(msgs, "csv", path=scratch + "/routed", checkpoint=scratch + "/chk",
                             trigger=streaming.AVAILABLE_NOW, partition_by=["topic", "partition"],
                             options={"header": "true"})
    streaming.run_all([q], timeout=300)
    back = spark.read.schema("key string, value string, topic string, partition int").option("header", True) \
        .csv(scratch + "/routed")
    want = sensor_messages(spark.read.parquet(f"{sf_dir}/events.parquet"), "WATER")
    assert back.count() == want.count()
    assert {r.partition for r in back.select("partition").distinct().collect()} == {0, 1}


def test_console_and_memory_sinks(spark, sf_dir):
    stream = streaming.table_stream(spark, sf_dir, "events").select("event_id")
    q1 = streaming.start_sink(stream.limit(3), "console", trigger=streaming.AVAILABLE_NOW, output_mode="append")
    q2 = streaming.start_sink(stream.agg(F.count(F.lit(1)).alias("n")), "memory", name="events_count",
                              trigger=streaming.AVAILABLE_NOW, output_mode="complete")
    streaming.run_all([q1, q2], timeout=300)
    assert spark.table("events_count").first().n == spark.read.parquet(f"{sf_dir}/events.parquet").count()
