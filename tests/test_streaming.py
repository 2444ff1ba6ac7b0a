"""Streams: equal to batch, restart from checkpoint without loss or duplicates."""

import datetime

import pytest
from pyspark.sql import functions as F

from feedmetrics import streaming
from feedmetrics.operators import sensors
from feedmetrics.plans import sensors as plans
from feedmetrics.sources.derived import sensor_messages


def test_stream_means_equal_batch(spark, sf_dir):
    s = plans.stream_means_water(spark, sf_dir).first().asDict()
    b = sensors.running_means(plans.parse_water(spark, sf_dir), sensors.MEAN_COLUMNS["WATER"]).first().asDict()
    assert s == b  # to the last bit


def test_align_stream_equals_batch(spark):
    sf_dir = "/root/testdata/sf0.01"  # sf0.001 has no time bucket with all three topics
    s = sorted(tuple(r) for r in plans.align3_stream(spark, sf_dir).collect())
    b = sorted(tuple(r) for r in plans.align3(spark, sf_dir).collect())
    assert s == b and len(s) > 0


def test_restart_from_checkpoint(spark, sf_dir, scratch):
    """Stop after the first file, add a second, restart: each message stored exactly once."""
    src, out, chk = scratch + "/in", scratch + "/out", scratch + "/chk"
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    ev.where("event_id % 2 = 0").write.parquet(src + "/part1")
    schema = ev.schema

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        msgs = sensor_messages(stream, "AIR")
        q = streaming.start_sink(msgs, "parquet", path=out, checkpoint=chk, trigger=streaming.AVAILABLE_NOW)
        streaming.run_all([q], timeout=300)

    run()
    first = spark.read.parquet(out).count()
    ev.where("event_id % 2 = 1").write.parquet(src + "/part2")
    run()
    got = spark.read.parquet(out)
    want = sensor_messages(ev, "AIR")
    assert first < got.count() == want.count()
    assert got.select("offset").distinct().count() == got.count()


def test_run_all_raises_and_stops_others(spark, scratch):
    import pytest

    ok = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    bad = ok.select(F.raise_error(F.lit("boom")).alias("x"))
    q1 = streaming.start_sink(ok, "memory", name="keep_running", trigger={"processingTime": "1 second"})
    q2 = streaming.start_sink(bad, "parquet", path=scratch + "/b", checkpoint=scratch + "/bc",
                              trigger={"processingTime": "1 second"})
    with pytest.raises(Exception):
        streaming.run_all([q1, q2], timeout=120)
    assert not q1.isActive


def test_environment_application(spark, scratch):
    """All sensor queries at once (means per topic + aligned documents), like the reference's
    streaming job; results equal the batch queries."""
    from feedmetrics.sources.files import read_documents
    from feedmetrics.streaming.environment import start_environment_queries

    sf = "/root/testdata/sf0.01"
    ev = streaming.table_stream(spark, sf, "events")
    topics = {t: sensor_messages(ev, t) for t in ("AIR", "EARTH", "WATER")}
    qs = start_environment_queries(topics, scratch + "/out", scratch + "/chk", trigger=streaming.AVAILABLE_NOW)
    assert set(qs) == {"means_air", "means_earth", "means_water", "documents"}
    streaming.run_all(list(qs.values()), timeout=600)
    docs = sensors.flatten(sensors.parse_document(read_documents(spark, scratch + "/out/documents")))
    want = plans.report_input(spark, sf)
    assert sorted(tuple(r) for r in docs.collect()) == sorted(tuple(r) for r in want.collect())
    m = streaming.read_result_table(spark, scratch + "/out/means_earth").first().asDict()
    b = sensors.running_means(plans.parse_earth(spark, sf), sensors.MEAN_COLUMNS["EARTH"]).first().asDict()
    assert {k: round(v, 6) for k, v in m.items()} == {k: round(v, 6) for k, v in b.items()}


def test_running_means_over_several_batches(spark, sf_dir, scratch):
    """Complete-mode means carried across micro-batches equal the batch means."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    for i in range(3):
        ev.where(f"event_id % 3 = {i}").coalesce(1).write.parquet(f"{scratch}/in/part{i}")
    stream = (spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", 1).parquet(scratch + "/in"))
    parsed = sensors.parse_envelope(sensor_messages(stream, "AIR"), sensors.AIR_SCHEMA)
    means = sensors.running_means(parsed, sensors.MEAN_COLUMNS["AIR"])
    q = streaming.start_sink(means, "table", path=scratch + "/m", checkpoint=scratch + "/c",
                             trigger=streaming.AVAILABLE_NOW, output_mode="complete")
    streaming.run_all([q], timeout=300)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    got = streaming.read_result_table(spark, scratch + "/m").first().asDict()
    want = sensors.running_means(plans.parse_air(spark, sf_dir), sensors.MEAN_COLUMNS["AIR"]).first().asDict()
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}


def test_environment_means_as_memory_tables(spark, scratch):
    from feedmetrics.streaming.environment import start_environment_queries

    ev = streaming.table_stream(spark, "/root/testdata/sf0.001", "events")
    topics = {t: sensor_messages(ev, t) for t in ("AIR", "EARTH", "WATER")}
    qs = start_environment_queries(topics, scratch + "/out", scratch + "/chk", trigger=streaming.AVAILABLE_NOW,
                                   means_kind="memory")
    streaming.run_all(list(qs.values()), timeout=600)
    assert spark.table("stats_table_water").columns == ["pH_mean", "DO_mean", "Temperature_mean", "Salinity_mean"]


def test_a_folder_of_part_files_is_streamed_whole(spark, sf_dir, scratch):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    ev.repartition(4).write.parquet(scratch + "/events.parquet")
    streaming.run_available_now(streaming.table_stream(spark, scratch, "events", max_files_per_trigger=1).select("event_id"),
                                "parquet", scratch + "/o", scratch + "/c")
    assert spark.read.parquet(scratch + "/o").count() == ev.count()
    with pytest.raises(Exception, match="does not exist"):
        streaming.table_stream(spark, scratch, "nothing")


def test_late_rows_and_odd_times_stay_by_default(spark, scratch):
    """Four times per topic over several batches, the last one late, one time with seconds and
    one that is none: without a watermark every pair is kept."""
    times = ["2023-08-23 10:00", "2023-08-23 12:00", "2023-08-23 00:01:00", "not a time", "2023-08-23 01:00"]
    for i, t in enumerate(times):
        spark.createDataFrame([(t, "S", float(i))], "Time string, Station string, x double").coalesce(1).write.parquet(f"{scratch}/in/{i}")

    def side():
        return (spark.readStream.schema("Time string, Station string, x double").option("recursiveFileLookup", "true")
                .option("maxFilesPerTrigger", 1).parquet(scratch + "/in"))

    out = sensors.align_streams([("a", side()), ("b", side()), ("c", side())])
    streaming.run_available_now(out, "parquet", scratch + "/o", scratch + "/c")
    assert sorted(r["Time"] for r in spark.read.parquet(scratch + "/o").collect()) == sorted(times)
    limited = sensors.align_streams([("a", side()), ("b", side())], watermark="30 minutes")
    streaming.run_available_now(limited, "parquet", scratch + "/o2", scratch + "/c2")
    assert {r["Time"] for r in spark.read.parquet(scratch + "/o2").collect()} <= set(times) - {"not a time"}
    batch = spark.read.parquet(*[f"{scratch}/in/{i}" for i in range(len(times))])
    assert [r["Time"] for r in sensors.untimed(batch).collect()] == ["not a time"]


def test_result_table_is_the_last_complete_one(spark, scratch):
    import os

    for k in (1, 2):
        spark.range(k).write.parquet(f"{scratch}/m/epoch={k:020d}")
    os.makedirs(f"{scratch}/m/epoch={3:020d}")  # begun, not finished
    assert streaming.read_result_table(spark, scratch + "/m").count() == 2
    with pytest.raises(FileNotFoundError):
        streaming.read_result_table(spark, scratch + "/none")


def test_feed_positions_over_files_and_restarts(spark, scratch):
    """Two feeds, five files in four runs, one run repeated from its checkpoint: positions as over the whole feeds."""
    from feedmetrics.streaming import feeds

    def add(name, rows):
        spark.createDataFrame(rows, "feed string, n long").coalesce(1).write.mode("append").parquet(f"{scratch}/in/{name}")

    want = {"a": [], "b": []}
    for k, (feed, size) in enumerate([("a", 5), ("b", 3), ("a", 4), ("a", 1), ("b", 6)]):
        rows = [(feed, 100 * k + i) for i in range(size)]
        want[feed] += [n for _, n in rows]
        add(f"{k}", rows)
        if k == 2:
            continue  # this file waits for the next run
        stream = spark.readStream.schema("feed string, n long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{scratch}/in")
        streaming.run_all([feeds.start_feed(stream, lambda rows: rows.select("feed", "n", "position", "partition"), f"{scratch}/out", f"{scratch}/c", 2, feed="feed")])
    got = sorted((r["feed"], r["position"], r["n"], r["partition"]) for r in spark.read.parquet(f"{scratch}/out/messages").collect())
    assert got == sorted((f, i, n, i % 2) for f, ns in want.items() for i, n in enumerate(ns))


def test_late_rows_are_kept_aside_and_drops_are_recorded(spark, scratch):
    import time as clock

    from feedmetrics.streaming import late

    files = [["2024-01-01 10:00:00", "2024-01-01 12:00:00", None], ["2024-01-01 11:30:00", "2024-01-01 10:59:00", "2024-01-01 11:00:00"], ["2024-01-01 15:00:00"], ["2024-01-01 13:59:59", "no time"], ["2024-01-01 09:00:00"]]
    for k, times in enumerate(files):
        spark.createDataFrame([(t, k) for t in times], "Time string, k int").coalesce(1).write.mode("append").parquet(f"{scratch}/in")

    def stream():
        return spark.readStream.schema("Time string, k int").option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")

    streaming.run_all([late.start_late_split(stream(), sensors.read_time(), "1 hour", f"{scratch}/out", f"{scratch}/c")])
    rows = late.read_split(spark, f"{scratch}/out", stream().schema)
    kinds = {(r["Time"], r["k"]): r["kind"] for r in rows.collect()}
    assert rows.count() == sum(map(len, files)) == len(kinds)
    assert {t for (t, _), kind in kinds.items() if kind == "late"} == {"2024-01-01 10:59:00", "2024-01-01 11:00:00", "2024-01-01 13:59:59", "2024-01-01 09:00:00"}
    assert {t for (t, _), kind in kinds.items() if kind == "untimed"} == {None, "no time"}
    assert late.read_split(spark, f"{scratch}/out", stream().schema, "on_time").count() == 4
    seen = []
    listener = late.StateListener(seen.append)
    spark.streams.addListener(listener)
    try:
        timed = stream().withColumn("t", sensors.read_time()).withWatermark("t", "1 hour").groupBy(F.window("t", "1 minute")).count()
        streaming.run_available_now(timed, "parquet", f"{scratch}/w", f"{scratch}/wc")
        for _ in range(50):
            if any(s["dropped"] for s in seen):
                break
            clock.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert sum(s["dropped"] for s in seen) >= 1 and max(s["state_rows"] for s in seen) > 0


def test_old_results_expire_and_a_reader_always_finds_a_whole_one(spark, scratch):
    import os

    for k in range(6):
        spark.range(k + 1).write.parquet(f"{scratch}/in/{k}")
        stream = spark.readStream.schema("id long").option("recursiveFileLookup", "true").parquet(f"{scratch}/in").groupBy().count()
        streaming.run_available_now(stream, "table", f"{scratch}/t", f"{scratch}/c", output_mode="complete", keep_results=2)
        kept = sorted(os.listdir(f"{scratch}/t"))
        assert streaming.read_result_table(spark, f"{scratch}/t").first()[0] == sum(range(1, k + 2))
        assert len(kept) <= 2
    os.makedirs(f"{scratch}/t/epoch={99:020d}")  # begun, not finished: the result before it must stay
    assert streaming.expire_results(spark, f"{scratch}/t", 98) == kept[:-1]
    assert streaming.read_result_table(spark, f"{scratch}/t").first()[0] == 21


def test_an_arrival_is_as_many_files_as_its_rows_were_read_in(spark, scratch):
    import glob

    from feedmetrics.sources.files import TABLE_SCHEMAS

    rows = [(i, datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=i), i, "view", 1.0, '{"k": 1}') for i in range(200)]
    for at in range(0, 200, 50):
        spark.createDataFrame(rows[at:at + 50], TABLE_SCHEMAS["events"]).coalesce(1).write.mode("append").parquet(f"{scratch}/events.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        files = [len(glob.glob(f"{scratch}/arriving/*.parquet")) for _ in plans.arriving(spark, scratch, f"{scratch}/arriving")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(files) == 4 and all(b - a > 1 for a, b in zip([0, *files], files))
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{scratch}/arriving").collect()) == list(range(200))
    assert plans.stream_reconciled(spark, scratch).count() == len([i for i in range(200) if i % 97])
    assert plans.late_rows(spark, scratch).count() == 200
