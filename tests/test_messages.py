"""Feed messages: JSON payloads, row positions, topic specs, routing."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from feedmetrics.operators import messages
from feedmetrics.sources.topics import TopicSpec


def test_to_messages_types(spark):
    df = spark.createDataFrame([(1, 2.5, "x", True, None)], "i int, d double, s string, b boolean, n string")
    df = df.withColumn("ts", F.to_timestamp(F.lit("2024-01-01 00:00:07.5")))
    got = json.loads(df.select(messages.to_messages(df).alias("v")).first().v)
    assert got == {"i": 1, "d": 2.5, "s": "x", "b": "True", "ts": "2024-01-01 00:00:07.5"}


def test_blank_numbers_and_booleans(spark):
    df = spark.createDataFrame([(None, None, None)], "i int, d double, b boolean")
    assert json.loads(df.select(messages.to_messages(df).alias("v")).first().v) == {"d": "NaN"}
    assert df.select(messages.to_messages(df, blanks="omit", booleans="json").alias("v")).first().v == "{}"
    yes = spark.createDataFrame([(True,)], "b boolean")
    assert json.loads(yes.select(messages.to_messages(yes, booleans="json").alias("v")).first().v) == {"b": True}


def test_positions_are_dense_and_ordered(spark):
    keys = list(range(5000))
    random.Random(3).shuffle(keys)
    df = spark.createDataFrame([(k, k * 2) for k in keys], "k long, v long").repartition(7)
    out = messages.with_positions(df, ["k"], partitions=5).collect()
    assert sorted((r.position, r.k) for r in out) == [(i, i) for i in range(5000)]
    # a plain collect and a filtered plan see the same numbering
    p = messages.assign_partition(df, 2, ["k"])
    assert p.where(F.col("partition") != F.col("k") % 2).count() == 0
    assert all(r.partition == r.k % 2 for r in p.collect())


def test_positions_with_hot_leading_key(spark):
    rows = [(0, i) for i in range(3000)] + [(1, i) for i in range(100)]   # one key holds most rows
    df = spark.createDataFrame(rows, "a int, b int")
    out = sorted((r.position, r.a, r.b) for r in messages.with_positions(df, ["a", "b"], partitions=4).collect())
    assert out == [(i, a, b) for i, (a, b) in enumerate(sorted(rows))]


def test_topic_spec_options():
    s = TopicSpec(bootstrap_servers="k1:9092", subscribe=("AIR",))
    assert s.options() == {"kafka.bootstrap.servers": "k1:9092", "startingOffsets": "earliest",
                           "failOnDataLoss": "false", "subscribe": "AIR"}
    a = TopicSpec(bootstrap_servers="k", assign={"EARTH": [0], "AIR": [0, 1]})
    assert a.options()["assign"] == '{"AIR":[0,1],"EARTH":[0]}'
    with pytest.raises(ValueError):
        TopicSpec().options()


def test_topic_spec_restricts_stored_messages(spark):
    df = spark.createDataFrame([("AIR", 0), ("AIR", 1), ("EARTH", 0), ("WATER", 0)], "topic string, partition int")
    got = TopicSpec(assign={"AIR": [0], "EARTH": [0]}).restrict(df).collect()
    assert sorted(tuple(r) for r in got) == [("AIR", 0), ("EARTH", 0)]


def test_route_to_csv_keeps_every_row(spark, scratch):
    from feedmetrics.sinks import route_to_csv
    from feedmetrics.sources.files import read_feed

    df = spark.createDataFrame([("AIR", i % 2, i, f"x{i}") for i in range(50)], "topic string, partition int, n int, s string")
    route_to_csv(df, scratch + "/r", mode="overwrite")
    back = read_feed(spark, scratch + "/r", "n int, s string, topic string, partition int")
    assert back.count() == 50
    assert sorted(r.n for r in back.where("partition = 0").collect()) == list(range(0, 50, 2))


def test_file_positions_follow_files_and_places(spark, scratch):
    """Files of unlike sizes, cut into several splits: the numbering is that of the files in order."""
    expect = []
    for k, n in enumerate((40, 900, 300)):
        with open(f"{scratch}/part{k}.csv", "w") as f:
            f.write("k,v\n" + "".join(f"{k * 1000 + i},{'x' * 20}\n" for i in range(n)))
        expect += [k * 1000 + i for i in range(n)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        rows = spark.read.schema("k long, v string").option("header", True).csv(scratch)
        assert rows.rdd.getNumPartitions() > 3
        out = messages.with_file_positions(rows)
        got = sorted((r.position, r.k) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == list(enumerate(expect))
    assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan


def test_reject_reasons(spark):
    cases = {'{"a": 1}': None, ' {"a": {"b": [1, 2]}} ': None, None: "missing", "": "blank", " \n": "blank", "[1]": "not an object", "12": "not an object", '"x"': "not an object",
             '{"a": 1} x': "trailing text", '{"a": 1}{"b": 2}': "trailing text", '{"a": 1},{"b": 2}': "trailing text", '{"a": 1': "cut off", '{"a": "x': "cut off", "{'a': 1}": "malformed", '{"a": }': "malformed",
             '{"a":1}]': "trailing text", '{"a":1},{"mark":"1"}]': "trailing text", '{"a":"': "cut off"}
    df = spark.createDataFrame([(v,) for v in cases], "value string")
    got = {r["value"]: r["reason"] for r in messages.reject_reason(df).collect()}
    assert got == cases
    assert {r["value"]: r["malformed"] for r in messages.malformed_flag(df).collect()} == {v: w is not None for v, w in cases.items()}


def test_malformed_parses_each_payload_once(spark, capsys):
    messages.malformed_flag(spark.createDataFrame([("{}",)], "value string")).select("malformed").explain(extended=False)
    assert capsys.readouterr().out.count("from_json") == 1


def test_replay_stores_a_correction_once(spark):
    layout = "topic string, partition int, offset long, value string, timestamp timestamp"
    at = datetime.datetime(2024, 1, 1)
    later = at + datetime.timedelta(hours=1)
    rejected = spark.createDataFrame([("t", 0, 1, "{", at), ("t", 0, 2, "{", at), ("t", 1, 1, "", at)], layout)
    stored = spark.createDataFrame([("t", 0, 0, "{}", at)], layout)
    corrected = spark.createDataFrame([("t", 0, 1, '{"v": 1}', at), ("t", 0, 1, '{"v": 2}', later), ("t", 0, 2, "{", at), ("t", 0, 0, '{"v": 9}', at), ("t", 5, 5, "{}", at)], layout)
    first = messages.replay(corrected, stored, rejected)
    assert [(r["partition"], r["offset"], r["value"]) for r in first.collect()] == [(0, 1, '{"v": 2}')] and first.columns == corrected.columns
    assert messages.replay(corrected, stored.unionByName(first), rejected).count() == 0


def test_replay_parses_and_groups_only_what_is_due(spark, scratch, capsys):
    rows = spark.createDataFrame([("t", 0, 1, "{"), ("t", 0, 2, '{"v": 1}'), ("t", 0, 3, None), (None, 0, 4, "{}"), ("t", 0, 2, '{"v": 1}')], "topic string, partition int, offset long, value string")
    good, bad = messages.split_malformed(rows, path=f"{scratch}/flagged")
    assert [sorted(map(str, x.collect())) for x in (good, bad)] == [sorted(map(str, x.collect())) for x in messages.split_malformed(rows)]
    good.explain()
    assert "from_json" not in capsys.readouterr().out
    messages.replay(rows, good, bad).explain()
    plan = capsys.readouterr().out
    assert plan.index("Aggregate") < plan.index("Join")


def test_file_positions_over_several_splits(spark, scratch):
    spark.range(500).select(F.col("id")).coalesce(1).write.parquet(f"{scratch}/a")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        rows = messages.with_file_positions(spark.read.schema("id long").parquet(f"{scratch}/a"))
        assert all(r["id"] == r["position"] for r in rows.collect()) and rows.count() == 500
        assert "SortExec" not in rows._jdf.queryExecution().executedPlan().toString() and "RangePartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
