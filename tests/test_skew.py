"""Hot keys: one key holding a large share of the rows is split by adaptive execution, and
results stay exact. Thresholds are lowered so the small test data counts as skewed."""

import pytest
from pyspark.sql import functions as F

from feedmetrics.operators import lookup, sensors

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_conf(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df):
    df.collect()  # runs this DataFrame's own adaptive plan to its final form
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return plan


def test_alignment_with_one_hot_time(spark, skew_conf):
    rows = [("hot", f"S{i % 3}", float(i)) for i in range(3000)] + \
           [(f"t{i}", "S0", float(i)) for i in range(3000)]
    a = spark.createDataFrame(rows, "Time string, Station string, x double").repartition(8)
    b = spark.createDataFrame([("hot", "S0", 1.0), ("hot", "S1", 2.0)] + [(f"t{i}", "S0", 1.0) for i in range(3000)],
                              "Time string, Station string, x double").repartition(8)
    out = sensors.align_streams([("a", a), ("b", b)])
    plan = _final_plan(out)
    assert "SortMergeJoin" in plan and "skew=true" in plan
    assert out.count() == 3000 * 2 + 3000


def test_every_join_of_three_frames_splits_a_hot_time(spark, skew_conf):
    rows = [("hot", f"S{i % 3}", float(i)) for i in range(3000)] + [(f"t{i}", "S0", float(i)) for i in range(3000)]
    few = [("hot", "S0", 1.0)] + [(f"t{i}", "S0", 1.0) for i in range(3000)]
    schema = "Time string, Station string, x double"
    a = spark.createDataFrame([*rows, (None, "S", 1.0)], schema).repartition(8)
    b, c = (spark.createDataFrame([*few, (None, "S", 1.0)], schema).repartition(8) for _ in range(2))
    out = sensors.align_streams([("a", a), ("b", b), ("c", c)])
    assert _final_plan(out).count("SortMergeJoin(skew=true)") == 2
    assert out.columns == ["Time", "a_Station", "a_x", "b_Station", "b_x", "c_Station", "c_x"]
    assert out.count() == 3000 + 3000


def test_salt_splits_equal_rows(spark, skew_conf):
    left = spark.createDataFrame([("k", 1)] * 4000, "ip string, x int").repartition(4)
    right = spark.createDataFrame([("k", "v")], "ip string, y string")
    out = lookup.salted_join(left, right, "ip", "left", ["k"], buckets=8)
    assert out.count() == 4000
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_lookup_with_hot_ip_over_broadcast_limit(spark, skew_conf):
    recs = spark.createDataFrame([(i, "10.0.0.1" if i % 3 else f"10.0.1.{i % 200}") for i in range(6000)],
                                 "line_id long, ip string").repartition(8)
    d = spark.createDataFrame([(f"10.0.1.{i}", "R", f"C{i}", "I") for i in range(200)] + [("10.0.0.1", "R", "HOT", "I")],
                              "ip string, region string, city string, isp string")
    assert lookup.hot_keys(recs, "ip", hot_fraction=0.1) == ["10.0.0.1"]
    out = lookup.dictionary_lookup(recs, d, max_broadcast_rows=10, skew="salt", hot_fraction=0.1,
                                   salt_buckets=8)  # too big to broadcast
    plan = _final_plan(out)
    assert "BroadcastHashJoin" not in plan
    # the hot key is spread over several join tasks, not one
    parts = out.where(F.col("city") == "HOT").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1
    assert out.where(F.col("city") == "HOT").count() == 4000
    assert out.count() == 6000
    plain = lookup.dictionary_lookup(recs, d, max_broadcast_rows=10, skew="off")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, plain.collect()))


def test_lookup_hot_ip_split_by_adaptive_execution(spark, skew_conf):
    recs = spark.createDataFrame([(i, "10.0.0.1" if i % 3 else f"10.0.1.{i % 200}") for i in range(6000)],
                                 "line_id long, ip string").repartition(8)
    d = spark.createDataFrame([(f"10.0.1.{i}", "R", f"C{i}", "I") for i in range(200)] + [("10.0.0.1", "R", "HOT", "I")],
                              "ip string, region string, city string, isp string")
    out = lookup.dictionary_lookup(recs, d, max_broadcast_rows=10)   # default skew="aqe"
    plan = _final_plan(out)
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    assert out.where(F.col("city") == "HOT").count() == 4000 and out.count() == 6000
