"""Number text, order-free means, sketches with an exact finish, figures summed up before a join, offset gaps."""

import math
import random

import pytest
from pyspark.sql import functions as F

from feedmetrics.functions.columns import duration_parts, number_text
from feedmetrics.operators import quality, sensors, sketches, stats
from feedmetrics.sources.topics import TopicSpec, offset_gaps

EDGES = [1e-4, 9.9e-5, 1e-3, 0.0005, 1e7, 12345678.9, 9999999999999998.0, 1e16, 1.5e16, 1e-5, 1e100, 2.5e-300, -0.0, 0.0, -0.0005, -1e7, 100.0, 5.0, 123456.789,
         0.1 + 0.2, 1 / 3, float("inf"), -float("inf")]


def test_numbers_are_written_as_the_report_prints_them(spark):
    r = random.Random(3)
    values = EDGES + [r.uniform(-1, 1) * 10 ** r.randint(-8, 15) for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double").select("x", number_text("x").alias("t")).collect()
    assert [x["t"] for x in rows[:-2]] == [repr(v) for v in values]
    assert [x["t"] for x in rows[-2:]] == [None, "nan"]


def test_report_lines_of_small_and_large_numbers(spark):
    one = spark.createDataFrame([(61, 1, 1, 0.0005, -0.0, 12345678.9, None, 5.0, 1e16)], "minutes_out_of_range long, hours long, minutes long, Max_Air_Temperature double, "
                                "Min_Air_Temperature double, Max_Air_Moisture double, Min_Air_Moisture double, Max_Earth_pH double, Min_Earth_pH double")
    assert [r["line"] for r in quality.report_lines(one).orderBy("line_no").collect()] == [
        "Average Time Out of Ideal: 1 hours 1 minutes", "Max Air Temperature: 0.0005°C", "Min Air Temperature: -0.0°C", "Max Air Moisture: 12345678.9%",
        "Min Air Moisture: None%", "Max Earth pH: 5.0", "Min Earth pH: 1e+16"]


def test_duration_of_a_count_beyond_doubles(spark):
    h, m = duration_parts("n")
    row = spark.createDataFrame([(2 ** 60 + 1,)], "n long").select(h.alias("h"), m.alias("m")).first()
    assert (row["h"], row["m"]) == divmod(2 ** 60 + 1, 60)


def test_means_do_not_depend_on_the_order(spark):
    r = random.Random(5)
    rows = [(r.uniform(-1, 1) * 10 ** r.randint(-6, 12), r.random()) for _ in range(4000)] + [(None, 0.1)]
    seen = set()
    for parts, seed in ((1, 1), (3, 2), (7, 3)):
        random.Random(seed).shuffle(rows)
        seen.add(tuple(stats.exact_means(spark.createDataFrame(rows, "a double, b double").repartition(parts), ["a", "b"]).first()))
    assert len(seen) == 1
    (a, b), = seen
    assert a == pytest.approx(math.fsum(x for x, _ in rows if x is not None) / 4000, rel=1e-15) and b == pytest.approx(math.fsum(y for _, y in rows) / 4001, rel=1e-15)


def test_means_of_odd_numbers(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0, inf, inf, 1e300, None, -1.5), (float("nan"), 1.0, -inf, 1.0, None, 0.25)], "a double, b double, c double, d double, e double, f double")
    row = stats.exact_means(df, list("abcdef")).first()
    assert math.isnan(row[0]) and row[1] == inf and math.isnan(row[2]) and row[3] is None and row[4] is None and row[5] == -0.625
    assert list(stats.exact_means(df.limit(0), ["a"]).first()) == [None]


@pytest.mark.parametrize("kind", ["double", "bigint"])
def test_order_statistics_by_sketches_are_exact(spark, kind):
    r = random.Random(7)
    values = [float(r.randint(0, 3000)) for _ in range(5000)] + [17.0] * 2500
    df = spark.createDataFrame([(v,) for v in values], "v double").select(F.col("v").cast(kind)).repartition(5)
    stored = sketches.value_sketches(df, "v", [F.pmod(F.xxhash64("v"), F.lit(4)).alias("g")], k=64)
    values.sort()
    for rank in (0, 1, 2500, 3749, 7499):
        assert stats.kth_smallest(df, "v", rank, max_range_rows=40, sketch_k=64).first()[0] == values[rank]
        assert stats.kth_smallest(df, "v", rank, stored=stored, sketch_k=64).first()[0] == values[rank]
    assert stats.kth_smallest(df, "v", 7500).first()[0] is None and stats.kth_smallest(df.limit(0), "v", fraction=0.5).first()[0] is None


def test_a_wrong_sketch_is_noticed(spark):
    df = spark.range(2000).select(F.col("id").cast("double").alias("v"))
    wrong = sketches.value_sketches(df.where("v >= 1900").union(spark.range(1900).select(F.lit(1950.0).alias("v"))), "v", k=64)
    assert stats.kth_smallest(df, "v", 1000, stored=wrong, sketch_k=64).first()[0] == 1000.0


def test_nan_sorts_last(spark):
    df = spark.createDataFrame([(float("nan"),), (2.0,), (None,), (1.0,)], "v double")
    assert [stats.kth_smallest(df, "v", k).first()[0] for k in (0, 1)] == [1.0, 2.0]
    assert math.isnan(stats.kth_smallest(df, "v", 2).first()[0])


def test_merged_distinct_sketches(spark):
    df = spark.range(20000).select((F.col("id") % 5000).alias("u"), (F.col("id") % 9).alias("day"))
    table = sketches.distinct_sketches(df, "u", ["day"])
    merged, direct = sketches.merged_distinct(table).first()[0], sketches.merged_distinct(sketches.distinct_sketches(df, "u", [])).first()[0]
    assert merged == direct and abs(merged - 5000) <= 3 * sketches.hll_error() * 5000
    assert sketches.merged_distinct(table.limit(0)).first()[0] == 0


def test_range_figures_before_the_join_equal_those_after_it(spark):
    r = random.Random(11)

    def side(n, names):
        rows = [(r.choice(["a", "b", "b", "c", "d", None]), *[r.choice([None, r.uniform(0, 100)]) for _ in names]) for _ in range(n)]
        return spark.createDataFrame(rows, ", ".join(["Time string", *(f"{c} double" for c in names)]))

    air, earth, water = side(40, ["Air_Temperature", "Air_Moisture"]), side(30, ["Earth_pH"]), side(20, [])
    joined = air.join(earth, "Time").join(water, "Time")
    b = quality.IDEAL_BOUNDS
    parts = [(air, {c: b[c] for c in ("Air_Temperature", "Air_Moisture")}), (earth, {"Earth_pH": b["Earth_pH"]}), (water, {})]
    assert quality.aligned_range_stats(parts).collect() == quality.range_stats(joined, b).collect()
    none = [(d.limit(0), x) for d, x in parts]
    assert list(quality.aligned_range_stats(none).first()) == [0, 0, 0] + [None] * 6


def test_offset_gaps(spark):
    offsets = [0, 1, 2, 7, 8, 8, 25, 26, 40]
    rows = [("t", 0, o) for o in offsets] + [("t", 1, 5), ("u", 0, 9), ("u", 0, 11)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long")
    want = {("t", 0, 3, 6, 4), ("t", 0, 9, 24, 16), ("t", 0, 27, 39, 13), ("u", 0, 10, 10, 1)}
    for chunk in (1, 3, 10, 1000):
        assert {tuple(r) for r in offset_gaps(df, chunk).collect()} == want
    assert offset_gaps(df.limit(0)).count() == 0


def test_reader_options_for_parallel_reads():
    o = TopicSpec(bootstrap_servers="b", subscribe=("t",), min_partitions=64, max_records_per_partition=1000).options()
    assert o["minPartitions"] == "64" and o["maxRecordsPerPartition"] == "1000" and "minPartitions" not in TopicSpec(subscribe=("t",)).options()


def test_reconciling_adds_what_is_missing_once(spark):
    def readings(rows, schema):
        return spark.createDataFrame(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" if "." not in f.name else f"`{f.name}` double" for f in schema.fields))

    rows = {"air": [(t, "s", float(i), *[None] * 10) for i, t in enumerate(["1", "1", "2", "3", None])],
            "earth": [(t, "s", 1.0, *[None] * 7) for t in ["1", "1", "2", None]], "water": [(t, "s", 1.0, None, None, None) for t in ["1", "2", "9"]]}
    frames = [(a, readings(rows[a], s)) for a, s in (("air", sensors.AIR_SCHEMA), ("earth", sensors.EARTH_SCHEMA), ("water", sensors.WATER_SCHEMA))]
    whole = sorted(r["value"] for r in sensors.build_document(sensors.align_streams(frames)).collect())
    assert len(whole) == 5
    for kept in ([], whole[:1], whole[1:], whole):
        stored = spark.createDataFrame([(v,) for v in kept], "value string")
        added = [r["value"] for r in sensors.reconcile(frames, stored).collect()]
        assert sorted(kept + added) == whole
        again = spark.createDataFrame([(v,) for v in kept + added], "value string")
        assert sensors.reconcile(frames, again).count() == 0


def test_payload_drift(spark):
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

    layout = {"t": StructType([StructField("a", DoubleType()), StructField("b", StringType()), StructField("c", DoubleType()), StructField("d", BooleanType())])}
    rows = [("t", '{"a": 1, "b": "x"}'), ("t", '{"a": 2.5e3, "b": 7}'), ("t", '{"a": "3", "n": null, "z": {"y": 1}}'), ("t", '{"a": 4, "d": true'), ("t", None), ("t", "[1]"), ("u", '{"q": [1]}')]
    got = {tuple(r) for r in sensors.payload_drift(spark.createDataFrame(rows, "topic string, value string"), layout).collect()}
    assert got == {("t", "a", "changed", "text", 1), ("t", "b", "changed", "number", 1), ("t", "n", "unknown", "null", 1), ("t", "z", "unknown", "object", 1),
                   ("t", "c", "absent", None, 0), ("t", "d", "absent", None, 0), ("u", "q", "unknown", "array", 1)}


def test_routed_files_are_bounded(spark, scratch):
    import glob

    from feedmetrics.sinks import route_to_csv

    df = spark.range(1000).select("id", F.when(F.col("id") < 900, "hot").when(F.col("id") < 990, F.lit(None)).otherwise("cold").alias("topic")).repartition(16)
    route_to_csv(df, f"{scratch}/r", by=("topic",), rows_per_file=300)
    count = {p.split("topic=")[1]: len(glob.glob(f"{p}/*.csv")) for p in glob.glob(f"{scratch}/r/topic=*")}
    assert count["cold"] == 1 and 3 <= count["hot"] <= 6 and count["__HIVE_DEFAULT_PARTITION__"] == 1
    assert spark.read.option("header", True).csv(f"{scratch}/r").count() == 1000
