"""Sensor payload parsing, alignment, documents and the out-of-range report."""

import math

import pytest
from pyspark.sql import functions as F

from feedmetrics.operators import messages, quality, sensors
from feedmetrics.operators.sensors import WATER_SCHEMA, AIR_SCHEMA


def _msgs(spark, payloads):
    return spark.createDataFrame([(p,) for p in payloads], "value string")


def test_parse_coerce_and_null_modes(spark):
    payloads = [
        '{"Time":"t","Station":"S","pH":"7.5","DO":2,"Temperature":NaN,"Salinity":"NaN"}',
        '{"Time":"t","pH":null}',
        'garbage',
        None,
    ]
    c = sensors.parse_envelope(_msgs(spark, payloads), WATER_SCHEMA).collect()
    assert c[0].pH == 7.5 and c[0].DO == 2.0 and math.isnan(c[0].Temperature) and math.isnan(c[0].Salinity)
    assert c[1].Time == "t" and c[1].pH is None and c[1].Station is None        # missing field, null
    assert all(v is None for v in c[2]) and all(v is None for v in c[3])        # malformed, NULL payload
    n = sensors.parse_envelope(_msgs(spark, payloads[:1]), WATER_SCHEMA, numeric_strings="null").first()
    assert n.pH is None and n.DO == 2.0                                          # "7.5" is text there


def test_int_field_coercion(spark):
    payloads = ['{"Wind_Direction":"120"}', '{"Wind_Direction":120}', '{"Wind_Direction":"x"}',
                '{"Wind_Direction":120.5}']
    got = [r.Wind_Direction for r in sensors.parse_envelope(_msgs(spark, payloads), AIR_SCHEMA).collect()]
    assert got == [120, 120, None, None]


def test_dotted_field_names(spark):
    r = sensors.parse_envelope(_msgs(spark, ['{"PM2.5": 3.5}']), AIR_SCHEMA).select(F.col("`PM2.5`")).first()
    assert r[0] == 3.5
    assert sensors.running_means(sensors.parse_envelope(_msgs(spark, ['{"PM2.5": 3.5}']), AIR_SCHEMA),
                                 ["PM2.5"]).columns == ["PM2_5_mean"]


def test_split_malformed(spark):
    df = _msgs(spark, ['{"a":1}', "garbage", '{"a": 1', None, "[1,2]"])
    good, bad = messages.split_malformed(df)
    assert good.count() == 1 and bad.count() == 4
    # The parser alone would accept these.
    odd = ['{"a":1} xyz', "{'a':1}", '{"a":1}{"b":2}', "", "  ", '{"a":1},{"b":2}', '{"a":1}],[{"b":2}', '{"a":1}},{"y":{"b":2}', "5", '"a"', "null"]
    good, bad = messages.split_malformed(_msgs(spark, [*odd, ' {"a": {"b": [1, {"c": null}]}, "d": "}]"} ', "{}", '{"a": NaN}']))
    assert bad.count() == len(odd) and good.count() == 3


def _side(spark, rows):
    return spark.createDataFrame(rows, "Time string, Station string, x double")


def test_align_on_time_multiplies_rows(spark):
    a = _side(spark, [("t1", "S1", 1.0), ("t2", "S1", 2.0), ("t2", "S2", 3.0)])
    out = sensors.align_streams([("a", a), ("b", a), ("c", a)])
    assert out.count() == 1 + 8                 # 1 row at t1, 2*2*2 at t2
    assert "a_x" in out.columns and out.columns.count("Time") == 1
    on_station = sensors.align_streams([("a", a), ("b", a), ("c", a)], on=["Time", "Station"])
    assert on_station.count() == 3


def test_align_dedup(spark):
    a = _side(spark, [("t1", "S1", 1.0), ("t1", "S1", 1.5)])
    assert sensors.align_streams([("a", a), ("b", a)], dedup=["Time", "Station"]).count() == 1


def test_document_roundtrip_drops_nulls_keeps_nan(spark):
    row = {"Time": "t"}
    for name, alias, schema in sensors.DOCUMENT_PARTS:
        for f in schema.fields:
            if f.name != "Time":
                row[f"{alias}_{sensors.safe_name(f.name)}"] = None
    row["air_Temperature"] = float("nan")
    row["earth_pH"] = 6.0
    cols = list(row)
    schema = ", ".join(f"`{c}` {'string' if c == 'Time' or c.endswith('Station') else ('int' if c.endswith('Wind_Direction') else 'double')}"
                       for c in cols)
    df = spark.createDataFrame([tuple(row[c] for c in cols)], schema)
    doc = sensors.build_document(df).first().value
    assert '"Moisture"' not in doc and '"NaN"' in doc
    flat = sensors.flatten(sensors.parse_document(sensors.build_document(df))).first()
    assert math.isnan(flat.Air_Temperature) and flat.Air_Moisture is None and flat.Earth_pH == 6.0


@pytest.mark.parametrize("v,flag", [(23.0, 0), (28.0, 0), (22.99, 1), (28.01, 1), (None, 0),
                                    (float("nan"), 1)])
def test_range_flag_edges(spark, v, flag):
    df = spark.createDataFrame([(v, 70.0, 6.0)], "Air_Temperature double, Air_Moisture double, Earth_pH double")
    assert quality.range_flags(df).first().Air_Temperature_Out == flag


def test_report_lines_and_duration(spark):
    rows = [(30.0, 70.0, 6.0)] * 61 + [(25.0, 70.0, 6.0)] * 5
    df = spark.createDataFrame(rows, "Air_Temperature double, Air_Moisture double, Earth_pH double")
    d = quality.out_of_range_duration(df).first()
    assert (d.minutes_out_of_range, d.hours, d.minutes) == (61, 1, 1)
    lines = [r.line for r in quality.range_report(df).orderBy("line_no").collect()]
    assert lines[0] == "Average Time Out of Ideal: 1 hours 1 minutes"
    assert lines[1] == "Max Air Temperature: 30.0°C" and lines[4] == "Min Air Moisture: 70.0%"
    assert lines[6] == "Min Earth pH: 6.0"


def test_report_on_empty_input(spark):
    df = spark.createDataFrame([], "Air_Temperature double, Air_Moisture double, Earth_pH double")
    lines = [r.line for r in quality.range_report(df).orderBy("line_no").collect()]
    assert lines[0] == "Average Time Out of Ideal: 0 hours 0 minutes" and lines[1] == "Max Air Temperature: None°C"


def test_report_reads_input_once(spark, sf_dir):
    from feedmetrics.plans import sensors as plans

    plan = plans.range_report(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    # one aggregation over the aligned documents: each topic is scanned once
    assert plan.count("FileScan parquet") == 3


def test_write_report(spark, scratch):
    from feedmetrics.sinks import write_report

    df = spark.createDataFrame([(25.0, 70.0, 6.0)], "Air_Temperature double, Air_Moisture double, Earth_pH double")
    write_report(quality.range_report(df), scratch + "/report")
    text = spark.read.text(scratch + "/report").collect()
    assert [r.value for r in text][0].startswith("Average Time Out of Ideal")
    assert len(text) == 7


def test_nan_in_extremes_and_means(spark):
    from feedmetrics.operators import stats

    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "Air_Temperature double")
    keep = quality.min_max(df, ["Air_Temperature"]).first()
    assert math.isnan(keep.Max_Air_Temperature) and keep.Min_Air_Temperature == 1.0
    skip = quality.min_max(df, ["Air_Temperature"], nan_as_null=True).first()
    assert skip.Max_Air_Temperature == 3.0
    s = stats.summary(df, "Air_Temperature", nan_as_null=True).first()
    assert s[0] == 2.0 and s[1] == 3.0 and s[2] == 1.0
    assert math.isnan(stats.summary(df, "Air_Temperature").first()[0])
