"""Plan shape: pruning and pushdown reach the scan, aggregates are partial, joins as intended."""

from feedmetrics.plans import feeds, logs, sensors


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_column_read_for_event_range_check(spark, sf_dir):
    p = _plan(sensors.range_duration_events(spark, sf_dir))
    assert "ReadSchema: struct<value:double>" in p


def test_lineitem_range_reads_two_columns(spark, sf_dir):
    p = _plan(sensors.range_stats_lineitem(spark, sf_dir))
    assert "ReadSchema: struct<l_quantity:double,l_discount:double>" in p
    assert "partial_max" in p and "partial_min" in p


def test_topic_reads_only_its_columns(spark, sf_dir):
    p = _plan(sensors.parse_air(spark, sf_dir))  # every event yields a reading, whatever its type
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double,props:string>" in p


def test_hit_rate_by_isp_is_partial_and_broadcast(spark, sf_dir):
    p = _plan(logs.isp_cache(spark, sf_dir))
    assert "partial_count" in p and "BroadcastHashJoin" in p and "LeftOuter" in p


def test_first10_is_take_ordered(spark, sf_dir):
    assert "TakeOrderedAndProject" in _plan(logs.log_first10(spark, sf_dir))


def test_log_parse_is_one_generator(spark, sf_dir):
    p = _plan(logs.log_valid(spark, sf_dir))
    assert p.count("split(") == 1 and "Generate inline" in p


def test_malformed_counts_partial(spark, sf_dir):
    p = _plan(feeds.malformed_split(spark, sf_dir))
    assert "partial_count" in p
