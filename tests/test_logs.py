"""Access-log edge rows (literal tables) and the log operators."""

import pytest

from feedmetrics.operators import cache, logs, lookup, stats


def _parse(spark, lines):
    df = spark.createDataFrame([(i, ln) for i, ln in enumerate(lines)], "line_id long, value string")
    return logs.parse_log(df)


GOOD = "0.5 10.0.0.1 TCP_HIT [02/Dec/2018:00:00:01 +0700] /a.mpd 100"


@pytest.mark.parametrize("line,ok", [
    (GOOD, True),
    (GOOD + "   ", True),                                   # trailing spaces are dropped
    (GOOD.replace(" 10.0.0.1", "  10.0.0.1"), False),      # double space: empty token
    ("", False),                                            # empty line
    ("0.5 10.0.0.1 TCP_HIT [02/Dec/2018:00:00:01 +0700] /a.mpd", False),       # 6 tokens
    (GOOD + " extra", False),                               # 8 tokens
    (GOOD.replace("0.5 ", "x "), False),                    # latency not a number
    (GOOD.replace("0.5 ", "-1 "), False),                   # negative latency
    (GOOD.replace("0.5 ", "NaN "), False),                  # NaN is not >= 0
    (GOOD.replace(" 100", " 0"), False),                    # size not positive
    (GOOD.replace(" 100", " abc"), False),                  # size not digits
    (GOOD.replace(" 100", " 99999999999"), True),           # beyond int, valid as bigint
    (GOOD.replace(" 100", " +100"), False),                 # sign is not a digit
    (GOOD.replace("TCP_HIT", "-"), False),                  # status '-'
])
def test_validity(spark, line, ok):
    assert _parse(spark, [line]).select("ok").first()[0] is ok


def test_log_time(spark):
    lines = [GOOD, GOOD.replace("+0700]", "GMT]"), GOOD.replace("02/Dec", "32/Dec"), "a b c [x"]
    got = [r.ts_ms for r in _parse(spark, lines).orderBy("line_id").collect()]
    assert got == [1543683601000, 1543708801000, None, None]


def test_first_k_puts_null_times_last(spark):
    lines = [GOOD.replace("02/Dec", "32/Dec"), GOOD.replace("00:00:01", "00:00:05"), GOOD]
    df = stats.first_k(_parse(spark, lines), ["ts_ms", "line_id"], 10)
    assert [r.line_id for r in df.collect()] == [2, 1, 0]
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_service_and_cache_classes(spark):
    df = spark.createDataFrame([("/a.mpd", "TCP_HIT"), ("/b.m3u8", "TCP_HIT1"), ("/c.dash", "X_MISS"),
                                ("/d.ts", "HIT"), ("/e.html", None)], "content string, hit_status string")
    out = logs.with_cache_status(logs.with_service(df)).select("service", "cache_status").collect()
    assert [tuple(r) for r in out] == [("HLS", "HIT"), ("HLS", "HIT1"), ("MPEG-DASH", "MISS"),
                                       ("MPEG-DASH", "HIT"), ("Web Service", "MISS")]


def _records(spark):
    return spark.createDataFrame(
        [(1, "10.0.0.1", 1.0, "+0700]", 10), (2, "10.0.0.2", 2.0, "+0700]", 20), (3, "10.0.0.9", 3.0, "+0700]", 30)],
        "line_id long, ip string, latency double, zone string, size long")


def test_lookup_defaults_and_null_attributes(spark):
    d = spark.createDataFrame([("10.0.0.1", "R1", "C1", "I1"), ("10.0.0.2", "R2", None, None)],
                              "ip string, region string, city string, isp string")
    out = {r.ip: (r.region, r.city, r.isp) for r in lookup.dictionary_lookup(_records(spark), d).collect()}
    assert out == {"10.0.0.1": ("R1", "C1", "I1"), "10.0.0.2": ("R2", None, None),
                   "10.0.0.9": ("Unknown", "Unknown", "Unknown")}


def test_lookup_duplicates(spark):
    d = spark.createDataFrame([("10.0.0.1", "R1", "C1", "I1", 1), ("10.0.0.1", "R1", "C2", "I2", 2)],
                              "ip string, region string, city string, isp string, pos int")
    out = lookup.dictionary_lookup(_records(spark), d, on_duplicate="last", order_by=["pos"])
    assert out.where("ip = '10.0.0.1'").select("city", "isp").first() == ("C2", "I2")
    with pytest.raises(Exception, match="duplicate dictionary key"):
        lookup.dictionary_lookup(_records(spark), d.drop("pos")).collect()
    with pytest.raises(ValueError):
        lookup.dictionary_lookup(_records(spark), d, on_duplicate="last")


def test_lookup_is_broadcast_when_small(spark):
    d = spark.createDataFrame([("10.0.0.1", "R1", "C1", "I1")], "ip string, region string, city string, isp string")
    plan = lookup.dictionary_lookup(_records(spark), d)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_lookup_not_hinted_when_over_limit(spark):
    d = spark.createDataFrame([("10.0.0.1", "R1", "C1", "I1"), ("10.0.0.2", "R1", "C1", "I1")],
                              "ip string, region string, city string, isp string")
    df, hinted = lookup.checked_broadcast(d, max_rows=1)
    assert not hinted
    _, hinted = lookup.checked_broadcast(d, max_rows=10, max_bytes=20)   # 2 rows x ~22 bytes
    assert not hinted
    _, hinted = lookup.checked_broadcast(d, max_rows=10, max_bytes=200)   # with 64 bytes a row
    assert hinted
    plan = lookup.dictionary_lookup(_records(spark), d, max_broadcast_rows=1)._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "broadcast" not in plan.lower()


@pytest.mark.parametrize("values,median,top2", [
    ([], None, []),
    ([5.0], 5.0, [5.0]),
    ([2.0, 1.0], 1.0, [2.0, 1.0]),
    ([3.0, 1.0, 2.0], 2.0, [3.0, 2.0]),
    ([4.0, 1.0, 3.0, 2.0], 2.0, [4.0, 3.0]),
    ([7.0, 7.0, 1.0], 7.0, [7.0, 7.0]),          # repeated maximum
])
def test_median_and_top2(spark, values, median, top2):
    df = spark.createDataFrame([(v,) for v in values], "latency double")
    assert stats.median_disc(df, "latency").first()[0] == median
    assert [r.latency for r in stats.kth_largest(df, "latency", 2).orderBy("rank").collect()] == top2


def test_kth_smallest_multi_round_matches_sort(spark):
    import random

    rnd = random.Random(7)
    vals = [float(rnd.randint(0, 300)) for _ in range(3000)] + [42.0] * 1500  # one hot value
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    s = sorted(vals)
    for rank in (0, 1, 1499, 2200, 3000, 4499):
        got = stats.kth_smallest(df, "x", rank=rank, buckets=8, max_bucket_rows=20).first()[0]
        assert got == s[rank], rank


def test_hit_rates_and_ties(spark):
    df = spark.createDataFrame([("a", "HIT"), ("a", "MISS"), ("b", "HIT1"), ("b", "MISS"), ("c", "MISS")],
                               "isp string, cache_status string")
    assert cache.status_counts(df).first() == (1, 1, 3)
    assert cache.hit_rate(df).first()[0] == 0.4
    best = stats.argmax_ties(cache.hit_rate_by(df, "isp"), "rate")
    assert sorted(r.isp for r in best.collect()) == ["a", "b"]     # two tied groups


def test_empty_inputs(spark):
    df = spark.createDataFrame([], "isp string, cache_status string, size long")
    assert cache.status_counts(df).first() == (0, 0, 0)
    assert cache.hit_rate(df).first()[0] is None
    assert stats.traffic(df).first()[0] is None
    assert stats.argmax_ties(cache.hit_rate_by(df, "isp"), "rate").count() == 0


def test_approximate_options(spark):
    df = spark.createDataFrame([(float(i % 500), f"ip{i % 300}") for i in range(20000)], "latency double, ip string")
    exact = stats.distinct_count(df, "ip").first()[0]
    approx = stats.distinct_count(df, "ip", approx=True).first()[0]
    assert exact == 300 and abs(approx - 300) <= 15
    m_exact = stats.median_disc(df, "latency").first()[0]
    m_approx = stats.median_disc(df, "latency", approx=True).first()[0]
    assert m_exact == 249.0 and abs(m_approx - m_exact) <= 5
