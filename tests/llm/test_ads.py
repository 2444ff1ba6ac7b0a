"""Nearest neighbours by an adaptive dimension scan (12): recall against brute force, ties, copies, odd vectors."""

import numpy as np
import pytest

from feedmetrics.llm import ads
from feedmetrics.llm.common import table
from feedmetrics.llm.queries import op12_ads

LAYOUT = "vec_id long, embedding array<float>, label int"


def brute(ids, x, q, k=10):
    d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
    d[ids == q] = np.inf
    best = np.lexsort((ids, d))[:min(k, len(ids) - 1)]
    return [(int(ids[i]), float(d[i])) for i in best]


def checked(rows, ids, x):
    """Share of the true neighbours found; ranks, order and scores are right."""
    by = {}
    for r in sorted(map(tuple, rows)):
        by.setdefault(r[0], []).append(r[1:])
    assert set(by) == {int(i) for i in ids if i % 100 == 0}
    hit = total = 0
    for q, found in by.items():
        want = brute(ids, x, q)
        assert [f[0] for f in found] == list(range(1, len(want) + 1))
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        for _, v, s in found:
            assert s == pytest.approx(float(np.sqrt(((x[ids == v][0] - x[ids == q][0]) ** 2).sum())), abs=1e-12)
        hit += len({v for _, v, _ in found} & {v for v, _ in want})
        total += len(want)
    return hit / total


def arrays(df):
    rows = sorted(map(tuple, df.select("vec_id", "embedding").collect()))
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)


def test_recall_on_the_given_vectors(spark):
    for sf_dir in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        ids, x = arrays(table(spark, sf_dir, "embeddings"))
        assert checked(op12_ads(spark, sf_dir).collect(), ids, x) >= 0.95


def test_recall_on_clusters_with_hot_vectors(spark, monkeypatch):
    """A third of the rows share one vector; blocks and query parts are small, so lists are many cells."""
    monkeypatch.setattr(ads, "BLOCK", 64)
    monkeypatch.setattr(ads, "QUERIES", 4)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20, 24))[rng.integers(0, 20, 3000)] + 0.3 * rng.normal(size=(3000, 24))
    x[rng.random(3000) < 1 / 3] = x[7]
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], LAYOUT)
    rows = ads.search(df, lambda v: v % 100 == 0).collect()
    ids = np.arange(3000)
    assert checked(rows, ids, x.astype(float)) >= 0.95
    hot = [q for q in range(0, 3000, 100) if (x[q] == x[7]).all()]
    copies = [i for i in range(3000) if (x[i] == x[7]).all()]
    for q in hot:  # ties go to the smaller id, the query itself is left out
        assert [r["vec_id"] for r in rows if r["query_id"] == q] == [i for i in copies if i != q][:10]


def test_scan_is_exact_where_no_test_can_fail():
    rng = np.random.default_rng(2)
    q, x = rng.normal(size=(5, 40)), rng.normal(size=(300, 40))
    rotation = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    qi, xi, d = ads.scan(q, x, np.full(5, np.inf), rotation, np.arange(300), 300)
    full = np.sqrt(((q[:, None] - x[None]) ** 2).sum(2))
    assert len(qi) == 1500 and np.allclose(full[qi, xi], d) and (np.diff(d)[qi[1:] == qi[:-1]] >= 0).all()
    qi, xi, d = ads.scan(q, x, np.full(5, np.inf), rotation, np.arange(300), 11)
    assert sum(set(xi[qi == i]) == set(np.argsort(full[i])[:11]) for i in range(5)) >= 4


def test_odd_vectors(spark):
    one = [1.0, 0.0]
    rows = [(0, one, 1), (1, [0.0, 1.0], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [float("nan"), 1.0], 1), (5, [float("inf"), 1.0], 1), (6, [None, 1.0], 1), (7, [], 1), (8, [1.0, 2.0, 3.0], 1),
            (None, one, 1), (100, one, 1), (100, one, 1), (9, [3.0, 0.0], 1), (9, [2.0, 0.0], 1), (200, [0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, LAYOUT).selectExpr("*", "1 as pid", "2 as rank", "3.0 as score")
    got = [tuple(r) for r in ads.search(df, lambda v: v % 100 == 0).orderBy("query_id", "rank").collect()]
    root2 = pytest.approx(2 ** 0.5)
    assert got == [(0, 1, 100, 0.0), (0, 2, 9, 1.0), (0, 3, 1, root2), (100, 1, 0, 0.0), (100, 2, 9, 1.0), (100, 3, 1, root2)]
    assert ads.search(df.limit(0), lambda v: v % 100 == 0).count() == 0
    assert ads.search(df.where("vec_id = 0"), lambda v: v % 100 == 0).count() == 0  # no other row
    assert ads.search(df.where("vec_id = 1 or vec_id = 9"), lambda v: v % 100 == 0).count() == 0  # no query
