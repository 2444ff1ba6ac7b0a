"""Nearest neighbours by an adaptive dimension scan of probed lists.

Vectors are dealt to lists by their nearest centre and rotated at random, so that any first columns of a
difference are a fair sample of it. A list's vectors are scanned in blocks of columns: after
each block a candidate goes if its partial distance, scaled up to all columns, is above the query's
limit by more than chance explains (a hypothesis test with ``EPSILON`` standard errors). Those that are
left at the last column are measured on the original vectors, in double precision.

A query first scans its nearest lists, which sets its limit: the distance of the last place it reports.
Which further lists it probes is decided by how many nearer vectors each can be expected to hold (its
vectors' distances to the query are taken as normal, by the list's size and spread): lists are
probed until at most ``MISSED`` of the places can be expected to lie in the rest. The number of
probes so follows from the data and the queries; the recall is measured in the tests.

Fitted on a bounded sample (``SAMPLE`` vectors a centre, ``MAX_LISTS`` centres at most; the number of
lists is the square root of the number of vectors); every vector is indexed.

Scale: equal vectors are one point with its smallest ids, so a vector that a third of the rows share
is scanned once and asked once; a list is cut into blocks of about ``BLOCK`` points and its queries
into parts of about ``QUERIES``, so a task's work is bounded however large a list is.

Defined cases: a vector that is null, zero, empty, or holds a null or non-finite component takes no part, nor
does one of another length than most (of equally common lengths the smaller counts), nor one
without an id; of rows that repeat an id the smallest vector counts; ties go to the smaller id;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmetrics.llm.common import column, saved

#: Standard errors of the hypothesis test, and columns of a block.
EPSILON, COLUMNS = 2.1, 16
#: Lists at most, sampled vectors per list, lists that set a query's limit.
MAX_LISTS, SAMPLE, FIRST = 2048, 32, 4
#: Share of the places that may be expected in lists that are not probed.
MISSED = 0.01
#: Points of a block and queries of a part, about.
BLOCK, QUERIES = 2048, 1024


def vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v): the rows that take part, one per id; saved."""
    x = F.col("v")
    real = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists(x, lambda c: c != 0)
    own = rows.select(rows[id_col].cast("long").alias("id"), rows[vector_col].cast("array<float>").alias("v")).where(F.col("id").isNotNull() & x.isNotNull()).where(real)
    own = saved(own.groupBy("id").agg(F.min("v").alias("v")), "vectors")
    size = own.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return own.where(F.size("v") == (size["size"] if size else 0))


def points(own: DataFrame, k: int) -> DataFrame:
    """(pid, v, ids): the distinct vectors with their ``k`` + 1 smallest ids (no query needs more), named by the smallest; saved."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = own.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    return saved(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.get("ids", F.lit(0)).alias("pid"), "v", "ids"), "vector-points")


# ---------------------------------------------------------------- the index

class Index:
    """Centres and rotation, of a size set by the parameters; ``stats`` has count, mean and variance of the
    squared distances to the centre for each list."""

    def __init__(self, centres: np.ndarray, rotation: np.ndarray):
        self.centres, self.rotation = centres, rotation
        self.stats = np.zeros((len(centres), 3))

    def squares(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x * x).sum(1)[:, None] + (self.centres * self.centres).sum(1) - 2 * x @ self.centres.T, 0)

    def expected(self, squares: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many vectors nearer than ``limit`` each list can be expected to hold, per query."""
        count, mean, var = self.stats.T
        spread = np.sqrt(var + 4 * squares * mean / self.centres.shape[1] + 1e-12)
        z = (limit[:, None] ** 2 - squares - mean) / spread
        return count * np.interp(z, _Z, _PHI)


_Z = np.linspace(-8, 8, 4001)
_PHI = np.array([0.5 * math.erfc(-z / math.sqrt(2)) for z in _Z])


def centres_of(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Lloyd's method on the sample."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.permutation(len(sample))[:lists]].astype(float)
    index = Index(centres, np.eye(sample.shape[1]))
    for _ in range(rounds):
        near = np.concatenate([index.squares(sample[i:i + 4096]).argmin(1) for i in range(0, len(sample), 4096)])
        count = np.bincount(near, minlength=len(centres))
        total = np.stack([np.bincount(near, sample[:, j], minlength=len(centres)) for j in range(sample.shape[1])], 1)
        index.centres[count > 0] = (total[count > 0].T / count[count > 0]).T
    return index.centres


def fit(pts: DataFrame, n: int, seed: int = 3) -> Index:
    lists = max(1, min(MAX_LISTS, round(math.sqrt(n))))
    bucket = F.pmod(F.xxhash64("v"), F.lit(SAMPLE * lists))
    rows = pts.groupBy(bucket.alias("b")).agg(F.min(F.struct(F.xxhash64(F.lit(seed), "v").alias("h"), "v")).alias("m")).select("m.v").collect()
    sample = np.array([r["v"] for r in rows])
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(sample.shape[1],) * 2))[0]
    return Index(centres_of(sample, min(lists, len(sample))), rotation)


def matrix(values: pa.Array) -> np.ndarray:
    """Rows of one length as a matrix."""
    flat = values.flatten().to_numpy()
    return flat.reshape(len(values), -1).astype(float) if len(values) else np.empty((0, 0))


def dealt(pts: DataFrame, index: Index) -> DataFrame:
    """The points with ``list`` and ``r2`` (squared distance to its centre); saved."""
    sent = pts.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            squares = sent.value.squares(matrix(column(b, "v")))
            near = squares.argmin(1)
            yield pa.RecordBatch.from_arrays([column(b, "pid"), column(b, "v"), pa.array(near.astype(np.int32)), pa.array(squares[np.arange(len(near)), near])], ["pid", "v", "list", "r2"])

    return saved(pts.select("pid", "v").mapInArrow(run, "pid long, v array<float>, list int, r2 double"), "vector-lists")


def probes(asked: DataFrame, index: Index, k: int) -> DataFrame:
    """(pid, v, limit, list) of the lists to scan: without a limit the nearest ``FIRST``; with one those among the
    others that are needed."""
    sent = asked.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 1024):
                b = big.slice(at, 1024)
                own = sent.value
                squares = own.squares(matrix(column(b, "v")))
                first = np.argsort(squares, 1, kind="stable")[:, :FIRST]
                if column(b, "limit").null_count:
                    q, lists = np.repeat(np.arange(len(first)), first.shape[1]), first.ravel()
                else:
                    held = own.expected(squares, column(b, "limit").to_numpy())
                    np.put_along_axis(held, first, -1, 1)
                    order = np.argsort(held, 1)  # least first
                    rest = np.cumsum(np.maximum(np.take_along_axis(held, order, 1), 0), 1)
                    q, place = np.nonzero((rest > MISSED * k) & (np.take_along_axis(held, order, 1) >= 0))
                    lists = order[q, place]
                at_q = pa.array(q)
                yield pa.RecordBatch.from_arrays([column(b, c).take(at_q) for c in ("pid", "v", "limit")] + [pa.array(lists.astype(np.int32))], ["pid", "v", "limit", "list"])

    return saved(asked.mapInArrow(run, "pid long, v array<float>, limit double, list int"), "vector-probes")


# ---------------------------------------------------------------- the scan

def scan(q: np.ndarray, x: np.ndarray, limit: np.ndarray, rotation: np.ndarray, names: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, distance): the ``most`` nearest of x for each query, as far as they pass the tests."""
    n, m, d = len(q), len(x), q.shape[1]
    rq, rx = (q @ rotation).astype(np.float32), (x @ rotation).astype(np.float32)
    bounds = [*range(0, d, COLUMNS), d]
    head = slice(0, bounds[1])
    partial = np.maximum((rq[:, head] ** 2).sum(1)[:, None] + (rx[:, head] ** 2).sum(1) - 2 * rq[:, head] @ rx[:, head].T, 0)
    limit2 = limit ** 2
    if m > most:  # the limit is at most the last place among those nearest so far
        some = np.argpartition(partial, most - 1, 1)[:, :most]
        limit2 = np.minimum(limit2, np.stack([((rx[s] - rq[i]) ** 2).sum(1).max() for i, s in enumerate(some)]))
    limit2 = limit2 * (1 + 1e-4)  # the scan is in single precision
    seen = bounds[1]
    qi, xi = np.nonzero(partial * (d / seen) <= (limit2 * (1 + EPSILON / math.sqrt(seen)) ** 2)[:, None]) if seen < d else np.nonzero(partial <= limit2[:, None])
    part = partial[qi, xi]
    for lo, hi in zip(bounds[1:-1], bounds[2:], strict=True):
        for at in range(0, len(qi), 1 << 17):
            s = slice(at, at + (1 << 17))
            part[s] += ((rx[xi[s], lo:hi] - rq[qi[s], lo:hi]) ** 2).sum(1)
        slack = (1 + EPSILON / math.sqrt(hi)) ** 2 if hi < d else 1
        stay = part * (d / hi) <= limit2[qi] * slack
        qi, xi, part = qi[stay], xi[stay], part[stay]
    exact = np.concatenate([np.sqrt(((x[xi[i:i + (1 << 17)]] - q[qi[i:i + (1 << 17)]]) ** 2).sum(1)) for i in range(0, len(qi), 1 << 17)] or [np.empty(0)])
    order = np.lexsort((names[xi], exact, qi))
    qi, xi, exact = qi[order], xi[order], exact[order]
    place = np.arange(len(qi)) - np.searchsorted(qi, qi)
    return qi[place < most], xi[place < most], exact[place < most]


def scanned(lists: DataFrame, wanted: DataFrame, index: Index, most: int) -> DataFrame:
    """(pid, found, score) of the queries ``wanted`` (pid, v, limit, list), per block of each probed list; saved."""
    spark = lists.sparkSession
    sent = spark.sparkContext.broadcast(index.rotation)
    asked = wanted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("parts"))
    held = lists.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    cut = F.broadcast(saved(asked.join(held, "list"), "vector-cells"))  # a row per list at most
    left = (wanted.join(cut, "list").withColumn("part", F.pmod(F.xxhash64("pid"), "parts")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("list", "part", "block", "pid", "v", "limit"))
    right = (lists.join(cut, "list").withColumn("block", F.pmod(F.xxhash64("pid"), "blocks")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("list", "part", "block", "pid", "v"))

    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        out = {"pid": [], "found": [], "score": []}
        if queries.num_rows and block.num_rows:
            q, x = (t.combine_chunks().column("v").combine_chunks() for t in (queries, block))
            ids, names = (t.column("pid").to_numpy() for t in (queries, block))
            limit = np.nan_to_num(queries.column("limit").to_numpy().astype(float), nan=np.inf)
            qi, xi, score = scan(matrix(q), matrix(x), limit, sent.value, names, most)
            out = {"pid": ids[qi], "found": names[xi], "score": score}
        return pa.table({"pid": pa.array(out["pid"], pa.int64()), "found": pa.array(out["found"], pa.int64()), "score": pa.array(out["score"], pa.float64())})

    key = ["list", "block", "part"]
    return saved(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "pid long, found long, score double"), "vector-found")


def nearest(rows: DataFrame, found: str, most: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("pid").orderBy("score", found))
    return rows.withColumn("rank", rank).where(F.col("rank") <= most)


def search(rows: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of each query (rows whose id meets ``is_query``, a function of the id column):
    query_id, rank (from 1), vec_id, score."""
    spark = rows.sparkSession
    own = vectors(rows, id_col, vector_col)
    pts = points(own, k)
    n = pts.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = saved(own.where(is_query(F.col("id"))).join(pts.select("pid", "v"), "v").select(F.col("id").alias("query_id"), "pid"), "vector-queries")
    asked = pts.join(queries.select("pid").distinct(), "pid").select("pid", "v")
    index = fit(pts, n)
    lists = dealt(pts, index)
    for r in lists.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.avg("r2").alias("mean"), F.var_pop("r2").alias("var")).collect():  # a row per list
        index.stats[r["list"]] = r["n"], r["mean"], r["var"]
    first = scanned(lists, probes(asked.withColumn("limit", F.lit(None).cast("double")), index, k), index, k + 1)
    last = nearest(first, "found", k + 1).groupBy("pid").agg(F.max("rank").alias("rank"), F.max("score").alias("limit"))
    # A query that found too few so far has no limit yet: every list may hold what it lacks.
    limit = F.when(F.col("rank") > k, F.col("limit")).otherwise(F.lit(float("inf")))
    further = probes(asked.join(last, "pid", "left").select("pid", "v", F.coalesce(limit, F.lit(float("inf"))).alias("limit")), index, k)
    both = first.unionByName(scanned(lists, further, index, k + 1))
    classes = saved(nearest(both, "found", k + 1).select("pid", "found", "score"), "vector-nearest")
    members = classes.join(pts.select(F.col("pid").alias("found"), "ids"), "found").select("pid", "score", F.explode("ids").alias("vec_id"))
    few = saved(nearest(members, "vec_id", k + 1).select("pid", "score", "vec_id"), "vector-answers")
    own_rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return (queries.join(few, "pid").where("vec_id <> query_id").withColumn("rank", own_rank.cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
