"""Exact join of documents by the Jaccard similarity of their word n-grams, as a metric-space join.

1 - Jaccard is a metric d. Two documents link when d <= r (r = 1/4 for a similarity of 0.75).
Documents with equal sets are one point: they are joined by a digest of the set.

First pivots are single shingles: the distance of a set x to {s} is 1 - 1/|x| if s is in x, else 1,
so a point's nearest pivots are its own shingles, and a fixed order of all shingles breaks the tie: a
point lies in the Voronoi region of its first shingle. A neighbour within r lacks less than a quarter of
x's shingles, so it shares one of the first |x| - ceil(3|x|/4) + 1 of them; a point is therefore
replicated into these regions, and any two neighbours meet in one. The order is by hash, with
shingles that fill large regions last (rarer first), so that a passage that many otherwise different
documents share does not make a region. The order decides how much work there is, not the result.

Two points meet in the region of the first shingle that they share, in that order. What stands before it in either
set is not in the other, which bounds their distance from its places in the two; a region's pairs beyond that
are none. Sizes bound it as well (the distance to the empty set). A sketch of 512 bits, each the parity of
the set's shingles that fall on it, is a contraction of the symmetric difference: as many bits as differ, so many
shingles differ at least. The three bounds need no texts and stand in the joins, so that these make few rows.

A region is joined by pivots that are points of it: first by one, then by some, and last, all by all, but every time only
points that are not connected yet. The pivots are the first of all points in one order, so that regions of nearly the same
points, as a group of copies has for each shingle of its prefixes, take the same ones. A region whose points are
all connected is finished. A group of many near copies is thus finished after a few pivots, without listing its pairs; points
of a region that are all unlike one another are only compared by the bounds.

Hot keys: documents with equal sets send one row per region and task; joins are plain joins of
saved tables, which Spark splits where one region or pivot is large; which shingles are shared is
told by sorting each shingle's points, a few bytes a row. Shingles and words are compared by 64-bit hashes.
A point's name is half of a 128-bit digest of its set; should two sets share it, all are named anew with another key.

Defined cases: a text without words (null, empty) has an empty set and links with nothing, not
even another; repeated rows, also of one id, are one point; a null id is never a component's
name unless all ids of the component are null; very long texts are used whole; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmetrics.llm import common
from feedmetrics.llm.common import column, only, plain_text, release, slices

#: Words of a shingle.
N = 5
#: Links: MUCH * intersection >= LEAST * union.
LEAST, MUCH = 75, 100
#: Regions of more points than this put their shingle last in the order ...
LARGE = 8
#: ... for at most so many shingles, the largest regions' (they are sent with the tasks).
MAX_LARGE = 100_000
#: Text bytes taken from Arrow at once; digests of sets and shingles that a task holds at most.
SLICE_BYTES, MAX_SEEN, MAX_HELD = 1 << 19, 200_000, 1_000_000
#: Spark's setting of the rows of an Arrow batch, and how many there are here: the JVM and Python each hold a batch's texts.
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 500
#: Pairs or points up to which a saved table of them is broadcast (16 bytes a row); beyond, joins are shuffled.
MAX_BROADCAST_ROWS = 200_000
#: Pivots of a region after the first; then so many times as many, then all its points.
PIVOTS, MORE_PIVOTS = 16, 16
#: 64-bit words of a sketch, and their columns.
WORDS = 8
SKETCH = [f"s{k}" for k in range(WORDS)]

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def saved(df: DataFrame, kind: str) -> DataFrame:
    """``common.saved``, with short Arrow batches."""
    conf = df.sparkSession.conf
    before = conf.get(BATCH)
    conf.set(BATCH, str(BATCH_ROWS))
    try:
        return common.saved(df, kind)
    finally:
        conf.set(BATCH, before)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_BYTES = np.random.default_rng(5).integers(1, 1 << 63, 256, np.uint64)
_STEP = 0x9E3779B97F4A7C15


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, offsets of each text): A-Z lower-cased, split at the six white-space
    bytes. A word's hash is a polynomial of its bytes' random numbers, for all words at once."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(plain_text(texts)))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words, offsets = lists.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]  # the input may be a slice
    blank = pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if blank.any():  # white space at an end gives an empty word
        kept = np.concatenate([[0], np.cumsum(~blank)])
        words, offsets = words.filter(pa.array(~blank)), kept[offsets]
    if not len(words):
        return np.empty(0, np.uint64), offsets
    place = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[place[0]:place[-1]]
    size, place = np.diff(place), place[:-1] - place[0]
    powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int(size.max()), _STEP, np.uint64)]))
    terms = _BYTES[data] * powers[np.arange(len(data)) - np.repeat(place, size)]
    return mixed(np.add.reduceat(terms, place) + size.astype(np.uint64)), offsets


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The distinct shingles of each text as ascending 64-bit hashes (signed)."""
    h, offsets = word_hashes(texts)
    runs = np.full(max(0, len(h) - N + 1), N, np.uint64)
    for j in range(N):
        runs += h[j:j + len(runs)] * _FACTORS[j]
    runs = mixed(runs).view(np.int64)
    out = []
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if hi - lo >= N:
            s = np.sort(runs[lo:hi - N + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif hi > lo:  # fewer words than a shingle: the whole sequence
            whole = np.uint64(hi - lo) + (h[lo:hi] * _FACTORS[:hi - lo]).sum(dtype=np.uint64)
            out.append(mixed(np.array([whole])).view(np.int64))
        else:
            out.append(np.empty(0, np.int64))
    return out


def prefix_size(n: int) -> int:
    """Shingles of which a neighbour shares at least one."""
    return n - -(-LEAST * n // MUCH) + 1


def first_shingles(s: np.ndarray, large: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first ``prefix_size`` of a set in the order; ``large`` are the shingles put last, by ``rank``."""
    p = prefix_size(len(s)) if len(s) else 0
    if not len(large):
        return s[:p]
    at = np.minimum(np.searchsorted(large, s), len(large) - 1)
    last = large[at] == s
    usual = s[~last][:p]
    if len(usual) < p:
        rest = s[last][np.argsort(rank[at[last]], kind="stable")]
        usual = np.concatenate([usual, rest[:p - len(usual)]])
    return usual


def per_text(docs: DataFrame, schema: str, make) -> DataFrame:
    """mapInArrow over (u, doc_id, text) with ``make`` from (slice, its sets) to a record batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only({})
        for big in batches:
            for b in slices(big, "text", SLICE_BYTES):
                yield make(b, shingle_sets(column(b, "text")))
        release()

    return docs.mapInArrow(run, schema)


def digest(s: np.ndarray, key: int) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16, salt=key.to_bytes(8, "little")).digest()


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``WORDS`` words for each set: the parities of its shingles by their last bits."""
    bits = 64 * WORDS
    place = np.concatenate([np.empty(0, np.int64), *sets]) & (bits - 1)
    place += np.repeat(np.arange(len(sets)) * bits, [len(s) for s in sets])
    odd = (np.bincount(place, minlength=bits * len(sets)) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(-1, WORDS)


def set_digests(key: int) -> Callable[[pa.RecordBatch, list[np.ndarray]], pa.RecordBatch]:
    def make(b: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
        raw = np.frombuffer(b"".join(digest(s, key) for s in sets), np.int64).reshape(-1, 2)
        sizes = np.array([len(s) for s in sets], np.int64)
        words = sketches(sets)
        return pa.RecordBatch.from_arrays([*(column(b, c) for c in ("u", "doc_id", "h")), pa.array(sizes), pa.array(raw[:, 0], mask=sizes == 0), pa.array(raw[:, 1]),
                                           *(pa.array(words[:, k]) for k in range(WORDS))], ["u", "doc_id", "h", "n", "cid", "d2", *SKETCH])

    return make


def fresh_sets(sets: list[np.ndarray], seen: set[bytes], key: int = 0) -> tuple[np.ndarray, list[np.ndarray]]:
    """(names, sets) of the sets of a slice that the task has not had yet: equal sets are one point, so a group of copies
    sends one row of each of its regions per task. ``seen`` holds digests, a bounded number of them."""
    names, fresh = [], []
    for s in sets:
        if len(s) and (d := digest(s, key)) not in seen:
            if len(seen) >= MAX_SEEN:
                seen.clear()
            seen.add(d)
            names.append(d[:8])
            fresh.append(s)
    return np.frombuffer(b"".join(names), np.int64), fresh


def region_rows(docs: DataFrame, large: np.ndarray, rank: np.ndarray, key: int) -> DataFrame:
    """Rows (shingle, point, its size, the shingle's place in it) of the regions of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for big in batches:
            for b in slices(big, "text", SLICE_BYTES):
                names, sets = fresh_sets(shingle_sets(column(b, "text")), seen, key)
                if len(sets):
                    own = [first_shingles(s, large, rank) for s in sets]
                    k = [len(x) for x in own]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.concatenate(own), np.repeat(names, k), np.repeat([len(s) for s in sets], k),
                                                                            np.concatenate([np.arange(x) for x in k]))], ["g", "cid", "n", "i"])
        release()

    return docs.select("text").mapInArrow(run, "g long, cid long, n long, i long")


def common_shingles(docs: DataFrame) -> DataFrame:
    """(g, n): shingles that would make large regions, by the texts that have them among their first ones in hash order.

    A task counts its own texts and tells those that it has seen twice or more; the sums leave out what no
    task saw twice. This only guides the order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        held: list[np.ndarray] = []

        def told() -> pa.RecordBatch:
            g, n = np.unique(np.concatenate(held) if held else np.empty(0, np.int64), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(g[n > 1]), pa.array(n[n > 1].astype(np.int64))], ["g", "n"])

        for big in batches:
            for b in slices(big, "text", SLICE_BYTES):
                _, sets = fresh_sets(shingle_sets(column(b, "text")), seen)
                held += [s[:int(prefix_size(len(s)) * 0.6) + 1] for s in sets]
                if sum(map(len, held)) > MAX_HELD:
                    yield told()
        yield told()
        release()

    return docs.mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).where(F.col("n") > LARGE)


def points(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(rows, points, key of their names). Per row: doc_id, h (hash of the text), n, cid (its point: the rows with an equal set,
    null without words). Per point: cid, n, u and h of a text that has the set (rows of one u may differ in text), sketch."""
    for key in count():
        rows = saved(per_text(docs, "u long, doc_id long, h long, n long, cid long, d2 long, " + ", ".join(f"{c} long" for c in SKETCH), set_digests(key)), "shingle-sets")
        made = rows.where("n > 0").groupBy("cid").agg(F.min(F.struct("u", "h")).alias("rep"), (F.min("d2") < F.max("d2")).alias("clash"), *(F.min(c).alias(c) for c in ("n", *SKETCH)))
        classes = saved(made.select("cid", "n", "rep.u", "rep.h", *SKETCH, "clash"), "points")
        if classes.where("clash").isEmpty():
            return rows.select("doc_id", "h", "n", "cid"), classes.drop("clash"), key


def regions(docs: DataFrame, key: int) -> DataFrame:
    """(g, cid, n, i, q, qn, qi, more): the points of each region of two or more but its first pivot q, and whether there are others; saved."""
    counts = saved(common_shingles(docs), "common-shingles")
    most = sorted((r["g"], r["n"]) for r in counts.orderBy(F.desc("n"), "g").limit(MAX_LARGE).collect())
    large = np.array([g for g, _ in most], np.int64)
    order = np.lexsort((large, np.array([n for _, n in most], np.int64)))
    rank = np.empty(len(large), np.int64)
    rank[order] = np.arange(len(large))
    w = Window.partitionBy("g").orderBy("cid")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Rows of one point, from several tasks, stand together; the last one stays.
    rows = region_rows(docs, large, rank, key).select("g", "cid", "n", "i", *(F.first(c).over(so_far).alias(q) for c, q in (("cid", "q"), ("n", "qn"), ("i", "qi"))),
                                                      F.lead("cid").over(w).alias("after"), F.dense_rank().over(w).alias("place"))
    rows = rows.where((F.col("cid") != F.col("q")) & (F.col("after").isNull() | (F.col("after") != F.col("cid"))))
    return saved(rows.select("g", "cid", "n", "i", "q", "qn", "qi", (F.col("after").isNotNull() | (F.col("place") > 2)).alias("more")), "regions")


def may_be_near(n: Column, m: Column) -> Column:
    """The bound by the sizes of two points."""
    return MUCH * F.least(n, m) >= LEAST * F.greatest(n, m)


def may_meet(n: Column, i: Column, m: Column, j: Column) -> Column:
    """The bounds by the sizes and by the places of the first shingle that both have: no more than follow it are common."""
    least = LEAST * (n + m)
    return may_be_near(n, m) & ((MUCH + LEAST) * (n - i) >= least) & ((MUCH + LEAST) * (m - j) >= least)


def alike(n: Column, m: Column, words: list[tuple[Column, Column]]) -> Column:
    """The bound by the sketches."""
    differ = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in words), F.lit(0))
    return (MUCH + LEAST) * differ <= (MUCH - LEAST) * (n + m)


def named(df: DataFrame, prefix: str, *kept: str) -> DataFrame:
    """The columns with a prefix, but those that are ``kept``."""
    return df.select(*(F.col(c).alias(c if c in kept else prefix + c) for c in df.columns))


class Comparer:
    """Compares pairs of points exactly, after the bounds by sizes and sketches."""

    def __init__(self, docs: DataFrame, classes: DataFrame):
        self.docs, self.classes = docs, classes

    def distances(self, pairs: DataFrame) -> DataFrame:
        """(a, b, link) of the pairs (a saved table) that pass the bounds; saved."""
        a, b = (named(self.classes.select("cid", "n", *SKETCH), c).withColumnRenamed(f"{c}cid", c) for c in "ab")
        # Few pairs (the later rounds): only the rows of their points move.
        if few(pairs):
            a, b = (x.join(F.broadcast(pairs.select(c).distinct()), c) for x, c in ((a, "a"), (b, "b")))
        na, nb = F.col("an"), F.col("bn")
        close = pairs.join(a, "a").join(b, "b").where(may_be_near(na, nb) & alike(na, nb, [(F.col(f"a{c}"), F.col(f"b{c}")) for c in SKETCH]))
        close = saved(close.select("a", "b", na.alias("na"), nb.alias("nb")), "close-pairs")
        texts = self.texts(close)
        ta, tb = (texts.select(F.col("cid").alias(c), F.col("text").alias(f"t{c}")) for c in "ab")
        if few(close):
            ta, tb = (x.join(F.broadcast(close.select(c).distinct()), c) for x, c in ((ta, "a"), (tb, "b")))
        rows = close.join(ta, "a").join(tb, "b")
        return saved(rows.select("a", "b", "na", "nb", "ta", "tb").mapInArrow(compare, "a long, b long, link boolean"), "distances")

    def texts(self, close: DataFrame) -> DataFrame:
        """(cid, text): a text of each point of some pairs; saved."""
        asked = close.select(F.col("a").alias("cid")).union(close.select(F.col("b").alias("cid"))).distinct()
        reps = saved(self.classes.select("cid", "u", "h").join(asked, "cid"), "representatives")
        # Where they are many, a merge join: they grow with the documents.
        own = F.broadcast(reps) if few(reps) else reps.hint("merge")
        return saved(self.docs.select("u", "h", "text").join(own, ["u", "h"]).dropDuplicates(["cid"]).select("cid", "text"), "point-texts")


def few(table: DataFrame) -> bool:
    """Whether a saved table is small enough to be broadcast."""
    return table.count() <= MAX_BROADCAST_ROWS


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether each pair of texts links; the sets of a batch's distinct points are made together."""
    for big in batches:
        for b in slices(big, "ta", SLICE_BYTES):
            text = dict(zip(column(b, "a").to_pylist(), column(b, "ta").to_pylist(), strict=True)) | dict(zip(column(b, "b").to_pylist(), column(b, "tb").to_pylist(), strict=True))
            size = dict(zip(column(b, "a").to_pylist(), column(b, "na").to_pylist(), strict=True)) | dict(zip(column(b, "b").to_pylist(), column(b, "nb").to_pylist(), strict=True))
            sets = dict(zip(text, shingle_sets(pa.array(text.values(), pa.large_string())), strict=True))
            rows = []
            for x, y in zip(column(b, "a").to_pylist(), column(b, "b").to_pylist(), strict=True):
                u, v = sets[x], sets[y]
                both = int((v[np.minimum(np.searchsorted(v, u), len(v) - 1)] == u).sum())
                union = size[x] + size[y] - both
                rows.append((x, y, MUCH * both >= LEAST * union))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.bool_()), strict=True)], ["a", "b", "link"])
    release()


def components(edges: DataFrame) -> DataFrame:
    """(cid, c): the smallest point connected with each point of ``edges`` (a, b); saved.

    Every round each point takes the smallest label around it and then that label's own label;
    both joins are on saved tables, minima are partial aggregations."""
    both = saved(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = saved(both.groupBy(F.col("a").alias("cid")).agg(F.least(F.col("cid"), F.min("b")).alias("c")), "labels")
    while True:
        near = saved(both.join(labels.select(F.col("cid").alias("b"), "c"), "b").groupBy(F.col("a").alias("cid")).agg(F.min("c").alias("m")), "near-labels")
        step = saved(labels.join(near, "cid").select("cid", F.least("c", "m").alias("c"), (F.col("m") < F.col("c")).alias("moved")), "labels-step")
        if not step.where("moved").limit(1).count():
            return step.select("cid", "c")
        own = step.select(F.col("cid").alias("c"), F.col("c").alias("up"))
        labels = saved(step.select("cid", "c").join(own, "c").select("cid", F.least("c", "up").alias("c")), "labels")


def region_links(docs: DataFrame, classes: DataFrame, key: int) -> DataFrame | None:
    """(cid, c) of all linked points; None if there are none."""
    rows = regions(docs, key)
    comparer = Comparer(docs, classes)
    n, i, m, j = (F.col(c) for c in ("n", "i", "qn", "qi"))
    pairs = rows.where(may_meet(n, i, m, j)).select(F.least("cid", "q").alias("a"), F.greatest("cid", "q").alias("b")).distinct()
    done = comparer.distances(saved(pairs, "pairs"))
    labels = None if done.where("link").isEmpty() else components(done.where("link"))
    # Regions of two points are done; the first pivots have been compared with all.
    now = rows.where("more").select("g", "cid", "n", "i")
    for many in (PIVOTS, PIVOTS * MORE_PIVOTS, None):
        now = now.withColumn("c", F.col("cid")) if labels is None else now.join(labels, "cid", "left").withColumn("c", F.coalesce("c", "cid"))
        mixed = saved(now.groupBy("g").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("g"), "mixed-regions")
        now = now.join(mixed, "g")
        if SKETCH[0] not in now.columns:
            now = now.join(classes.select("cid", *SKETCH), "cid")
        now = saved(now, "region-state")
        if now.isEmpty():
            break
        if many is None:
            others, once = now, F.col("cid") < F.col("qcid")
        else:
            # The draw goes by point alone: regions of nearly the same points take the same pivots.
            salt = F.pmod(F.xxhash64("cid"), F.lit(many)).alias("salt")
            drawn = now.groupBy("g", salt).agg(F.min("cid").alias("cid")).select("g", "cid")
            others, once = now.join(drawn, ["g", "cid"]), F.col("cid") != F.col("qcid")
        both = now.join(named(others, "q", "g"), "g").where(
            once & (F.col("c") != F.col("qc")) & may_meet(n, i, m, j) & alike(n, m, [(F.col(c), F.col(f"q{c}")) for c in SKETCH]))
        pairs = both.select(F.least("cid", "qcid").alias("a"), F.greatest("cid", "qcid").alias("b")).distinct()
        fresh = comparer.distances(saved(pairs.join(done.select("a", "b"), ["a", "b"], "left_anti"), "pairs"))
        done = saved(done.unionByName(fresh), "compared")
        if not fresh.where("link").isEmpty():
            labels = components(done.where("link"))
        now = now.drop("c")
    return labels


def prepared(docs: DataFrame) -> DataFrame:
    """u (a key of the row: its id, or a hash of the text where that is null), doc_id, h, text."""
    doc = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc, F.xxhash64("text")).alias("u"), doc.alias("doc_id"), F.xxhash64("text").alias("h"), "text")


def linked(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, h (hash of the text), n_shingles, c (its component, null without words); saved."""
    docs = prepared(docs)
    rows, classes, key = points(docs)
    labels = region_links(docs, classes, key)
    rows = rows.withColumn("c", F.col("cid")) if labels is None else rows.join(labels, "cid", "left").withColumn("c", F.coalesce("c", "cid"))
    return saved(rows.select("doc_id", "h", F.col("n").alias("n_shingles"), "c"), "labelled-rows")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest id of its component)."""
    rows = linked(docs)
    first = saved(rows.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("first")), "component-names")
    return rows.join(first, "c", "left").select("doc_id", "n_shingles", F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("first")).alias("component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, that come first in their component: by id (null
    last), then hash of the text; of rows that repeat id and text one stays. Rows without words
    link with nothing and all stay."""
    rows = linked(docs)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "h")
    first = saved(rows.where("c is not null").groupBy("c").agg(F.min(place).alias("first")), "first-of-component")
    gone = saved(rows.join(first, "c").where(place != F.col("first")).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct(), "copies")
    own = docs["doc_id"].cast("long").eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_h"])
    left = docs.join(gone.hint("merge"), own, "left_anti")
    again = rows.where("c is not null").groupBy("doc_id", "h").count().where("count > 1")
    if again.isEmpty():
        return left
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return left.where(worded).dropDuplicates(["doc_id", "text"]).unionByName(left.where(~worded))
