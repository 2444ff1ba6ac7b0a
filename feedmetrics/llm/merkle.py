"""Merkle manifest of a dataset as a postorder append log, with proofs of membership.

The leaves of a tree (one tree per source) are numbered in order; every ``ARITY`` consecutive
nodes of a level have their hash as parent, the last run being shorter, until one is left. So all
leaves lie at the same depth, and the node ``index`` of ``level`` covers the leaves from
``index * ARITY ** level`` on.

Aligned builders make the nodes: a builder holds an aligned subtree of ``ARITY ** LEVELS`` leaves, appends
each node to its log at the moment it is complete (postorder) and reports its root, which is a leaf
for the builders of the tier above. Where a node stands in a log needs no index: its position follows
from the sizes of the subtrees before it (``position``). A proof is extracted by computing the
positions of the siblings of each level and reading the log there: within the builder's own log, and for
the levels above it once per builder, not once per leaf. ``append_log`` gives the whole
tree's log, in global postorder, and ``prove`` extracts single proofs from it by an equi-join on positions.

Scale: leaves are numbered by a range shuffle on (tree, key, leaf) and counts of each range, so a
source with a third of the rows is spread; a builder's row has at most that many leaves; a tier has a
few hundredths of the rows of the one below. The trees' roots go through the same code as one more tree.

Defined cases: a null field is hashed as ``-``; a null id sorts first and is not tampered with; rows that
repeat an id are ordered by their leaf hash, equal rows are leaves of their own; empty and very
long texts are hashed whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmetrics.llm.common import column, saved

ARITY = 3
#: Levels of one builder's subtree; it has ``ARITY ** LEVELS`` leaves.
LEVELS = 5
#: Range pieces of trees beyond which their offsets are joined by a shuffle, not broadcast.
MAX_BROADCAST_ROWS = 500_000
#: Hex characters of a digest.
WIDTH = 64


def field(value: Column) -> Column:
    """A value as it enters a leaf's hash: ``-`` if null, else byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """Per row: source, doc_id, leaf, and ``changed``: the leaf after tampering, where that differs."""
    doc = F.col("doc_id").cast("long")

    def leaf(text: Column) -> Column:
        return F.sha2(F.concat(field(doc), field(F.col("source")), field(F.col("lang")), field(F.col("n_chars").cast("long")), field(text)), 256)

    tampered = (F.crc32(doc.cast("string")) % 2 == 0) & F.contains(F.col("text"), F.lit("\n"))
    return docs.select(F.col("source"), doc.alias("doc_id"), leaf(F.col("text")).alias("leaf"),
                       F.when(tampered, leaf(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).alias("changed"))


def numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with i (0-based place in its tree, by ``keys``, nulls first) and n (the tree's rows).

    The range-sorted rows are stored with a number that has the range in its upper bits, so
    a lost task renumbers nothing; the rows before a range come from one count per tree and range."""
    order = ["tree", *keys]
    stored = saved(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "merkle-ranges")
    place = F.shiftright("at", 33)
    per = stored.groupBy("tree", place.alias("range")).agg(F.count(F.lit(1)).alias("k"), F.min("at").alias("first"))
    from pyspark.sql import Window

    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("k").over(tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = saved(per.select("tree", "range", (F.col("first") - before).alias("offset"), F.sum("k").over(tree).alias("n")), "merkle-offsets")
    side = F.broadcast(per) if per.count() <= MAX_BROADCAST_ROWS else per.hint("merge")
    return stored.withColumn("range", place).join(side, ["tree", "range"]).withColumn("i", F.col("at") - F.col("offset")).drop("range", "at", "offset")


# ---------------------------------------------------------------- one builder's subtree

def digest(parts: bytes) -> bytes:
    return hashlib.sha256(parts).hexdigest().encode()


def depth(n: int) -> int:
    """Levels above the leaves until one node is left."""
    d = 0
    while n > 1:
        n, d = -(-n // ARITY), d + 1
    return d


def position(level, index, n: int, height: int):
    """Postorder position of the node ``index`` of ``level`` in a tree of ``n`` leaves and ``height`` levels
    (numbers or arrays): of the levels up to its own, the nodes that its last leaf has completed; of
    those above, the nodes that the leaves before that one completed."""
    done = np.minimum((np.asarray(index, np.int64) + 1) * ARITY ** np.asarray(level, np.int64), n)
    return sum(np.where(np.asarray(level) >= j, -(-done // ARITY ** j), (done - 1) // ARITY ** j) for j in range(height + 1)) - 1


def postorder(own: list[bytes], height: int) -> list[bytes]:
    """The log of a subtree: every node appended when it is complete."""
    log: list[bytes] = []
    open_: list[list[bytes]] = [[] for _ in range(height + 1)]
    for k, leaf in enumerate(own):
        last, node = k == len(own) - 1, leaf
        for level in range(height + 1):
            log.append(node)
            if level == height:
                break
            run = open_[level]
            run.append(node)
            if len(run) < ARITY and not last:
                break
            node, open_[level] = digest(b"".join(run)), []
    return log


def siblings(log: list[bytes], n: int, height: int) -> list[list[tuple[int, list[bytes]]]]:
    """Per leaf, per level: (its place among the run's nodes, the run's other nodes), read from the log."""
    out: list[list[tuple[int, list[bytes]]]] = [[] for _ in range(n)]
    for level in range(height):
        count = -(-n // ARITY ** level)
        at = position(level, np.arange(count), n, height).tolist()
        nodes = [log[p] for p in at]
        steps = [(i % ARITY, [nodes[j] for j in range(i - i % ARITY, min(i - i % ARITY + ARITY, count)) if j != i]) for i in range(count)]
        span = ARITY ** level
        for i, own in enumerate(out):
            own.append(steps[i // span])
    return out


def one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch as Python objects, one at a time (a builder's row is long)."""
    return (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows))


def fold(node: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    for place, others in path:
        node = digest(b"".join([*others[:place], node, *others[place:]]))
    return node


def packed(path: list[tuple[int, list[bytes]]]) -> bytes:
    return b"".join(bytes([place, len(others)]) + b"".join(others) for place, others in path)


def unpacked(raw: bytes) -> list[tuple[int, list[bytes]]]:
    path, at = [], 0
    while at < len(raw):
        place, k = raw[at], raw[at + 1]
        path.append((place, [raw[at + 2 + WIDTH * j:at + 2 + WIDTH * (j + 1)] for j in range(k)]))
        at += 2 + WIDTH * k
    return path


def cut(raw: bytes) -> list[bytes]:
    return [raw[i:i + WIDTH] for i in range(0, len(raw), WIDTH)]


# ---------------------------------------------------------------- all builders, tier by tier

BLOCK = "tree string, n long, b long, leaves string"


def build(blocks: DataFrame, levels: int) -> DataFrame:
    """Rows (tree, n, b, leaves) with the log of each aligned subtree (hex digests joined)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            logs = [b"".join(postorder(cut(own.encode()), min(levels, depth(n)))).decode()
                    for n, own in zip(column(b, "n").to_pylist(), column(b, "leaves").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(logs, pa.string())], [*b.schema.names, "log"])

    return blocks.select("tree", "n", "b", "leaves").mapInArrow(run, BLOCK + ", log string")


def joined_leaves(rows: DataFrame, i: str, leaf: str, span: int) -> DataFrame:
    """Rows (tree, n, i, leaf) gathered by builder: at most ``span`` of them each."""
    own = F.array_sort(F.collect_list(F.struct(F.col(i).alias("i"), F.col(leaf).alias("leaf"))))
    return rows.groupBy("tree", "n", F.floor(F.col(i) / span).alias("b")).agg(F.array_join(F.transform(own, lambda x: x["leaf"]), "").alias("leaves"))


def tiers(rows: DataFrame, levels: int) -> list[DataFrame]:
    """The builders of each tier, the lowest first: (tree, n, b, leaves, log); saved. ``n`` counts the tier's leaves."""
    span = ARITY ** levels
    out = [saved(build(joined_leaves(rows, "i", "leaf", span), levels), "merkle-tier")]
    while True:
        open_ = out[-1].where(F.col("n") > span)
        if open_.isEmpty():
            return out
        tops = open_.select("tree", F.ceil(F.col("n") / span).alias("n"), "b", F.right("log", F.lit(WIDTH)).alias("leaf"))
        out.append(saved(build(joined_leaves(tops, "b", "leaf", span), levels), "merkle-tier"))


def roots(built: list[DataFrame], levels: int) -> DataFrame:
    """(tree, subroot): the last node appended to the log of each tree's uppermost builder."""
    tops = [t.where(F.col("n") <= ARITY ** levels).select("tree", F.right("log", F.lit(WIDTH)).alias("subroot")) for t in built]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def paths(built: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """(tree, b, above, subroot, root) of every lowest builder: the proof path from its root on,
    handed down tier by tier. ``above``: (tree, above, subroot, root) of whole trees."""
    carried = None
    for t in reversed(built[1:]):
        carried = saved(hand_down(with_above(t, carried, above, levels), levels), "merkle-paths")
    return with_above(built[0], carried, above, levels)


def with_above(tier: DataFrame, carried: DataFrame | None, above: DataFrame, levels: int) -> DataFrame:
    span = ARITY ** levels
    own = tier.where(F.col("n") <= span).join(above, "tree")
    if carried is None:
        return own
    return own.unionByName(tier.where(F.col("n") > span).join(carried, ["tree", "b"]), allowMissingColumns=True)


def hand_down(rows: DataFrame, levels: int) -> DataFrame:
    """(tree, b, above, ...) of the children of each builder."""
    span = ARITY ** levels
    names = pa.schema([("tree", pa.string()), ("b", pa.int64()), ("above", pa.binary()), ("subroot", pa.string()), ("root", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in one_by_one(batch):
                found = siblings(cut(r["log"].encode()), len(r["leaves"]) // WIDTH, min(levels, depth(r["n"])))
                yield pa.RecordBatch.from_pylist([{"tree": r["tree"], "b": r["b"] * span + i, "above": packed(p) + r["above"], "subroot": r["subroot"], "root": r["root"]} for i, p in enumerate(found)], names)

    return rows.select("tree", "n", "b", "leaves", "log", "above", "subroot", "root").mapInArrow(run, "tree string, b long, above binary, subroot string, root string")


class Manifest:
    """The trees of a dataset: one per source, and the tree of their roots."""

    def __init__(self, docs: DataFrame, levels: int = LEVELS):
        self.levels = levels
        rows = leaves(docs).withColumn("tree", tree_name(F.col("source"))).drop("source")
        self.rows = saved(numbered(rows, ["doc_id", "leaf"]), "merkle-leaves")
        self.sources = tiers(self.rows, levels)
        subroots = roots(self.sources, levels).select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("leaf"))
        self.names = saved(numbered(subroots, ["name"]), "merkle-sources")
        self.top = tiers(self.names, levels)

    def root(self) -> DataFrame:
        return roots(self.top, self.levels).select(F.col("subroot").alias("root"))

    def builders(self) -> DataFrame:
        """Each lowest builder with the path from its root to the dataset's root."""
        start = self.root().select(F.lit("").alias("tree"), F.lit(b"").cast("binary").alias("above"), F.lit("").alias("subroot"), "root")
        own = paths(self.top, start, self.levels)
        down = hand_down(own, self.levels).select(F.col("b").alias("i"), "above", "root")
        above = saved(self.names.join(down, "i").select(F.col("name").alias("tree"), "above", F.col("leaf").alias("subroot"), "root"), "merkle-above")
        return paths(self.sources, above, self.levels)


def tree_name(source: Column) -> Column:
    """A tree's name: sorts as the sources do, null first."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def verify(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256 (of its siblings up to the root), folded_root
    (from the tampered leaf, where the row is tampered with) and verified."""
    manifest = Manifest(docs, levels)
    own = F.array_sort(F.collect_list(F.struct("i", "doc_id", "changed")))
    docs_of = manifest.rows.groupBy("tree", F.floor(F.col("i") / ARITY ** levels).alias("b")).agg(own.alias("docs"))
    rows = docs_of.join(manifest.builders(), ["tree", "b"]).select("docs.doc_id", "docs.changed", "n", "leaves", "log", "above", "subroot", "root")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in one_by_one(batch):
                yield pa.RecordBatch.from_pylist(list(proofs(r, levels)), pa.schema([(c, pa.int64() if c == "doc_id" else pa.bool_() if c == "verified" else pa.string()) for c in (x.split()[0] for x in PROOF.split(", "))]))

    return rows.mapInArrow(run, PROOF)


def proofs(r: dict, levels: int) -> Iterator[dict]:
    """The proofs of one builder's leaves. The path above the builder is folded once per node that reaches it."""
    own, above = cut(r["leaves"].encode()), unpacked(r["above"])
    found = siblings(cut(r["log"].encode()), len(own), min(levels, depth(r["n"])))
    tail = b"".join(x for _, others in above for x in others)
    reached: dict[bytes, bytes] = {}
    for leaf, doc_id, changed, path in zip(own, r["doc_id"], r["changed"], found, strict=True):
        node = fold(changed.encode() if changed else leaf, path)
        if node not in reached:
            reached[node] = fold(node, above)
        folded = reached[node].decode()
        yield {"doc_id": doc_id, "leaf": leaf.decode(), "subroot": r["subroot"], "root": r["root"],
               "proof_sha256": digest(b"".join(x for _, others in path for x in others) + tail).decode(), "folded_root": folded, "verified": folded == r["root"]}


# ---------------------------------------------------------------- the whole log, and single proofs from it

def append_log(built: list[DataFrame], counts: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(tree, start, digests): the nodes of each tree in global postorder, as runs that one builder
    completes together. ``counts``: (tree, total) with the leaves of each tree."""
    out = None
    for k, tier in enumerate(built):
        def run(batches: Iterator[pa.RecordBatch], k: int = k) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in one_by_one(batch):
                    yield pa.RecordBatch.from_pylist(list(runs(r, k, levels)), pa.schema([("tree", pa.string()), ("start", pa.int64()), ("digests", pa.string())]))

        rows = tier.join(counts, "tree").select("tree", "n", "b", "leaves", "log", "total").mapInArrow(run, "tree string, start long, digests string")
        out = rows if out is None else out.unionByName(rows)
    return out


def runs(r: dict, tier: int, levels: int) -> Iterator[dict]:
    """A builder's log as runs at global positions. Its leaves are left out where they are roots of the tier below."""
    log, count, total = cut(r["log"].encode()), len(r["leaves"]) // WIDTH, r["total"]
    height, whole = min(levels, depth(r["n"])), depth(total)
    where = {}
    for level in range(0 if tier == 0 else 1, height + 1):
        index = np.arange(-(-count // ARITY ** level))
        own = position(level, index, count, height).tolist()
        every = position(tier * levels + level, index + r["b"] * ARITY ** (levels - level), total, whole).tolist()
        where.update(zip(every, own, strict=True))
    start, nodes = None, []
    for p in sorted(where):
        if start is not None and p == start + len(nodes):
            nodes.append(log[where[p]])
            continue
        if nodes:
            yield {"tree": r["tree"], "start": start, "digests": b"".join(nodes).decode()}
        start, nodes = p, [log[where[p]]]
    if nodes:
        yield {"tree": r["tree"], "start": start, "digests": b"".join(nodes).decode()}


def run_start(level: int, index: int, n: int, levels: int) -> int:
    """Start of the log run that holds a node: its builder's first leaf, or the first node that was
    completed with it in its builder."""
    height = depth(n)
    tier, span = max(0, level - 1) // levels, ARITY ** levels
    if tier == 0:
        return int(position(0, index * ARITY ** level // span * span, n, height))
    last = min((index + 1) * ARITY ** level, n)
    low = tier * levels + 1
    return int(position(low, -(-last // ARITY ** low) - 1, n, height))


def prove(log: DataFrame, wanted: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(tree, i, level, place, sibling) for each (tree, i, total) of ``wanted``: the proof of leaf i, read
    from the append log by an equi-join on the starts of its runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                n, height = r["total"], depth(r["total"])
                for level in range(height):
                    own = r["i"] // ARITY ** level
                    for j in range(own - own % ARITY, min(own - own % ARITY + ARITY, -(-n // ARITY ** level))):
                        if j != own:
                            start = run_start(level, j, n, levels)
                            rows.append({"tree": r["tree"], "i": r["i"], "level": level, "place": j % ARITY, "start": start, "skip": int(position(level, j, n, height)) - start})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("tree", pa.string()), *((c, pa.int64()) for c in ("i", "level", "place", "start", "skip"))]))

    asked = wanted.select("tree", "i", "total").mapInArrow(run, "tree string, i long, level long, place long, start long, skip long")
    node = F.substr("digests", (F.col("skip") * WIDTH + 1).cast("int"), F.lit(WIDTH))
    return asked.join(log, ["tree", "start"]).select("tree", "i", "level", "place", node.alias("sibling"))
