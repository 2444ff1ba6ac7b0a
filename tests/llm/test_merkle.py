"""Merkle manifest (11): against a plain recursion and the registered SQL; the log, its positions and proofs."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from feedmetrics.llm import merkle, oracle
from feedmetrics.llm.common import table
from feedmetrics.llm.queries import op11_merkle

LAYOUT = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def path(tree, i):
    out = []
    for level in tree[:-1]:
        run = level[i - i % 3:i - i % 3 + 3]
        out.append((i % 3, [x for j, x in enumerate(run) if j != i % 3]))
        i //= 3
    return out


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = [levels([leaf(r, r["text"]) for r in by[s]]) for s in names]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(by[s]):
            steps = path(trees[k], i) + path(top, k)
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(r, text)
            for place, others in steps:
                node = h("".join([*others[:place], node, *others[place:]]))
            out.append((r["doc_id"], trees[k][0][i], trees[k][-1][0], top[-1][0], h("".join(x for _, o in steps for x in o)), node, node == top[-1][0]))
    return sorted(out, key=repr)


def got(docs, levels=merkle.LEVELS):
    return sorted(map(tuple, merkle.verify(docs, levels).collect()), key=repr)


@pytest.mark.parametrize("span", [1, 5])
def test_against_recursion(spark, sf_dir, span):
    """With builders of three leaves the trees have several tiers."""
    docs = table(spark, sf_dir, "documents").withColumn("source", F.when(F.col("doc_id") % 3 > 0, "hot").otherwise(F.col("source")))
    assert got(docs, span) == expected(docs.collect())


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "a\nb", "x", None, 3), (5, "", "x", "", 0), (5, "", "x", "", 0), (6, "l\n" * 5000, None, "é", None), (7, "\n", "y", "s", -1), (8, "日\n本", "y", "s", 2), (7, "t", "y", "s", 1)]
    docs = spark.createDataFrame(rows, LAYOUT).selectExpr("*", "1 as tree", "'x' as leaf", "2 as i")
    assert got(docs) == expected([r.asDict() for r in docs.collect()])
    one = docs.where("doc_id = 6")
    (r,) = merkle.verify(one).collect()
    assert r["subroot"] == r["leaf"] == r["root"] and r["proof_sha256"] == h("")
    assert merkle.verify(docs.limit(0)).count() == 0


def test_sql_twin(spark):
    import duckdb

    sf_dir = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    assert sorted(map(tuple, op11_merkle(spark, sf_dir).collect())) == sorted(con.sql(oracle.MERKLE).fetchall())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 100])
def test_positions_are_the_postorder(n):
    height = merkle.depth(n)
    log = merkle.postorder([str(i).encode() for i in range(n)], height)
    node = {(0, i): str(i).encode() for i in range(n)}
    for level in range(1, height + 1):
        for i in range(-(-n // 3 ** level)):
            node[level, i] = merkle.digest(b"".join(node[level - 1, j] for j in range(3 * i, min(3 * i + 3, -(-n // 3 ** (level - 1))))))
    assert len(log) == len(node) and all(log[int(merkle.position(level, i, n, height))] == x for (level, i), x in node.items())


def test_append_log_and_proofs_from_it(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("source", F.when(F.col("doc_id") % 2 == 0, "hot").otherwise(F.col("source")))
    manifest = merkle.Manifest(docs, 2)
    counts = manifest.rows.select("tree", F.col("n").alias("total")).distinct()
    log = merkle.append_log(manifest.sources, counts, 2).collect()
    for name, total in [tuple(r) for r in counts.collect()]:
        runs = sorted((r["start"], r["digests"]) for r in log if r["tree"] == name)
        at = 0
        for start, digests in runs:  # every node once, in completion order, without a gap
            assert start == at
            at += len(digests) // merkle.WIDTH
        own = [r["leaf"].encode() for r in manifest.rows.where(F.col("tree") == name).orderBy("i").collect()]
        assert "".join(d for _, d in runs) == b"".join(merkle.postorder(own, merkle.depth(total))).decode()
    rows = manifest.rows.where("tree = 'shot'").select("tree", "i", F.col("n").alias("total"))
    leaves = [r["leaf"] for r in manifest.rows.where("tree = 'shot'").orderBy("i").collect()]
    steps = {}
    for r in merkle.prove(spark.createDataFrame(log), rows, 2).collect():
        steps.setdefault(r["i"], []).append((r["level"], r["place"], r["sibling"]))
    tree = levels(leaves)
    for i in range(len(leaves)):
        assert [x for _, _, x in sorted(steps[i])] == [x for _, others in path(tree, i) for x in others]
