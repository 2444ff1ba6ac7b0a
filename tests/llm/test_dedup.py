"""Decontamination (3), line dedup (4), Jaccard join (5) and the pipeline, against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedmetrics.llm import decontaminate, jaccard, line_dedup
from feedmetrics.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- decontamination ---------------------------------------------------------------------------

def index_of(items):
    rows, df, n, total = [], Counter(), 0, 0
    for i, text in items:
        q, a = ([t for t in x if t] for x in decontaminate.terms_of(pa.array(list(decontaminate.parts(text)), pa.string())).to_pylist())
        if q or a:
            rows.append((i, q, a))
            for at in range(0, len(q + a), decontaminate.SEGMENT):
                df.update(set((q + a)[at:at + decontaminate.SEGMENT]))
                n += 1
            total += len(q + a)
    return decontaminate.build_index(rows, n, total / n, df)


def test_retrieval_against_all_scores():
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    items = [(k, " ".join(r.choices(vocabulary, weights, k=r.randint(3, 150)))) for k in range(60)]
    index = index_of(items)
    docs = []
    for _ in range(60):
        words = r.choices(vocabulary, weights, k=r.randint(0, 700))
        if r.random() < 0.7:
            own = r.choice(items)[1].split()
            words[len(words) // 2:len(words) // 2] = own[r.randint(0, len(own) // 2):]
        docs.append(" ".join(words))
    dense = np.zeros((len(index.item_of), len(index.terms)))
    term = np.repeat(np.arange(len(index.terms)), np.diff(index.start))
    dense[index.segment, term] = index.impact
    assert np.allclose(dense.sum(1), 1)
    number = {t: i for i, t in enumerate(index.terms.to_pylist())}
    expect = {}
    for d, text in enumerate(docs):
        ids = [number.get(w, -1) for w in text.split()]
        for at in range(0, max(1, len(ids)), decontaminate.WINDOW // 2):
            own = sorted({t for t in ids[at:at + decontaminate.WINDOW] if t >= 0})
            for s, x in enumerate(dense[:, own].sum(1)):
                if x >= 0.6:
                    key = d, int(index.item_of[s])
                    expect[key] = max(x, expect.get(key, 0))
    got = {(d, k): x for d, k, x, _, _ in decontaminate.find(index, pa.array(docs), 0.6, 0.0)}
    assert expect and got.keys() == expect.keys() and all(abs(got[k] - expect[k]) < 1e-9 for k in got)


def test_leaks(spark):
    item = "What is the colour of the quiet northern harbour light?\nIt is a deep amber seen only before dawn."
    question = item.split("\n")[0]
    items = spark.createDataFrame([(1, item), (2, None), (3, "..."), (4, "tiny"), (4, "tiny")], "item_id long, text string").withColumn("doc_id", F.lit(1))
    rows = [(1, f"Before it. {item} After it."), (2, f"Only {question} here"), (3, None), (4, ""), (5, "word " * 100000 + item.upper()), (6, "clean text of a harbour"),
            (7, "a tiny thing"), (None, item), (1, f"Before it. {item} After it.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = sorted(((r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()), key=repr)
    assert got == sorted([(1, 1), (1, 1), (5, 1), (None, 1), (7, 4), (7, 4)], key=repr)
    left = decontaminate.decontaminate(docs, items)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4, 6]
    qa = spark.createDataFrame([(9, question, item.split("\n")[1])], "item_id long, q string, a string")
    assert decontaminate.find_leaks(docs, qa, question_col="q", answer_col="a").count() == 4
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0 and decontaminate.decontaminate(docs, items.limit(0)).count() == len(rows)
    assert decontaminate.find_leaks(docs.limit(0), items).count() == 0


def test_index_in_blocks_gives_the_same(spark, sf_dir, monkeypatch):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    one = sorted(map(tuple, decontaminate.find_leaks(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 20_000)
    many = sorted(map(tuple, decontaminate.find_leaks(docs, items).collect()))
    assert one and [x[:2] for x in one] == [x[:2] for x in many] and np.allclose([x[2:] for x in one], [x[2:] for x in many])
    verbatim = {(d["doc_id"], i["item_id"]) for d in docs.collect() for i in items.collect() if i["text"] in d["text"]}
    assert verbatim <= {x[:2] for x in one}


def test_short_items_are_reported_not_found(spark):
    items = spark.createDataFrame([(1, "Paris"), (2, "Yes.\nNo"), (3, "the quick brown fox jumps over the lazy dog\nand runs away"), (4, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "we went to Paris in spring"), (2, "they say yes and no"), (3, "look: the quick brown fox jumps over the lazy dog and runs away home")], "doc_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()] == [(3, 3)]
    assert sorted(map(tuple, decontaminate.short_items(items).collect())) == [(1, 1), (2, 2), (4, 0)]


# -- line dedup --------------------------------------------------------------------------------

def brute_lines(docs, least):
    """Deleted lines by the definition: every repeated run, every later copy."""
    seqs = [(i, t.split("\n")) for i, t in sorted({d for d in docs if d[1] is not None}, key=lambda d: (d[0] is not None, d[0] or 0, d[1]))]
    gone = {k: set() for k in range(len(seqs))}
    for a, (_, x) in enumerate(seqs):
        for s in range(len(x)):
            best = 0
            for b in range(a + 1):
                y = seqs[b][1]
                for t in range(len(y) if b < a else s):
                    n = 0
                    while s + n < len(x) and t + n < len(y) and x[s + n] == y[t + n]:
                        n += 1
                    best = max(best, n)
            if sum(len(WORD.findall(z)) for z in x[s:s + best]) >= least:
                gone[a] |= set(range(s, s + best))
    return {(i, "\n".join(x)): ("\n".join(z for j, z in enumerate(x) if j not in gone[k]) if len(gone[k]) < len(x) else None, len(gone[k])) for k, (i, x) in enumerate(seqs)}


def line_docs():
    r = random.Random(11)
    pool = ["", "a", "b c", "d e f", "one two three four", "x " * 6, "Ti wh"]
    docs = [(i, "\n".join(r.choice(pool) if r.random() < 0.8 else f"own {r.random()}" for _ in range(r.randint(1, 25)))) for i in range(40)]
    docs += [(100 + i, docs[i % 5][1]) for i in range(10)] + [(200, None), (201, ""), (202, "\n\n"), (None, docs[3][1]), (5, docs[5][1]), (5, "other text"), (300, "a\n" * 60)]
    return docs


@pytest.mark.parametrize("least", [7, 20])
def test_line_dedup_against_brute_force(spark, least):
    rows = line_docs()
    expect = brute_lines(rows, least)
    docs = spark.createDataFrame([(*d, 1, 2) for d in rows], "doc_id long, text string, n_deleted int, rank int")
    got = line_dedup.delete_repeats(docs.withColumn("before", F.col("text")), min_words=least).collect()
    assert len(got) == len(rows) and got[0].__fields__[:4] == ["doc_id", "text", "rank", "before"]
    assert any(x[1] for x in expect.values())
    for r in got:
        if r["before"] is None:
            assert r["text"] is None and r["n_lines"] == 0 and r["n_deleted"] == 0
        else:
            assert (r["text"], r["n_deleted"]) == expect[r["doc_id"], r["before"]], r["doc_id"]
            assert r["n_lines"] == len(r["before"].split("\n"))


def test_line_dedup_of_repeated_rows(spark):
    """A run of 60 words over five lines in a row given twice or more, as the later and as the earliest copy."""
    run = ["\n".join(" ".join(f"{p}{i}w{j}" for j in range(12)) for i in range(5)) for p in "abc"]
    rows = [(1, run[0]), (2, f"own\n{run[0]}")] + [(2, f"own\n{run[0]}")] + [(3, run[1])] * 3 + [(4, f"{run[1]}\nend"), (5, f"x\n{run[2]}\ny"), (None, run[2]), (None, run[2])]
    got = line_dedup.delete_repeats(spark.createDataFrame(rows, "doc_id long, text string").withColumn("before", F.col("text"))).collect()
    expect = brute_lines(rows, 50)
    assert len(got) == len(rows) and sorted(expect[r["doc_id"], r["before"]] == (r["text"], r["n_deleted"]) for r in got) == [True] * len(rows)
    assert [r["n_deleted"] for r in sorted(got, key=lambda r: r["doc_id"] or 0)] == [0, 0, 0, 5, 5, 0, 0, 0, 5, 5]


def test_line_dedup_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert line_dedup.delete_repeats(docs.limit(0)).count() == 0
    assert [tuple(r) for r in line_dedup.delete_repeats(docs).collect()] == [(1, "a", 1, 0)]


# -- Jaccard join ------------------------------------------------------------------------------

def shingles(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    name = list(range(len(rows)))

    def top(i):
        while name[i] != i:
            i = name[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                name[top(i)] = top(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[top(i)] = min(d, ids.get(top(i), d))
    return [(d, len(s), (ids.get(top(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def jaccard_docs(size=1.0):
    r = random.Random(4)

    def prose(n):
        return [f"w{r.randint(0, 5000)}" for _ in range(n)]

    def near(words, k):
        words = list(words)
        for _ in range(k):
            words[r.randrange(len(words))] = f"v{r.randint(0, 10 ** 6)}"
        return words

    shared, base, chain = prose(60), prose(120), prose(100)
    texts = [" ".join(prose(r.randint(1, 90))) for _ in range(40)]
    texts += [" ".join([*prose(60), *shared, *prose(60)]) for _ in range(int(40 * size))]  # a passage that many share
    texts += [" ".join(near(base, r.randint(0, 8))) for _ in range(int(60 * size))]  # a group around the limit
    for _ in range(int(25 * size)):
        chain = near(chain, 2)
        texts.append(" ".join(chain))                                                # linked one to the next
    texts += [" ".join(shared), " ".join(shared).upper(), "a b", "A  b", "b a", "one", "", None, "  \n", " ".join(prose(30000))]
    texts += [texts[3]] * 5 + [texts[-20]] * 5
    rows = [(i, t) for i, t in enumerate(texts)]
    r.shuffle(rows)
    return [*rows, (7, "seven again with other words than before here"), (7, texts[7]), (None, texts[20]), (None, "no id at all in this one"), (None, texts[20])]


@pytest.mark.parametrize(("large", "pivots"), [(8, 16), (2, 2)])
def test_jaccard_against_brute_force(spark, monkeypatch, large, pivots):
    monkeypatch.setattr(jaccard, "LARGE", large)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    rows = jaccard_docs(1.0 if large == 8 else 0.2)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(0)).withColumn("c", F.lit("clash"))
    got = sorted((tuple(r) for r in jaccard.near_duplicates(docs).collect()), key=repr)
    assert got == sorted(brute_components(rows), key=repr)


def test_one_of_each_group_stays(spark):
    rows = jaccard_docs(0.2)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit(1))
    got = jaccard.keep_first(docs)
    assert got.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in got.collect()]
    # Text decides the component; of each there is one, that with the smallest id (null last).
    texts = sorted({t for _, t in rows if shingles(t)})
    place = {t: i for i, t in enumerate(texts)}
    component = {t: c for t, (_, _, c) in zip(texts, brute_components([(place[t], t) for t in texts]), strict=True)}
    best = {}
    for d, t in rows:
        if shingles(t):
            best[component[t]] = min(best.get(component[t], 10 ** 9), 10 ** 9 if d is None else d)
    assert sum(not shingles(t) for _, t in left) == sum(not shingles(t) for _, t in rows)
    assert sorted((component[t], 10 ** 9 if d is None else d) for d, t in left if shingles(t)) == sorted(best.items())
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0 and jaccard.keep_first(docs.limit(0)).count() == 0


def test_rows_without_words_stay(spark):
    """Also where they are repeated, and other documents are as well."""
    blank = [(1, " \n"), (1, " \n"), (2, ""), (2, ""), (None, None), (None, None)]
    docs = spark.createDataFrame([*blank, (3, "a b c"), (3, "a b c")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.keep_first(docs).collect()), key=repr) == sorted([*blank, (3, "a b c")], key=repr)


def test_slices_of_a_batch_are_read_right():
    texts = ["one two three four five six", None, "", " \t", "a b", "Ab c d e f g h ", "x " * 50]
    rng = random.Random(8)
    texts += [" ".join(f"W{rng.randint(0, 99)}é" for _ in range(rng.randint(1, 900))) for _ in range(20)]
    for lo in range(len(texts)):
        part, whole = pa.array(texts).slice(lo, 3), pa.array(texts[lo:lo + 3], pa.string())
        assert [s.tolist() for s in jaccard.shingle_sets(part)] == [s.tolist() for s in jaccard.shingle_sets(whole)]
        assert [len(s) for s in jaccard.shingle_sets(part)] == [len(shingles(t)) for t in texts[lo:lo + 3]]
        for got, want in zip(decontaminate.flat_terms(part), decontaminate.flat_terms(whole), strict=True):
            assert got.tolist() == want.tolist()


# -- pipeline ----------------------------------------------------------------------------------

def test_pipeline_stages(spark, sf_dir, scratch):
    docs = table(spark, sf_dir, "documents")
    extra = spark.createDataFrame([(10 ** 6, None, None, None, None), (10 ** 6 + 1, "", "en", "s", 0), (10 ** 6 + 2, "12 34", "en", "s", 5)], docs.schema)
    docs = docs.unionByName(extra)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, sf_dir).write.parquet(f"{scratch}/{k}")
        out = spark.read.parquet(f"{scratch}/{k}")
        after = out.collect()
        if name != "bpe":
            assert out.columns == docs.columns
        left = {r["doc_id"]: r for r in after}
        gone = before.keys() - left.keys()
        if name == "language_id":
            assert {10 ** 6, 10 ** 6 + 1, 10 ** 6 + 2} <= gone and len(gone) <= 5
        if name == "line_dedup":
            expect = brute_lines(list(before.items()), 50)
            assert {i: r["text"] for i, r in left.items()} == {i: t for (i, _), (t, n) in expect.items() if t is not None}
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        if name == "jaccard_join":
            assert left.keys() == {c for _, _, c in brute_components(list(before.items()))}
        if name == "decontamination":
            items = [r["text"] for r in table(spark, sf_dir, "benchmark").collect()]
            assert {i for i, t in before.items() if any(x in t for x in items)} <= gone
            assert len(gone) < 0.2 * len(before)
        if name == "bpe":
            assert not gone
        docs = out


def test_near_copies_are_compared_with_few_pivots(spark, monkeypatch):
    words = [f"w{i}" for i in range(120)]
    docs = spark.createDataFrame([(i, " ".join([*words[:i], f"x{i}", *words[i + 1:]])) for i in range(100)], "doc_id long, text string")
    counts, distances = [], jaccard.Comparer.distances
    monkeypatch.setattr(jaccard.Comparer, "distances", lambda self, pairs: counts.append(pairs.count()) or distances(self, pairs))
    assert {r["component_id"] for r in jaccard.near_duplicates(docs).collect()} == {0}
    assert sum(counts) < 100 * 30


def test_unlike_points_of_a_region_are_told_apart_by_the_bounds(spark, monkeypatch):
    """Much in common, but not enough to link: the pairs would grow with the square of the group."""
    r = random.Random(11)
    words = [f"w{i}" for i in range(70)]
    docs = spark.createDataFrame([(i, " ".join(f"x{i}_{j}" if j in gone else w for j, w in enumerate(words))) for i in range(150) for gone in [r.sample(range(70), 4)]], "doc_id long, text string")
    counts, distances = [], jaccard.Comparer.distances
    monkeypatch.setattr(jaccard.Comparer, "distances", lambda self, pairs: counts.append(pairs.count()) or distances(self, pairs))
    got = sorted(map(tuple, jaccard.near_duplicates(docs).collect()), key=repr)
    assert got == sorted(brute_components([tuple(r) for r in docs.collect()]), key=repr)
    assert sum(counts) < 150 * 10


def test_sketches_never_tell_more_than_differs():
    rng = np.random.default_rng(3)
    base = rng.integers(-1 << 62, 1 << 62, 900)
    sets = [np.unique(np.concatenate([base[:k], rng.integers(-1 << 62, 1 << 62, m)])) for k, m in ((900, 0), (880, 9), (500, 2), (0, 1), (0, 0), (3, 2000))]
    bits = np.unpackbits(jaccard.sketches(sets).view(np.uint8), axis=1).astype(int)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            assert np.abs(bits[i] - bits[j]).sum() <= len(np.setxor1d(x, y))
