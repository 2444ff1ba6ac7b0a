"""Divergence rules (6), chat collapse (7) and language identification (10)."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedmetrics.llm import chat, crf, divergence
from feedmetrics.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))  # noqa: B905
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed)


def test_base_counts_against_brute_force(spark, sf_dir):
    odd = [(9001, None), (9002, ""), (9003, " \n\t\x0b"), (9004, "a b c a b c a b c"), (9005, "x\n\nx\n \nx"), (9006, "é é # 日本"), (9007, "w1 w2 w3 " * 40000), (None, "no id"), (9001, None)]
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(i, t, None) for i, t in odd], "doc_id long, text string, lang string"))
    docs = docs.withColumn("kept", F.lit("clash"))
    got = divergence.judge(docs).collect()
    names = divergence.NAMES[1:7]
    assert sorted(((r["doc_id"], *(r[c] for c in names)) for r in got), key=repr) == sorted(((r["doc_id"], *base(r["text"])) for r in docs.collect()), key=repr)
    assert all(not (r["base_failed"] and r["kept"]) for r in got)
    clean = [r for r in got if not r["base_failed"] and r["class_distance"] < 0.2]
    assert clean and all(r["kept"] for r in clean if r["word_distance"] < 0.4)
    assert divergence.judge(docs.limit(0)).count() == 0


def test_distances():
    p, q = np.array([0.5, 0.5, 0]), np.array([0, 0.5, 0.5])
    assert divergence.js_distance(p, p) == 0 and divergence.js_distance(np.array([1.0, 0]), np.array([0, 1.0])) == 1
    assert divergence.js_distance(p, q) == pytest.approx(0.5 ** 0.5)
    refs = {"a": divergence.Reference(divergence.class_counts(b"plain words here"), {b"the": 0.5, b"of": 0.1})}
    near = divergence.nearest([b"the", b"of", b"x", b"the"], divergence.class_counts(b"the of x the"), refs)
    far = divergence.nearest([b"THE!!"] * 4, divergence.class_counts(b"THE!! THE!!"), refs)
    assert far[0] > 0.7 > near[0] and far[1] > near[1]


def test_noise_of_any_length_is_rejected(spark):
    """Words that are common in no language, and 'word | word' texts, of few and of many words."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    refs = divergence.references(docs)
    rng = random.Random(3)
    prose = [w for t, in docs.where("lang = 'en'").select("text").limit(200).collect() for w in (t or "").split() if w.isascii()]
    seldom = sorted({w for w in prose if w.isalpha() and not any(w.encode() in r.words for r in refs.values())})
    rows = []
    for n in (60, 200, 2000):
        rows += [(n, " ".join(rng.choices(seldom, k=n))), (n + 1, " ".join(w if i % 2 else "|" for i, w in enumerate(rng.choices(seldom, k=n)))), (n + 2, " ".join(rng.choices([w for w in prose if w != "|"], k=n)))]
    got = {r["doc_id"]: r for r in divergence.judge(spark.createDataFrame(rows, "doc_id long, text string"), refs).collect()}
    assert {i: (r["base_failed"], r["kept"]) for i, r in got.items()} == {n + k: (False, k == 2) for n in (60, 200, 2000) for k in range(3)}


def brute_chat(rows):
    convs = {}
    for c, turn, role, text in sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r)):
        convs.setdefault(c, []).append((role, text))
    whole = {c: tuple(t) for c, t in convs.items()}
    begun = {t[:i] for t in whole.values() for i in range(1, len(t))}
    kept = {}
    for c, t in whole.items():
        if t not in begun:
            kept.setdefault(t, []).append(c)
    return sorted(((min((c for c in cs if c is not None), default=None), len(t), "".join(f"<|im_start|>{r or ''}\n{x or ''}<|im_end|>\n" for r, x in t)) for t, cs in kept.items()), key=repr)


CHATS = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "bot", "b"), (3, 5, "user", "a"), (3, 9, "bot", "b"), (4, 0, "user", None), (5, 0, "user", ""), (6, 0, None, "user"),
         (7, 0, "user", "a"), (7, 0, "user", "a"), (None, 0, "user", "z"), (None, None, "user", "y"), (8, 0, "user", "a"), (8, 1, "bot", "c"), (9, 0, "u", "w " * 50000)]


def test_collapse_against_brute_force(spark, sf_dir):
    turns = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string").withColumn("n_turns", F.lit(1)).withColumn("i", F.lit(0))
    assert sorted(map(tuple, chat.collapse_and_render(turns).collect()), key=repr) == brute_chat(CHATS)
    given = table(spark, sf_dir, "conversations")
    begun = given.where("turn < 2 and conv_id < 20").withColumn("conv_id", F.col("conv_id") + 10 ** 6)
    both = given.unionByName(begun)
    assert sorted(map(tuple, chat.collapse_and_render(both).collect()), key=repr) == brute_chat([tuple(r) for r in both.collect()])
    assert chat.collapse_and_render(turns.limit(0)).count() == 0


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(3)
    e, first, move = rng.random((7, 3)), rng.random(3), rng.random((3, 3))
    start, count = np.array([0, 1, 5]), np.array([1, 4, 2])
    post, pairs = crf.forward_backward(e, start, count, first, move, pairs=True)
    expect, moves = np.zeros_like(e), np.zeros((3, 3))
    for s, n in zip(start, count, strict=True):
        weight, own, step = 0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=n):
            w = first[path[0]] * np.prod([e[s + i, k] for i, k in enumerate(path)]) * np.prod([move[a, b] for a, b in itertools.pairwise(path)])
            weight += w
            for i, k in enumerate(path):
                own[i, k] += w
            for a, b in itertools.pairwise(path):
                step[a, b] += w
        expect[s:s + n], moves = own / weight, moves + step / weight
    assert np.allclose(post, expect) and np.allclose(pairs, moves)


@pytest.fixture(scope="module")
def field(spark):
    return crf.learn(table(spark, "/root/testdata/sf0.01", "documents"), buckets=150)


def test_held_out_accuracy(spark, field):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = crf.identify(docs, field).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_code_switched_words(field):
    lines = {"en": "the and of thing that there", "de": "der die und nicht schein ungen"}
    e = np.stack([np.frombuffer(x, np.float32) for x in field.emissions(f"{lines['en']} {lines['de']}".split())]).astype(float)
    post, _ = crf.forward_backward(e, np.array([0]), np.array([len(e)]), field.first, field.move)
    assert [field.labels[k] for k in post.argmax(1)] == ["en"] * 6 + ["de"] * 6


def test_text_without_spaces_is_read_to_its_end(field):
    """Every letter of an unbroken run or of words joined by commas is labelled, in pieces."""
    assert crf.words_of("Ab,c1d--É") == ["ab", "c", "d", "é"] and crf.words_of("12,") == [] and crf.words_of("e\u0301t") == ["et"]
    assert list(map(len, crf.words_of("日" * 100))) == [40, 40, 20]
    few, many = "the,and,of,that,there,", "der,die,und,nicht,schein,"
    recent = crf.Recent(field.emissions, 1000)
    got, _ = field.predict(pa.array([few * 2 + many * 40, many * 2 + few * 40, "the" * 20 + "schein" * 200, "schein" * 20 + "the" * 400]), recent)
    assert got.to_pylist() == ["de", "en", "de", "en"]


def test_words_are_labelled(spark, field):
    rows = [(1, "the and of thing\nder die und nicht, der schein"), (2, None), (3, "12 --"), (None, "the and of that there")]
    got = {r["doc_id"]: r for r in crf.label_words(spark.createDataFrame(rows, "doc_id long, text string"), field).collect()}
    assert got[1]["words"] == "the and of thing der die und nicht der schein".split()
    assert got[1]["labels"] == ["en"] * 4 + ["de"] * 6 and got[None]["labels"] == ["en"] * 5
    assert got[2]["words"] == got[2]["labels"] == got[3]["words"] == []


def test_language_of_odd_rows(spark, field):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !! --\n", "en"), (None, "the and of that", None), (5, "the and of that " * 30000, "de"), (5, "the and of that", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1))
    got = crf.identify(docs, field).collect()
    assert [r["lang_pred"] for r in sorted(got, key=lambda r: (r["doc_id"] or 99))] == ["und", "und", "und", "en", "en", "en"]
    assert crf.keep_identified(docs, field=field).columns == docs.columns and crf.keep_identified(docs, field=field).count() == 3
    nothing = crf.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}
    assert crf.identify(docs.limit(0)).count() == 0
