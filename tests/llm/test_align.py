"""Cross-tokenizer alignment (13): against a plain walk over both libraries' tokens."""

import hashlib
from collections import Counter

import pyarrow as pa
import pytest

from feedmetrics.llm import align
from feedmetrics.llm.bpe import byte_letters, flat_ids
from feedmetrics.llm.common import table
from feedmetrics.llm.queries import op13_align, tokenizer_path

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", "<s> </s>", "<|endoftext|> x", "x\n", "\nx", "  a", " a b", "a\x00b", "ﬁ é", "▁", "a▁b", "日本 \U0001F600é", "it's  we'll", "x" * 3000, "l.\x0b\t \n  x", "ab " * 500, "end.\nStart of line\nnext"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(libraries, text):
    """(A ids, B ids, groups, links) by interval overlap; None where there are no tokens."""
    t, sp = libraries
    if not text:
        return None
    letters = byte_letters()
    a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    raw = [[bytes(letters[c] for c in t.id_to_token(i)) for i in a], [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]]
    if any(b"".join(r) != (" " + text).encode() for r in raw):
        return None
    spans = []
    for r in raw:
        at, own = 0, []
        for x in r:
            own.append((at, at + len(x)))
            at += len(x)
        spans.append(own)
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, lo = [], 0
    for c in cuts:
        groups.append(([i for i, (_, e) in zip(a, spans[0], strict=True) if lo < e <= c], [i for i, (_, e) in zip(b, spans[1], strict=True) if lo < e <= c]))
        lo = c
    links, first = [], 0
    for i, (s, e) in zip(a, spans[0], strict=True):
        while first < len(b) and spans[1][first][1] <= s:
            first += 1
        k = first
        while k < len(b) and spans[1][k][0] < e:
            links.append((i, b[k]))
            k += 1
    return a, b, groups, links


def expected(libraries, rows):
    found = [plain(libraries, t) for _, t in rows]
    count = Counter(p for f in found if f for p in set(f[3]))
    most = Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for (doc_id, _), f in zip(rows, found, strict=True):
        if f is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_given_documents(spark, sf_dir, libraries):
    docs = table(spark, sf_dir, "documents").where("length(text) < 6000 or text is null").select("doc_id", "text")
    assert sorted(map(tuple, align.align(docs, A, B, chunk_bytes=40_000).collect()), key=repr) == expected(libraries, [tuple(r) for r in docs.collect()])


def test_query_covers_the_table(spark, sf_dir):
    got = op13_align(spark, sf_dir)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r["doc_id"] for r in got.collect()} == {r["doc_id"] for r in table(spark, sf_dir, "documents").collect()}


def test_odd_texts(spark, libraries):
    rows = [(None if i == 3 else i // 2, t) for i, t in enumerate(ODD)] + [(50, "same text"), (50, "same text"), (51, "same text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as chunk", "'x' as pair", "2 as n_a")
    assert sorted(map(tuple, align.align(docs, A, B).collect()), key=repr) == expected(libraries, rows)
    assert align.align(docs.limit(0), A, B).count() == 0
    text = {r["groups"] for r in align.groups(docs.where("doc_id = 51"), A, B).collect()}
    assert text == {";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in plain(libraries, "same text")[2])}


def test_tokens_equal_the_libraries(spark, libraries):
    own = align.Aligner(align._read(A), align._read(B))
    texts = [r["text"] for r in table(spark, "/root/testdata/sf0.01", "documents").collect()] + [t for t in ODD if t]
    t, sp = libraries
    for e, want in ((own.a, [t.encode(" " + x, add_special_tokens=False).ids for x in texts]), (own.b, [sp.encode(x) for x in texts])):
        ids, ends = flat_ids(e.encode(pa.array(texts)))
        assert [ids[x:y].tolist() for x, y in zip(ends, ends[1:])] == want  # noqa: B905
