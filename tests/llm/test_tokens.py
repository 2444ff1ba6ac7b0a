"""BPE (9) and token files (1): against the tokenizers library, exact round trips, odd inputs."""

import hashlib
import itertools
import random
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedmetrics.llm import bpe, token_files
from feedmetrics.llm.queries import tokenizer_path

ODD = ["", " ", "\n\n", "a", "it's  we'll\t'x", "<|endoftext|>", "a<|endoftext|> b", "<|endoftext|><|endoftext|>", "ab " * 3000, "x" * 5000, "日本 \U0001F600é",
       "l.\x0b\t \n  x", "\x1ctt  \x85 ' \x1c\né dlt", "1234 567", "... !!", " lead", "trail ", "a\nb\n\nc", "'s't", "aaaaaaaaaaaa " * 5]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def memory():
    with open(tokenizer_path(), "rb") as f:
        return bpe.Memory(f.read())


def want(library, text):
    return library.encode(text, add_special_tokens=False).ids


def ids_of(encoder, texts):
    flat, ends = bpe.flat_ids(encoder.encode(pa.array(texts, pa.string())))
    return [flat[a:b].tolist() for a, b in itertools.pairwise(ends.tolist())]


def test_encoding_equals_the_library(library, memory):
    r = random.Random(1)
    texts = ODD + [None] + ["".join(r.choice("thein anorstr.,'\n") for _ in range(r.randint(1, 300))) for _ in range(300)]
    encoded = memory.encode(pa.array(texts, pa.string()))
    back, said = memory.texts_of(encoded, memory.bytes_of), memory.texts_of(encoded, memory.said)
    for text, ids, b, s in zip(texts, ids_of(memory, texts), back, said, strict=True):
        assert ids == want(library, text or ""), text[:50]
        assert bytes(s).decode() == "".join(f"{i}," for i in ids)
        assert bpe.shown(b).decode() == library.decode(ids, skip_special_tokens=False) == (text or "")


@pytest.mark.parametrize("shape", ["x {}'s y", "x  {}'s y", "{}", "a{}\n{}b"])
def test_every_character_is_split_as_the_library_does(library, memory, shape):
    texts = [shape.replace("{}", chr(c)) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    if shape != "x {}'s y":
        texts = texts[:0x3000] + texts[0x3000::29] + [shape.replace("{}", c) for c in "\u0558\u058b\u088f\u0c5c\u0cdc\U00010940"]
    with open(tokenizer_path(), "rb") as f:
        other = token_files.LibraryEncoder(f.read())
    for at in range(0, len(texts), 50_000):
        some = texts[at:at + 50_000]
        expect = [e.ids for e in library.encode_batch_fast(some, add_special_tokens=False)]
        assert ids_of(memory, some) == expect
        assert ids_of(other, some) == expect


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_round_trips(library, memory, text):
    if any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    assert ids_of(memory, [text]) == [want(library, text)]
    assert bytes(memory.texts_of(memory.encode(pa.array([text])), memory.bytes_of)[0]).decode() == text


def test_speculation_and_both_merging_ways_agree(memory):
    b, r = memory.bpe, random.Random(2)
    words = ["".join(r.choice("thaeinor") for _ in range(r.randint(1, 60))).encode() for _ in range(2000)]
    exact = [array("I", b._heap([b.id_of[w[i:i + 1]] for i in range(len(w))])).tobytes() for w in words]
    assert b._together(words) == exact and b.exact(words) == exact
    assert b.encode_words(words) == exact
    flat, owner = b.greedy(words)
    greedy = [flat[owner == i].astype("<u4").tobytes() for i in range(len(words))]
    assert [b"".join(b.bytes_of[t] for t in flat[owner == i]) for i in range(50)] == words[:50]
    assert 0 < sum(g != e for g, e in zip(greedy, exact, strict=True)) < len(words)  # some are verified, some fail
    assert b.reachable.all()


def test_recent_keeps_keys_in_use():
    seen = []
    recent = bpe.Recent(lambda keys: seen.extend(keys) or [k.encode() * 2 for k in keys], 3 * bpe.KEY_BYTES)
    for keys in (["1", "2", "3", "4"], ["1", "5"], ["1", "6", "7", "8"], ["1", "9"]):
        assert recent.get(keys) == [k.encode() * 2 for k in keys]
    assert seen.count("1") == 1 and len(recent.young) + len(recent.old) < 9


#: Texts a worker has seen, and a slice after them in which an empty text stands between new pieces, the next after a space.
SEEN, BETWEEN = ["start the word", "start"], ["start thenew word", "", "start newword, other", None, "thirdnew", "", "start\nfourthnew x"]


def test_token_files_take_empty_texts_between_new_pieces(library):
    with open(tokenizer_path(), "rb") as f:
        own = token_files.LibraryEncoder(f.read())
    assert ids_of(own, SEEN) == [want(library, t) for t in SEEN]
    assert ids_of(own, BETWEEN) == [want(library, t or "") for t in BETWEEN]
    for keys in itertools.permutations(["", "\n", "\r", "\x02", "a", "\nb", "\rc", "\x02.", "\vd"], 5):
        assert own.compute([*keys]) == [array("I", want(library, bpe.piece_text(k))).tobytes() for k in keys]


def test_digests_take_empty_texts_between_new_pieces(library):
    with open(tokenizer_path(), "rb") as f:
        own = bpe.Memory(f.read())
    assert ids_of(own, SEEN) == [want(library, t) for t in SEEN]
    assert ids_of(own, BETWEEN) == [want(library, t or "") for t in BETWEEN]
    for keys in itertools.permutations(["", "\n", "\r", "\x02", "a", "\nb", "\rc", "\x02.", "\vd"], 5):
        assert [*own.compute([*keys])] == [array("I", want(library, bpe.piece_text(k))).tobytes() for k in keys]


def rows(spark):
    data = [(3, "b a", 1), (1, None, 2), (2, "", 3), (1, "dup", 4), (1, "dup", 4), (None, "no id", 5), (7, "long word " * 20000, 6)] + [(100 + i, t, 0) for i, t in enumerate(ODD)]
    return spark.createDataFrame(data, "doc_id long, text string, n_tokens int")


def test_digests(spark, library):
    got = sorted(map(tuple, bpe.encode_digests(rows(spark), tokenizer_path()).collect()), key=repr)
    expect = []
    for r in rows(spark).collect():
        ids = want(library, r["text"] or "")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), r["text"] or "")]
        expect.append((r["doc_id"], len(ids), *sha))
    assert got == sorted(expect, key=repr)
    assert bpe.encode_digests(rows(spark).limit(0), tokenizer_path()).count() == 0


def test_encode_and_decode_keep_columns(spark, library):
    out = bpe.decode(bpe.encode(rows(spark), tokenizer_path()), tokenizer_path())
    assert out.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    for r in out.collect():
        assert r["ids"] == want(library, r["text"] or "") and r["decoded"] == (r["text"] or "")


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_planes_round_trip(planes):
    for n in (1, 7, 8, 1000):
        ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
        data = token_files.to_planes(ids, planes)
        assert len(data) == (4 if planes == "byte" else 32)
        assert (token_files.from_planes(data, n, planes) == ids).all()


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_token_files_equal_the_library(spark, library, scratch, planes):
    got = [tuple(r) for r in token_files.token_file_digests(rows(spark), tokenizer_path(), f"{scratch}/t", planes=planes, block_ids=64).collect()]
    order = sorted(rows(spark).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or ""))
    expect, start = [], 0
    for r in order:
        ids = want(library, r["text"] or "") + [0]
        expect.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=repr) == sorted(expect, key=repr)


def test_any_chunk_is_read_alone(spark, scratch):
    token_files.write_token_files(rows(spark), tokenizer_path(), f"{scratch}/t", block_ids=100)
    folder = token_files.Folder(f"{scratch}/t/shards")
    for m in spark.read.parquet(f"{scratch}/t/manifest").collect():
        with folder.read(m["file"]) as f:
            shard = token_files.ShardReader(f)
            chunks = shard.head["chunks"]
            assert [len(shard.chunk(k)) for k in range(len(chunks))] == [c[1] for c in chunks]
            assert sum(c[1] for c in chunks) == m["n_ids"] and all(c[1] == 100 for c in chunks[:-1])


def test_empty_table_gives_no_files(spark, scratch):
    assert token_files.token_file_digests(rows(spark).limit(0), tokenizer_path(), f"{scratch}/e").count() == 0


def test_a_worker_keeps_the_models_of_one_operator():
    """A pipeline's stages run in the same Python workers, one after the other."""
    import pickle

    from feedmetrics.llm import crf

    blob = zlib.compress(pickle.dumps(crf.Field([], {}, np.zeros((1, 0)), np.zeros(0), np.zeros((0, 0)))))
    with open(tokenizer_path(), "rb") as f:
        file = f.read()
    field = crf.loaded(blob)
    assert crf.loaded(blob) is field
    own = bpe.memory(file)
    assert not crf._fields and bpe.memory(file) is own
    token_files.encoder(file)
    assert not bpe._loaded and token_files._encoder
    crf.loaded(blob)
    assert not token_files._encoder and crf._fields
