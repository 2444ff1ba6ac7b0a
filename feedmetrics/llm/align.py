"""Alignment of two tokenizers' tokens: byte-level BPE of a tokenizers file (A), and a sentencepiece model (B).

A text, with a space before it, is tokenised whole by both. Where the byte offsets at which tokens
of A and of B end coincide, and the next token of either begins with a space, stands a verified
anchor; anchors cut a document into windows of token ids. Windows are aligned once: Arrow numbers a
slice's distinct windows by their tuples of ids, and each is aligned once for all documents of the slice (most
windows are common words). A window's alignment is its groups (cut where tokens of both end) and its links
(tokens whose bytes overlap).

Tokenising is exact and uses the same repetition: a run of characters after one space is encoded once,
since no token of either tokenizer crosses such a border (checked on the vocabulary); a text
with other white space is encoded whole.

How many documents hold an id pair linked is counted over the corpus in two steps: documents are
taken in chunks of about ``CHUNK_BYTES``; a chunk counts its own pairs once, so a pair that every
document has is one row per chunk; the sums go back to the chunks by a join on the pair, and each chunk's
documents are scored from its windows. Nothing is gathered beyond a chunk.

Defined cases: texts that are null, empty, or whose tokens' bytes differ from the text with its space
have no tokens (zeros, empty digest); a null id stays null; repeated rows count each as a document; very
long texts are aligned whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmetrics.llm.bpe import LINE, PieceEncoder, _read, byte_letters, flat_ids
from feedmetrics.llm.common import column, only, plain_text, release, saved, slices, worker_cache
from feedmetrics.llm.token_files import LibraryEncoder

SPACE = "▁"
#: Text bytes of a chunk; bytes of pieces that a worker remembers for each tokenizer in each of two generations.
CHUNK_BYTES, REMEMBERED_BYTES = 3 << 20, 28 << 20


class SpacedEncoder(LibraryEncoder):
    """Tokenizer A on texts with a space before them; special tokens' texts are ordinary text."""

    start = ""

    def __init__(self, file: bytes):
        super().__init__(file, plain=True)
        self.recent.most = REMEMBERED_BYTES
        letters = byte_letters()
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        table = [b""] * (max(self.tokenizer.get_vocab().values()) + 1)
        for t, i in vocab.items():
            if all(c in letters for c in t):
                table[i] = bytes(letters[c] for c in t)
        self.bytes_of = pa.array(table, pa.large_binary())

    def whole(self, text: str) -> bytes:
        return super().whole(" " + text)


class SentenceEncoder(PieceEncoder):
    """Tokenizer B, which puts the space before a text itself."""

    start = ""

    def __init__(self, file: bytes):
        super().__init__()
        self.recent.most = REMEMBERED_BYTES
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=file)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        special = {i for i in range(size) if self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)}
        table = [b"" if i in special else bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.bytes_of = pa.array(table, pa.large_binary())
        self.space = self.model.piece_to_id(SPACE)
        # No piece crosses the border before a space or on either side of a line feed.
        self.local = not any("\n" in p or SPACE in p.lstrip(SPACE) for i, p in enumerate(pieces) if i not in special)

    def encode(self, texts: pa.Array) -> pa.LargeBinaryArray:
        if self.local:
            return super().encode(texts)
        return pa.array([self.whole(t) for t in plain_text(texts).to_pylist()], pa.large_binary())

    def whole(self, text: str) -> bytes:
        return array("I", self.model.encode(text, num_threads=1) if text else []).tobytes()

    def compute(self, keys: list[str]) -> Iterator[bytes]:
        for k, ids in zip(keys, self.model.encode(keys, num_threads=1) if keys else [], strict=True):
            # After a line feed there is no space; encoded by itself the piece has one before it.
            yield array("I", ids[1:] if k[:1] == LINE and ids[:1] == [self.space] else ids).tobytes()


# ---------------------------------------------------------------- windows

class Windows:
    """The alignments of some windows, all at once: ``text`` (groups, each with a ``;`` after it), ``n_groups``,
    and the linked pairs ``pairs``, ``n_pairs`` of them for each window.

    On both sides the windows cover the same bytes. Between two neighbouring ends of either side lies one token
    of A and one of B: these are the links. Ends of both sides cut the groups."""

    def __init__(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], sizes: list[np.ndarray], said: pa.LargeBinaryArray):
        (ia, wa), (ib, wb) = a, b
        end_a, end_b = np.cumsum(sizes[0][ia]), np.cumsum(sizes[1][ib])
        ends = np.zeros(int(end_a[-1]) + 1 if len(end_a) else 1, np.int8)
        ends[end_a] = 1
        ends[end_b] += 2
        at = np.flatnonzero(ends)
        here = ends[at]
        # The tokens before each end: those that ended earlier.
        token_a, token_b = (np.cumsum(here & side > 0) - (here & side > 0) for side in (1, 2))
        self.pairs = ia[token_a].astype(np.int64) << 32 | ib[token_b]
        window = np.repeat(np.arange(len(wa) - 1), np.diff(wa))[token_a]
        self.n_pairs = np.bincount(window, minlength=len(wa) - 1)
        self.n_groups = np.bincount(window[here == 3], minlength=len(wa) - 1)
        # Text: a group's ids of A, then those of B. A token's place follows from the tokens of the groups before.
        last_a, last_b = ends[end_a] == 3, ends[end_b] == 3
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        count_a, count_b = np.bincount(group_a), np.bincount(group_b)
        vocab = len(said) // 3
        order = np.empty(len(ia) + len(ib), np.int64)
        order[np.arange(len(ia)) + (np.cumsum(count_b) - count_b)[group_a]] = ia + np.where(last_a, vocab, 0)
        order[np.arange(len(ib)) + np.cumsum(count_a)[group_b]] = ib + np.where(last_b, 2 * vocab, 0)
        taken = said.take(pa.array(order))
        bounds = np.frombuffer(taken.buffers()[1], np.int64)[wa + wb] if len(order) else np.zeros(len(wa), np.int64)
        self.text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(wa) - 1, [None, pa.py_buffer(np.ascontiguousarray(bounds)), taken.buffers()[2]])


class Aligner:
    """The two encoders of a worker, with tables of their ids."""

    def __init__(self, file_a: bytes, file_b: bytes):
        self.a, self.b = SpacedEncoder(file_a), SentenceEncoder(file_b)
        self.sizes = [pc.binary_length(e.bytes_of).to_numpy().astype(np.int64) for e in (self.a, self.b)]
        self.spaced = [np.array([t[:1] == b" " for t in e.bytes_of.to_pylist()]) for e in (self.a, self.b)]
        vocab = max(map(len, self.sizes))
        self.said = pa.array([f"{i}{mark}" for mark in ",|;" for i in range(vocab)], pa.large_binary())

    def windows(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> Windows:
        return Windows(a, b, self.sizes, self.said)

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """(whether each text has tokens; ids and bounds of the texts for A and for B). Without tokens a text has none."""
        texts = plain_text(texts)
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
        want, fine, both = bytes_of(spaced), pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), []
        for e in (self.a, self.b):
            ids, ends = flat_ids(e.encode(texts))
            got = e.bytes_of.take(pa.array(ids))
            at = np.frombuffer(got.buffers()[1], np.int64)[ends] if len(ids) else np.zeros(len(ends), np.int64)
            data = memoryview(got.buffers()[2]) if len(ids) else memoryview(b"")
            fine = fine & np.array([data[x:y] == w for x, y, w in zip(at.tolist(), at[1:].tolist(), want)], bool)  # noqa: B905
            both.append((ids, ends))
        return fine, [kept(ids, ends, fine) for ids, ends in both]

    def chunk(self, texts: pa.Array) -> dict:
        """All that is known of a slice of documents before the corpus is counted."""
        fine, ((ia, da), (ib, db)) = self.tokens(texts)
        end_a, end_b = np.cumsum(self.sizes[0][ia]), np.cumsum(self.sizes[1][ib])
        ends = np.zeros(int(end_a[-1]) + 1 if len(end_a) else 1, np.int8)
        ends[end_a] = 1
        ends[end_b] += 2
        at_a, at_b = np.flatnonzero(ends[end_a] == 3), np.flatnonzero(ends[end_b] == 3)  # shared ends, as token numbers
        last = np.zeros(len(ia) + 1, bool)
        last[da] = True
        anchor = last[at_a + 1] | (self.spaced[0][np.append(ia, 0)[at_a + 1]] & self.spaced[1][np.append(ib, 0)[at_b + 1]])
        cut_a, cut_b = (np.concatenate([[0], x[anchor] + 1]) for x in (at_a, at_b))
        # The distinct windows, by their tuples of ids, and the document's sequence of them.
        code_a, code_b = (ids_between(i, c).dictionary_encode() for i, c in ((ia, cut_a), (ib, cut_b)))
        many = max(1, len(code_b.dictionary))
        coded = pa.array(code_a.indices.to_numpy().astype(np.int64) * many + code_b.indices.to_numpy()).dictionary_encode()
        which, seq = coded.dictionary.to_numpy(), coded.indices.to_numpy().astype(np.uint32)
        found = self.windows(*(flat_ids(d.take(pa.array(w))) for d, w in ((code_a.dictionary, which // many), (code_b.dictionary, which % many))))
        text = found.text.take(pa.array(seq))
        raw, text_at = memoryview(text.buffers()[2] or b""), np.frombuffer(text.buffers()[1], np.int64) if len(text) else np.zeros(1, np.int64)
        doc_at = np.searchsorted(cut_a, da)  # the first window of each document
        known, codes = np.unique(found.pairs, return_inverse=True)
        doc = np.repeat(np.arange(len(fine)), np.diff(doc_at))
        return {
            "n_a": np.diff(da), "n_b": np.diff(db),
            "n_groups": np.bincount(doc, found.n_groups[seq], len(fine)).astype(np.int64), "n_links": np.bincount(doc, found.n_pairs[seq], len(fine)).astype(np.int64),
            "groups_sha256": [hashlib.sha256(raw[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(text_at[doc_at].tolist(), text_at[doc_at[1:]].tolist())],  # noqa: B905
            "doc_at": doc_at, "seq": seq, "n_pairs": found.n_pairs, "codes": codes.astype(np.uint32), "pairs": known, "docs": holders(doc, seq, found.n_pairs, codes, len(known)),
        }


def bytes_of(texts: pa.Array) -> list[memoryview]:
    data = memoryview(texts.buffers()[2] or b"")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1].tolist() if len(texts) else [0]
    return [data[x:y] for x, y in zip(at, at[1:])]  # noqa: B905


def kept(ids: np.ndarray, ends: np.ndarray, fine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the texts that are ``fine``; the others have none."""
    count = np.diff(ends)
    if fine.all():
        return ids, ends
    return ids[np.repeat(fine, count)], np.concatenate([[0], np.cumsum(np.where(fine, count, 0))])


def ids_between(ids: np.ndarray, cut: np.ndarray) -> pa.LargeBinaryArray:
    """The windows of a stream of ids, as their bytes."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut) - 1, [None, pa.py_buffer(np.ascontiguousarray(cut * 4, np.int64)), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))])


def holders(doc: np.ndarray, seq: np.ndarray, n_pairs: np.ndarray, codes: np.ndarray, size: int) -> np.ndarray:
    """How many documents of the chunk hold each pair."""
    if not len(seq):
        return np.zeros(size, np.int64)
    once = np.unique(doc * len(n_pairs) + seq)  # a document's distinct windows
    doc, seq = np.divmod(once, len(n_pairs))
    first = np.cumsum(n_pairs) - n_pairs
    count = n_pairs[seq]
    at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[seq], count)
    return np.bincount(np.unique(np.repeat(doc, count) * size + codes[at]) % size, minlength=size)


# ---------------------------------------------------------------- the corpus

PACKED = {"doc_at": "<i8", "seq": "<u4", "n_pairs": "<i8", "codes": "<u4"}
LISTS = ("n_a", "n_b", "n_groups", "n_links")
CHUNK = ("chunk long, doc_id array<long>, " + ", ".join(f"{c} array<long>" for c in LISTS) + ", groups_sha256 array<string>, "
         + ", ".join(f"{c} binary" for c in PACKED) + ", pairs array<long>, docs array<long>")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

_loaded: dict[str, Aligner] = worker_cache()


def aligner(file_a: bytes, file_b: bytes) -> Aligner:
    key = hashlib.sha256(file_a + file_b).hexdigest()
    if key not in only(_loaded):
        _loaded[key] = Aligner(file_a, file_b)
    return _loaded[key]


def chunks(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The documents' windows and pairs, a row per chunk of documents; saved."""
    file_a, file_b = docs.sparkSession.sparkContext.broadcast(_read(path_a)), docs.sparkSession.sparkContext.broadcast(_read(path_b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, zip_ = aligner(file_a.value, file_b.value), zstandard.ZstdCompressor(level=1)
        number = TaskContext.get().partitionId() << 32
        for big in batches:
            for b in slices(big, "text", chunk_bytes):
                c = own.chunk(column(b, "text"))
                rows = {"chunk": pa.array([number], pa.int64()), "doc_id": pa.array([column(b, "doc_id").to_pylist()], pa.list_(pa.int64()))}
                rows |= {k: pa.array([c[k]], pa.list_(pa.int64())) for k in (*LISTS, "pairs", "docs")} | {"groups_sha256": pa.array([c["groups_sha256"]], pa.list_(pa.string()))}
                rows |= {k: pa.array([zip_.compress(np.ascontiguousarray(c[k], t).tobytes())], pa.binary()) for k, t in PACKED.items()}
                names = [x.split()[0] for x in CHUNK.split(", ")]
                yield pa.RecordBatch.from_arrays([rows[k] for k in names], names)
                number += 1
        release()

    return saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, CHUNK), "aligned-chunks")


def pair_counts(parts: DataFrame) -> DataFrame:
    """(pair, count, best): in how many documents of the corpus the ids are linked, and whether that is the most for
    the pair's A id; saved. ``pair`` is A's id * 2**32 + B's."""
    held = parts.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("count"))
    counts = saved(held.withColumn("a", F.shiftright("pair", 32)), "pair-counts")
    most = saved(counts.groupBy("a").agg(F.max("count").alias("most")), "pair-most")
    return saved(counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "pair-scores")


def align(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is the most common of its A id),
    count_sum (of the pairs' document counts over the links), groups_sha256."""
    parts = chunks(docs, path_a, path_b, chunk_bytes)
    rows = (parts.select(F.col("chunk").alias("of"), F.posexplode(F.col("pairs")).alias("code", "pair")).join(pair_counts(parts), "pair")
            .select("of", "code", "count", "best"))

    def run(own: pa.Table, scores: pa.Table) -> pa.Table:
        out = pa.table({k: pa.array([], pa.string() if k == "groups_sha256" else pa.int64()) for k in (x.split()[0] for x in RESULT.split(", "))})
        for r in own.to_pylist():
            unzip = zstandard.ZstdDecompressor()
            doc_at, seq, n_pairs, codes = (np.frombuffer(unzip.decompress(r[k]), t) for k, t in PACKED.items())
            order = np.argsort(scores.column("code").to_numpy())
            count = scores.column("count").to_numpy()[order]
            best = scores.column("best").to_numpy().astype(np.int64)[order]
            window, doc = np.repeat(np.arange(len(n_pairs)), n_pairs), np.repeat(np.arange(len(r["doc_id"])), np.diff(doc_at))
            sums = [per_document(doc, seq, window, x[codes] if len(codes) else x[:0], len(n_pairs), len(r["doc_id"])) for x in (best, count)]
            columns = {"doc_id": r["doc_id"], **{k: r[k] for k in LISTS}, "n_best": sums[0], "count_sum": sums[1]}
            out = pa.concat_tables([out, pa.table({**{k: pa.array(v, pa.int64()) for k, v in columns.items()}, "groups_sha256": pa.array(r["groups_sha256"], pa.string())})])
        return out

    return parts.drop("pairs", "docs").groupBy("chunk").cogroup(rows.groupBy("of")).applyInArrow(run, RESULT)


def per_document(doc: np.ndarray, seq: np.ndarray, window: np.ndarray, values: np.ndarray, windows: int, docs: int) -> np.ndarray:
    """Sums over the links of each document, by way of its windows; in whole numbers."""
    own = np.zeros(windows, np.int64)
    np.add.at(own, window, values)
    out = np.zeros(docs, np.int64)
    np.add.at(out, doc, own[seq])
    return out


def groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row: doc_id and its groups as text (``a1,a2|b1;a3|b2,b3``; empty without tokens)."""
    file_a, file_b = _read(path_a), _read(path_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(file_a, file_b)
        for big in batches:
            for b in slices(big, "text", CHUNK_BYTES):
                text = [t.decode()[:-1] for t in own.windows(*own.tokens(column(b, "text"))[1]).text.to_pylist()]  # a document as one window
                yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(text, pa.string())], ["doc_id", "groups"])
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, groups string")
