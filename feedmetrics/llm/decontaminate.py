"""Benchmark decontamination with a BM25 inverted index and block-max WAND.

The test items are cut into segments of at most ``SEGMENT`` terms and indexed: per term a
posting list of (segment, impact), in blocks of ``BLOCK`` segments with the largest impact of
each. Impacts are BM25 weights divided by the segment's score for itself, so a passage holding
all of a segment scores 1 whatever its length.

Every window of ``WINDOW`` terms of every document is a query; windows overlap by half, so any
run of ``SEGMENT`` terms lies whole in one of them. All segments above the threshold are
retrieved. A segment's postings of the smallest impacts, together at most ``REST`` of its
score, are optional: a segment that reaches the threshold has threshold - REST from its other,
essential postings. So, for many windows at once:
1. the list maxima of a window's essential terms must add up to threshold - REST;
2. block-max: so must, in some block, the block maxima of its essential terms;
3. the blocks that are left are scored exactly with all postings.
A hit is then verified on the text: of the item's question and of its answer, each at least
``overlap`` of the five-term shingles must occur in the document around the window.

An item without separate columns is split: its last line is the answer, or its last sentence
if it has one line, or its last third if it has one sentence.

An item of fewer than ``MIN_TERMS`` terms is not looked for, since clean text holds such short runs; ``short_items``
reports these items.

The index is broadcast in blocks of items of bounded bytes; a larger benchmark takes several
passes over the documents, each of which is stored before the next block is indexed, with document frequencies over all items.

Ties: a hit's score is the best of its windows. Null document or item ids stay null in the hits.

Defined cases: terms are runs of letters and digits, lower-cased; items and documents without
a term (null, empty) match nothing; an item's shingles are its whole part where that is shorter
than five terms; repeated items give a hit each and repeated documents likewise; very long
texts are used whole; empty tables give no hits; extra columns stay with the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmetrics.llm.common import column, only, plain_text, release, saved, slices

SEGMENT, WINDOW, BLOCK, SHINGLE = 64, 128, 8, 5
K1, B = 1.2, 0.75
#: Share of a segment's score that its optional postings hold at most.
REST = 0.3
#: Terms that an item needs: shorter ones would be found in clean text (``short_items`` tells them).
MIN_TERMS = 8
#: Item text that one pass indexes.
PASS_BYTES = 16 << 20


def terms_of(texts: pa.Array) -> pa.ListArray:
    """The terms of each text; of null and of texts without a letter or digit, none."""
    plain = pc.replace_substring_regex(pc.utf8_lower(plain_text(texts)), r"[^\pL\pN]+", " ")
    return pc.utf8_split_whitespace(pc.utf8_trim(plain, " "))


def flat_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all terms, offsets of each text); empty texts have none."""
    lists = terms_of(texts)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = lists.offsets.to_numpy()
    values, offsets = lists.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]  # the input may be a slice
    blank = pc.equal(values, "").to_numpy(zero_copy_only=False)
    if blank.any():  # splitting an empty text gives one empty string
        kept = np.concatenate([[0], np.cumsum(~blank)])
        return values.filter(pa.array(~blank)), kept[offsets]
    return values, offsets


def parts(text: str) -> tuple[str, str]:
    """(question, answer) of an item given as one text."""
    lines = [x for x in text.split("\n") if x.strip()]
    if len(lines) > 1:
        return "\n".join(lines[:-1]), lines[-1]
    sentences = [x for x in re.split(r"(?<=[.!?])\s+", text.strip()) if x]
    if len(sentences) > 1:
        return " ".join(sentences[:-1]), sentences[-1]
    words = text.split()
    at = len(words) - max(1, len(words) // 3) if len(words) > 1 else len(words)
    return " ".join(words[:at]), " ".join(words[at:])


def shingles(ids: np.ndarray) -> set[bytes]:
    """Distinct runs of five ids, or the whole run where it is shorter."""
    raw, n = np.ascontiguousarray(ids, np.int32).tobytes(), len(ids)
    k = min(SHINGLE, n)
    return {raw[4 * i:4 * (i + k)] for i in range(n - k + 1)} if n else set()


@dataclass
class Index:
    """Posting lists over the segments of some items."""

    terms: pa.Array          # the vocabulary
    start: np.ndarray        # start of each term's postings
    segment: np.ndarray      # segment of each posting, ascending within a term
    impact: np.ndarray
    most: np.ndarray         # largest essential impact of each term, 0 if it has none
    block_start: np.ndarray  # start of each term's blocks of essential postings
    block: np.ndarray
    block_most: np.ndarray
    n_blocks: int
    item_of: np.ndarray      # item number of each segment
    items: list              # item ids
    question: list           # shingles of each item's question
    answer: list
    length: np.ndarray       # terms of each item


def build_index(items: list[tuple], n_segments: int, mean_length: float, frequency: dict[str, int]) -> Index:
    """Index of (id, question terms, answer terms); the statistics are those of all items."""
    vocabulary = sorted({t for _, q, a in items for t in (*q, *a)})
    number = {t: i for i, t in enumerate(vocabulary)}
    rows, item_of, questions, answers, lengths = [], [], [], [], []
    for k, (_, q, a) in enumerate(items):
        ids = np.array([number[t] for t in (*q, *a)], np.int32)
        questions.append(shingles(ids[:len(q)]))
        answers.append(shingles(ids[len(q):]))
        lengths.append(len(ids))
        for at in range(0, len(ids), SEGMENT):
            own, tf = np.unique(ids[at:at + SEGMENT], return_counts=True)
            df = np.array([frequency[vocabulary[t]] for t in own.tolist()])
            idf = np.log(1 + (n_segments - df + 0.5) / (df + 0.5))
            weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * tf.sum() / mean_length))
            weight /= weight.sum()
            rising = np.argsort(weight, kind="stable")
            essential = np.empty(len(own), bool)
            essential[rising] = np.cumsum(weight[rising]) > REST
            rows.append((own, np.full(len(own), len(item_of)), weight, essential))
            item_of.append(k)
    term, segment, impact, essential = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.lexsort((segment, term))
    term, segment, impact, essential = term[order].astype(np.int64), segment[order].astype(np.int64), impact[order], essential[order]
    t, s, i = term[essential], segment[essential], impact[essential]
    first = np.flatnonzero(np.diff(t * len(item_of) + s // BLOCK, prepend=-1))
    most = np.zeros(len(vocabulary))
    np.maximum.at(most, t, i)
    every = np.arange(len(vocabulary) + 1)
    return Index(pa.array(vocabulary, pa.large_string()), np.searchsorted(term, every), segment, impact, most, np.searchsorted(t[first], every),
                 s[first] // BLOCK, np.maximum.reduceat(i, first), (len(item_of) - 1) // BLOCK + 1, np.array(item_of, np.int64),
                 [x for x, _, _ in items], questions, answers, np.array(lengths, np.int64))


def expand(start: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``of``, position in the lists) of every list entry of the terms ``of``."""
    count = start[of + 1] - start[of]
    owner = np.repeat(np.arange(len(of)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start[of], count)


def candidates(index: Index, window: np.ndarray, term: np.ndarray, threshold: float) -> np.ndarray:
    """window * n_blocks + block of every block that may hold a segment of at least ``threshold``,
    from distinct (window, essential term) pairs sorted by window."""
    need = threshold - REST - 1e-9
    if not len(window):
        return window
    alive = np.bincount(window, index.most[term])[window] >= need
    window, term = window[alive], term[alive]
    owner, at = expand(index.block_start, term)
    pair, back = np.unique(window[owner] * index.n_blocks + index.block[at], return_inverse=True)
    return pair[np.bincount(back, index.block_most[at], minlength=len(pair)) >= need]


def score(index: Index, terms: np.ndarray, blocks: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(segments, scores) of at least ``threshold`` in some blocks, for a window's distinct terms."""
    _, at = expand(index.start, terms)
    at = at[np.isin(index.segment[at] // BLOCK, blocks)]
    total = np.bincount(index.segment[at], index.impact[at], minlength=1)
    good = np.flatnonzero(total >= threshold - 1e-9)
    return good, total[good]


def find(index: Index, texts: pa.Array, threshold: float, overlap: float) -> list[tuple[int, int, float, float, float]]:
    """(row, item number, best score, question overlap, answer overlap) of every verified hit."""
    if not len(index.items):
        return []
    values, offsets = flat_terms(texts)
    ids = pc.fill_null(pc.index_in(values, value_set=index.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    half, n_terms = WINDOW // 2, len(index.terms)
    # Halves are numbered through all rows; window h is the halves h and h + 1 of one row.
    first = np.concatenate([[0], np.cumsum(-(-np.diff(offsets) // half))])
    at = np.flatnonzero(np.append(index.most, 0)[ids] > 0)  # places of essential terms
    row = np.searchsorted(offsets, at, "right") - 1
    h = first[row] + (at - offsets[row]) // half
    own = h > first[row]  # also in the window that began half a window earlier
    pairs = np.unique(np.concatenate([h, h[own] - 1]) * n_terms + np.concatenate([ids[at], ids[at[own]]]))
    found_blocks = candidates(index, pairs // n_terms, pairs % n_terms, threshold)
    best: dict[tuple[int, int], tuple[float, set[int]]] = {}
    for w in np.unique(found_blocks // index.n_blocks).tolist():
        r = int(np.searchsorted(first, w, "right")) - 1
        lo = offsets[r] + (w - first[r]) * half
        terms = np.unique(ids[lo:min(offsets[r + 1], lo + WINDOW)])
        segments, scores = score(index, terms[terms >= 0], found_blocks[found_blocks // index.n_blocks == w] % index.n_blocks, threshold)
        for s, x in zip(segments.tolist(), scores.tolist(), strict=True):
            most, windows = best.get((r, int(index.item_of[s])), (0.0, set()))
            best[r, int(index.item_of[s])] = max(most, x), windows | {w}
    found = []
    for (r, item), (x, windows) in sorted(best.items()):
        near: set[bytes] = set()
        reach = int(index.length[item])
        for w in windows:
            lo = offsets[r] + (w - first[r]) * half
            seg = ids[max(offsets[r], lo - reach):min(offsets[r + 1], lo + WINDOW + reach)].astype(np.int32)
            for n in {len(next(iter(p))) // 4 for p in (index.question[item], index.answer[item]) if p}:
                raw = seg.tobytes()
                near.update(raw[4 * i:4 * (i + n)] for i in range(len(seg) - n + 1))
        q, a = (len(p & near) / len(p) if p else 1.0 for p in (index.question[item], index.answer[item]))
        if q >= overlap and a >= overlap:
            found.append((r, item, x, q, a))
    return found


def item_terms(items: DataFrame, id_col: str, text_col: str, question_col: str | None, answer_col: str | None) -> DataFrame:
    """(id, q, a): the terms of each item's question and answer."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            whole = column(b, "question").to_pylist(), column(b, "answer").to_pylist(), column(b, "text").to_pylist()
            qa = [(q or "", a or "") if t is None else parts(t) for q, a, t in zip(*whole, strict=True)]
            q, a = (terms_of(pa.array([x[k] for x in qa], pa.string())) for k in (0, 1))
            clean = [[[t for t in x if t] for x in y.to_pylist()] for y in (q, a)]
            yield pa.RecordBatch.from_arrays([column(b, "id"), *(pa.array(c, pa.list_(pa.string())) for c in clean)], ["id", "q", "a"])

    null = F.lit(None).cast("string")
    rows = items.select(F.col(id_col).cast("long").alias("id"), (F.col(question_col) if question_col else null).alias("question"),
                        (F.col(answer_col) if question_col else null).alias("answer"), (null if question_col else F.col(text_col)).alias("text"))
    return rows.mapInArrow(split, "id long, q array<string>, a array<string>")


def short_items(items: DataFrame, *, item_id: str = "item_id", item_text: str = "text", question_col: str | None = None, answer_col: str | None = None) -> DataFrame:
    """item_id, n_terms of the items that are too short to be looked for."""
    size = F.size("q") + F.size("a")
    return item_terms(items, item_id, item_text, question_col, answer_col).where(size < MIN_TERMS).select(F.col("id").alias("item_id"), size.cast("long").alias("n_terms"))


def indexes(items: DataFrame, id_col: str, text_col: str, question_col: str | None, answer_col: str | None) -> Iterator[Index]:
    """The index of each block of items (one block of up to ``PASS_BYTES`` of text at a time)."""
    rows = saved(item_terms(items, id_col, text_col, question_col, answer_col).where(F.size("q") + F.size("a") >= MIN_TERMS), "test-items")
    size = F.size("q") + F.size("a")
    stats = rows.agg(F.sum(F.ceil(size / SEGMENT)).alias("segments"), F.sum(size).alias("terms"),
                     F.sum(F.length(F.array_join("q", " ")) + F.length(F.array_join("a", " "))).alias("bytes")).first()
    if not stats["segments"]:
        return
    blocks = int(4 * stats["bytes"] // PASS_BYTES) + 1
    all_terms = F.concat("q", "a")
    segments = F.transform(F.sequence(F.lit(0).cast("long"), F.ceil(size / SEGMENT) - 1),
                           lambda k: F.array_distinct(F.slice(all_terms, (k * SEGMENT + 1).cast("int"), SEGMENT)))
    frequency = rows.select(F.explode(segments).alias("s")).select(F.explode("s").alias("term")).groupBy("term").count()
    frequency = saved(frequency, "item-terms") if blocks > 1 else frequency
    for k in range(blocks):
        block = rows.where(F.pmod(F.xxhash64("id", "q", "a"), F.lit(blocks)) == k)
        own = frequency if blocks == 1 else frequency.join(block.select(F.explode(all_terms).alias("term")).distinct(), "term", "left_semi")
        items_here = sorted(((r["id"], r["q"], r["a"]) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
        yield build_index(items_here, int(stats["segments"]), stats["terms"] / stats["segments"], {r["term"]: r["count"] for r in own.collect()})


def find_leaks(docs: DataFrame, items: DataFrame, *, threshold: float = 0.6, overlap: float = 0.75, doc_id: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", question_col: str | None = None, answer_col: str | None = None) -> DataFrame:
    """Every (document, item) whose text leaks: doc_id, item_id, score, question_overlap, answer_overlap."""
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"

    def scan(index: Index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            only({})
            for big in batches:
                for b in slices(big, "text", 2 << 20):
                    hits = find(index, column(b, "text"), threshold, overlap)
                    if hits:
                        r, k, *numbers = zip(*hits, strict=True)
                        yield pa.RecordBatch.from_arrays([column(b, "id").take(pa.array(r)), pa.array([index.items[i] for i in k], pa.int64()),
                                                          *(pa.array(x, pa.float64()) for x in numbers)],
                                                         ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])
            release()

        return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)

    out = last = None
    for index in indexes(items, item_id, item_text, question_col, answer_col):
        if last is not None:  # stored, so that one index is held at a time
            out = saved(last, "leaks") if out is None else out.unionByName(saved(last, "leaks"))
        last = scan(index)
    if last is not None:
        out = last if out is None else out.unionByName(last)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def decontaminate(docs: DataFrame, items: DataFrame, *, threshold: float = 0.6, overlap: float = 0.75, text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", question_col: str | None = None, answer_col: str | None = None) -> DataFrame:
    """The documents without a leak, with all their columns."""
    for index in indexes(items, item_id, item_text, question_col, answer_col):
        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            only({})
            for big in batches:
                for b in slices(big, text_col, 2 << 20):
                    keep = np.ones(b.num_rows, bool)
                    keep[[h[0] for h in find(index, column(b, text_col), threshold, overlap)]] = False
                    yield b.filter(pa.array(keep))
            release()

        docs = docs.mapInArrow(run, docs.schema)
    return docs
