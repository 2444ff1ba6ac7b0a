"""Language identification by a linear-chain conditional random field over words.

Every word of a line is labelled with a language; a word's features are its affixes, its
character n-grams and what a learned lexicon says of it, and transitions between the labels of
neighbouring words are learned too, so a line may switch languages. Words are the runs of letters
(combining marks are left out and do not end a run); a longer run, as in scripts without spaces, is cut into consecutive
words of at most ``LONGEST`` letters, and all of them are labelled. Forward-backward gives each
word's label probabilities; a document's language is the one with the largest sum over its words
and its score that sum's share.

Learning uses documents with a language whose crc32(id as text) mod 4 is not 2. From these a
bounded sample is fitted on the driver: per language ``buckets`` documents (for each bucket of a
hash of the text the one with the smallest hash, a partial aggregation), of each at most
``sample_chars`` characters. One half makes the lexicon, the other the field, so that the field
learns how far the lexicon can be trusted on new words. Training lines of different languages
are joined, which is how switches are learned. Prediction uses whole texts and nothing but them.

Defined cases: a null text and a text without a letter are ``und`` with score 0, and so is
every text if there is nothing to learn from; a null id counts as the empty text for the
remainder; repeated rows are predicted each; ties go to the first label in order; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import pickle
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmetrics.llm.bpe import Recent
from feedmetrics.llm.common import column, only, plain_text, release, slices, worker_cache

#: Weight rows that features are hashed to.
ROWS = 1 << 16
NOT_IN_LEXICON = ["l?"]
UNKNOWN = "und"
#: Letters of a word at most.
LONGEST = 40
#: Text bytes taken from Arrow at once; bytes of chunks that a worker remembers in each of two generations.
SLICE_BYTES, REMEMBERED_BYTES = 2 << 20, 40 << 20


def words_of(chunk: str) -> list[str]:
    """The words in a run of non-space characters: its runs of letters, in lower case, in pieces of at most ``LONGEST``."""
    if chunk.isalpha():
        runs = [chunk.lower()]
    else:
        runs = "".join(c if c.isalpha() else "" if unicodedata.category(c)[0] == "M" else " " for c in chunk).lower().split()
    return [r[i:i + LONGEST] for r in runs for i in range(0, len(r), LONGEST)]


_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def hashed(kind: int, letters: list[np.ndarray]) -> np.ndarray:
    """Weight rows of features: a kind and one to three letters each."""
    h = np.full(len(letters[0]), kind + 1, np.uint64)
    for x, m in zip(letters, _MIX, strict=False):
        h = (h ^ (h >> np.uint64(29)) ^ x) * m
    return ((h ^ (h >> np.uint64(32))) % np.uint64(ROWS)).astype(np.int64)


def word_features(words: list[str], lexicon: dict[str, list[str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the words' affixes, n-grams and lexicon features, kind after kind: (rows, how many each word has)."""
    # Every word stands between marks; a letter before the first and after the last of them is never read.
    text = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(size + 2) - size - 1  # each word's first letter
    last, one = first + size - 1, np.ones(len(words), np.int64)
    for k in (1, 2, 3):  # of a shorter word, the whole word
        yield hashed(k, [text[np.minimum(first + j, last)] * (size > j) for j in range(k)]), one
        yield hashed(10 + k, [text[np.maximum(last - j, first)] * (size > j) for j in range(k)]), one
    for n in (2, 3):
        count = size + 3 - n
        at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first - 1, count)
        yield hashed(20 + n, [text[at + j] for j in range(n)]), count
    found = [lexicon.get(w, NOT_IN_LEXICON) for w in words]
    yield np.array([zlib.crc32(f.encode()) % ROWS for x in found for f in x], np.int64), np.fromiter(map(len, found), np.int64, len(found))


def features_of_each(words: list[str], lexicon: dict[str, list[str]]) -> list[np.ndarray]:
    """The rows of all features of each word."""
    kinds = list(word_features(words, lexicon))
    owner = np.concatenate([np.repeat(np.arange(len(words)), n) for _, n in kinds])
    rows = np.concatenate([r for r, _ in kinds])[np.argsort(owner, kind="stable")]
    return np.split(rows, np.cumsum(np.bincount(owner, minlength=len(words)))[:-1])


def forward_backward(e: np.ndarray, start: np.ndarray, count: np.ndarray, first: np.ndarray, move: np.ndarray,
                     pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Label probabilities of every word, for many lines at once.

    e: label weights of all words (positive); the words of line i are e[start[i]:][:count[i]].
    first, move: weights of the first label and of neighbouring labels. With ``pairs`` also the
    expected number of each pair of neighbouring labels."""
    order = np.argsort(-count, kind="stable")
    start, count = start[order], count[order]
    longest = int(count[0]) if len(count) else 0
    live = np.searchsorted(-count, -np.arange(longest), "left")  # lines with more than t words
    alpha, post = np.empty_like(e), np.empty_like(e)
    now = np.empty((0, e.shape[1]), e.dtype)
    for t in range(longest):
        at = start[:live[t]] + t
        now = e[at] * (first if t == 0 else now[:live[t]] @ move)
        now /= now.sum(1, keepdims=True)
        alpha[at] = now
    total = np.zeros_like(move) if pairs else None
    beta = np.empty((0, e.shape[1]), e.dtype)
    for t in range(longest - 1, -1, -1):
        at = start[:live[t]] + t
        back = np.ones((live[t], e.shape[1]), e.dtype)
        if len(beta):
            ahead = e[at[:len(beta)] + 1] * beta
            back[:len(beta)] = ahead @ move.T
            if pairs:
                joint = alpha[at[:len(beta)]][:, :, None] * move * ahead[:, None, :]
                total += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            back[:len(beta)] /= back[:len(beta)].sum(1, keepdims=True)
        beta = back
        p = alpha[at] * beta
        post[at] = p / p.sum(1, keepdims=True)
    return post, total


class Field:
    """A fitted conditional random field."""

    def __init__(self, labels: list[str], lexicon: dict[str, list[str]], weights: np.ndarray, first: np.ndarray, move: np.ndarray):
        self.labels, self.lexicon, self.weights, self.first, self.move = labels, lexicon, weights, first, move

    def emissions(self, chunks: list[str]) -> list[bytes]:
        """Label weights of the words in each chunk, as bytes, word after word; none where it has no letter."""
        words = [words_of(c) for c in chunks]
        own = {w: i for i, w in enumerate(dict.fromkeys(w for x in words for w in x))}
        if not own:
            return [b""] * len(chunks)
        score = np.zeros((len(own), len(self.labels)), np.float32)
        for rows, n in word_features(list(own), self.lexicon):
            score += np.add.reduceat(self.weights[rows], np.cumsum(n) - n, axis=0)
        raw = np.exp(np.maximum(score - score.max(1, keepdims=True), -30)).astype(np.float32).tobytes()
        step = 4 * len(self.labels)
        return [b"".join([raw[step * own[w]:step * own[w] + step] for w in x]) for x in words]

    def labelled(self, texts: pa.Array, recent: Recent) -> tuple[np.ndarray, np.ndarray]:
        """(label probabilities of all words, the text of each). Arrow cuts the texts and numbers the
        distinct chunks, so Python works once per distinct chunk of a slice."""
        n = len(self.labels)
        lines = pc.split_pattern(plain_text(texts), "\n")
        doc = np.repeat(np.arange(len(lines)), np.diff(lines.offsets.to_numpy()))
        chunks = pc.utf8_split_whitespace(lines.values.slice(lines.offsets[0].as_py(), len(doc)))
        at = chunks.offsets.to_numpy().astype(np.int64)
        own = chunks.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        found = pa.array(recent.get(own.dictionary.to_pylist()), pa.large_binary()).take(own.indices)
        _, ends, data = found.buffers()
        ends = np.frombuffer(ends, np.int64)[found.offset:found.offset + len(found) + 1]
        place = (ends[at - at[0]] - ends[0]) // (4 * n)  # of each line's first word
        raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.empty(0, np.uint8)
        e = np.ascontiguousarray(raw).view(np.float32).reshape(-1, n)
        count = np.diff(place)
        used = np.flatnonzero(count)
        post, _ = forward_backward(e, place[:-1][used], count[used], self.first.astype(np.float32), self.move.astype(np.float32))
        return post, np.repeat(doc, count)

    def predict(self, texts: pa.Array, recent: Recent) -> tuple[pa.Array, pa.Array]:
        """(language, score) of each text."""
        n = len(self.labels)
        if not n or not len(texts):
            return pa.array([UNKNOWN] * len(texts), pa.string()), pa.array([0.0] * len(texts), pa.float64())
        post, owner = self.labelled(texts, recent)
        total = np.stack([np.bincount(owner, post[:, k], minlength=len(texts)) for k in range(n)], 1)
        words = np.bincount(owner, minlength=len(texts))
        best = np.where(words > 0, total.argmax(1), n)
        score = np.where(words > 0, np.minimum(1.0, total.max(1) / np.maximum(words, 1)), 0.0)
        return pa.array([*self.labels, UNKNOWN], pa.string()).take(pa.array(best)), pa.array(score, pa.float64())


def lexicon_of(docs: list[tuple[str, str]], labels: list[str]) -> dict[str, list[str]]:
    """Per word seen twice or more: which languages it speaks for, by its smoothed shares."""
    counts = {k: Counter() for k in labels}
    for lang, text in docs:
        counts[lang].update(w for c in text.split() for w in words_of(c))
    size = {k: sum(c.values()) + 1 for k, c in counts.items()}
    found = {}
    for w in sorted(set().union(*counts.values())):
        if sum(c[w] for c in counts.values()) > 1:
            rate = {k: (counts[k][w] + 0.1) / size[k] for k in labels}
            total = sum(rate.values())
            found[w] = [f"l{k}{'+' if r / total > 0.8 else '-'}" for k, r in rate.items() if r / total > 0.3] or ["l!"]
    return found


def fit(sample: list[tuple[str, str]], epochs: int = 4, rate: float = 0.2, batch_words: int = 20_000, seed: int = 7) -> Field:
    """Fit on (language, text) rows by AdaGrad on the log-likelihood of the labelled lines."""
    labels = sorted({k for k, _ in sample})
    n, rng = len(labels), np.random.default_rng(seed)
    sample = sorted(sample)
    lexicon = lexicon_of(sample[::2], labels)
    lines = []
    for lang, text in sample[1::2] or sample:
        for x in text.split("\n"):
            words = [w for c in x.split() for w in words_of(c)]
            lines += [(lang, words[i:i + 40]) for i in range(0, len(words), 40)]
    # Joined in random order, two lines make one training line: switches occur between them.
    shuffled = [lines[i] for i in rng.permutation(len(lines))]
    joined = [shuffled[i:i + 2] for i in range(0, len(shuffled), 2)]
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, x in lines for w in x}))}
    features = features_of_each(list(vocabulary), lexicon) if vocabulary else []
    number = {k: i for i, k in enumerate(labels)}
    weights, move, first = np.zeros((ROWS, n)), np.zeros((n, n)), np.zeros(n)
    sums = [np.full_like(x, 1e-3) for x in (weights, move, first)]

    def step(x: np.ndarray, s: np.ndarray, g: np.ndarray, rows=slice(None)) -> None:
        s[rows] += g * g
        x[rows] += rate * g / np.sqrt(s[rows])

    for _ in range(epochs):
        order, at = rng.permutation(len(joined)), 0
        while at < len(order):
            word, label, count = [], [], []
            while at < len(order) and len(word) < batch_words:
                own = joined[order[at]]
                for lang, x in own:
                    word += [vocabulary[w] for w in x]
                    label += [number[lang]] * len(x)
                count.append(sum(len(x) for _, x in own))
                at += 1
            gold, count = np.eye(n)[label], np.array(count)
            start = np.cumsum(count) - count
            ids, back = np.unique(np.array(word), return_inverse=True)
            sizes = np.array([len(features[i]) for i in ids])
            flat, owner = np.concatenate([features[i] for i in ids]), np.repeat(np.arange(len(ids)), sizes)
            score = np.add.reduceat(weights[flat], np.cumsum(sizes) - sizes, axis=0)
            e = np.exp(score - score.max(1, keepdims=True))[back]
            post, pairs = forward_backward(e, start, count, np.exp(first), np.exp(move), pairs=True)
            inner = np.ones(len(gold), bool)
            inner[start] = False
            seen = gold[:-1][inner[1:]].T @ gold[1:][inner[1:]]
            by_word = np.stack([np.bincount(back, (gold - post)[:, k], minlength=len(ids)) for k in range(n)], 1)
            rows, slot = np.unique(flat, return_inverse=True)
            grad = np.stack([np.bincount(slot, by_word[owner, k], minlength=len(rows)) for k in range(n)], 1)
            step(weights, sums[0], grad - 1e-4 * weights[rows], rows)
            step(move, sums[1], seen - pairs)
            step(first, sums[2], (gold[start] - post[start]).sum(0))
    return Field(labels, lexicon, weights.astype(np.float32), np.exp(first), np.exp(move))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4)) == 2


def learn(docs: DataFrame, buckets: int = 400, sample_chars: int = 3000) -> Field:
    """The field fitted on a bounded sample: at most ``buckets`` documents per language."""
    rows = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
            .select("lang", F.xxhash64("text").alias("h"), F.substring("text", 1, sample_chars).alias("text")))
    sample = rows.groupBy("lang", F.pmod("h", F.lit(buckets)).alias("b")).agg(F.min(F.struct("h", "text")).alias("t"))
    found = [(r["lang"], r["text"]) for r in sample.select("lang", "t.text").collect()]
    return fit(found) if found else Field([], {}, np.zeros((1, 0)), np.zeros(0), np.zeros((0, 0)))


_fields: dict[int, tuple[Field, Recent]] = worker_cache()


def loaded(blob: bytes) -> tuple[Field, Recent]:
    """The worker's field, with the label weights of recent chunks of text."""
    key = zlib.crc32(blob)
    if key not in only(_fields):
        field = pickle.loads(zlib.decompress(blob))
        _fields.clear()
        _fields[key] = field, Recent(field.emissions, REMEMBERED_BYTES)
    return _fields[key]


def predict_batches(field: Field, spark):
    """A function from Arrow batches to (slice of a batch, languages, scores); the field (of a size set
    by its parameters, not by the data) is broadcast."""
    sent = spark.sparkContext.broadcast(zlib.compress(pickle.dumps(field), 1))

    def run(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, pa.Array, pa.Array]]:
        own, recent = loaded(sent.value)
        for big in batches:
            for b in slices(big, text, SLICE_BYTES):
                yield b, *own.predict(column(b, text), recent)
        release()

    return run


def identify(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    predict = predict_batches(learn(docs) if field is None else field, docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, lang, score in predict(batches, "text"):
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), column(b, "held_out"), lang, score],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def label_words(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """Per document: doc_id, its words (in lower case, as ``words_of`` cuts them) and the language of each."""
    field = learn(docs) if field is None else field
    sent = docs.sparkSession.sparkContext.broadcast(zlib.compress(pickle.dumps(field), 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, recent = loaded(sent.value)
        for big in batches:
            for b in slices(big, "text", SLICE_BYTES):
                words = [[w for c in (t or "").split() for w in words_of(c)] for t in column(b, "text").to_pylist()]
                ends = pa.array(np.cumsum([0, *map(len, words)]), pa.int32())
                post = own.labelled(column(b, "text"), recent)[0] if own.labels else np.empty((0, 1))
                best = post.argmax(1) if own.labels else np.zeros(ends[-1].as_py(), int)
                label = pa.array(own.labels or [UNKNOWN], pa.string()).take(pa.array(best, pa.int64()))
                yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(words, pa.list_(pa.string())), pa.ListArray.from_arrays(ends, label)], ["doc_id", "words", "labels"])
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, words array<string>, labels array<string>")


def keep_identified(docs: DataFrame, min_score: float = 0.35, field: Field | None = None) -> DataFrame:
    """The documents, with all their columns, whose language is told with at least ``min_score``."""
    predict = predict_batches(learn(docs) if field is None else field, docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, lang, score in predict(batches, "text"):
            yield b.filter(pc.and_(pc.not_equal(lang, UNKNOWN), pc.greater_equal(score, min_score)))

    return docs.mapInArrow(run, docs.schema)
