"""Quality rules by distribution divergence.

A first pass over all documents makes the language references: per language the histogram of
character classes and the shares of its common words (words with at least ``min_share`` of the
language's words, so at most 1 / min_share of them). A second pass compares each document's
histograms with every reference by the Jensen-Shannon distance (base 2, so between 0 and 1); the
reference with the least sum of both distances judges it. The word distance is that among the
common words, 1 if the text has none: with all other words as one cell, a text without common
words would be at a moderate distance. How many of the words are common is judged by itself: at
least ``min_common`` of the reference's share, less two standard deviations of a sample of that
size. Distances of short texts are large by chance alone: the limit of the class distance widens
as noise / sqrt(words), and the square of the word distance may exceed ``max_word`` squared by
what sampling gives so many common words. Texts under ``min_words`` are not judged by distance at
all (the base rules fail them first).

Base rules: fewer than ``min_words`` words, or more than half of the words within repeated
three-word windows.

Defined cases: a null text has no words and fails the base rules; documents with a null
language are no part of a reference but are judged; without any reference no document is
rejected by distance; repeated rows are counted each; very long texts are used whole; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmetrics.llm.common import column, saved, slices

# Character classes by byte; bytes inside a character count as none.
CLASSES = ("other", "space", "lower", "upper", "digit", "sentence", "symbol", "beyond", "none")
SENTENCE, SYMBOLS, SPACES = b".,;:!?'\"()-", b"#*$%&|<>", b" \t\n\x0b\x0c\r"
#: Entries a counting task holds before it passes them on.
MAX_COUNTED = 400_000


def byte_classes() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for name, members in (("space", SPACES), ("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)),
                          ("sentence", SENTENCE), ("symbol", SYMBOLS), ("none", range(128, 192)), ("beyond", range(192, 256))):
        table[list(members)] = CLASSES.index(name)
    return table


CLASS_OF = byte_classes()


def class_counts(raw: bytes) -> np.ndarray:
    """Characters of each class in UTF-8 text (without the bytes inside characters)."""
    return np.bincount(CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=len(CLASSES))[:-1]


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))  # noqa: B905
    if len(set(windows)) == len(windows):
        return 0
    found, covered, upto = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if found[w] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance to the base 2 of two histograms (each of sum 1)."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a, b = np.where(p > 0, p * np.log2(p / m), 0).sum(), np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, (a + b) / 2)))


class Reference:
    """What is usual in one language."""

    def __init__(self, classes: np.ndarray, words: dict[bytes, float]):
        self.classes = classes / max(1, classes.sum())
        self.words = list(words)
        self.common = min(1.0, sum(words.values()))
        self.shares = np.array(list(words.values()), float) / (self.common or 1)

    def word_limit(self, common: float, max_word: float) -> float:
        """The largest usual word distance of a text with so many ``common`` words: by chance a
        word of share s adds about 1 / (8 common ln 2) to the divergence, and at most s."""
        return float(np.sqrt(max_word ** 2 + np.minimum(self.shares, 1 / (8 * max(common, 1) * np.log(2))).sum()))

    def least_common(self, n: int, part: float) -> float:
        """The least usual number of common words among ``n`` words."""
        return part * self.common * n - 2 * (self.common * (1 - self.common) * n) ** 0.5


def references(docs: DataFrame, min_share: float = 0.002, min_words: int = 50) -> dict[str, Reference]:
    """The reference of each language, from all documents of at least ``min_words`` words.

    The driver gets one histogram and at most 1 / min_share words per language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            lang, kind, word = zip(*counts, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(kind, pa.int32()), pa.array(word, pa.binary()),
                                               pa.array(counts.values(), pa.int64())], ["lang", "kind", "word", "n"])

        for big in batches:
            for b in slices(big, "text", 4 << 20):
                for lang, text in zip(column(b, "lang").to_pylist(), column(b, "text").to_pylist(), strict=True):
                    raw = text.encode()
                    words = raw.split()
                    if len(words) < min_words:
                        continue
                    for w, n in Counter(words).items():
                        counts[lang, 1, w] += n
                    counts[lang, 2, b""] += len(words)
                    for c, n in enumerate(class_counts(raw).tolist()):
                        counts[lang, 0, b"%d" % c] += n
                if len(counts) > MAX_COUNTED:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    rows = docs.select("lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull()).mapInArrow(run, "lang string, kind int, word binary, n long")
    total = saved(rows.groupBy("lang", "kind", "word").agg(F.sum("n").alias("n")), "word-counts")
    size = total.where("kind = 2").select("lang", F.col("n").alias("words"))
    common = total.join(F.broadcast(size), "lang").where((F.col("kind") == 0) | ((F.col("kind") == 1) & (F.col("n") >= min_share * F.col("words"))))
    found: dict[str, tuple[np.ndarray, dict]] = {}
    for r in common.select("lang", "kind", "word", "n", "words").collect():
        classes, words = found.setdefault(r["lang"], (np.zeros(len(CLASSES) - 1), {}))
        if r["kind"] == 0:
            classes[int(bytes(r["word"]))] = r["n"]
        else:
            words[bytes(r["word"])] = r["n"] / r["words"]
    return {k: Reference(c, dict(sorted(w.items()))) for k, (c, w) in sorted(found.items())}


def nearest(words: list[bytes], classes: np.ndarray, refs: dict[str, Reference]) -> tuple[float, float, float, Reference | None]:
    """The character-class and the common-word distance to the reference with the least sum of
    both, the number of its common words in the text, and the reference."""
    count = Counter(words)
    share = classes / max(1, classes.sum())
    best = 0.0, 0.0, 0.0, None
    for r in refs.values():
        own = np.fromiter((count.get(w, 0) for w in r.words), float, len(r.words))
        common = float(own.sum())
        by_class = js_distance(share, r.classes)
        by_word = js_distance(own / common, r.shares) if common else float(bool(r.words))
        if best[3] is None or by_class + by_word < best[0] + best[1]:
            best = by_class, by_word, common, r
    return best


def judge(docs: DataFrame, refs: dict[str, Reference] | None = None, *, min_words: int = 50, max_class: float = 0.28,
          max_word: float = 0.5, noise: float = 2.0, min_common: float = 0.5) -> DataFrame:
    """Per document: doc_id, the base counts, base_failed, kept, and both distances."""
    refs = references(docs, min_words=min_words) if refs is None else refs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in slices(big, "text", 4 << 20):
                rows = []
                for text in column(b, "text").to_pylist():
                    raw = (text or "").encode()
                    words, classes = raw.split(), class_counts(raw)
                    n, chars = len(words), int(classes.sum() - classes[CLASSES.index("space")])
                    again = repeat_words(words)
                    failed = n < min_words or 100 * again > 50 * n
                    c, w, common, ref = nearest(words, classes, refs) if n >= min_words else (0.0, 0.0, 0.0, None)
                    usual = ref is None or (c <= max_class + noise / n ** 0.5 / 10 and w <= ref.word_limit(common, max_word)
                                            and common >= ref.least_common(n, min_common))
                    rows.append((n, chars, int(classes[CLASSES.index("symbol")]), duplicate_lines(raw), again, failed,
                                 not failed and usual, c, w))
                kinds = (*[pa.int64()] * 5, pa.bool_(), pa.bool_(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([column(b, "doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, OUT)


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"]
OUT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
       "base_failed boolean, kept boolean, class_distance double, word_distance double")
