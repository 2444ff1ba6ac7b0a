"""Byte-level BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of each distinct word. A vectorised check then tests
every adjacent pair of proposed tokens: a pair is compatible if no merge across its border
would have come first while the two tokens were being built. A word whose tokens are all
reachable and whose pairs are all compatible is the one that BPE gives; only the failing words
are merged exactly, step by step.

The words are those of the tokenizer file's own pre-tokenizer.

Defined cases: a null text is treated as empty and has no ids; a null id stays null; an empty table
gives no rows; repeated rows are encoded each; very long texts and very long words are encoded whole; the special token's text inside a text
becomes its id, as the tokenizer file says; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from feedmetrics.llm.common import column, only, plain_text, release, slices, worker_cache

NEVER = np.int64(1 << 40)
#: Bytes of a word beyond which it is merged by itself.
LONG = 48
#: Bytes of pieces that a Python worker remembers in each of two generations, and what Python needs besides for each.
MAX_REMEMBERED, KEY_BYTES = 48 << 20, 180
#: Text bytes taken from Arrow at once.
SLICE_BYTES = 4 << 20


def byte_letters() -> dict[str, int]:
    """The printable letter of each byte in a byte-level vocabulary file, as letter -> byte.

    Printable Latin-1 bytes stand for themselves; the rest are numbered from code point 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Bpe:
    """A byte-level BPE vocabulary with speculative encoding; built from a tokenizer file's bytes."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        letters = byte_letters()
        vocab = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for t, i in vocab.items():
            self.bytes_of[i] = t
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode()
        self.id_of = vocab
        # Merges: pair -> (rank, id); formed[t] = rank of t's merge, -1 for a single byte.
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}
        self.formed = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            x, y = (vocab[bytes(letters[c] for c in t)] for t in (a, b))
            z = vocab[self.bytes_of[x] + self.bytes_of[y]]
            self.pair.setdefault((x, y), (rank, z))
            if self.formed[z] < 0 and len(self.bytes_of[z]) > 1:
                self.formed[z], self.left[z], self.right[z] = rank, x, y
        self.size = size
        keys = np.array([x * size + y for x, y in self.pair], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.pair.values()], np.int64)[order]
        self.pair_ids = np.array([t for _, t in self.pair.values()], np.int64)[order]
        self.byte_ids = np.array([vocab[bytes([i])] for i in range(256)], np.int64)
        self.finder = ahocorasick.Automaton()
        for t, i in vocab.items():
            self.finder.add_word(t.decode("latin-1"), i)
        self.finder.make_automaton()
        self.sizes = np.array([len(t) for t in self.bytes_of], np.int64)
        # A token is reachable if its two halves are, and stay apart until its own merge.
        self.reachable = np.ones(size, bool)
        made = np.flatnonzero(self.formed >= 0)
        made = made[np.argsort(self.formed[made])]
        apart = self.compatible(self.left[made], self.right[made], self.formed[made])
        for t, ok in zip(made.tolist(), apart.tolist(), strict=True):
            self.reachable[t] = ok and self.reachable[self.left[t]] and self.reachable[self.right[t]]

    def ranks(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The merge rank of each pair, NEVER where there is no such merge."""
        key = x.astype(np.int64) * self.size + y
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)

    def compatible(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether BPE leaves the border between each x and y alone (before rank ``limit``).

        Walks back through the merges that built the two tokens, latest first. At each step the
        parts beside the border are those that existed together; a merge of these two with a rank
        below the next merge of either would have crossed the border. Equal ranks go to the left."""
        ok = np.ones(len(x), bool)
        x, y = np.array(x, np.int64), np.array(y, np.int64)
        limit = np.full(len(x), NEVER) if limit is None else np.array(limit, np.int64)
        live = np.arange(len(x))
        while len(live):
            a, b = x[live], y[live]
            bad = self.ranks(a, b) < limit[live]
            ok[live[bad]] = False
            fa, fb = self.formed[a], self.formed[b]
            go = ~bad & ((fa >= 0) | (fb >= 0))
            live, a, b, fa, fb = live[go], a[go], b[go], fa[go], fb[go]
            back = fa > fb  # the left token's last merge is the later one
            x[live] = np.where(back, self.right[a], a)
            y[live] = np.where(back, b, self.left[b])
            limit[live] = np.where(back, fa, fb + 1)
        return ok

    def greedy(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their words): the longest token at every place, from left to right."""
        ends = np.cumsum([len(w) + 1 for w in words])
        # Between the words stands a character that no token has.
        found = np.array(list(self.finder.iter_long("\u0100".join([w.decode("latin-1") for w in words]))), np.int64).reshape(-1, 2)
        return found[:, 1], np.searchsorted(ends, found[:, 0], "right")

    def exact(self, words: list[bytes]) -> list[bytes]:
        """BPE by the definition: always the merge of the lowest rank, the leftmost first."""
        short = [i for i, w in enumerate(words) if len(w) <= LONG]
        out = [b""] * len(words)
        for i, ids in zip(short, self._together([words[i] for i in short]), strict=True):
            out[i] = ids
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = array("I", self._heap(self.byte_ids[np.frombuffer(w, np.uint8)].tolist())).tobytes()
        return out

    def _together(self, words: list[bytes]) -> list[bytes]:
        """For short words: every round does the next merge of each word that has one."""
        out = [b""] * len(words)
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank = np.full(len(ids), NEVER)
        self._rank(ids, owner, rank, np.arange(len(ids)))
        while len(ids):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            size = np.diff(np.append(first, len(ids)))
            least = np.minimum.reduceat(rank, first)
            over = np.repeat(least == NEVER, size)
            if over.any():
                done, raw = np.flatnonzero(least == NEVER), ids[over].astype("<u4").tobytes()
                end = 4 * np.cumsum(size[done])
                for w, a, b in zip(owner[first[done]].tolist(), (end - 4 * size[done]).tolist(), end.tolist(), strict=True):
                    out[w] = raw[a:b]
                ids, owner, rank = ids[~over], owner[~over], rank[~over]
                size, least = size[least < NEVER], least[least < NEVER]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == np.repeat(least, size))
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]
            key = ids[at] * self.size + ids[at + 1]
            ids[at] = self.pair_ids[np.searchsorted(self.pair_keys, key)]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            at = at - np.arange(len(at))  # one token less before it for each word before
            self._rank(ids, owner, rank, np.concatenate([at, at[at > 0] - 1]))
        return out

    def _rank(self, ids: np.ndarray, owner: np.ndarray, rank: np.ndarray, at: np.ndarray) -> None:
        """Looks up the ranks of the pairs that begin at ``at``."""
        rank[at] = NEVER
        at = at[at + 1 < len(ids)]
        at = at[owner[at] == owner[at + 1]]
        rank[at] = self.ranks(ids[at], ids[at + 1])

    def _heap(self, ids: list[int]) -> list[int]:
        """For long words: a heap of the merges that may come next, O(n log n)."""
        after = list(range(1, len(ids))) + [-1]
        before = list(range(-1, len(ids) - 1))
        heap = [(self.pair[p][0], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.pair]  # noqa: B905
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = self.pair[a, b][1], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k, m in ((before[i], i), (i, after[i])):
                if k >= 0 and m >= 0 and (p := (ids[k], ids[m])) in self.pair:
                    heapq.heappush(heap, (self.pair[p][0], k, *p))
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word: speculated, verified together, merged exactly where that failed."""
        if not words:
            return []
        flat, owner = self.greedy(words)
        bad = np.bincount(owner, self.sizes[flat], len(words)) != np.fromiter(map(len, words), np.int64, len(words))
        bad[owner[~self.reachable[flat]]] = True
        inner = owner[1:] == owner[:-1]
        pairs, back = np.unique(flat[:-1][inner] * self.size + flat[1:][inner], return_inverse=True)
        bad[owner[1:][inner][~self.compatible(pairs // self.size, pairs % self.size)[back]]] = True
        ends = np.concatenate([[0], 4 * np.cumsum(np.bincount(owner, minlength=len(words)))]).tolist()
        raw = flat.astype("<u4").tobytes()
        found = [raw[a:b] for a, b in zip(ends, ends[1:])]  # noqa: B905
        failed = np.flatnonzero(bad).tolist()
        for i, ids in zip(failed, self.exact([words[i] for i in failed]), strict=True):
            found[i] = ids
        return found

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


# Fixed value: the published pattern that splits text into words before the merges. It is used
# for characters below U+0180; classes of others differ between versions of Unicode, so
# text that has any is split by the tokenizers library.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
BEYOND = regex.compile("[^\\x00-\u017f]")
# Kinds of remembered pieces: what stands before a run of non-space characters.
LINE, START, WORD, NEAR = "\n", "\r", "\v", "\x02"
#: Keys of pieces without a run (an empty text is one). Joined to others by line feeds they would make one word of the
#: white space around them, so they are encoded by themselves.
BARE = frozenset({"", LINE, START, NEAR})
#: Texts that are not cut at white space: some other white space than single spaces and line
#: feeds between other characters.
UNEVEN = "^[ \\n]|[ \\n]$|[ \\n][ \\n]|[\\x02\\t\\x0b\\f\\r\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
#: New pieces given to the tokenizers library at once.
AT_ONCE = 4000


def piece_text(key: str) -> str:
    """The text a key of a piece stands for."""
    if key[:1] in (START, WORD, NEAR):
        return key[1:]
    return key if key[:1] == LINE else " " + key


def bare_text(key: str) -> str:
    """The same without a line feed before it."""
    return key[1:] if key[:1] == LINE else piece_text(key)


def apart(keys: list[str]) -> tuple[list[str], list[str]]:
    """(keys encoded by themselves, keys of runs that may be joined by line feeds)."""
    alone = [k for k in keys if k[:1] == WORD or k in BARE]
    return alone, [k for k in keys if k[:1] != WORD and k not in BARE]


class Recent:
    """Values (bytes) by key in two generations: when the younger is full it becomes the older.

    Bounds a worker's memory by bytes while keys in steady use stay known. ``compute`` gets the keys that
    neither generation has and returns their values."""

    def __init__(self, compute, most_bytes: int = MAX_REMEMBERED):
        self.compute, self.most = compute, most_bytes
        self.clear()

    def clear(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.used = 0

    def get(self, keys: list[str]) -> list[bytes]:
        """The value of each of the (distinct) keys."""
        if self.used > self.most:
            self.young, self.old, self.used = {}, self.young, 0
        young, old = self.young, self.old
        new = [k for k in keys if k not in young]
        fresh = [k for k in new if k not in old]
        found = {k: old[k] for k in new if k in old}
        found.update(zip(fresh, self.compute(fresh), strict=True))
        self.used += sum(map(len, found)) + sum(map(len, found.values())) + KEY_BYTES * len(found)
        young.update(found)
        return [young[k] for k in keys]


class PieceEncoder:
    """Encodes texts piece by piece; a subclass encodes the pieces not seen lately (``compute``).

    Where every white space is one space or one line feed between other characters, each run of other
    characters is a piece with what stands before it: no word of the tokenizer's rule crosses such
    a border. Arrow cuts a slice's texts, numbers its distinct pieces and gathers their ids, so Python
    works once per distinct piece. Any other text, and one that holds a special token's text, is
    split by the tokenizer's own rule and encoded word by word."""

    #: Texts of special tokens and their ids.
    special: dict[str, int] = {}
    #: What stands before a text: nothing, or a space if the tokenizer puts one there.
    start = START
    #: Whether words end between a letter and a punctuation mark, so that pieces do too.
    marks_apart = False

    def __init__(self):
        self.recent = Recent(self.compute)

    def compute(self, keys: list[str]) -> Iterable[bytes]:
        raise NotImplementedError

    def whole(self, text: str) -> bytes:
        raise NotImplementedError

    def encode(self, texts: pa.Array) -> pa.LargeBinaryArray:
        """The ids of each text as little-endian 32-bit integers."""
        texts = plain_text(texts)
        odd = pc.match_substring_regex(texts, UNEVEN)
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        if not pc.any(odd).as_py():
            return self.even(texts)
        which = odd.to_numpy(zero_copy_only=False)
        rest = pa.array([self.whole(t) for t in texts.filter(odd).to_pylist()], pa.large_binary())
        both = pa.concat_arrays([self.even(texts.filter(pc.invert(odd))), rest])
        place = np.empty(len(which), np.int64)
        place[np.flatnonzero(~which)] = np.arange(int((~which).sum()))
        place[np.flatnonzero(which)] = np.arange(int((~which).sum()), len(which))
        return both.take(pa.array(place))

    def even(self, texts: pa.Array) -> pa.LargeBinaryArray:
        if self.marks_apart:
            texts = pc.replace_substring_regex(texts, r"([A-Za-z])([,.;:!?])", "\\1 \x02\\2")
        marked = pc.binary_join_element_wise(pa.scalar(self.start, pa.large_string()), pc.replace_substring(texts, "\n", " \n"), pa.scalar("", pa.large_string()))
        lists = pc.split_pattern(marked, " ")
        if not len(lists):
            return pa.array([], pa.large_binary())
        offsets = lists.offsets.to_numpy().astype(np.int64)
        own = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        ids = pa.array(self.recent.get(own.dictionary.to_pylist()), pa.large_binary()).take(own.indices)
        _, ends, data = ids.buffers()
        ends = np.frombuffer(ends, np.int64)[ids.offset:ids.offset + len(ids) + 1]
        starts = np.ascontiguousarray(ends[offsets - offsets[0]])
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(starts), data])


def flat_ids(ids: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, where each text's begin and end) of an encoded slice."""
    _, ends, data = ids.buffers()
    ends = np.frombuffer(ends, np.int64)[ids.offset:ids.offset + len(ids) + 1]
    flat = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.empty(0, np.uint8)
    return np.ascontiguousarray(flat).view("<u4"), (ends - ends[0]) // 4


class RuleEncoder(PieceEncoder):
    """With a tokenizer file of the tokenizers library; ``plain``: special tokens' texts are ordinary text."""

    def __init__(self, file: bytes, plain: bool = False):
        import os

        super().__init__()

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file.decode())
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        # The file's rule is the published pattern, as far as a probe of every character it is used for tells.
        probe = "".join(f"x{c} {c}'s  {c}{c}1 {c}" for c in map(chr, range(0x180)))
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)
        self.known_rule = self.marks_apart = [probe[a:b] for _, (a, b) in split] == PATTERN.findall(probe)
        added = self.tokenizer.get_added_tokens_decoder()
        self.tokenizer.encode_special_tokens = plain
        self.special = {} if plain else {t.content: i for i, t in added.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def words(self, text: str) -> list[str]:
        """The words of a text by the tokenizer's own rule (its file's pre-tokenizer)."""
        if self.known_rule and not BEYOND.search(text):
            return PATTERN.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def whole(self, text: str) -> bytes:
        """The ids of one text of any shape."""
        out = []
        for x in self.cut.split(text) if self.cut else [text]:
            if x in self.special:
                out.append(array("I", [self.special[x]]).tobytes())
            elif x:
                words = [WORD + w for w in self.words(x)]
                own = list(dict.fromkeys(words))
                ids = dict(zip(own, self.recent.get(own), strict=True))
                out += [ids[w] for w in words]
        return b"".join(out)


class Memory(RuleEncoder):
    """Speculates and verifies the words of new pieces; decodes by gathering the tokens' bytes."""

    def __init__(self, file: bytes):
        super().__init__(file)
        self.bpe = Bpe(file)
        self.said = pa.array([f"{i}," for i in range(self.bpe.size)], pa.large_binary())
        self.bytes_of = pa.array(self.bpe.bytes_of, pa.large_binary())

    def compute(self, keys: list[str]) -> Iterator[bytes]:
        alone, runs = apart(keys)
        split: list[list[str]] = [[w] if (w := piece_text(k)) else [] for k in alone]
        runs.sort(key=lambda k: BEYOND.search(k) is not None)
        for at in range(0, len(runs), AT_ONCE):
            some = runs[at:at + AT_ONCE]
            # Joined by line feeds, which are words of their own between pieces.
            text = "\n".join(map(bare_text, some))
            parts: list[list[str]] = [[]]
            for w in self.words(text):
                if w == "\n":
                    parts.append([])
                else:
                    parts[-1].append(w)
            split += [["\n", *p] if k[:1] == LINE else p for k, p in zip(some, parts, strict=True)]
        words = list({w for s in split for w in s})
        ids = dict(zip(words, self.bpe.encode_words([w.encode() for w in words]), strict=True))
        found = dict(zip([*alone, *runs], split, strict=True))
        return (b"".join([ids[w] for w in found[k]]) for k in keys)

    def texts_of(self, ids: pa.LargeBinaryArray, table: pa.LargeBinaryArray) -> list[memoryview]:
        """Per encoded text the entries of ``table`` for its ids, joined."""
        flat, ends = flat_ids(ids)
        if not len(flat):
            return [memoryview(b"")] * len(ids)
        _, at, data = table.take(pa.array(flat)).buffers()
        at, data = np.frombuffer(at, np.int64)[ends].tolist(), memoryview(data)
        return [data[a:b] for a, b in zip(at, at[1:])]  # noqa: B905


_loaded: dict[str, Memory] = worker_cache()


def memory(file: bytes) -> Memory:
    """The worker's encoder for a tokenizer file (built once per Python worker)."""
    key = hashlib.sha256(file).hexdigest()
    if key not in only(_loaded):
        _loaded[key] = Memory(file)
    return _loaded[key]


def shown(text: memoryview) -> bytes:
    """Decoded bytes as the library shows them in UTF-8: bytes that are no UTF-8 become U+FFFD."""
    return bytes(text).decode("utf-8", "replace").encode()


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256 (of the text decoded from the ids)."""
    file = _read(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mem = memory(file)
        for big in batches:
            for b in slices(big, "text", SLICE_BYTES):
                ids = mem.encode(column(b, "text"))
                n = np.diff(flat_ids(ids)[1])
                own = [hashlib.sha256(x[:-1]).hexdigest() for x in mem.texts_of(ids, mem.said)]
                back = [hashlib.sha256(shown(x)).hexdigest() for x in mem.texts_of(ids, mem.bytes_of)]
                yield pa.RecordBatch.from_arrays([column(b, "id"), pa.array(n, pa.int64()), pa.array(own, pa.string()), pa.array(back, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        release()

    kind = docs.schema[id_col].dataType.simpleString()
    out = (docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
           .mapInArrow(run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"))
    return out.withColumnRenamed("id", id_col)


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` (all its columns) with the ids of each text as an array of int."""
    file = _read(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mem = memory(file)
        for big in batches:
            for b in slices(big, text_col, SLICE_BYTES):
                flat, ends = flat_ids(mem.encode(column(b, text_col)))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*b.columns, ids], [*b.schema.names, ids_col])
        release()

    from pyspark.sql.types import ArrayType, IntegerType, StructType

    keep = docs.drop(ids_col)
    return keep.mapInArrow(run, StructType([*keep.schema.fields]).add(ids_col, ArrayType(IntegerType())))


def decode(rows: DataFrame, tokenizer_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of each array of ids (null ids: empty text)."""
    file = _read(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = memory(file).bpe
        for b in batches:
            text = [bpe.decode(i or []) for i in column(b, ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], [*b.schema.names, text_col])

    from pyspark.sql.types import StringType, StructType

    keep = rows.drop(text_col)
    return keep.mapInArrow(run, StructType([*keep.schema.fields]).add(text_col, StringType()))


def _read(path: str) -> bytes:
    """The tokenizer file; it is read once here and sent with the tasks (about 1.5 MB)."""
    with open(path, "rb") as f:
        return f.read()
