"""Token files: bit-plane shuffled ids in compressed chunks with a chunk index.

Documents are ordered by id over the whole table (range partitions); each partition becomes one
shard file. Ids of a shard form one stream, cut into blocks of a fixed number of ids. A block is
transposed into planes (the four bytes of every id, or its 32 bits), each plane is compressed
with zstandard, and the footer stores the chunk index (offset and ids of each chunk, length of
each plane) and the document index (id and first token of each document). A manifest table has
one row per shard, in order, with its number of ids, so any document's place in the whole
stream is the shard's start plus its own.

File layout: chunks, then the footer (JSON header, document ids and starts as little-endian
64-bit integers, compressed), then the footer's length as 8 bytes and the magic bytes.

Defined cases: a null text is empty; every document gets the end id, so an empty one has that
id alone; a null document id comes first; rows with the same id are kept, each with its own
tokens, ordered by text; an empty table gives no shards and no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedmetrics.llm.bpe import AT_ONCE, LINE, SLICE_BYTES, RuleEncoder, apart, bare_text, flat_ids, piece_text
from feedmetrics.llm.common import Folder, column, only, release, slices, worker_cache
from feedmetrics.session import fresh_path

#: Bytes of pieces that a worker remembers in each of two generations: the library is slow on new ones.
REMEMBERED_BYTES = 100 << 20
MAGIC = b"IDPLANE1"
MANIFEST = "shard long, file string, n_docs long, n_ids long"


# -- encoding with the tokenizers library ------------------------------------------------------

class LibraryEncoder(RuleEncoder):
    """Encodes with a ``tokenizers.Tokenizer``: new pieces go to it joined by line feeds, whose id
    separates their ids again."""

    def __init__(self, file: bytes, plain: bool = False):
        super().__init__(file, plain)
        self.recent.most = REMEMBERED_BYTES
        self.line = self.ids("\n")[0]

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def compute(self, keys: list[str]) -> list[bytes]:
        done: dict[str, bytes] = {}
        alone, runs = apart(keys)
        for k, e in zip(alone, self.tokenizer.encode_batch_fast([piece_text(k) for k in alone], add_special_tokens=False), strict=True):
            done[k] = array("I", e.ids).tobytes()
        line = array("I", [self.line]).tobytes()
        for at in range(0, len(runs), AT_ONCE):
            some = runs[at:at + AT_ONCE]
            text = "\n".join(map(bare_text, some))
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = [*np.flatnonzero(ids == self.line).tolist(), len(ids)]
            if len(ends) != len(some):
                raise ValueError("a piece holds a line feed")
            raw, start = ids.tobytes(), 0
            for k, end in zip(some, ends, strict=True):
                own = raw[4 * start:4 * end]
                done[k] = line + own if k[:1] == LINE else own
                start = end + 1
        return [done[k] for k in keys]


_encoder: dict[int, LibraryEncoder] = worker_cache()


def encoder(file: bytes) -> LibraryEncoder:
    key = zlib.crc32(file)
    if key not in only(_encoder):
        _encoder[key] = LibraryEncoder(file)
    return _encoder[key]


# -- planes and chunks -------------------------------------------------------------------------

def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """The block transposed: plane k holds byte k (or bit k) of every id."""
    table = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [np.ascontiguousarray(table[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(table, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(data: list[bytes], n: int, planes: str) -> np.ndarray:
    if planes == "byte":
        return np.stack([np.frombuffer(p, np.uint8) for p in data], 1).reshape(-1).view("<u4")
    bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in data], 1)
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")


class ShardWriter:
    """Streams ids into one shard file; holds one block and the document index."""

    def __init__(self, out, planes: str, block_ids: int, level: int):
        self.out, self.planes, self.block = out, planes, block_ids
        self.zip = zstandard.ZstdCompressor(level=level)
        self.wait: list[np.ndarray] = []
        self.waiting = self.at = self.n = 0
        self.chunks: list[list] = []
        self.docs: list[int | None] = []
        self.starts: list[int] = []

    def add(self, docs: list[int | None], ids: np.ndarray, starts: np.ndarray) -> None:
        """Some documents' ids, and where each begins among them."""
        self.docs += docs
        self.starts += (starts + self.n).tolist()
        self.n += len(ids)
        self.wait.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            ids = np.concatenate(self.wait)
            whole = len(ids) // self.block * self.block
            for i in range(0, whole, self.block):
                self.chunk(ids[i:i + self.block])
            self.wait, self.waiting = [ids[whole:]], len(ids) - whole

    def chunk(self, ids: np.ndarray) -> None:
        data = [self.zip.compress(p) for p in to_planes(ids, self.planes)]
        self.chunks.append([self.at, len(ids), [len(d) for d in data]])
        for d in data:
            self.out.write(d)
            self.at += len(d)

    def close(self) -> None:
        if self.waiting:
            self.chunk(np.concatenate(self.wait))
        nulls = [i for i, d in enumerate(self.docs) if d is None]
        head = json.dumps({"planes": self.planes, "block_ids": self.block, "n_ids": self.n, "n_docs": len(self.docs),
                           "null_docs": nulls, "chunks": self.chunks}).encode()
        body = np.array([d or 0 for d in self.docs] + self.starts, "<i8").tobytes()
        foot = self.zip.compress(len(head).to_bytes(8, "little") + head + body)
        self.out.write(foot + len(foot).to_bytes(8, "little") + MAGIC)
        self.out.close()


class ShardReader:
    """Reads a shard by its indexes: any chunk, or the documents in order."""

    def __init__(self, file):
        self.file, size = file, file.size()
        tail = file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError("not a token shard")
        n = int.from_bytes(tail[:8], "little")
        foot = zstandard.ZstdDecompressor().decompress(file.read_at(n, size - 16 - n))
        k = int.from_bytes(foot[:8], "little")
        self.head = json.loads(foot[8:8 + k])
        body = np.frombuffer(foot, "<i8", offset=8 + k).reshape(2, -1)
        nulls = set(self.head["null_docs"])
        self.docs = [None if i in nulls else d for i, d in enumerate(body[0].tolist())]
        self.starts = body[1].tolist()
        self.unzip = zstandard.ZstdDecompressor()

    def chunk(self, k: int) -> np.ndarray:
        """The ids of chunk k (one read, its planes decompressed and transposed back)."""
        at, n, sizes = self.head["chunks"][k]
        raw, data, pos = self.file.read_at(sum(sizes), at), [], 0
        for s in sizes:
            data.append(self.unzip.decompress(raw[pos:pos + s]))
            pos += s
        return from_planes(data, n, self.head["planes"])

    def documents(self) -> Iterator[tuple[int | None, int, list[np.ndarray]]]:
        """(id, first token, its ids in pieces) of each document, one chunk in memory at a time."""
        block, ends = self.head["block_ids"], [*self.starts[1:], self.head["n_ids"]]
        have, ids = -1, np.empty(0, "<u4")
        for doc, start, end in zip(self.docs, self.starts, ends, strict=True):
            own = []
            for k in range(start // block, (end - 1) // block + 1 if end > start else start // block):
                if k != have:
                    have, ids = k, self.chunk(k)
                own.append(ids[max(0, start - k * block):end - k * block])
            yield doc, start, own


# -- the operator ------------------------------------------------------------------------------

def write_token_files(docs: DataFrame, tokenizer_path: str, path: str, *, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = 0, planes: str = "byte", block_ids: int = 1 << 16, level: int = 3) -> DataFrame:
    """Encode every text, append ``end_id``, write the shards under ``path`` in ascending id
    order; returns (and stores as ``path``/manifest) one row per shard."""
    if planes not in ("byte", "bit"):
        raise ValueError("planes is 'byte' or 'bit'")
    with open(tokenizer_path, "rb") as f:
        file = f.read()
    folder = Folder(f"{path}/shards")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, out, name = TaskContext.get().partitionId(), None, ""
        enc = encoder(file)
        for big in batches:
            for b in slices(big, "text", SLICE_BYTES):
                if out is None:
                    name, raw = folder.create(f"shard-{shard:06d}")
                    out = ShardWriter(raw, planes, block_ids, level)
                flat, ends = flat_ids(enc.encode(column(b, "text")))
                out.add(column(b, "id").to_pylist(), np.insert(flat, ends[1:], end_id), ends[:-1] + np.arange(len(ends) - 1))
        release()
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [name], "n_docs": [len(out.docs)], "n_ids": [out.n]})

    ordered = (docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
               .repartitionByRange("id").sortWithinPartitions("id", "text"))
    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{path}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files: id, start (ids before it in the whole stream), n_tokens and
    ids_crc32 (unsigned CRC-32 of its ids as little-endian 32-bit integers)."""
    folder = Folder(f"{path}/shards")
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    # One row per shard: the running sum in one task is over shards, not documents.
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.select("shard", "file", F.coalesce(before, F.lit(0)).alias("first"))
    n = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                with folder.read(row["file"]) as f:
                    rows = []
                    for doc, start, parts in ShardReader(f).documents():
                        crc = 0
                        for p in parts:
                            crc = zlib.crc32(np.ascontiguousarray(p).tobytes(), crc)
                        rows.append((doc, row["first"] + start, sum(map(len, parts)), crc))
                for at in range(0, len(rows), 10_000):
                    doc, start, count, crc = zip(*rows[at:at + 10_000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, start, count, crc)], ["id", "start", "n_tokens", "ids_crc32"])

    out = shards.repartition(n).mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long")
    return out.withColumnRenamed("id", id_col)


def token_file_digests(docs: DataFrame, tokenizer_path: str, path: str | None = None, **options) -> DataFrame:
    """Write the token files of ``docs`` (under the shared work folder) and read them back."""
    spark = docs.sparkSession
    path = path or fresh_path(spark, "token-files")
    write_token_files(docs, tokenizer_path, path, **options)
    return read_token_files(spark, path, options.get("id_col", "doc_id"))
