"""WARC archives with revisit resolution.

1. Every page becomes a response record (HTTP headers and the payload) in capture archives; the
   task that writes a record returns its header row: page, place in the archive, payload digest
   and length. Payloads are never shuffled.
2. Header rows are aggregated by payload digest: the record with the largest page id is the
   original. Joining the headers to the originals decides response or revisit.
3. The archives are written anew in the order of the captures: originals are copied with fresh
   headers, the others become revisit records that name the original (record id, URI, date).
4. ``read_archives`` reads the files back, record by record, and checks each payload's digest.

Each record is a gzip member of its own, as the format advises, so any record can be read alone.

Defined cases: a null html is an empty payload; a null url gives a record without a target URI;
equal payloads shorter than ``min_bytes`` are all responses; among rows with the same page id
and payload the last one in the archives is the original; a null page id counts as the smallest; an empty
table gives no archives and no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmetrics.llm.common import Folder, column, saved, slices
from feedmetrics.session import fresh_path

HEADERS = ("page_id long, url string, record_id string, file string, offset long, length long, "
           "payload_bytes long, payload_digest string")
RECORDS = ("page_id long, record_id string, record_type string, target_uri string, payload_bytes long, payload_digest string, "
           "refers_to long, refers_to_record string")
#: Bytes of an archive after which a task starts another.
ARCHIVE_BYTES = 1 << 30
#: Payload bytes that one rewriting task handles.
TASK_BYTES = 64 << 20
# Fixed value: the profile of a revisit whose payload is the same, from the WARC standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: list[tuple[str, object]], block: bytes, level: int) -> bytes:
    """One WARC record as a gzip member; headers without a value are left out."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in [*headers, ("Content-Length", len(block))] if v is not None)]
    zip_ = zlib.compressobj(level, zlib.DEFLATED, 31)
    return zip_.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + zip_.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of an unzipped record."""
    head, _, rest = member.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines)
    return headers, rest[:int(headers["Content-Length"])]


def uri(url: str | None) -> str | None:
    """The URL fit for a header line: control characters are percent-encoded."""
    return None if url is None else "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def http_block(payload: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload


def response(page_id: int | None, url: str | None, payload: bytes, sha: str, record_id: str, date: str, level: int) -> bytes:
    block = http_block(payload)
    return record([("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{record_id}>"), ("WARC-Date", date), ("WARC-Target-URI", uri(url)),
                   ("WARC-Payload-Digest", f"sha1:{sha}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("X-Page-Id", page_id),
                   ("Content-Type", "application/http; msgtype=response")], block, level)


def fresh_id(record_id: str) -> str:
    """The id of a record's rewritten form; a function of the old id, so revisits can name it."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"urn:uuid:{record_id}"))


class ArchiveWriter:
    """Appends records to archives of at most about ``ARCHIVE_BYTES``."""

    def __init__(self, folder: Folder, stem: str):
        self.folder, self.stem, self.out, self.at, self.name = folder, stem, None, 0, ""

    def add(self, data: bytes) -> tuple[str, int, int]:
        if self.out is None or self.at >= ARCHIVE_BYTES:
            self.close()
            self.name, self.out = self.folder.create(self.stem)
            self.at = 0
        place = self.name, self.at, len(data)
        self.out.write(data)
        self.at += len(data)
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def write_captures(pages: DataFrame, path: str, *, date: str = "1970-01-01T00:00:00Z", level: int = 4) -> DataFrame:
    """Capture archives under ``path``, every row a response; returns the header rows (saved)."""
    folder = Folder(f"{path}/captures")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out = ArchiveWriter(folder, f"capture-{TaskContext.get().partitionId():06d}")
        for big in batches:
            for b in slices(big, "html", 8 << 20):
                rows = []
                for page, url, html in zip(*(column(b, c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                    payload, own = (html or "").encode(), str(uuid.uuid4())
                    sha = digest(payload)
                    rows.append((page, url, own, *out.add(response(page, url, payload, sha, own, date, level)), len(payload), sha))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                    pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                    ["page_id", "url", "record_id", "file", "offset", "length", "payload_bytes", "payload_digest"])
        out.close()

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, HEADERS)
    return saved(rows, "warc-headers")


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Header rows with the original's page, record and URI; null where the row is the original.

    The originals are pre-aggregated per digest and saved, so that a digest with a large part of
    all rows meets one row in the join, whose large side Spark can split."""
    candidates = headers.where(F.col("payload_bytes") >= min_bytes)
    originals = saved(
        candidates.groupBy("payload_digest", "payload_bytes")
        .agg(F.max(F.struct("page_id", "file", "offset", "record_id", "url")).alias("o"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("payload_digest", "payload_bytes", F.col("o.page_id").alias("refers_to"),
                               F.col("o.record_id").alias("refers_to_record"), F.col("o.url").alias("refers_to_url")), "warc-originals")
    joined = headers.join(originals, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("refers_to_record").isNotNull() & (F.col("refers_to_record") != F.col("record_id")) & (F.col("payload_bytes") >= min_bytes)
    return joined.withColumn("revisit", revisit)


def write_deduplicated(resolved: DataFrame, path: str, *, date: str = "1970-01-01T00:00:00Z", level: int = 4) -> DataFrame:
    """Archives with one response per payload and revisits for the rest; returns file names and
    places (saved). Tasks take ranges of the captures, so they read these in order."""
    source, folder = Folder(f"{path}/captures"), Folder(f"{path}/archives")
    rows = saved(resolved, "warc-resolved")
    total = rows.agg(F.sum("payload_bytes")).first()[0] or 0
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, total // TASK_BYTES + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out, name, file = ArchiveWriter(folder, f"archive-{TaskContext.get().partitionId():06d}"), None, None
        for b in batches:
            places = []
            for r in b.to_pylist():
                own = fresh_id(r["record_id"])
                if r["revisit"]:
                    data = record([
                        ("WARC-Type", "revisit"), ("WARC-Record-ID", f"<urn:uuid:{own}>"), ("WARC-Date", date), ("WARC-Target-URI", uri(r["url"])),
                        ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:uuid:{fresh_id(r['refers_to_record'])}>"),
                        ("WARC-Refers-To-Target-URI", uri(r["refers_to_url"])), ("WARC-Refers-To-Date", date),
                        ("WARC-Payload-Digest", f"sha1:{r['payload_digest']}"), ("X-Page-Id", r["page_id"]), ("X-Refers-To-Page-Id", r["refers_to"]),
                        ("X-Payload-Length", r["payload_bytes"]), ("Content-Type", "application/http; msgtype=response")], b"", level)
                else:
                    if r["file"] != name:
                        if file is not None:
                            file.close()
                        name, file = r["file"], source.read(r["file"])
                    _, block = parse(zlib.decompress(file.read_at(r["length"], r["offset"]), 31))
                    data = response(r["page_id"], r["url"], block.partition(b"\r\n\r\n")[2], r["payload_digest"], own, date, level)
                places.append(out.add(data))
            if places:
                f, o, n = zip(*places, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(o, pa.int64()), pa.array(n, pa.int64())], ["file", "offset", "length"])
        out.close()

    placed = rows.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, "file string, offset long, length long")
    return saved(placed, "warc-places")


def read_archives(spark: SparkSession, path: str, places: DataFrame, sub: str = "archives") -> DataFrame:
    """The records of the archives in ``places``; a response's payload is checked against its digest."""
    folder = Folder(f"{path}/{sub}")
    total = places.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, total // TASK_BYTES + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for b in batches:
            rows = []
            for f, at, n in zip(*(column(b, c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                if f != name:
                    if file is not None:
                        file.close()
                    name, file = f, folder.read(f)
                h, block = parse(zlib.decompress(file.read_at(n, at), 31))
                sha, own = h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Record-ID"][10:-1]
                page = int(h["X-Page-Id"]) if "X-Page-Id" in h else None
                if h["WARC-Type"] == "response":
                    payload = block.partition(b"\r\n\r\n")[2]
                    if digest(payload) != sha:
                        raise ValueError(f"payload of {own} does not match its digest")
                    rows.append((page, own, "response", h.get("WARC-Target-URI"), len(payload), sha, None, None))
                else:
                    to = int(h["X-Refers-To-Page-Id"]) if "X-Refers-To-Page-Id" in h else None
                    rows.append((page, own, "revisit", h.get("WARC-Target-URI"), int(h["X-Payload-Length"]), sha, to, h["WARC-Refers-To"][10:-1]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                    pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()), strict=True)],
                    ["page_id", "record_id", "record_type", "target_uri", "payload_bytes", "payload_digest", "refers_to", "refers_to_record"])

    return places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, RECORDS)


def deduplicated_archives(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write the captures, resolve revisits, write the deduplicated archives and read them back."""
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc")
    places = write_deduplicated(resolve(write_captures(pages, path), min_bytes), path)
    return read_archives(spark, path, places)
