"""Helpers shared by the operators of this package: tables, work tables, Arrow slices, files."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from feedmetrics.session import fresh_path

# Layouts of the tables the queries read.
SCHEMAS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


#: Spark's setting that drops a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, with its declared layout."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written as a Parquet table under the shared work folder and read back.

    Cuts the lineage like a checkpoint: a lost executor costs only the running tasks, and
    the reader gets true sizes, so joins on it are planned (and skew-split) from plain scans.
    The shuffle files of the write are of no more use then, and Spark is told to drop them at once."""
    spark = df.sparkSession
    path = fresh_path(spark, kind)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices of a batch holding about ``max_bytes`` of ``column`` each.

    Every row is in exactly one slice; a single longer value is a slice of its own."""
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(size):
        if i > start and total + n > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    if batch.num_rows > start:
        yield batch.slice(start)


def plain_text(texts: pa.Array) -> pa.Array:
    """``texts`` with empty texts for nulls, as a fresh array: the case kernels misread the
    64-bit copy of a slice, whose offsets do not begin at 0."""
    return pc.fill_null(texts, "").take(pa.array(np.arange(len(texts)))).cast(pa.large_string())


_caches: list[dict] = []


def worker_cache() -> dict:
    """A new cache for what an operator keeps in a Python worker from task to task."""
    _caches.append({})
    return _caches[-1]


def only(cache: dict) -> dict:
    """``cache``, with all others emptied: a worker serves one stage after the other, and only this one's models are of use now."""
    others = [c for c in _caches if c is not cache and c]
    for c in others:
        c.clear()
    if others:
        gc.collect()
        release()
    return cache


def release() -> None:
    """At the end of a task: give free memory back, Arrow's and that of the C library, since the worker may stay alive beside later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # no glibc
        pass


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


class Folder:
    """A folder on any file system that Arrow can open (local, HDFS, S3, GCS), for binary files.

    Executors write each file under a name of its own attempt and report it in the rows they
    return; only names in committed rows are ever read, so a lost or repeated task leaves at
    most an unused file."""

    def __init__(self, uri: str):
        self.uri = uri

    def _open(self):
        from pyarrow import fs

        return (fs.FileSystem.from_uri(self.uri) if "://" in self.uri or self.uri.startswith("file:")
                else (fs.LocalFileSystem(), os.path.abspath(self.uri)))

    def create(self, stem: str):
        """(file name, output stream) of a new file."""
        system, base = self._open()
        system.create_dir(base, recursive=True)
        name = f"{stem}-{uuid.uuid4().hex}"
        return name, system.open_output_stream(f"{base}/{name}", compression=None)

    def read(self, name: str):
        """Random-access input of a file."""
        system, base = self._open()
        return system.open_input_file(f"{base}/{name}")
