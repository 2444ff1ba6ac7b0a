"""Structured Streaming: file-backed sources, sinks with checkpoints, and running them."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

AVAILABLE_NOW = {"availableNow": True}
EVERY_MINUTE = {"processingTime": "1 minute"}


def stream_session(spark: SparkSession, state_partitions: int | None = None,
                   final_cleanup: bool = True) -> SparkSession:
    """A private session for one streaming run: the caller's SQL settings, plus the number of
    state-store partitions (fixed in the checkpoint at the first batch; default: the
    cluster's task slots, not ``spark.sql.shuffle.partitions``, which batch jobs size for
    shuffles) and whether a closing no-data batch runs (see ``run_available_now``).
    The caller's session is left untouched."""
    s = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if k.startswith("spark.sql.") and not k.startswith("spark.sql.catalog") and spark.conf.isModifiable(k):
            s.conf.set(k, v)
    slots = spark.sparkContext.defaultParallelism
    s.conf.set("spark.sql.shuffle.partitions", str(state_partitions or max(1, slots)))
    s.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true" if final_cleanup else "false")
    return s


def table_stream(spark: SparkSession, sf_dir: str, table: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A driver table as a stream: the part files of the folder ``<table>.parquet`` are the data,
    or, where that is a single file, files of this name. Raises if there is neither."""
    from feedmetrics.sources.files import TABLE_SCHEMAS

    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(hadoop)
    schema = TABLE_SCHEMAS.get(table) or spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path) if status.isDirectory() else r.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)


def _overwrite_table(path: str, keep: int):
    """Each micro-batch writes a folder of its own, so a reader always has a complete result. Folders that are
    ``keep`` or more batches old are removed once a newer one is complete."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch_id:020d}")
        expire_results(batch.sparkSession, path, epoch_id - keep)
    return write


def expire_results(spark: SparkSession, path: str, last: int) -> list[str]:
    """Removes the results of a ``table`` sink up to batch ``last``, but never the current one; their names.

    A reader takes the newest complete result when it begins; it has until that one is ``keep`` batches old."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = sorted(f.getPath().getName() for f in fs.listStatus(hadoop) if f.getPath().getName().startswith("epoch="))
    done = [n for n in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{n}/_SUCCESS"))]
    old = [n for n in found if done and n < done[-1] and int(n[len("epoch="):]) <= last]
    for n in old:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{n}"), True)
    return old


def read_result_table(spark: SparkSession, path: str) -> DataFrame:
    """The last complete result of a ``table`` sink (its folder with the largest epoch that has
    the writer's success mark)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/epoch=*/_SUCCESS")
    found = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(hadoop)
    if not found:
        raise FileNotFoundError(f"no complete result under {path}")
    return spark.read.parquet(max(f.getPath().getParent().toString() for f in found))


def start_sink(df: DataFrame, kind: str, path: str | None = None, checkpoint: str | None = None,
               name: str | None = None, trigger: dict | None = None, output_mode: str = "append",
               partition_by: Sequence[str] = (), options: dict | None = None, keep_results: int = 10) -> StreamingQuery:
    """Start one streaming query.

    kind: ``json``/``parquet``/``csv``/``text`` (file sink, append), ``table`` (the whole
    result written as parquet per micro-batch, each in a folder of its own, see
    ``read_result_table``: for small complete-mode aggregates; the ``keep_results`` newest stay),
    ``kafka`` (publish ``topic, partition, key, value`` rows; pass
    ``options={"kafka.bootstrap.servers": ...}``; needs the Kafka connector), ``memory``
    (driver memory: small results in tests only), ``console`` (preview).
    Durable kinds need ``checkpoint``; it lives and dies with ``path``.
    """
    w = df.writeStream.outputMode(output_mode).trigger(**(trigger or EVERY_MINUTE))
    if name:
        w = w.queryName(name)
    if kind in ("json", "parquet", "csv", "text", "table"):
        if not checkpoint or not path:
            raise ValueError(f"{kind} sink needs path and checkpoint")
        w = w.option("checkpointLocation", checkpoint)
    if kind == "kafka":
        if not checkpoint:
            raise ValueError("kafka sink needs a checkpoint")
        w = w.option("checkpointLocation", checkpoint)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if kind == "table":
        return w.foreachBatch(_overwrite_table(path, keep_results)).start()
    if kind in ("json", "parquet", "csv", "text"):
        if partition_by:
            w = w.partitionBy(*partition_by)
        return w.format(kind).start(path)
    if kind == "kafka":
        return w.format("kafka").start()
    if kind == "memory":
        if not name:
            raise ValueError("memory sink needs a name")
        return w.format("memory").start()
    if kind == "console":
        return w.format("console").start()
    raise ValueError(f"unknown sink kind {kind!r}")


def run_available_now(df: DataFrame, kind: str, path: str, checkpoint: str, output_mode: str = "append",
                      skip_final_cleanup: bool = False, **kw) -> None:
    """Process everything available now, then stop (one-shot incremental run).

    ``skip_final_cleanup=True`` leaves out the closing no-data micro-batch, whose only work
    is evicting state below the watermark. That is safe only when eviction emits nothing
    (inner joins, complete-mode aggregates): the next run evicts instead. Append-mode window
    aggregates and outer joins must keep it.
    """
    spark = df.sparkSession
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key, "true")
    if skip_final_cleanup:
        spark.conf.set(key, "false")  # read once when the query starts
    try:
        q = start_sink(df, kind, path=path, checkpoint=checkpoint, trigger=AVAILABLE_NOW,
                       output_mode=output_mode, **kw)
    finally:
        spark.conf.set(key, before)
    run_all([q])
    # Build ``df`` in a ``stream_session`` so that this toggle never touches a shared session.


def run_all(queries: Sequence[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until every query ends; when one fails, stop the others and raise its error."""
    deadline = None if timeout is None else time.time() + timeout
    pending = list(queries)
    try:
        while pending:
            for q in list(pending):
                if not q.isActive:
                    pending.remove(q)
                    err = q.exception()
                    if err is not None:
                        raise err
            if pending:
                if deadline is not None and time.time() > deadline:
                    raise TimeoutError(f"{len(pending)} streaming queries still running")
                pending[0].awaitTermination(0.2)
    finally:
        for q in pending:
            if q.isActive:
                q.stop()
