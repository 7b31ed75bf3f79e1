"""Continuous sync: apply a save mode to every micro-batch of a stream.

The merge operators take plain batch frames, so a Structured Streaming query
drives them through ``foreachBatch``. Two writers are provided:

* ``snapshot_batch_writer`` - each batch produces a new Parquet snapshot
  ``<base>/v=<batch id>`` from the previous one; a replayed batch (after a
  driver restart the engine re-runs the last uncommitted batch id) finds its
  finished snapshot and does nothing, so the sink is idempotent.
* ``jdbc_batch_writer`` - each batch goes through the staged six-mode JDBC
  writer; with keyed modes a replay re-applies the same rows, which is
  harmless for upsert and ignore-record.

The stream's own checkpoint (``checkpointLocation``) must be in shared
storage; the helpers never pick a local folder for it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import SaveMode
from ..session import checkpoint_dir
from ..sinks.snapshot import save_snapshot

BatchFn = Callable[[DataFrame, int], None]
VERSION_PREFIX = "v="


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # type: ignore[attr-defined]
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p  # type: ignore[attr-defined]


def committed_versions(spark: SparkSession, base: str) -> list[int]:
    """Batch ids whose snapshot under ``base`` finished (has ``_SUCCESS``)."""
    fs, root = _fs(spark, base)
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(VERSION_PREFIX):
            if fs.exists(st.getPath().suffix("/_SUCCESS")):
                out.append(int(name[len(VERSION_PREFIX):]))
    return sorted(out)


def version_path(base: str, batch_id: int) -> str:
    return f"{base.rstrip('/')}/{VERSION_PREFIX}{batch_id:012d}"


def latest_snapshot(spark: SparkSession, base: str) -> str | None:
    versions = committed_versions(spark, base)
    return version_path(base, versions[-1]) if versions else None


def _once(batch: DataFrame) -> DataFrame:
    """The batch, evaluated one time: the merge reads its change set more than once,
    and a source that answers differently would lose or repeat rows."""
    checkpoint_dir(batch.sparkSession)
    return batch.checkpoint()


def snapshot_batch_writer(
    base: str,
    mode: SaveMode | str = SaveMode.UPSERT,
    keys: str | Sequence[str] | None = None,
    order_by: str | Column | Sequence[str | Column] | None = None,
    initial: str | None = None,
    partition_by: Sequence[str] | None = None,
) -> BatchFn:
    """``foreachBatch`` function merging each batch into the latest snapshot.

    ``initial`` is the table to start from when ``base`` has no snapshot yet.
    With ``partition_by`` columns that are part of the key, each batch merges
    only the partitions it touches (see ``save_snapshot``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        versions = committed_versions(spark, base)
        if batch_id in versions:
            return  # replay of a finished batch
        previous = [v for v in versions if v < batch_id]
        current = version_path(base, previous[-1]) if previous else initial
        out = version_path(base, batch_id)
        fs, p = _fs(spark, out)
        if fs.exists(p):
            fs.delete(p, True)  # an unfinished attempt of this same batch
        # ignore_table on an existing table writes nothing; the next batch
        # then starts from the same committed version.
        save_snapshot(_once(batch), current, out, mode, keys=keys, order_by=order_by, partition_by=partition_by)

    return write


def jdbc_batch_writer(
    endpoint,
    table: str,
    mode: SaveMode | str = SaveMode.UPSERT,
    keys: str | Sequence[str] | None = None,
    order_by: str | Column | Sequence[str | Column] | None = None,
    **kw,
) -> BatchFn:
    from ..sinks.jdbc import save_jdbc

    def write(batch: DataFrame, batch_id: int) -> None:
        save_jdbc(_once(batch), endpoint, table, mode, keys=keys, order_by=order_by, **kw)

    return write


def start_sync(
    stream: DataFrame,
    writer: BatchFn,
    checkpoint_location: str,
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start ``stream`` with ``writer`` as its ``foreachBatch`` sink."""
    w = stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint_location)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def run_available(
    stream: DataFrame,
    writer: BatchFn,
    checkpoint_location: str,
    timeout_s: float | None = None,
) -> None:
    """Process everything available now (``availableNow`` trigger) and stop;
    rerun with the same checkpoint to pick up later arrivals."""
    q = start_sync(stream, writer, checkpoint_location, trigger={"availableNow": True})
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("streaming sync did not finish in time")
    if q.exception() is not None:
        raise q.exception()
