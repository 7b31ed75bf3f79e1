"""Composed table-sync jobs: read a source, keep the changed window, merge
into a target under a save mode.

``sync`` is storage-agnostic: it takes DataFrames and returns the new target
state; ``sync_to_path`` additionally writes that state as a new Parquet
snapshot (never onto the path being read) and ``sync_to_jdbc`` hands the
changed rows to the JDBC six-mode writer.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from ..operators.filters import filter_daily, filter_range
from ..operators.merge import SaveMode, merge_state

#: Options of ``sync_to_jdbc`` that belong to the writer.
WRITER_OPTIONS = ("num_partitions", "batchsize", "staging_table", "run_sql", "isolation_level", "create_column_types", "once")


def changed_rows(
    source: DataFrame,
    day: str | _dt.date | None = None,
    start: str | None = None,
    end: str | None = None,
    column: str = "rec_upd_ts",
    materialize: str | None = None,
    partition_column: str | None = None,
) -> DataFrame:
    """The source window to sync: one day, one range, or everything.

    ``partition_column`` names a day partition column of the source so only
    the touched day directories are listed and read.

    The merge plan reads its incoming side more than once (keys for the join,
    rows for the insert). For a cheap Parquet source that is a pruned re-scan;
    for a JDBC source or an expensive upstream plan pass
    ``materialize="checkpoint"`` (written once to the shared checkpoint folder,
    survives executor loss) or ``"persist"`` (memory and disk, recomputed from
    lineage if an executor is lost).
    """
    if day is not None and (start is not None or end is not None):
        raise ValueError("give either day or start/end, not both")
    if start is not None or end is not None:
        if start is None or end is None:
            raise ValueError("a range needs both start and end")
        window = filter_range(source, start, end, column=column, partition_column=partition_column)
    else:
        window = filter_daily(source, day, column=column, partition_column=partition_column)
    return _materialize(window, materialize)


def _materialize(df: DataFrame, how: str | None) -> DataFrame:
    if how is None:
        return df
    if how == "checkpoint":
        from ..session import checkpoint_dir

        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "persist":
        from pyspark import StorageLevel

        return df.persist(StorageLevel.MEMORY_AND_DISK)
    raise ValueError("materialize must be None, 'checkpoint' or 'persist'")


def sync(
    source: DataFrame,
    target: DataFrame | None,
    mode: SaveMode | str = SaveMode.UPSERT,
    keys: str | Sequence[str] | None = None,
    order_by: str | Column | Sequence[str | Column] | None = None,
    day: str | _dt.date | None = None,
    start: str | None = None,
    end: str | None = None,
    column: str = "rec_upd_ts",
    materialize: str | None = None,
    partition_column: str | None = None,
    dedup: bool = True,
) -> DataFrame:
    """New target state after syncing the changed window of ``source``.

    ``dedup=False`` skips duplicate-key removal (one shuffle and sort of the
    change set) when its keys are known to be unique, e.g. a window of a
    table keyed the same way.
    """
    incoming = changed_rows(
        source, day=day, start=start, end=end, column=column, materialize=materialize,
        partition_column=partition_column,
    )
    return merge_state(target, incoming, mode, keys=keys, order_by=order_by, dedup=dedup)


def sync_to_path(
    source: DataFrame,
    target_path: str | None,
    out_path: str,
    mode: SaveMode | str = SaveMode.UPSERT,
    keys: str | Sequence[str] | None = None,
    order_by: str | Column | Sequence[str | Column] | None = None,
    partition_by: Sequence[str] | None = None,
    dedup: bool = True,
    **window,
) -> str:
    """Sync into a Parquet table snapshot; returns the path written."""
    from ..sinks.snapshot import save_snapshot

    incoming = changed_rows(source, **window)
    return save_snapshot(
        incoming, target_path, out_path, mode, keys=keys, order_by=order_by, partition_by=partition_by, dedup=dedup
    )


def sync_to_jdbc(
    source: DataFrame,
    endpoint,
    table: str,
    mode: SaveMode | str = SaveMode.UPSERT,
    keys: str | Sequence[str] | None = None,
    order_by: str | Column | Sequence[str | Column] | None = None,
    dedup: bool = True,
    **options,
):
    """Sync into a relational table through the staged six-mode writer. The change
    set is written to the checkpoint folder first, as a live source may answer
    differently each time it is read; ``materialize=None`` leaves that out.

    ``options`` are those of ``changed_rows`` (the window) and of ``save_jdbc`` (the
    writer: ``num_partitions``, ``batchsize``, ``staging_table``, ``run_sql``,
    ``isolation_level``, ``create_column_types``, ``once``); any other name is an error."""
    from ..sinks.jdbc import save_jdbc

    writer = {k: options.pop(k) for k in WRITER_OPTIONS if k in options}
    incoming = changed_rows(source, **{"materialize": "checkpoint", **options})
    return save_jdbc(incoming, endpoint, table, mode, keys=keys, order_by=order_by, dedup=dedup, **writer)
