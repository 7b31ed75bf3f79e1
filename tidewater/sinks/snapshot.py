"""Six-mode saves into Parquet table snapshots.

A file table cannot be updated in place, and Spark must never write onto the
path it is reading (it would empty the directory first). A save therefore
reads the current snapshot, computes the new state with ``merge_state`` and
writes it as a *new* snapshot directory, returning its path. The caller (or a
catalog) switches readers to the new path; the old one stays readable until
it is removed. The write goes through Spark's commit protocol, so a lost
executor only retries tasks and a failed job leaves no snapshot behind.

``save_partitions_in_place`` is the opt-in exception for tables partitioned
by key columns: it rewrites just the touched partitions of the table itself
(dynamic partition overwrite), trading cross-partition atomicity for writing
only as much as changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession

from ..operators.merge import (
    SaveMode,
    TableExistsError,
    align_to,
    check_incoming_columns,
    merge_state,
    resolve_column,
    resolve_keys,
)
from ..operators.staged import merge_once, merge_staged, staged_changes


def read_snapshot(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The table at ``path``, or ``None`` when there is no table there."""
    if not path:
        return None
    try:
        df = spark.read.parquet(path)
        df.schema  # noqa: B018 - resolve now so a missing path surfaces here
        return df
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise


def merge_partition_local(
    target: DataFrame,
    incoming: DataFrame,
    mode: SaveMode | str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    order_by: str | Column | Sequence[str | Column] | None = None,
    dedup: bool = True,
) -> DataFrame:
    """``merge_state`` restricted to the partitions the change set touches.

    Valid when the partition columns are part of the key, so a key lives in
    exactly one partition and can never move. Untouched partitions pass
    through an anti-join on the (small) set of touched partition values - no
    shuffle of their rows - and only the touched ones enter the merge joins;
    on a partitioned Parquet table Spark's dynamic partition pruning skips the
    untouched directories on that side. No broadcast is forced: the touched
    set is at most the table's partition count and AQE broadcasts it by its
    measured size.
    """
    keys = resolve_keys(target, keys)
    pcols = [resolve_column(target, p) for p in partition_by]
    if not set(pcols) <= set(keys):
        raise ValueError(f"partition columns {pcols} must be part of the key {keys}")
    touched = incoming.select(*[resolve_column(incoming, p) for p in pcols]).toDF(*pcols).distinct()
    inside = target.join(touched, pcols, "left_semi").select(*target.columns)
    outside = target.join(touched, pcols, "left_anti").select(*target.columns)
    merged = merge_state(inside, incoming, mode, keys=keys, order_by=order_by, dedup=dedup)
    # The merged rows leave the key-hash shuffle with every touched partition
    # in every task; regroup them by partition (AQE sizes the result, splitting
    # a large partition and packing small ones) so the partitioned write makes
    # a few files per touched partition instead of one per task and partition.
    return outside.unionByName(merged.hint("rebalance", *pcols))


def _norm(p: str) -> str:
    return p.rstrip("/").replace("file://", "").replace("file:", "")


def save_snapshot(
    incoming: DataFrame,
    target_path: str | None,
    out_path: str,
    mode: SaveMode | str,
    keys: str | Sequence[str] | None = None,
    order_by: str | Column | Sequence[str | Column] | None = None,
    partition_by: Sequence[str] | None = None,
    dedup: bool = True,
) -> str:
    """Write the state after saving ``incoming`` into the table at ``target_path``.

    Returns the path now holding the table: ``out_path``, or ``target_path``
    when the mode leaves an existing table untouched (``ignore_table``).
    ``append`` with ``out_path == target_path`` adds the new rows to the table
    itself instead of copying it.
    With ``partition_by`` columns that are part of the key, keyed modes merge
    only the touched partitions (``merge_partition_local``). Keyed modes evaluate
    ``incoming`` once (``operators.staged``).
    """
    mode = SaveMode.coerce(mode)
    spark = incoming.sparkSession
    if target_path and _norm(target_path) == _norm(out_path):
        if mode is not SaveMode.APPEND:
            raise ValueError("out_path must differ from target_path: Spark cannot overwrite the table it reads")
        # Appending deletes nothing, so it may go into the table itself: only
        # the new rows are written (no copy of the existing table).
        current = read_snapshot(spark, target_path)
        rows_out = incoming
        if current is not None:
            check_incoming_columns(current, incoming)
            rows_out = align_to(current.schema, incoming)
        writer = rows_out.write.mode("append")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(target_path)
        return target_path
    target = read_snapshot(spark, target_path)
    if target is not None and mode is SaveMode.IGNORE_TABLE:
        return target_path  # type: ignore[return-value]
    if target is not None and mode is SaveMode.ERROR_IF_EXISTS:
        raise TableExistsError(f"table at {target_path} already exists")

    def write(state: DataFrame) -> None:
        writer = state.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(out_path)

    local = (
        target is not None
        and mode.keyed
        and partition_by
        and {p.lower() for p in partition_by} <= {k.lower() for k in resolve_keys(target, keys)}
    )
    if local:
        named = resolve_keys(target, keys)
        own = [resolve_column(incoming, k) for k in named]
        keep = ("last" if mode is SaveMode.UPSERT else "first") if dedup else None
        with staged_changes(incoming, own, order_by, keep) as changes:
            write(merge_partition_local(target, changes, mode, named, partition_by, dedup=False))
    elif mode.keyed:
        merge_once(target, incoming, mode, write, keys=keys, order_by=order_by, dedup=dedup)
    else:
        write(merge_state(target, incoming, mode, keys=keys, order_by=order_by, dedup=dedup))
    return out_path


def save_partitions_in_place(
    incoming: DataFrame,
    table_path: str,
    mode: SaveMode | str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    order_by: str | Column | Sequence[str | Column] | None = None,
    dedup: bool = True,
) -> list[str]:
    """Rewrite only the partitions ``incoming`` touches, in the table itself.

    For a table partitioned by columns that are part of the key. The touched
    partitions are merged and written back with dynamic partition overwrite,
    so the work and the bytes written follow the change set, not the table -
    the difference between rewriting one day and rewriting 100 TB.

    Trade-off (hence opt-in; ``save_snapshot`` is the atomic path): files are
    written to a staging folder and each touched partition directory is
    swapped at job commit. A failed or lost task changes nothing, but readers
    during the commit may see some partitions new and others old, and a driver
    failure in the middle of the commit can leave a partition missing.
    Returns the partition columns written.
    """
    mode = SaveMode.coerce(mode)
    if mode not in (SaveMode.UPSERT, SaveMode.IGNORE_RECORD, SaveMode.APPEND):
        raise ValueError("in-place partition writes support upsert, ignore_record and append")
    spark = incoming.sparkSession
    pcols = list(partition_by)
    target = read_snapshot(spark, table_path)
    if mode is SaveMode.APPEND:
        if target is not None:
            check_incoming_columns(target, incoming)
            incoming = align_to(target.schema, incoming)
            pcols = [resolve_column(target, p) for p in pcols]
        incoming.write.mode("append").partitionBy(*pcols).parquet(table_path)
        return pcols
    if target is None:
        merge_state(None, incoming, mode, keys=keys, order_by=order_by, dedup=dedup).write.mode(
            "errorifexists"
        ).partitionBy(*pcols).parquet(table_path)
        return pcols
    keys = resolve_keys(target, keys)
    pcols = [resolve_column(target, p) for p in pcols]
    if not set(pcols) <= set(keys):
        raise ValueError(f"partition columns {pcols} must be part of the key {keys}")
    own = [resolve_column(incoming, k) for k in keys]
    keep = ("last" if mode is SaveMode.UPSERT else "first") if dedup else None
    with staged_changes(incoming, own, order_by, keep) as changes:
        touched = changes.select(*[resolve_column(changes, p) for p in pcols]).toDF(*[f"_p_{p}" for p in pcols]).distinct()
        # Null-safe: a touched NULL partition must bring its existing rows along,
        # or the overwrite would drop them.
        cond = [target[p].eqNullSafe(touched[f"_p_{p}"]) for p in pcols]
        inside = target.join(touched, cond, "left_semi").select(*target.columns)
        merged = merge_staged(inside, changes, mode, keys=keys)
        (
            merged.hint("rebalance", *pcols)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*pcols)
            .parquet(table_path)
        )
    return pcols
