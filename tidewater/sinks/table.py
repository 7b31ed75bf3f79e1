"""Six-mode saves into catalog tables bucketed by the merge keys.

A target written with ``bucketBy(n, keys)`` is read back as ``n`` partitions
already hash-partitioned on the keys, so the anti/left joins of the next merge
shuffle only the incoming side: the target - the large side at scale - is
read in place, with no exchange. Spark keeps the bucketed layout only when
``n`` is at least ``spark.sql.shuffle.partitions``; ``save_table`` therefore
defaults ``buckets`` to that value, and a merge session should keep it.

Each bucket is read by one task, and AQE can split skewed *shuffle*
partitions but not a bucketed scan, so this layout assumes keys that are
unique or nearly so - what the keyed save modes produce. For a table where one
key holds a large share of the rows, set
``spark.sql.sources.bucketing.enabled=false`` for the merge; the join then
shuffles the target and AQE splits the hot partition.

Like Parquet snapshots, each save writes a *new* table (at an explicit
location, e.g. under the shared checkpoint folder) and leaves the one it read
untouched; the caller switches readers to the returned name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators.merge import SaveMode, TableExistsError, merge_state, resolve_keys


def table_or_none(spark: SparkSession, name: str | None) -> DataFrame | None:
    if not name or not spark.catalog.tableExists(name):
        return None
    return spark.table(name)


def save_table(
    incoming: DataFrame,
    target_table: str | None,
    out_table: str,
    mode: SaveMode | str,
    keys: str | Sequence[str] | None = None,
    order_by: str | Column | Sequence[str | Column] | None = None,
    buckets: int | None = None,
    path: str | None = None,
    dedup: bool = True,
) -> str:
    """Write the merged state as ``out_table`` bucketed by ``keys``; returns its name.

    ``path`` makes the table external at that location (shared storage);
    without it the table goes to the session's warehouse directory.
    """
    mode = SaveMode.coerce(mode)
    spark = incoming.sparkSession
    if target_table and target_table == out_table:
        raise ValueError("out_table must differ from target_table")
    target = table_or_none(spark, target_table)
    if target is not None and mode is SaveMode.IGNORE_TABLE:
        return target_table  # type: ignore[return-value]
    if target is not None and mode is SaveMode.ERROR_IF_EXISTS:
        raise TableExistsError(f"table {target_table} already exists")
    state = merge_state(target, incoming, mode, keys=keys, order_by=order_by, dedup=dedup)
    key_cols = resolve_keys(state, keys)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = state.write.mode("errorifexists").format("parquet").bucketBy(n, *key_cols).sortBy(*key_cols)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(out_table)
    return out_table
