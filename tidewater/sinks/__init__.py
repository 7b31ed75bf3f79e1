"""Sinks: Parquet snapshots, bucketed catalog tables, relational tables."""

from .jdbc import (
    JdbcSave,
    append_jdbc,
    append_to_db2,
    append_to_mysql,
    append_to_postgres,
    check_writable,
    merge_statement,
    save_jdbc,
    save_to_db2,
    save_to_mysql,
    save_to_postgres,
)
from .snapshot import merge_partition_local, read_snapshot, save_partitions_in_place, save_snapshot
from .table import save_table, table_or_none
