"""Writes into relational tables: plain append and the six save modes.

Keyed modes (upsert, ignore-record) never run per-row statements. The frame is
de-duplicated on its keys in Spark, written in parallel by Spark's JDBC writer
into a fresh staging table, and merged by **one** set-based statement in the
database, then the staging table is dropped::

    PostgreSQL  INSERT ... SELECT ... ON CONFLICT (keys) DO UPDATE SET c = EXCLUDED.c
    MySQL       INSERT ... SELECT ... ON DUPLICATE KEY UPDATE c = s.c  /  INSERT IGNORE
    others      MERGE INTO t USING staging s ON (...) WHEN MATCHED ... WHEN NOT MATCHED ...

So a failed or retried task can only touch the staging table, and the target
changes atomically with the one statement. Before anything is created or
dropped, a preflight checks that every column type is writable and that the
frame has no columns the target lacks.

Statements are run by a ``run_sql(statement)`` callable. The default opens a
JDBC connection from the driver through the Py4J gateway; pass your own (for
example a DB-API connection) where that is not available.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import SaveMode, TableExistsError, SchemaMismatchError, dedup_incoming, resolve_keys
from ..session import checkpoint_dir
from ..sources.endpoint import DEFAULT_BATCH_SIZE, Endpoint

RunSql = Callable[[str], None]
#: The staging table's own column in an exactly-once append.
ROW_ID = "tw_row_id"


class UnwritableTypeError(TypeError):
    pass


# ---------------------------------------------------------------- preflight

_ATOMIC_WRITABLE = (
    T.IntegerType,
    T.LongType,
    T.DoubleType,
    T.FloatType,
    T.ShortType,
    T.ByteType,
    T.BooleanType,
    T.StringType,
    T.CharType,
    T.VarcharType,
    T.BinaryType,
    T.TimestampType,
    T.TimestampNTZType,
    T.DateType,
    T.DecimalType,
)
_ARRAY_KINDS = ("postgresql",)


def check_writable(schema: T.StructType, kind: str = "generic") -> None:
    """Raise before any DDL if a column cannot be bound as a JDBC parameter."""
    bad = []
    for f in schema.fields:
        dt = f.dataType
        if isinstance(dt, _ATOMIC_WRITABLE):
            continue
        if isinstance(dt, T.ArrayType) and kind in _ARRAY_KINDS and isinstance(dt.elementType, _ATOMIC_WRITABLE):
            continue
        bad.append(f"{f.name} {dt.simpleString()}")
    if bad:
        raise UnwritableTypeError(f"Can't get JDBC type for columns: {', '.join(bad)} ({kind})")


# ---------------------------------------------------------------- statement text


def quote(name: str, kind: str) -> str:
    if kind == "mysql":
        return "`" + name.replace("`", "``") + "`"
    return '"' + name.replace('"', '""') + '"'


def merge_statement(
    kind: str,
    table: str,
    staging: str,
    columns: Sequence[str],
    keys: Sequence[str],
    mode: SaveMode | str,
    target_columns: Sequence[str] | None = None,
) -> str:
    """The one statement that applies ``staging`` to ``table`` under ``mode``.

    ``columns`` are the staging (frame) column names; ``target_columns`` the
    same columns as the target table spells them (quoted identifiers are
    case-sensitive in most databases), default the same names.

    Staging rows with a complete key are made distinct (a task retried after
    its commit can only duplicate whole rows); rows with a NULL key part are
    inserted as they are - they never conflict.
    """
    mode = SaveMode.coerce(mode)
    if not mode.keyed:
        raise ValueError(f"{mode.value} needs no merge statement")
    tcols_raw = list(target_columns) if target_columns is not None else list(columns)
    if len(tcols_raw) != len(columns):
        raise ValueError("target_columns must match columns one to one")
    to_target = dict(zip(columns, tcols_raw))
    q = [quote(c, kind) for c in columns]
    t = [quote(to_target[c], kind) for c in columns]
    qk = [quote(k, kind) for k in keys]
    tk = [quote(to_target[k], kind) for k in keys]
    cols = ", ".join(q)
    tcols = ", ".join(t)
    pairs = [(tc, sc) for tc, sc, c in zip(t, q, columns) if c not in keys]
    keyed = " AND ".join(f"{k} IS NOT NULL" for k in qk)
    unkeyed = " OR ".join(f"{k} IS NULL" for k in qk)
    source = (
        f"SELECT DISTINCT {cols} FROM {staging} WHERE {keyed} "
        f"UNION ALL SELECT {cols} FROM {staging} WHERE {unkeyed}"
    )
    if kind == "postgresql":
        head = f"INSERT INTO {table} ({tcols}) SELECT {cols} FROM ({source}) s"
        if mode is SaveMode.UPSERT and pairs:
            sets = ", ".join(f"{tc} = EXCLUDED.{tc}" for tc, _ in pairs)
            return f"{head} ON CONFLICT ({', '.join(tk)}) DO UPDATE SET {sets}"
        return f"{head} ON CONFLICT ({', '.join(tk)}) DO NOTHING"
    if kind == "mysql":
        if mode is SaveMode.IGNORE_RECORD:
            return f"INSERT IGNORE INTO {table} ({tcols}) SELECT {cols} FROM ({source}) s"
        head = f"INSERT INTO {table} ({tcols}) SELECT {cols} FROM ({source}) s"
        sets = ", ".join(f"{tc} = s.{sc}" for tc, sc in (pairs or [(tk[0], qk[0])]))
        return f"{head} ON DUPLICATE KEY UPDATE {sets}"
    on = " AND ".join(f"t.{a} = s.{b}" for a, b in zip(tk, qk))
    insert = f"WHEN NOT MATCHED THEN INSERT ({tcols}) VALUES ({', '.join('s.' + c for c in q)})"
    # Derby's MERGE takes only a table or view as its source.
    using = staging if kind == "derby" else f"({source})"
    stmt = f"MERGE INTO {table} t USING {using} s ON ({on}) "
    if mode is SaveMode.UPSERT and pairs:
        sets = ", ".join(f"{tc} = s.{sc}" for tc, sc in pairs)
        stmt += f"WHEN MATCHED THEN UPDATE SET {sets} "
    return stmt + insert


def insert_once_statement(
    kind: str, table: str, staging: str, columns: Sequence[str], row_id: str = ROW_ID, target_columns: Sequence[str] | None = None
) -> str:
    """Insert each staged row once, however often its ``row_id`` was staged. A row
    number and not DISTINCT, so large-object columns are allowed."""
    q = [quote(c, kind) for c in columns]
    t = ", ".join(quote(c, kind) for c in target_columns or columns)
    rid = quote(row_id, kind)
    numbered = f"SELECT {', '.join(q)}, ROW_NUMBER() OVER (PARTITION BY {rid} ORDER BY {rid}) AS tw_repeat FROM {staging}"
    return f"INSERT INTO {table} ({t}) SELECT {', '.join(q)} FROM ({numbered}) s WHERE s.tw_repeat = 1"


def unique_index_statement(kind: str, table: str, keys: Sequence[str]) -> str:
    """A unique (not primary) key: NULL keys stay legal, as in the merge."""
    base = table.split(".")[-1].strip('"`')
    name = f"{base}_uk_{uuid.uuid4().hex[:8]}"
    return f"CREATE UNIQUE INDEX {quote(name, kind)} ON {table} ({', '.join(quote(k, kind) for k in keys)})"


def rename_statement(kind: str, old: str, new: str) -> str:
    if kind == "postgresql":
        return f"ALTER TABLE {old} RENAME TO {new.split('.')[-1]}"
    return f"RENAME TABLE {old} TO {new.split('.')[-1] if kind in ('db2', 'derby') else new}"


# ---------------------------------------------------------------- execution


def jvm_run_sql(spark: SparkSession, endpoint: Endpoint) -> RunSql:
    """Run one statement from the driver over a JDBC connection (Py4J)."""

    def run(statement: str) -> None:
        jvm = spark.sparkContext._jvm  # type: ignore[attr-defined]
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        jvm.java.lang.Class.forName(endpoint.driver, True, loader)
        props = jvm.java.util.Properties()
        for k, v in endpoint.connection_properties().items():
            props.setProperty(k, v)
        conn = jvm.java.sql.DriverManager.getConnection(endpoint.resolved_url, props)
        try:
            stmt = conn.createStatement()
            try:
                stmt.executeUpdate(statement)
            finally:
                stmt.close()
        finally:
            conn.close()

    return run


def target_schema(spark: SparkSession, endpoint: Endpoint, table: str) -> T.StructType | None:
    """The table's columns, or ``None`` when it does not exist."""
    try:
        return spark.read.format("jdbc").options(**endpoint.options()).option("dbtable", table).load().schema
    except Exception as exc:  # noqa: BLE001 - drivers report a missing table in many ways
        msg = str(exc).lower()
        if any(s in msg for s in ("does not exist", "doesn't exist", "not found", "undefined", "unknown table", "sql0204")):
            return None
        raise


def write_table(
    df: DataFrame,
    endpoint: Endpoint,
    table: str,
    spark_mode: str,
    num_partitions: int | None = None,
    batchsize: int = DEFAULT_BATCH_SIZE,
    create_column_types: str | None = None,
    isolation_level: str | None = None,
) -> None:
    """Spark's JDBC writer; ``num_partitions`` caps concurrent connections.

    The cap is a ``repartition`` rather than the writer's own ``coalesce``, so
    the work feeding the write (a dedup, a merge) keeps its full parallelism.
    Each task writes its partition in one transaction (``isolation_level``,
    Spark's default ``READ_UNCOMMITTED``; ``NONE`` for autocommit batches).
    """
    from ..plans.layout import cap_partitions

    df = cap_partitions(df, num_partitions)
    writer = df.write.format("jdbc").options(**endpoint.options()).option("dbtable", table)
    writer = writer.option("batchsize", str(batchsize))
    if isolation_level:
        writer = writer.option("isolationLevel", isolation_level)
    if create_column_types:
        writer = writer.option("createTableColumnTypes", create_column_types)
    writer.mode(spark_mode).save()


def append_jdbc(
    df: DataFrame,
    endpoint: Endpoint,
    table: str,
    num_partitions: int | None = None,
    batchsize: int = DEFAULT_BATCH_SIZE,
    isolation_level: str | None = None,
    once: bool = False,
    run_sql: RunSql | None = None,
    staging_table: str | None = None,
) -> None:
    """Plain append; creates the table when missing. A task that is retried after its
    commit adds its rows twice; ``once=True`` goes through a staging table instead
    (see ``save_jdbc``)."""
    if once:
        save_jdbc(
            df, endpoint, table, SaveMode.APPEND, run_sql=run_sql, num_partitions=num_partitions, batchsize=batchsize,
            staging_table=staging_table, isolation_level=isolation_level, once=True,
        )
        return
    check_writable(df.schema, endpoint.kind)
    write_table(df, endpoint, table, "append", num_partitions, batchsize, isolation_level=isolation_level)


def save_jdbc(
    df: DataFrame,
    endpoint: Endpoint,
    table: str,
    mode: SaveMode | str,
    keys: str | Sequence[str] | None = None,
    order_by: str | Column | Sequence[str | Column] | None = None,
    run_sql: RunSql | None = None,
    num_partitions: int | None = None,
    batchsize: int = DEFAULT_BATCH_SIZE,
    staging_table: str | None = None,
    dedup: bool = True,
    isolation_level: str | None = None,
    create_column_types: str | None = None,
    once: bool = False,
) -> str:
    """Save ``df`` into ``table`` under one of the six modes; returns what was done.

    ``dedup=False`` is for frames whose keys are already unique; duplicate
    keys in one merge statement are an error in most databases. ``isolation_level``
    and ``create_column_types`` go to every table that Spark writes.

    ``once=True`` makes append exactly-once: rows get an id that is fixed in the shared
    checkpoint folder before the first write, so a task retried after its commit stages
    the same ids again, and one statement inserts each id once. Readers see all new
    rows or none. Equal rows have ids of their own and all stay.

    Steps run in an order that keeps the old table until the new rows are complete,
    and a step that fails undoes those before it, last one first: staging tables are
    dropped, a table created by this save is dropped, a table renamed away is renamed
    back. Then the failure is raised.
    """
    mode = SaveMode.coerce(mode)
    spark = df.sparkSession
    kind = endpoint.kind
    check_writable(df.schema, kind)
    existing = target_schema(spark, endpoint, table)
    if existing is not None:
        known = {f.name.lower() for f in existing.fields}
        unknown = [c for c in df.columns if c.lower() not in known]
        if unknown and mode not in (SaveMode.OVERWRITE, SaveMode.IGNORE_TABLE, SaveMode.ERROR_IF_EXISTS):
            raise SchemaMismatchError(f"columns {unknown} do not exist in {table}")

    def write(rows: DataFrame, name: str, spark_mode: str, partitions: int | None = num_partitions) -> None:
        write_table(
            rows, endpoint, name, spark_mode, partitions, batchsize,
            create_column_types=create_column_types, isolation_level=isolation_level,
        )

    if mode is SaveMode.ERROR_IF_EXISTS:
        if existing is not None:
            raise TableExistsError(f"table {table} already exists")
        write(df, table, "errorifexists")
        return "created"
    if mode is SaveMode.IGNORE_TABLE:
        if existing is not None:
            return "ignored"
        write(df, table, "errorifexists")
        return "created"
    if mode is SaveMode.APPEND and not once:
        write(df, table, "append")
        return "appended"
    run = run_sql or jvm_run_sql(spark, endpoint)
    steps = Steps()
    target_cols = list(df.columns)
    if existing is not None and mode is not SaveMode.OVERWRITE:
        spelled = {f.name.lower(): f.name for f in existing.fields}
        target_cols = [spelled[c.lower()] for c in df.columns]
    if mode is SaveMode.APPEND:
        if any(c.lower() == ROW_ID for c in df.columns):
            raise SchemaMismatchError(f"{ROW_ID} is the staging table's own column")
        checkpoint_dir(spark)
        rows = df.withColumn(ROW_ID, F.monotonically_increasing_id()).checkpoint()
        staging = staging_table or f"{table}__stg_{uuid.uuid4().hex[:12]}"
        steps.do(lambda: write(rows, staging, "errorifexists"), lambda: run(f"DROP TABLE {staging}"))
        if existing is None:
            steps.do(lambda: write(df.limit(0), table, "errorifexists", None), lambda: run(f"DROP TABLE {table}"))
        steps.do(lambda: run(insert_once_statement(kind, table, staging, df.columns, target_columns=target_cols)))
        run(f"DROP TABLE {staging}")
        return "appended"
    if mode is SaveMode.OVERWRITE:
        if existing is None:
            write(df, table, "errorifexists")
            return "created"
        # The new table is complete before the old one is touched, and the old one
        # is dropped only when the new one has its name.
        tag = uuid.uuid4().hex[:12]
        fresh, old = staging_table or f"{table}__new_{tag}", f"{table}__old_{tag}"
        steps.do(lambda: write(df, fresh, "errorifexists"), lambda: run(f"DROP TABLE {fresh}"))
        steps.do(lambda: run(rename_statement(kind, table, old)), lambda: run(rename_statement(kind, old, table)))
        steps.do(lambda: run(rename_statement(kind, fresh, table)))
        run(f"DROP TABLE {old}")
        return "overwritten"

    key_cols = resolve_keys(df, keys)
    keep = "last" if mode is SaveMode.UPSERT else "first"
    incoming = dedup_incoming(df, key_cols, order_by, keep) if dedup else df
    staging = staging_table or f"{table}__stg_{uuid.uuid4().hex[:12]}"
    steps.do(lambda: write(incoming, staging, "errorifexists"), lambda: run(f"DROP TABLE {staging}"))
    if existing is None:
        # the rows are staged by now, so the empty target stands for moments only
        steps.do(lambda: write(df.limit(0), table, "errorifexists", None), lambda: run(f"DROP TABLE {table}"))
        steps.do(lambda: run(unique_index_statement(kind, table, key_cols)))
    steps.do(lambda: run(merge_statement(kind, table, staging, df.columns, key_cols, mode, target_columns=target_cols)))
    run(f"DROP TABLE {staging}")
    return "merged"


class Steps:
    """Steps of which each may say how it is undone."""

    def __init__(self):
        self.undo: list[Callable[[], None]] = []

    def do(self, step: Callable[[], None], undo: Callable[[], None] | None = None) -> None:
        """Run ``step``. If it fails, undo it (it may be half done) and all steps
        before it, last one first, and raise its failure. An undo that fails too
        is noted on that failure and does not keep the others from running."""
        if undo is not None:
            self.undo.append(undo)
        try:
            step()
        except BaseException as failure:
            for back in reversed(self.undo):
                try:
                    back()
                except Exception as second:  # noqa: BLE001 - the first failure is the one to raise
                    failure.add_note(f"undo failed: {second}")
            raise


# ---------------------------------------------------------------- named targets


def append_to_postgres(df: DataFrame, endpoint: Endpoint, table: str, **kw) -> None:
    append_jdbc(df, endpoint.require("postgresql"), table, **kw)


def append_to_mysql(df: DataFrame, endpoint: Endpoint, table: str, **kw) -> None:
    append_jdbc(df, endpoint.require("mysql"), table, **kw)


def append_to_db2(df: DataFrame, endpoint: Endpoint, table: str, **kw) -> None:
    append_jdbc(df, endpoint.require("db2"), table, **kw)


@dataclass(frozen=True)
class JdbcSave:
    """A save request (endpoint, table, mode, keys) applied to any frame:
    ``JdbcSave(ep, "my_user", "upsert", keys=("id",)).save(df)``."""

    endpoint: Endpoint
    table: str
    mode: SaveMode | str
    keys: tuple[str, ...] | None = None
    order_by: tuple[str, ...] | None = None
    num_partitions: int | None = None
    batchsize: int = DEFAULT_BATCH_SIZE

    def save(self, df: DataFrame, run_sql: RunSql | None = None) -> str:
        return save_jdbc(
            df,
            self.endpoint,
            self.table,
            self.mode,
            keys=list(self.keys) if self.keys else None,
            order_by=list(self.order_by) if self.order_by else None,
            run_sql=run_sql,
            num_partitions=self.num_partitions,
            batchsize=self.batchsize,
        )


def save_to_postgres(df: DataFrame, endpoint: Endpoint, table: str, mode: SaveMode | str, **kw) -> str:
    return save_jdbc(df, endpoint.require("postgresql"), table, mode, **kw)


def save_to_mysql(df: DataFrame, endpoint: Endpoint, table: str, mode: SaveMode | str, **kw) -> str:
    return save_jdbc(df, endpoint.require("mysql"), table, mode, **kw)


def save_to_db2(df: DataFrame, endpoint: Endpoint, table: str, mode: SaveMode | str, **kw) -> str:
    return save_jdbc(df, endpoint.require("db2"), table, mode, **kw)
