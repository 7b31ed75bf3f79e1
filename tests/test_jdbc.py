import datetime as dt
import decimal
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.merge import SaveMode, SchemaMismatchError, TableExistsError
from tidewater.sinks import jdbc as J
from tidewater.sources.endpoint import Endpoint, EndpointError

TYPES_DDL = (
    "i int, l long, d double, f float, s short, b byte, flag boolean, str string, bin binary, "
    "ts timestamp, day date, dec decimal(10,2), arr array<int>"
)


def test_types_row_writable(spark):
    row = (1, 2, 3.0, 4.0, 5, 6, True, "x", b"\x00", dt.datetime(2020, 1, 1), dt.date(2020, 1, 1),
           decimal.Decimal("1.25"), [1, 2])
    df = spark.createDataFrame([row, tuple([None] * len(row))], TYPES_DDL)
    J.check_writable(df.schema, "postgresql")
    with pytest.raises(J.UnwritableTypeError):
        J.check_writable(df.schema, "mysql")
    J.check_writable(df.drop("arr").schema, "mysql")


@pytest.mark.parametrize("ddl", ["m map<string,int>", "st struct<a:int>", "v interval day"])
def test_unwritable_types(ddl):
    with pytest.raises(J.UnwritableTypeError, match="Can't get JDBC type"):
        J.check_writable(T.StructType.fromDDL(ddl))


def test_endpoint_templating_and_kind():
    e = Endpoint("jdbc:postgresql://$host/$db?currentSchema=$schema", "org.postgresql.Driver",
                 user="u", password="p", db="shop", host="h:5432")
    assert e.resolved_url == "jdbc:postgresql://h:5432/shop?currentSchema=$schema"
    assert e.kind == "postgresql"
    assert Endpoint(e.url, e.driver, db="x", host="h", schema="s").resolved_url.endswith("currentSchema=s")
    assert e.options()["user"] == "u" and "password" in e.options()
    assert Endpoint.mysql("h", "d").kind == "mysql"
    assert Endpoint.db2("h", "d").require("db2").kind == "db2"


def test_endpoint_driver_mismatch():
    bad = Endpoint("jdbc:db2://h/d", "com.mysql.jdbc.Driver")
    with pytest.raises(EndpointError):
        bad.require("db2")
    with pytest.raises(EndpointError):
        Endpoint.mysql("h", "d").require("postgresql")


COLS = ["id", "account", "passwd"]


def test_postgres_upsert_text():
    sql = J.merge_statement("postgresql", "my_user", "stg", COLS, ["id"], SaveMode.UPSERT)
    assert sql.startswith('INSERT INTO my_user ("id", "account", "passwd") SELECT')
    assert 'ON CONFLICT ("id") DO UPDATE SET "account" = EXCLUDED."account", "passwd" = EXCLUDED."passwd"' in sql
    assert 'SELECT DISTINCT "id", "account", "passwd" FROM stg WHERE "id" IS NOT NULL' in sql
    assert 'UNION ALL SELECT "id", "account", "passwd" FROM stg WHERE "id" IS NULL' in sql


def test_postgres_ignore_text():
    sql = J.merge_statement("postgresql", "my_user", "stg", COLS, ["id"], "ignore_record")
    assert sql.endswith('ON CONFLICT ("id") DO NOTHING')
    assert "INSERT IGNORE" not in sql


def test_mysql_texts():
    up = J.merge_statement("mysql", "my_user", "stg", COLS, ["id"], SaveMode.UPSERT)
    assert up.startswith("INSERT INTO my_user (`id`, `account`, `passwd`) SELECT")
    assert up.endswith("ON DUPLICATE KEY UPDATE `account` = s.`account`, `passwd` = s.`passwd`")
    ig = J.merge_statement("mysql", "my_user", "stg", COLS, ["id"], SaveMode.IGNORE_RECORD)
    assert ig.startswith("INSERT IGNORE INTO my_user")


def test_merge_text_composite_and_mixed_case():
    sql = J.merge_statement("db2", "T", "S", ["K1", "k2", "v"], ["K1", "k2"], SaveMode.UPSERT)
    assert 'ON (t."K1" = s."K1" AND t."k2" = s."k2")' in sql
    assert 'WHEN MATCHED THEN UPDATE SET "v" = s."v"' in sql
    assert 'WHEN NOT MATCHED THEN INSERT ("K1", "k2", "v") VALUES (s."K1", s."k2", s."v")' in sql
    ig = J.merge_statement("derby", "T", "S", ["K1", "v"], ["K1"], SaveMode.IGNORE_RECORD)
    assert "WHEN MATCHED" not in ig


def test_key_only_frame():
    assert J.merge_statement("postgresql", "t", "s", ["id"], ["id"], "upsert").endswith("DO NOTHING")


class Recorder:
    def __init__(self, existing):
        self.existing = existing
        self.writes = []
        self.sql = []

    def install(self, monkeypatch):
        monkeypatch.setattr(J, "target_schema", lambda spark, ep, table: self.existing)
        monkeypatch.setattr(
            J, "write_table",
            lambda df, ep, table, mode, *a, **k: self.writes.append((table, mode, df.count())),
        )
        return self.sql.append


@pytest.fixture()
def my_user(spark):
    return spark.createDataFrame([(1, "north", "spare"), (2, "south", "first"), (2, "south", "newer")],
                                 "id int, account string, passwd string")


PG = Endpoint.postgres("localhost:5432", "db", "u", "p")


def test_save_upsert_existing_table(monkeypatch, my_user):
    rec = Recorder(my_user.schema)
    run = rec.install(monkeypatch)
    assert J.save_jdbc(my_user, PG, "my_user", SaveMode.UPSERT, run_sql=run) == "merged"
    (stg, mode, n), = rec.writes
    assert stg.startswith("my_user__stg_") and mode == "errorifexists" and n == 2
    assert rec.sql[0].startswith("INSERT INTO my_user") and rec.sql[-1] == f"DROP TABLE {stg}"


def test_save_upsert_missing_table_creates_unique_key(monkeypatch, my_user):
    rec = Recorder(None)
    run = rec.install(monkeypatch)
    J.save_jdbc(my_user, PG, "my_user", "upsert", keys=["id"], run_sql=run)
    assert rec.writes[0][0].startswith("my_user__stg_") and rec.writes[1] == ("my_user", "errorifexists", 0)
    assert rec.sql[0].startswith("CREATE UNIQUE INDEX") and '("id")' in rec.sql[0]


def test_staging_dropped_when_merge_fails(monkeypatch, my_user):
    rec = Recorder(my_user.schema)
    rec.install(monkeypatch)

    def run(sql):
        rec.sql.append(sql)
        if sql.startswith("INSERT"):
            raise RuntimeError("db said no")

    with pytest.raises(RuntimeError):
        J.save_jdbc(my_user, PG, "my_user", SaveMode.UPSERT, run_sql=run)
    assert rec.sql[-1].startswith("DROP TABLE my_user__stg_")


def test_table_modes(monkeypatch, my_user):
    rec = Recorder(my_user.schema)
    run = rec.install(monkeypatch)
    with pytest.raises(TableExistsError):
        J.save_jdbc(my_user, PG, "my_user", SaveMode.ERROR_IF_EXISTS, run_sql=run)
    assert J.save_jdbc(my_user, PG, "my_user", SaveMode.IGNORE_TABLE, run_sql=run) == "ignored"
    assert J.save_jdbc(my_user, PG, "my_user", SaveMode.APPEND, run_sql=run) == "appended"
    assert J.save_jdbc(my_user, PG, "my_user", SaveMode.OVERWRITE, run_sql=run) == "overwritten"
    new_table = rec.writes[-1][0]
    old = rec.sql[0].split()[-1]
    assert old.startswith("my_user__old_") and rec.sql == [
        f"ALTER TABLE my_user RENAME TO {old}", f"ALTER TABLE {new_table} RENAME TO my_user", f"DROP TABLE {old}"
    ]
    assert not rec.writes[0:1] or rec.writes[0][1] == "append"


def test_preflight_before_any_ddl(monkeypatch, spark):
    rec = Recorder(None)
    run = rec.install(monkeypatch)
    df = spark.createDataFrame([(1, {"a": 1})], "id int, m map<string,int>")
    with pytest.raises(J.UnwritableTypeError):
        J.save_jdbc(df, PG, "t", SaveMode.OVERWRITE, run_sql=run)
    assert rec.writes == [] and rec.sql == []


def test_unknown_column_refused(monkeypatch, spark, my_user):
    rec = Recorder(my_user.select("id", "account").schema)
    run = rec.install(monkeypatch)
    with pytest.raises(SchemaMismatchError):
        J.save_jdbc(my_user, PG, "my_user", SaveMode.UPSERT, run_sql=run)
    assert rec.writes == []


def test_read_options_split_only_with_bounds():
    from tidewater.sources.jdbc import jdbc_read_options

    plain = jdbc_read_options(PG, "my_user")
    assert plain["dbtable"] == "my_user" and "partitionColumn" not in plain
    split = jdbc_read_options(PG, "orders", 4, "o_orderdate", dt.datetime(1995, 1, 1), dt.datetime(2001, 8, 1))
    assert split["partitionColumn"] == "o_orderdate" and split["numPartitions"] == "4"
    assert split["lowerBound"] == "1995-01-01 00:00:00" and split["upperBound"] == "2001-08-01 00:00:00"
    assert jdbc_read_options(PG, "t", 6, "id", 1, None).get("partitionColumn") is None
    assert jdbc_read_options(PG, "t", fetchsize=5000)["fetchsize"] == "5000"


def test_save_request_and_append_variants(monkeypatch, my_user):
    rec = Recorder(my_user.schema)
    run = rec.install(monkeypatch)
    req = J.JdbcSave(PG, "my_user", "upsert", keys=("id",))
    assert req.save(my_user, run_sql=run) == "merged"
    J.append_to_postgres(my_user, PG, "my_user")
    assert rec.writes[-1] == ("my_user", "append", 3)
    with pytest.raises(EndpointError):
        J.append_to_mysql(my_user, PG, "my_user")


def test_endpoint_from_config():
    conf = {"user": "root", "password": "pw", "db": "hive", "driver": "com.mysql.jdbc.Driver",
            "host": "localhost:3306", "url": "jdbc:mysql://$host/$db?user=$user&password=$password",
            "fetchsize": 1000}
    e = Endpoint.from_config(conf)
    assert e.resolved_url == "jdbc:mysql://localhost:3306/hive?user=root&password=pw"
    assert e.kind == "mysql" and e.options()["fetchsize"] == "1000"
    with pytest.raises(EndpointError):
        Endpoint.from_config({"url": "jdbc:mysql://h/d"})


def test_streaming_jdbc_writer(monkeypatch, my_user):
    from tidewater.streaming.sync_stream import jdbc_batch_writer

    rec = Recorder(my_user.schema)
    run = rec.install(monkeypatch)
    write = jdbc_batch_writer(PG, "my_user", "upsert", keys=["id"], run_sql=run)
    write(my_user, 0)
    write(my_user, 0)  # a replayed batch re-applies the same rows
    assert [w[2] for w in rec.writes] == [2, 2]
    assert sum(1 for q in rec.sql if q.startswith("INSERT INTO my_user")) == 2


def test_sync_to_jdbc_sends_only_the_window(monkeypatch, spark):
    from conftest import SF_SMALL
    from tidewater.plans.jobs import sync_to_jdbc

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    rec = Recorder(ev.schema)
    run = rec.install(monkeypatch)
    monkeypatch.setattr(J, "jvm_run_sql", lambda spark, ep: run)
    assert sync_to_jdbc(ev, PG, "events", "upsert", keys=["event_id"], day="2024-01-15", column="ts") == "merged"
    day_rows = ev.filter("ts >= timestamp_ntz'2024-01-15 00:00:00' and ts < timestamp_ntz'2024-01-16 00:00:00'")
    assert rec.writes[0][2] == day_rows.count()
    assert 'ON CONFLICT ("event_id") DO UPDATE' in rec.sql[0]


def test_embeddings_array_column_preflight(spark):
    from conftest import SF_SMALL

    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    J.check_writable(emb.schema, "postgresql")
    for kind in ("mysql", "derby", "db2", "generic"):
        with pytest.raises(J.UnwritableTypeError, match="embedding"):
            J.check_writable(emb.schema, kind)


def test_derby_merge_uses_the_staging_table():
    sql = J.merge_statement("derby", "T", "S", ["K1", "v"], ["K1"], SaveMode.UPSERT)
    assert sql.startswith('MERGE INTO T t USING S s ON (t."K1" = s."K1")')


def test_merge_uses_target_spelling(monkeypatch, spark):
    df = spark.createDataFrame([(1, "x")], "ID int, Account string")
    rec = Recorder(T.StructType.fromDDL("id int, account string"))
    run = rec.install(monkeypatch)
    J.save_jdbc(df, PG, "my_user", "upsert", keys=["ID"], run_sql=run)
    sql = rec.sql[0]
    assert sql.startswith('INSERT INTO my_user ("id", "account") SELECT "ID", "Account" FROM')
    assert 'ON CONFLICT ("id") DO UPDATE SET "account" = EXCLUDED."account"' in sql
    m = J.merge_statement("db2", "T", "S", ["ID", "V"], ["ID"], "upsert", target_columns=["id", "v"])
    assert 'ON (t."id" = s."ID")' in m and 'UPDATE SET "v" = s."V"' in m and 'INSERT ("id", "v") VALUES (s."ID", s."V")' in m


def test_read_helpers_check_the_endpoint_kind_first(spark):
    from tidewater.sources.jdbc import read_db2, read_mysql, read_postgres

    my = Endpoint.mysql("h:3306", "d")
    with pytest.raises(EndpointError):
        read_db2(spark, my, "t")
    with pytest.raises(EndpointError):
        read_postgres(spark, my, "t")
    with pytest.raises(EndpointError):
        read_mysql(spark, Endpoint("jdbc:db2://h/d", "com.mysql.jdbc.Driver"), "t")


@pytest.mark.parametrize(
    "endpoint, head",
    [
        (Endpoint.mysql("h:3306", "d"), "INSERT INTO events (`event_id`"),
        (Endpoint("jdbc:db2://h:50000/d", "com.ibm.db2.jcc.DB2Driver"), "MERGE INTO events t USING ("),
    ],
)
def test_sync_to_jdbc_other_dialects(monkeypatch, spark, endpoint, head):
    from conftest import SF_SMALL
    from tidewater.plans.jobs import sync_to_jdbc

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    rec = Recorder(ev.schema)
    run = rec.install(monkeypatch)
    monkeypatch.setattr(J, "jvm_run_sql", lambda spark, ep: run)
    sync_to_jdbc(ev, endpoint, "events", "upsert", keys=["event_id"], day="2024-01-15", column="ts")
    assert rec.sql[0].startswith(head)


class Database:
    """Tables by name; fails at the ``fail``-th step, before or after it took effect."""

    def __init__(self, tables, fail, late):
        self.tables, self.fail, self.late, self.steps = dict(tables), fail, late, 0

    def _step(self, effect):
        self.steps += 1
        if self.steps == self.fail and not self.late:
            raise ConnectionError(f"step {self.fail}")
        effect()
        if self.steps == self.fail:
            raise ConnectionError(f"step {self.fail}")

    def write(self, df, ep, table, mode, *a, **k):
        self._step(lambda: self.tables.__setitem__(table, "new" if df.count() else "empty"))

    def run(self, sql):
        words = sql.split()

        def effect():
            if sql.startswith("DROP TABLE"):
                del self.tables[words[2]]
            elif "RENAME TO" in sql:
                self.tables[words[-1]] = self.tables.pop(words[2])
            elif sql.startswith("INSERT INTO"):
                self.tables[words[2]] = "merged"

        self._step(effect)


@pytest.mark.parametrize("late", [False, True])
@pytest.mark.parametrize("mode, existing, done, last", [
    ("overwrite", True, "new", 4), ("upsert", True, "merged", 3), ("ignore_record", True, "merged", 3), ("upsert", False, "merged", 5),
])
def test_a_failure_at_any_step_keeps_the_old_table(monkeypatch, my_user, mode, existing, done, last, late):
    before = {"my_user": "old"} if existing else {}
    for fail in range(1, last + 2):
        db = Database(before, fail, late)
        monkeypatch.setattr(J, "target_schema", lambda spark, ep, table: my_user.schema if existing else None)
        monkeypatch.setattr(J, "write_table", db.write)
        save = lambda: J.save_jdbc(my_user, PG, "my_user", mode, keys=["id"], run_sql=db.run)
        if fail > last:
            save()
            assert db.tables == {"my_user": done} and db.steps == last
            continue
        with pytest.raises(ConnectionError, match=f"step {fail}"):
            save()
        if fail < last - 1 or (fail == last - 1 and not late):
            assert db.tables == before, (fail, db.tables)  # undone, nothing left behind
        else:
            # the last statement that changes the table took effect, or only the clean-up failed
            assert set(db.tables) >= {"my_user"} or not existing


def test_writer_options_pass_through_jobs(monkeypatch, spark):
    from conftest import SF_SMALL
    from tidewater.plans.jobs import sync_to_jdbc

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    seen = []
    monkeypatch.setattr(J, "target_schema", lambda *a: ev.schema)
    monkeypatch.setattr(J, "write_table", lambda df, ep, table, mode, parts, batch, **k: seen.append((table, parts, batch, k["isolation_level"])))
    sync_to_jdbc(ev, PG, "events", "append", day="2024-01-15", column="ts", num_partitions=3, batchsize=50, isolation_level="NONE")
    assert seen == [("events", 3, 50, "NONE")]
    sql = []
    sync_to_jdbc(ev, PG, "events", "upsert", keys=["event_id"], day="2024-01-15", column="ts", staging_table="stage", run_sql=sql.append)
    assert seen[-1][0] == "stage" and sql[-1] == "DROP TABLE stage"
    with pytest.raises(TypeError):
        sync_to_jdbc(ev, PG, "events", "append", batch_size=3)


def test_append_once_stages_fixed_row_ids(monkeypatch, spark, my_user):
    """A task retried after its commit stages the same ids again; one statement takes
    each id once."""
    staged = []
    rec = Recorder(my_user.schema)
    run = rec.install(monkeypatch)
    monkeypatch.setattr(J, "write_table", lambda df, ep, table, mode, *a, **k: staged.append((table, mode, df.collect(), df.collect())))
    rows = my_user.union(my_user).withColumn("account", F.concat("account", F.expr("cast(uuid() as string)")))
    J.append_to_postgres(rows, PG, "my_user", once=True, run_sql=run)
    (stg, mode, first, again), = staged
    assert stg.startswith("my_user__stg_") and mode == "errorifexists"
    assert first == again and len({r[J.ROW_ID] for r in first}) == 6
    insert, drop = rec.sql
    assert insert == (
        f'INSERT INTO my_user ("id", "account", "passwd") SELECT "id", "account", "passwd" FROM (SELECT "id", "account", "passwd", '
        f'ROW_NUMBER() OVER (PARTITION BY "{J.ROW_ID}" ORDER BY "{J.ROW_ID}") AS tw_repeat FROM {stg}) s WHERE s.tw_repeat = 1'
    )
    assert drop == f"DROP TABLE {stg}"
    # the statement's rows, staged twice over as after such a retry, here in Spark
    spark.createDataFrame(first + again[:4]).createOrReplaceTempView("stage_twice")
    select = J.insert_once_statement("mysql", "t", "stage_twice", my_user.columns).split(") ", 1)[1]
    assert Counter(map(tuple, spark.sql(select).collect())) == Counter(tuple(r)[:3] for r in first)


@pytest.mark.parametrize("failing", ["INSERT", "write target", None])
def test_append_once_to_a_new_table_undoes_its_steps(monkeypatch, my_user, failing):
    rec = Recorder(None)
    rec.install(monkeypatch)

    def write(df, ep, table, mode, *a, **k):
        if failing == "write target" and table == "my_user":
            raise RuntimeError("db said no")
        rec.writes.append((table, mode, df.count()))

    def run(sql):
        rec.sql.append(sql)
        if failing and sql.startswith(failing):
            raise RuntimeError("db said no")

    monkeypatch.setattr(J, "write_table", write)
    save = lambda: J.save_jdbc(my_user, PG, "my_user", "append", run_sql=run, once=True, staging_table="stage")
    if failing is None:
        assert save() == "appended"
        assert rec.writes == [("stage", "errorifexists", 3), ("my_user", "errorifexists", 0)] and rec.sql[-1] == "DROP TABLE stage"
        return
    with pytest.raises(RuntimeError):
        save()
    assert rec.sql[-2:] == ["DROP TABLE my_user", "DROP TABLE stage"]


def test_append_once_keeps_its_own_column_name(monkeypatch, my_user):
    Recorder(None).install(monkeypatch)
    with pytest.raises(SchemaMismatchError):
        J.save_jdbc(my_user.withColumn(J.ROW_ID, F.lit(1)), PG, "t", "append", run_sql=print, once=True)
