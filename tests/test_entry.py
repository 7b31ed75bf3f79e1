import importlib

import duckdb

from conftest import SF_SMALL

E = importlib.import_module("__spark_entry__")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_id", "ts", "user_id", "event_type", "value", "props"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_queries_match_oracle_at_smallest_scale(spark):
    con = duckdb.connect()
    for t in ("orders", "lineitem", "events", "customer", "documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ("sync_daily_upsert", "save_upsert", "save_upsert_composite", "save_ignore_record",
                 "save_upsert_partial", "filter_range", "key_scan", "dedup_latest"):
        s = E.queries()[name](spark, SF_SMALL)
        got = sorted(tuple(r) for r in s.collect())
        want = sorted(con.execute(E.oracle_sql()[name]).fetchall())
        assert len(got) == len(want), name
        assert [tuple(str(x) for x in r) for r in got] == [tuple(str(x) for x in r) for r in want], name
