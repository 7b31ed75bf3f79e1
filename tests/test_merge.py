import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_text, rows
from tidewater.operators.merge import (
    SaveMode,
    SchemaMismatchError,
    TableExistsError,
    dedup_incoming,
    merge_state,
)

KV = "k int, v string, extra double"


@pytest.fixture()
def target_kv(spark):
    return spark.createDataFrame(
        [(1, "t1", 1.0), (2, "t2", 2.0), (None, "tn", 9.0), (4, "t4", 4.0)], KV
    )


@pytest.fixture()
def incoming_kv(spark):
    return spark.createDataFrame(
        [(1, "i1", 10.0), (3, "i3", 30.0), (4, None, 40.0), (None, "in", 99.0)], KV
    )


def test_upsert_basic(target_kv, incoming_kv):
    out = merge_state(target_kv, incoming_kv, SaveMode.UPSERT, keys=["k"])
    assert rows(out) == rows(out.sparkSession.createDataFrame(
        [(1, "i1", 10.0), (2, "t2", 2.0), (3, "i3", 30.0), (4, None, 40.0), (None, "tn", 9.0), (None, "in", 99.0)], KV))


def test_upsert_null_overwrites(target_kv, incoming_kv):
    out = merge_state(target_kv, incoming_kv, "upsert", keys="k")
    assert [r.v for r in out.filter("k = 4").collect()] == [None]


def test_default_key_is_first_column(target_kv, incoming_kv):
    a = merge_state(target_kv, incoming_kv, SaveMode.UPSERT)
    b = merge_state(target_kv, incoming_kv, SaveMode.UPSERT, keys=["k"])
    assert rows(a) == rows(b)


def test_null_keys_never_conflict(spark):
    t = spark.createDataFrame([(None, "a", 1.0), (None, "a", 1.0)], KV)
    i = spark.createDataFrame([(None, "a", 1.0), (None, "b", 2.0)], KV)
    assert merge_state(t, i, SaveMode.UPSERT, keys=["k"]).count() == 4
    assert merge_state(t, i, SaveMode.IGNORE_RECORD, keys=["k"]).count() == 4
    assert dedup_incoming(i, ["k"]).count() == 2


def test_ignore_record(target_kv, incoming_kv):
    out = merge_state(target_kv, incoming_kv, SaveMode.IGNORE_RECORD, keys=["k"])
    expected = [(1, "t1", 1.0), (2, "t2", 2.0), (3, "i3", 30.0), (4, "t4", 4.0), (None, "tn", 9.0), (None, "in", 99.0)]
    assert rows(out) == rows(out.sparkSession.createDataFrame(expected, KV))


def test_duplicate_incoming_keys_with_order(spark, target_kv):
    inc = spark.createDataFrame(
        [(5, "first", 1.0, 1), (5, "second", 0.5, 2), (5, "third", 0.7, 3), (1, "x", 1.0, 1), (1, "y", 1.0, 0)],
        "k int, v string, extra double, seq int",
    )
    up = merge_state(target_kv, inc.drop("seq"), SaveMode.UPSERT, keys=["k"])
    assert up.filter("k = 5").count() == 1
    last = dedup_incoming(inc, ["k"], order_by=["seq"], keep="last")
    first = dedup_incoming(inc, ["k"], order_by=["seq"], keep="first")
    assert {r.k: r.v for r in last.collect()} == {5: "third", 1: "x"}
    assert {r.k: r.v for r in first.collect()} == {5: "first", 1: "y"}


def test_upsert_keeps_last_ignore_keeps_first(spark, target_kv):
    inc = spark.createDataFrame([(7, "a", 1.0), (7, "b", 2.0)], KV)
    up = merge_state(target_kv, inc, SaveMode.UPSERT, keys=["k"], order_by=["extra"])
    ig = merge_state(target_kv, inc, SaveMode.IGNORE_RECORD, keys=["k"], order_by=["extra"])
    assert [r.v for r in up.filter("k = 7").collect()] == ["b"]
    assert [r.v for r in ig.filter("k = 7").collect()] == ["a"]


def test_dedup_without_order_is_repeatable(spark):
    inc = spark.createDataFrame([(1, "b", 1.0), (1, "a", 3.0), (1, "c", 2.0)], KV)
    outs = {tuple(dedup_incoming(inc.repartition(n), ["k"]).collect()[0]) for n in (1, 2, 3)}
    assert outs == {(1, "c", 2.0)}


def test_partial_columns(spark, target_kv):
    inc = spark.createDataFrame([(1, "p1"), (3, "p3"), (None, "pn")], "k int, v string")
    out = merge_state(target_kv, inc, SaveMode.UPSERT, keys=["k"])
    assert out.columns == target_kv.columns
    expected = [(1, "p1", 1.0), (2, "t2", 2.0), (3, "p3", None), (4, "t4", 4.0), (None, "tn", 9.0), (None, "pn", None)]
    assert rows(out) == rows(spark.createDataFrame(expected, KV))


def test_unknown_incoming_column_raises(spark, target_kv):
    inc = spark.createDataFrame([(1, "x", 1.0, "bad")], "k int, v string, extra double, nope string")
    for mode in (SaveMode.UPSERT, SaveMode.IGNORE_RECORD, SaveMode.APPEND):
        with pytest.raises(SchemaMismatchError):
            merge_state(target_kv, inc, mode, keys=["k"])


def test_composite_keys(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0)], "k1 int, k2 string, v double")
    i = spark.createDataFrame([(1, "a", 10.0), (1, "c", 20.0), (2, "b", 30.0)], "k1 int, k2 string, v double")
    out = merge_state(t, i, SaveMode.UPSERT, keys=["k1", "k2"])
    expected = [(1, "a", 10.0), (1, "b", 2.0), (1, "c", 20.0), (2, "a", 3.0), (2, "b", 30.0)]
    assert rows(out) == sorted(expected, key=repr)


def test_append_and_overwrite(spark, target_kv, incoming_kv):
    ap = merge_state(target_kv, incoming_kv.select("k", "v"), SaveMode.APPEND)
    assert ap.count() == 8 and ap.columns == target_kv.columns
    ov = merge_state(target_kv, incoming_kv.select("k", "v"), SaveMode.OVERWRITE)
    assert ov.columns == ["k", "v"] and ov.count() == 4


def test_table_level_modes(target_kv, incoming_kv):
    with pytest.raises(TableExistsError):
        merge_state(target_kv, incoming_kv, SaveMode.ERROR_IF_EXISTS)
    assert rows(merge_state(target_kv, incoming_kv, SaveMode.IGNORE_TABLE)) == rows(target_kv)
    for mode in SaveMode:
        out = merge_state(None, incoming_kv, mode, keys=["k"])
        assert out.count() == 4


def test_missing_table_keyed_modes_dedup(spark):
    inc = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], KV)
    assert merge_state(None, inc, SaveMode.UPSERT, keys=["k"]).count() == 1
    assert merge_state(None, inc, SaveMode.APPEND, keys=["k"]).count() == 2


def test_types_cast_to_target(spark, target_kv):
    inc = spark.createDataFrame([(1, "x", 5)], "k long, v string, extra int")
    out = merge_state(target_kv, inc, SaveMode.UPSERT, keys=["k"])
    assert out.schema == target_kv.schema


def test_mode_names():
    assert SaveMode.coerce("ErrorIfExists") is SaveMode.ERROR_IF_EXISTS
    assert SaveMode.coerce("IgnoreRecord") is SaveMode.IGNORE_RECORD
    assert SaveMode.coerce("ignore-table") is SaveMode.IGNORE_TABLE
    assert SaveMode.coerce("ignore") is SaveMode.IGNORE_TABLE
    with pytest.raises(ValueError):
        SaveMode.coerce("merge")


def test_dedup_is_an_aggregate_not_a_window(spark):
    inc = spark.createDataFrame([(1, "a", 1.0)], KV)
    plan = plan_text(dedup_incoming(inc, ["k"], order_by=["extra"]))
    assert "Window" not in plan and "max(" in plan


def test_upsert_shuffles_only_incoming_keys(spark):
    t = spark.range(1000).select(F.col("id").alias("k"), F.lit("t").alias("v"))
    i = spark.range(500, 1500).select(F.col("id").alias("k"), F.lit("i").alias("v"))
    out = merge_state(t, i, SaveMode.UPSERT, keys=["k"], dedup=False)
    assert out.count() == 1500
    assert out.filter("v = 'i'").count() == 1000


# ------------------------------------------------------------ properties

keyed_rows = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["a", "b", None]), st.integers(0, 3)),
    max_size=12,
)
PROP = "k int, v string, n int"
cfg = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _unique_target(data):
    seen, out = set(), []
    for r in data:
        if r[0] is None or r[0] not in seen:
            out.append(r)
            if r[0] is not None:
                seen.add(r[0])
    return out


@cfg
@given(t=keyed_rows, i=keyed_rows)
def test_upsert_idempotent(spark, t, i):
    tdf = spark.createDataFrame(_unique_target(t), PROP)
    idf = spark.createDataFrame(i, PROP)
    once = merge_state(tdf, idf, SaveMode.UPSERT, keys=["k"]).cache()
    twice_nonnull = merge_state(once.filter("k is not null"), idf.filter("k is not null"), SaveMode.UPSERT, keys=["k"])
    assert rows(twice_nonnull) == rows(once.filter("k is not null"))


@cfg
@given(t=keyed_rows, i=keyed_rows)
def test_ignore_record_keeps_existing_and_key_union(spark, t, i):
    tdf = spark.createDataFrame(_unique_target(t), PROP)
    idf = spark.createDataFrame(i, PROP)
    ig = merge_state(tdf, idf, SaveMode.IGNORE_RECORD, keys=["k"])
    tk = {r[0] for r in _unique_target(t) if r[0] is not None}
    ik = {r[0] for r in i if r[0] is not None}
    got = rows(ig.filter(F.col("k").isin(list(tk)) if tk else F.lit(False)))
    assert got == rows(tdf.filter(F.col("k").isin(list(tk)) if tk else F.lit(False)))
    up = merge_state(tdf, idf, SaveMode.UPSERT, keys=["k"])
    assert {r.k for r in up.collect() if r.k is not None} == tk | ik
    nulls = sum(1 for r in _unique_target(t) if r[0] is None) + sum(1 for r in i if r[0] is None)
    assert up.filter("k is null").count() == nulls


def test_dedup_with_map_payload(spark):
    inc = spark.createDataFrame(
        [(1, {"a": 1}, 1), (1, {"b": 2}, 2), (None, {"c": 3}, 0)], "k int, m map<string,int>, seq int"
    )
    out = {r.k: r.m for r in dedup_incoming(inc, ["k"], order_by=["seq"]).collect()}
    assert out == {1: {"b": 2}, None: {"c": 3}}


def test_dedup_keeps_identical_null_key_rows(spark):
    inc = spark.createDataFrame(
        [(None, "a", 1.0), (None, "a", 1.0), (None, "a", 1.0), (1, "x", 1.0), (1, "y", 2.0)], KV
    )
    out = dedup_incoming(inc, ["k"], order_by=["extra"])
    assert sorted(rows(out), key=repr) == sorted([(None, "a", 1.0)] * 3 + [(1, "y", 2.0)], key=repr)


def test_dedup_composite_partly_null(spark):
    df = spark.createDataFrame(
        [(1, None, 1.0), (2, None, 1.0), (1, None, 1.0), (1, "a", 1.0), (1, "a", 5.0)], "k1 int, k2 string, v double"
    )
    out = dedup_incoming(df, ["k1", "k2"], order_by=["v"])
    assert out.count() == 4
    assert [r.v for r in out.filter("k2 = 'a'").collect()] == [5.0]
    assert out.filter("k2 is null").count() == 3


def test_dedup_keys_only_frame(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    got = rows(dedup_incoming(df, ["k"]))
    assert sorted(got, key=repr) == sorted([(1,), (None,), (None,)], key=repr)


@cfg
@given(data=keyed_rows)
def test_dedup_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, PROP)
    got = rows(dedup_incoming(df, ["k"], order_by=["n"]))
    best = {}
    nulls = []
    for r in data:
        if r[0] is None:
            nulls.append(r)
            continue
        key = (r[2], r[1] is not None, r[1] or "")  # order_by n, then v with NULL lowest
        if r[0] not in best or key > best[r[0]][0]:
            best[r[0]] = (key, r)
    want = sorted([v[1] for v in best.values()] + nulls, key=repr)
    assert sorted(got, key=repr) == want


def test_map_key_refused(spark):
    df = spark.createDataFrame([({"a": 1}, 1)], "m map<string,int>, v int")
    with pytest.raises(SchemaMismatchError):
        dedup_incoming(df, ["m"])


def test_duplicate_target_keys_replaced_by_one_row(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "c", 3.0)], KV)
    i = spark.createDataFrame([(1, "new", 0.0)], KV)
    out = merge_state(t, i, SaveMode.UPSERT, keys=["k"])
    assert rows(out) == sorted([(1, "new", 0.0), (2, "c", 3.0)], key=repr)


def test_partial_upsert_updates_each_duplicate_target_row(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], KV)
    i = spark.createDataFrame([(1, "new")], "k int, v string")
    out = merge_state(t, i, SaveMode.UPSERT, keys=["k"])
    assert rows(out) == sorted([(1, "new", 1.0), (1, "new", 2.0)], key=repr)


def test_align_with_odd_names_and_nested_types(spark):
    t = spark.createDataFrame([(1, "a", (1, "x"))], "`my key` int, `v-1` string, s struct<`a b`:int, c:string>")
    i = spark.createDataFrame([(1, "b")], "`my key` long, `v-1` string")
    out = merge_state(t, i, SaveMode.UPSERT, keys=["my key"])
    assert out.schema == t.schema
    assert [tuple(r) for r in out.collect()] == [(1, "b", (1, "x"))]
    t2 = spark.createDataFrame([(1, "a", 2.5)], "`my key` int, `v-1` string, `x.y` double")
    out2 = merge_state(t2, i, SaveMode.APPEND)
    assert out2.count() == 2 and out2.columns == t2.columns


def test_order_by_nested_field(spark):
    inc = spark.createDataFrame([(1, (5, "a"), "x"), (1, (9, "b"), "y")], "k int, s struct<ts:int, t:string>, v string")
    out = dedup_incoming(inc, ["k"], order_by=["s.ts"], keep="first")
    assert [r.v for r in out.collect()] == ["x"]
