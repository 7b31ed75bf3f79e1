import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tidewater.operators.merge import SaveMode, TableExistsError
from tidewater.plans.layout import SHARD_COL, cap_partitions, hash_layout, write_hash_layout
from tidewater.sinks.snapshot import read_snapshot, save_snapshot
from tidewater.sources.documents import DocumentStore, read_collection, replace_documents, save_collection


def test_cap_partitions(spark):
    df = spark.range(0, 100, numPartitions=8)
    assert cap_partitions(df, 3, shuffle=False).rdd.getNumPartitions() == 3
    assert cap_partitions(df, 3).rdd.getNumPartitions() == 3
    assert cap_partitions(df, 100, shuffle=False).rdd.getNumPartitions() == 8
    assert cap_partitions(df, None) is df


def test_cap_partitions_query_shuffles_no_table(spark, tmp_path):
    """Three tasks read the table where it lies, every row of it once."""
    from tidewater.plans.catalog import QUERIES

    rows = spark.range(0, 4000, 1, 8).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("v"))
    rows.unionByName(rows.where("id < 10")).write.parquet(str(tmp_path / "lineitem.parquet"))
    out = QUERIES["cap_partitions"](spark, str(tmp_path))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert 1 <= out.rdd.getNumPartitions() <= 3
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, rows.collect() + rows.where("id < 10").collect()), key=repr)



def test_hash_layout_one_shard_per_key(spark, tmp_path):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    laid = hash_layout(o, "o_orderkey", 8, spread=3)
    per_key = laid.groupBy("o_orderkey").agg(F.countDistinct(SHARD_COL).alias("n"))
    assert per_key.filter("n > 1").count() == 0
    path = write_hash_layout(o, str(tmp_path / "h"), "o_orderkey", 8)
    back = spark.read.parquet(path)
    assert back.select(SHARD_COL).distinct().count() == 8
    assert rows(back.drop(SHARD_COL)) == rows(o)


def test_snapshot_modes(spark, tmp_path):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    i = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    base = str(tmp_path / "v1")
    t.write.parquet(base)
    with pytest.raises(ValueError):
        save_snapshot(i, base, base + "/", SaveMode.UPSERT)
    with pytest.raises(TableExistsError):
        save_snapshot(i, base, str(tmp_path / "x"), SaveMode.ERROR_IF_EXISTS)
    assert save_snapshot(i, base, str(tmp_path / "y"), SaveMode.IGNORE_TABLE) == base
    out = save_snapshot(i, base, str(tmp_path / "v2"), SaveMode.UPSERT, keys=["k"])
    assert rows(spark.read.parquet(out)) == [(1, "a"), (2, "B"), (3, "C")]
    assert read_snapshot(spark, str(tmp_path / "missing")) is None
    new = save_snapshot(i, str(tmp_path / "missing"), str(tmp_path / "v3"), SaveMode.ERROR_IF_EXISTS)
    assert rows(spark.read.parquet(new)) == rows(i)


def test_snapshot_partitioned(spark, tmp_path):
    t = spark.createDataFrame([(1, "a", "d1"), (2, "b", "d2")], "k int, v string, day string")
    out = save_snapshot(t, None, str(tmp_path / "p"), SaveMode.APPEND, partition_by=["day"])
    assert sorted(r.day for r in spark.read.parquet(out).collect()) == ["d1", "d2"]


def test_document_append_and_replace(spark, tmp_path):
    store = DocumentStore(root=str(tmp_path / "docs"))
    save_collection(spark.createDataFrame([("x", 1)], "name string, n long"), store, "plain")
    save_collection(spark.createDataFrame([("y", 2)], "name string, n long"), store, "plain")
    assert read_collection(spark, store, "plain").count() == 2
    first = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "_id long, name string, n long")
    save_collection(first, store, "c")
    with pytest.raises(ValueError):
        save_collection(first, store, "c")
    new = spark.createDataFrame([(2, "B", "extra"), (3, "C", None)], "_id long, name string, tag string")
    out = save_collection(new, store, "c", out_collection="c2")
    got = {r["_id"]: (r["name"], r["n"], r["tag"]) for r in read_collection(spark, store, out).collect()}
    assert got == {1: ("a", 10, None), 2: ("B", None, "extra"), 3: ("C", None, None)}


def test_replace_documents_last_duplicate_wins(spark):
    cur = spark.createDataFrame([(1, "a")], "_id long, name string")
    inc = spark.createDataFrame([(1, "b"), (1, "c")], "_id long, name string")
    assert [r.name for r in replace_documents(cur, inc).collect()] == ["c"]


def test_store_validation():
    with pytest.raises(ValueError):
        DocumentStore()
    with pytest.raises(ValueError):
        DocumentStore(uri="mongodb://h")


def test_document_timestamps_keep_microseconds(spark, tmp_path):
    import datetime as dt

    store = DocumentStore(root=str(tmp_path / "d"))
    ts = dt.datetime(2024, 1, 1, 12, 0, 0, 123456)
    df = spark.createDataFrame([(1, ts, ts)], "_id long, a timestamp_ntz, b timestamp")
    save_collection(df, store, "t")
    back = read_collection(spark, store, "t", schema="_id long, a timestamp_ntz, b timestamp").collect()[0]
    assert back.a == ts and back.b == ts


def test_sync_materialize(spark):
    from tidewater.plans.jobs import changed_rows, sync

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    a = changed_rows(ev, day="2024-01-15", column="ts", materialize="checkpoint")
    b = changed_rows(ev, day="2024-01-15", column="ts", materialize="persist")
    assert rows(a) == rows(b) == rows(changed_rows(ev, day="2024-01-15", column="ts"))
    with pytest.raises(ValueError):
        changed_rows(ev, day="2024-01-15", start="2024-01-1500:00:00", end="2024-01-1500:00:01", column="ts")
    with pytest.raises(ValueError):
        changed_rows(ev, day="2024-01-15", column="ts", materialize="cache")
    out = sync(ev, ev.limit(0), "upsert", keys=["event_id"], day="2024-01-15", column="ts", materialize="persist")
    assert out.count() == a.count()


def test_bucketed_table_merge_reads_target_without_shuffle(spark, tmp_path):
    from conftest import plan_text
    from tidewater.sinks.table import save_table, table_or_none

    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        t = spark.createDataFrame([(i, f"t{i}") for i in range(200)], "k long, v string")
        i = spark.createDataFrame([(i, f"i{i}") for i in range(150, 260)], "k long, v string")
        v1 = save_table(t, None, "tw_test_v1", "overwrite", keys=["k"], path=str(tmp_path / "v1"))
        v2 = save_table(i, v1, "tw_test_v2", "upsert", keys=["k"], path=str(tmp_path / "v2"))
        got = spark.table(v2)
        assert got.count() == 260 and got.filter("v like 'i%'").count() == 110
        from tidewater.operators.merge import merge_state

        plan = plan_text(merge_state(spark.table(v1), i, "upsert", keys=["k"]))
        assert "Bucketed: true" in plan
        assert save_table(i, v2, "tw_test_v3", "ignore_table", keys=["k"]) == v2
        assert table_or_none(spark, "tw_missing") is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_partition_local_merge_equals_full_merge(spark, tmp_path):
    from conftest import plan_text
    from tidewater.operators.merge import merge_state
    from tidewater.sinks.snapshot import merge_partition_local

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("day", F.trunc(F.to_date("l_shipdate"), "month"))
    base = str(tmp_path / "li_v1")
    li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")).write.partitionBy("day").parquet(base)
    target = spark.read.parquet(base)
    inc = li.filter(F.col("l_shipdate") >= F.lit("1997-12-01").cast("timestamp_ntz")).withColumn(
        "l_quantity", F.col("l_quantity") + 1
    )
    keys = ["l_orderkey", "l_linenumber", "day"]
    for mode in ("upsert", "ignore_record"):
        full = merge_state(target, inc, mode, keys=keys, order_by=["l_shipdate"])
        local = merge_partition_local(target, inc, mode, keys, ["day"], order_by=["l_shipdate"])
        assert rows(local) == rows(full)
    out = save_snapshot(inc, base, str(tmp_path / "li_v2"), "upsert", keys=keys, partition_by=["day"])
    assert spark.read.parquet(out).count() == merge_state(target, inc, "upsert", keys=keys).count()
    with pytest.raises(ValueError):
        merge_partition_local(target, inc, "upsert", ["l_orderkey"], ["day"])
    assert "dynamicpruning" in plan_text(merge_partition_local(target, inc, "upsert", keys, ["day"])).lower()


def test_collection_in_byte_sized_ranges(spark, tmp_path):
    """Parts follow the collection's bytes; ranges are sorted and share no key but a
    hot one, which takes several; no row is lost, NULL and equal keys included."""
    from tidewater.sources.documents import split_count

    store = DocumentStore(root=str(tmp_path / "r"))
    data = [(i if i % 3 else 7, f"{i:04d}" + "x" * 200, f"a.{i}") for i in range(6000)] + [(None, "none", "z")] * 50
    df = spark.createDataFrame(data, "k long, body string, `a.b` string")
    save_collection(df, store, "c")
    schema = "k long, body string, `a.b` string"
    size = sum(f.stat().st_size for f in (tmp_path / "r" / "c").glob("part-*"))
    n = -(-size // (128 << 10))
    assert split_count(spark, store.path("c"), 0.125) == n > 8
    got = read_collection(spark, store, "c", schema=schema, split_mb=0.125, split_by="k")
    assert got.columns == df.columns and sorted(rows(got), key=repr) == sorted(rows(df), key=repr)
    parts = {}
    for r in got.select("k", F.spark_partition_id().alias("p"), F.length("body").alias("b")).collect():
        parts.setdefault(r.p, []).append((-1 if r.k is None else r.k, r.b))
    assert len(parts) == n
    keys = [[k for k, _ in parts[p]] for p in sorted(parts)]
    assert all(k == sorted(k) for k in keys) and all(a[-1] <= b[0] for a, b in zip(keys, keys[1:]))
    assert sum(7 in k for k in keys) >= n // 4
    sizes = [sum(b for _, b in v) for v in parts.values()]
    assert max(sizes) < 2 * sum(sizes) / n
    one = read_collection(spark, store, "c", schema=schema, split_mb=1024, split_by="k")
    assert one.rdd.getNumPartitions() == 1
    with pytest.raises(ValueError):
        read_collection(spark, store, "c", schema=schema, split_mb=0, split_by="k")


def test_partitions_in_place_equals_full_merge(spark, tmp_path):
    from tidewater.operators.merge import merge_state
    from tidewater.sinks.snapshot import save_partitions_in_place

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn(
        "day", F.trunc(F.to_date("l_shipdate"), "month")
    )
    target = li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    # One target row in the NULL partition (a NULL key part): it must survive.
    extra_null = (
        target.orderBy("l_orderkey", "l_linenumber", "l_partkey").limit(1)
        .withColumn("l_orderkey", F.lit(-1).cast("bigint"))
        .withColumn("day", F.lit(None).cast("date"))
    )
    base = str(tmp_path / "in_place")
    target.unionByName(extra_null).write.partitionBy("day").parquet(base)
    before = spark.read.parquet(base).cache()
    inc = li.filter(F.col("l_shipdate") >= F.lit("1997-12-01").cast("timestamp_ntz")).withColumn(
        "l_quantity", F.col("l_quantity") + 1
    )
    # The change set also touches the NULL partition; the row already there stays.
    inc = inc.unionByName(extra_null.withColumn("l_orderkey", F.lit(-2).cast("bigint")))
    keys = ["l_orderkey", "l_linenumber", "day"]
    want = rows(merge_state(before, inc, "upsert", keys=keys, order_by=["l_shipdate"]).select(*before.columns))
    save_partitions_in_place(inc, base, "upsert", keys, ["day"], order_by=["l_shipdate"])
    after = spark.read.parquet(base)
    assert rows(after.select(*before.columns)) == want
    assert sorted(r.l_orderkey for r in after.filter("day is null").collect()) == [-2, -1]
    with pytest.raises(ValueError):
        save_partitions_in_place(inc, base, "upsert", ["l_orderkey"], ["day"])


def test_append_in_place_writes_only_new_rows(spark, tmp_path):
    t = spark.createDataFrame([(1, "a", 1.0)], "k int, v string, x double")
    base = str(tmp_path / "t")
    t.write.parquet(base)
    i = spark.createDataFrame([(2, "b")], "k long, v string")
    assert save_snapshot(i, base, base, "append") == base
    got = spark.read.parquet(base)
    assert got.schema == t.schema
    assert rows(got) == [(1, "a", 1.0), (2, "b", None)]
    with pytest.raises(ValueError):
        save_snapshot(i, base, base, "upsert", keys=["k"])


def test_failed_save_leaves_target_intact(spark, tmp_path):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    base = str(tmp_path / "v1")
    t.write.parquet(base)
    bad = spark.createDataFrame([("2", "B"), ("oops", "C")], "k string, v string")  # 'oops' fails the int cast
    with pytest.raises(Exception):
        save_snapshot(bad, base, str(tmp_path / "v2"), "upsert", keys=["k"])
    assert read_snapshot(spark, str(tmp_path / "v2")) is None
    assert rows(spark.read.parquet(base)) == [(1, "a"), (2, "b")]


def test_named_collections(spark, tmp_path):
    from tidewater.sources.documents import NAMED_COLLECTIONS, read_named_collection

    store = DocumentStore(root=str(tmp_path / "crawl"))
    save_collection(spark.createDataFrame([(1, "10% off")], "_id long, title string"), store, NAMED_COLLECTIONS["coupon"])
    assert [r.title for r in read_named_collection(spark, store, "coupon").collect()] == ["10% off"]


def test_replace_keeps_other_documents_byte_identical(spark, tmp_path):
    store = DocumentStore(root=str(tmp_path / "s"))
    lines = ['{"_id":1, "price":12345678901234567.89,"tags":{"b":1.50,"a":[1,2.0]}}', '{"_id":2,"price":1.0}', '{"price":3.10}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(store.path("c"))
    new = spark.createDataFrame([(2, "x"), (3, None)], "_id long, name string")
    save_collection(new, store, "c", out_collection="c2")
    got = sorted(r.value for r in spark.read.text(store.path("c2")).collect())
    assert got == sorted([lines[0], lines[2], '{"_id":2,"name":"x"}', '{"_id":3}'])
