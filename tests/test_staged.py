"""The change set is evaluated once, and unchanged keys are not shuffled."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text, rows
from tidewater.operators.merge import SaveMode, merge_state
from tidewater.operators.staged import bitmap_bits, key_bitmap, merge_once, merge_staged, split_by_bitmap, staged_changes
from tidewater.plans import fixtures as fx
from tidewater.session import checkpoint_dir
from tidewater.sinks.snapshot import save_partitions_in_place, save_snapshot

MODES = [SaveMode.UPSERT, SaveMode.IGNORE_RECORD]


def pair(spark):
    target = spark.createDataFrame(
        [(1, "a", 1.0), (2, "b", 2.0), (2, "b", 2.5), (None, "n", 3.0), (5, None, None)], "id int, `x.y` string, v double"
    )
    changes = spark.createDataFrame(
        [(2, "B", 20.0), (7, "g", 70.0), (7, "h", 71.0), (None, "m", 9.0), (None, "m", 9.0), (5, "e", None)], "id int, `x.y` string, v double"
    )
    return target, changes


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("bits", [None, 32768])
def test_same_state_as_the_plain_merge(spark, mode, bits):
    target, changes = (df.toDF("id", "x", "v") for df in pair(spark))
    keep = "last" if mode is SaveMode.UPSERT else "first"
    with staged_changes(changes, ["id"], keep=keep) as once:
        assert rows(merge_staged(target, once, mode, ["id"], bits=bits)) == rows(merge_state(target, changes, mode, ["id"]))
        partial = once.select("id", "v")
        assert rows(merge_staged(target, partial, mode, ["id"])) == rows(merge_state(target, partial, mode, ["id"]))


@pytest.mark.parametrize("mode", MODES)
def test_whole_tables(spark, mode):
    t, c = fx.orders_target(spark, SF_SMALL), fx.orders_changed(spark, SF_SMALL)
    got = merge_once(t, c, mode, rows, keys=["o_orderkey"])
    assert got == rows(merge_state(t, c, mode, ["o_orderkey"]))


def test_other_keys_take_the_plain_plan(spark):
    t = spark.createDataFrame([(0.0, 1), (2.0, 2)], "k double, v int")
    c = spark.createDataFrame([(-0.0, 9)], "k double, v int")
    assert merge_once(t, c, "upsert", rows, keys=["k"]) == rows(merge_state(t, c, "upsert", ["k"]))
    t = spark.createDataFrame([(3, 1)], "k long, v int")
    c = spark.createDataFrame([("3", 9), ("4", 8)], "k string, v int")
    assert merge_once(t, c, "upsert", rows, keys=["k"]) == rows(merge_state(t, c, "upsert", ["k"]))
    assert merge_once(None, c.union(c), "upsert", rows, keys=["k"]) == [("3", 9), ("4", 8)]


def unstable(spark):
    """Rows whose values differ each time they are evaluated, and keys too."""
    return spark.range(200).select(F.when(F.rand() < 0.5, F.col("id")).otherwise(F.col("id") + 1000).alias("id"), F.rand().alias("v"))


@pytest.mark.parametrize("mode", MODES)
def test_unstable_input_loses_and_doubles_no_key(spark, mode, tmp_path):
    target = spark.range(0, 2000, 3).select("id", F.lit(-1.0).alias("v"))
    target.write.parquet(str(tmp_path / "t"))
    out = save_snapshot(unstable(spark), str(tmp_path / "t"), str(tmp_path / "o"), mode, keys=["id"])
    got = spark.read.parquet(out)
    ids = [r["id"] for r in got.collect()]
    assert len(ids) == len(set(ids)) and set(range(0, 2000, 3)) <= set(ids)
    assert all((i % 1000 if i >= 1000 else i) < 200 or i % 3 == 0 for i in ids)
    # 200 rows came in, each under one of its two keys
    for i in range(200):
        held = (i in ids) + (i + 1000 in ids)
        assert held == 1 or i % 3 == 0 or (i + 1000) % 3 == 0


def test_the_copy_is_released(spark):
    _, changes = pair(spark)
    scratch = os.path.join(checkpoint_dir(spark).replace("file:", ""), "tidewater-scratch")
    with staged_changes(changes, ["id"]) as once:
        held = {f for f in os.listdir(scratch) if f.startswith("changes-")}
        assert held and once.columns == changes.columns and once.count() == 5  # 2, 5, 7 and both rows without a key
    assert not {f for f in os.listdir(scratch) if f.startswith("changes-")} & held
    with pytest.raises(ZeroDivisionError), staged_changes(changes, ["id"]):
        raise ZeroDivisionError
    assert not [f for f in os.listdir(scratch) if f.startswith("changes-")]


def test_bitmap_divides_the_target(spark):
    changes, target = spark.range(0, 400, 4).toDF("k"), spark.range(20_000).toDF("k")
    bits = bitmap_bits(100)
    maybe, never = split_by_bitmap(target, ["k"], key_bitmap(changes, ["k"], bits), bits)
    assert {r["k"] for r in changes.collect()} <= {r["k"] for r in maybe.collect()}
    assert maybe.count() + never.count() == 20_000 and maybe.count() < 100 + 20_000 * 100 / bits * 3
    assert bitmap_bits(0) == 32768 and bitmap_bits(10**12) == 1 << 28


@pytest.mark.parametrize("mode", MODES)
def test_no_unfiltered_target_key_is_shuffled(spark, mode, tmp_path):
    """With size-based broadcast off, each exchange below a join has the bitmap test
    beneath it or reads the change set."""
    target = spark.range(100_000).select("id", F.lit(1.0).alias("v"))
    target.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        with staged_changes(spark.range(0, 100_000, 100).select("id", F.lit(2.0).alias("v")), ["id"]) as once:
            state = merge_staged(table, once, mode, ["id"])
            state.write.parquet(str(tmp_path / "o"))
            state.collect()
            final = plan_text(state).split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    lines = final.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*|"))
    for at, line in enumerate(lines):
        if "Exchange hashpartitioning(id" not in line:
            continue
        below = []
        for other in lines[at + 1 :]:
            if depth(other) <= depth(line):
                break
            below.append(other)
        text = "\n".join(below)
        assert "[c0#" in text or "_held" in text or "_bitmap" in text, text  # the copy's columns are numbered
    assert spark.read.parquet(str(tmp_path / "o")).count() == 100_000


def test_in_place_partitions_read_changes_once(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(100).select("id", (F.col("id") % 4).alias("part"), F.lit(0.0).alias("v")).write.partitionBy("part").parquet(path)
    changes = spark.range(50, 120).where("id % 4 = 1").select("id", (F.col("id") % 4).alias("part"), F.rand().alias("v"))
    save_partitions_in_place(changes, path, "upsert", ["id", "part"], ["part"])
    got = spark.read.parquet(path)
    assert got.count() == 105 and got.where("v > 0").count() == changes.count()
