"""Bucketed collections: replacement writes the touched buckets alone."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewater.sources.documents import DocumentStore, bucket_collection, read_collection, save_collection

SCHEMA = "_id long, v string"


def files(root):
    """path -> (modified, bytes) of each data file."""
    found = {}
    for folder, _, names in os.walk(root):
        for name in names:
            if name.startswith("part-"):
                stat = os.stat(os.path.join(folder, name))
                found[os.path.relpath(os.path.join(folder, name), root)] = (stat.st_mtime_ns, stat.st_size)
    return found


def docs(spark, n=1000):
    return spark.range(n).select(F.col("id").alias("_id"), F.concat(F.lit("v"), "id").alias("v"))


@pytest.fixture
def store(tmp_path):
    return DocumentStore(root=str(tmp_path))


def test_only_touched_buckets_are_written(spark, store):
    save_collection(docs(spark), store, "c", buckets=32)
    before = files(store.path("c"))
    new = spark.createDataFrame([(5, "new"), (2000, "added"), (5, "newest")], SCHEMA).coalesce(1)
    assert save_collection(new, store, "c") == "c"
    after = files(store.path("c"))
    changed = {p for p in after if before.get(p) != after[p]}
    assert {os.path.dirname(p) for p in before} | {os.path.dirname(p) for p in changed} == {os.path.dirname(p) for p in after}
    assert 1 <= len({os.path.dirname(p) for p in changed}) <= 2
    assert sum(after[p][1] for p in changed) < sum(s for _, s in after.values()) / 8
    got = dict(rows(read_collection(spark, store, "c", schema=SCHEMA)))
    assert got == {**{i: f"v{i}" for i in range(1000)}, 5: got[5], 2000: "added"} and got[5] in ("new", "newest")
    assert sorted(read_collection(spark, store, "c").columns) == ["_id", "v"]


def test_same_documents_as_a_plain_collection(spark, store):
    save_collection(docs(spark), store, "plain")
    bucket_collection(spark, store, "plain", "b", 7)
    new = docs(spark, 1500).where("_id % 3 = 0").select("_id", F.lit("again").alias("v"))
    save_collection(new, store, "plain", out_collection="plain2")
    for _ in range(2):  # a repeated run changes nothing
        save_collection(new, store, "b")
        assert rows(read_collection(spark, store, "b", schema=SCHEMA), "_id", "v") == rows(
            read_collection(spark, store, "plain2", schema=SCHEMA), "_id", "v"
        )


def test_lines_without_an_id_stay_byte_by_byte(spark, store, tmp_path):
    lines = ['{"v" : "none"}', "no json", '{"_id": null, "v":"null"}', '{"_id":  1, "v":"one", "more":{"x":[1, 2.50]}}', '{"_id":2,"v":"two"}']
    os.makedirs(tmp_path / "c")
    (tmp_path / "c" / "part-0.json").write_text("\n".join(lines) + "\n")
    bucket_collection(spark, store, "c", "b", 3)
    save_collection(spark.createDataFrame([(2, "TWO"), (None, "plain")], SCHEMA), store, "b")
    got = sorted(r.value for r in spark.read.text(store.path("b")).collect())
    assert got == sorted([*lines[:4], '{"_id":2,"v":"TWO"}', '{"v":"plain"}'])


def test_text_ids_and_plain_appends(spark, store):
    save_collection(spark.createDataFrame([("a", 1), ("b", 2)], "_id string, n int"), store, "c", buckets=4)
    save_collection(spark.createDataFrame([(9,)], "n int"), store, "c")
    save_collection(spark.createDataFrame([("b", 3)], "_id string, n int"), store, "c")
    assert rows(read_collection(spark, store, "c", schema="_id string, n int"), "_id", "n") == [("a", 1), ("b", 3), (None, 9)]


@pytest.mark.parametrize("bucketed", [True, False])
def test_changing_input_is_read_once(spark, store, bucketed):
    save_collection(docs(spark), store, "c", buckets=8 if bucketed else None)
    new = spark.range(500).select(F.expr("cast(rand() * 3000 as bigint)").alias("_id"), F.lit("new").alias("v"))
    out = save_collection(new, store, "c", out_collection=None if bucketed else "c2")
    got = read_collection(spark, store, out, schema=SCHEMA)
    ids = [r[0] for r in got.select("_id").collect()]
    assert len(ids) == len(set(ids)) and set(range(1000)) <= set(ids)


def test_refused(spark, store):
    save_collection(docs(spark, 10), store, "plain")
    with pytest.raises(ValueError):
        save_collection(docs(spark, 10), store, "plain", buckets=4)
    save_collection(docs(spark, 10), store, "c", buckets=4)
    with pytest.raises(ValueError):
        save_collection(docs(spark, 10), store, "c", buckets=5)
    with pytest.raises(ValueError):
        save_collection(docs(spark, 10).withColumn("_id", F.col("_id").cast("double")), store, "c")
    with pytest.raises(ValueError):
        bucket_collection(spark, store, "c", "c2", 4)


def test_empty_inputs(spark, store):
    save_collection(docs(spark, 10), store, "c", buckets=4)
    before = files(store.path("c"))
    save_collection(docs(spark, 0), store, "c")
    assert files(store.path("c")) == before
    save_collection(docs(spark, 0), store, "none", buckets=4)
    save_collection(docs(spark, 10), store, "none", buckets=4)
    assert read_collection(spark, store, "none", schema=SCHEMA).count() == 10
