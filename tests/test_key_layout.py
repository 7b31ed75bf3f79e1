"""Key tables in key order: prefixes skip row groups, matches come in ranges."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewater.sources.keys import key_scan, write_key_layout


def keyed(spark, n=8000):
    return spark.range(n).select(F.format_string("k:%05d", "id").alias("key"), F.col("id").alias("v"))


def rows_read(df):
    """Rows that the scan handed on, after it skipped row groups."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return scan.metrics().get("numOutputRows").get().value()


def per_partition(df):
    found = df.select("key", F.spark_partition_id().alias("p")).groupBy("p").agg(F.min("key"), F.max("key"), F.count("*"))
    return sorted(tuple(r)[1:] for r in found.collect())


def test_a_prefix_reads_its_own_row_groups(spark, tmp_path):
    shuffled = keyed(spark).orderBy(F.xxhash64("key"))
    shuffled.repartition(8).write.parquet(str(tmp_path / "plain"))
    path = write_key_layout(shuffled, str(tmp_path / "sorted"), 8)
    plain, laid = (key_scan(spark.read.parquet(p), "k:003*") for p in (str(tmp_path / "plain"), path))
    assert rows(laid) == rows(plain) and laid.count() == 100
    assert rows_read(plain) == 8000
    assert rows_read(laid) <= 2500  # the range that holds the prefix, or two


def test_matches_come_in_ranges_of_the_key(spark):
    got = key_scan(keyed(spark), "k:0[0-3]*", partitions=4)
    assert got.rdd.getNumPartitions() == 4 and got.count() == 4000
    parts = per_partition(got)
    assert all(a[1] < b[0] for a, b in zip(parts, parts[1:]))
    assert max(p[2] for p in parts) < 1500
    assert key_scan(keyed(spark), "k:0000*", keys_only=True, partitions=2).columns == ["key"]


def test_a_hot_key_fills_several_ranges(spark, tmp_path):
    hot = keyed(spark, 4000).unionByName(spark.range(4000).select(F.lit("k:02000").alias("key"), (-F.col("id")).alias("v")))
    path = write_key_layout(hot, str(tmp_path / "hot"), 8)
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert sum(r[1] for r in files) == 8000 and max(r[1] for r in files) < 2000
    assert key_scan(spark.read.parquet(path), "k:02000").count() == 4001


def test_null_keys_maps_and_empty_tables(spark, tmp_path):
    df = spark.createDataFrame([(None, {"a": 1}), ("k:1", {"b": 2}), ("k:1", None)], "key string, m map<string,int>")
    path = write_key_layout(df, str(tmp_path / "maps"), 3)
    assert spark.read.parquet(path).count() == 3
    assert key_scan(spark.read.parquet(path), "k:*", partitions=2).count() == 2
    path = write_key_layout(df.limit(0), str(tmp_path / "none"), 3)
    assert key_scan(spark.read.schema(df.schema).parquet(path), "*").count() == 0
    with pytest.raises(ValueError):
        key_scan(df, "*", partitions=0)
