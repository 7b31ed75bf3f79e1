"""Splits by rows: JDBC predicates and hash layouts."""

import datetime as dt
import decimal
import glob

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tidewater.plans.layout import SHARD_COL, hash_layout, shards_for, write_hash_layout
from tidewater.sources import jdbc
from tidewater.sources.endpoint import Endpoint

PG = Endpoint.postgres("localhost:5432", "db", "u", "p")


@pytest.mark.parametrize("column, skew", [("l_orderkey", 0.1), ("l_shipdate", 0.1), ("l_extendedprice", 0.1), ("l_quantity", 1.0)])
def test_every_row_falls_in_one_part(spark, column, skew):
    table = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    table.withColumn(column, F.when(F.xxhash64("l_orderkey", "l_linenumber") % 50 != 0, F.col(column))).createOrReplaceTempView("split_source")
    last = sorted(r["hi"] for r in spark.sql(jdbc.quantile_query("split_source", column, 6)).collect())
    parts = jdbc.quantile_predicates(column, last)
    view = spark.table("split_source")
    counts = view.agg(*[F.count(F.when(F.expr(p), 1)).alias(f"p{i}") for i, p in enumerate(parts)]).first()
    held = F.expr(" + ".join(f"CAST(COALESCE({p}, FALSE) AS INT)" for p in parts))
    assert view.filter(held != 1).count() == 0
    *full, nulls = counts
    assert nulls == view.filter(F.col(column).isNull()).count() and sum(counts) == view.count()
    assert len(full) == 6 and max(full) <= (1 + skew) * sum(full) / 6


def test_predicates_of_ties_and_types():
    P = jdbc.quantile_predicates
    assert P("k", [3, 3, 3, 9]) == ["k <= 3", "k > 3", "k IS NULL"]
    assert P("k", []) == ["k IS NOT NULL", "k IS NULL"] or P("k", [])[-1] == "k IS NULL"
    assert P("k", [5]) == ["k IS NOT NULL", "k IS NULL"]
    assert P("s", ["a'b", "z"]) == ["s <= 'a''b'", "s > 'a''b'", "s IS NULL"]
    assert jdbc.sql_literal(dt.date(2024, 1, 2)) == "DATE '2024-01-02'" and jdbc.sql_literal(decimal.Decimal("1.50")) == "1.50"
    assert jdbc.sql_literal(dt.datetime(2024, 1, 2, 3)) == "TIMESTAMP '2024-01-02 03:00:00'"
    with pytest.raises(TypeError):
        jdbc.sql_literal(b"x")


def test_partitions_need_something_to_split_on(spark):
    with pytest.raises(ValueError, match="partition_column"):
        jdbc.read_jdbc(spark, PG, "t", num_partitions=4)
    with pytest.raises(ValueError, match="split"):
        jdbc.read_jdbc(spark, PG, "t", partition_column="k", split="depth")


class Reader:
    """Stands for ``spark.read`` and records the split."""

    def __init__(self):
        self.read, self.calls = self, []

    def jdbc(self, url, table, predicates, properties):
        self.calls.append((table, predicates))

    def format(self, kind):
        return self

    def options(self, **options):
        self.calls.append(options)
        return self

    def load(self):
        return None


def test_reads_are_split_by_rows_unless_bounds_are_given(monkeypatch):
    reader = Reader()
    monkeypatch.setattr(jdbc, "quantiles", lambda spark, endpoint, table, column, n: list(range(10, 10 * n + 1, 10)))
    jdbc.read_jdbc(reader, PG, "t", num_partitions=3, partition_column="k")
    jdbc.read_jdbc(reader, PG, "t", num_partitions=3, partition_column="k", lower_bound=1, upper_bound=9)
    assert reader.calls[0] == ("t", ["k <= 10", "k > 10 AND k <= 20", "k > 20", "k IS NULL"])
    assert reader.calls[1]["lowerBound"] == "1" and reader.calls[1]["numPartitions"] == "3"


def test_a_hot_key_is_written_by_many_tasks(spark, tmp_path):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("a.b"))
    path = write_hash_layout(df, str(tmp_path / "h"), "k", 6, rows_per_task=500)
    back = spark.read.parquet(path)
    assert rows(back.drop(SHARD_COL).select("k", F.col("`a.b`"))) == rows(df)
    hot = back.filter("k = 7").select(SHARD_COL).distinct().collect()
    assert len(hot) == 1
    files = {s: len(glob.glob(f"{tmp_path}/h/{SHARD_COL}={s}/*.parquet")) for s in range(6)}
    assert files[hot[0][0]] >= 4 and len({r["k"] for r in back.select("k").distinct().collect()}) == df.select("k").distinct().count()
    per_key = back.groupBy("k").agg(F.count_distinct(SHARD_COL).alias("n")).filter("n > 1")
    assert per_key.count() == 0


def test_layout_arguments(spark):
    df = spark.range(10).toDF("k")
    assert shards_for(df, 3) == 4 and shards_for(df.limit(0), 3) == 1
    for bad in ({"n": 0}, {"n": 2, "spread": 0}, {"n": 2, "rows_per_task": 0}, {"n": 2, "spread": 2, "rows_per_task": 2}):
        with pytest.raises(ValueError):
            hash_layout(df, "k", **bad)
    with pytest.raises(ValueError):
        shards_for(df, 0)
    assert rows(hash_layout(df, "k", 3).select("k")) == rows(df) == rows(hash_layout(df, "k", 3, rows_per_task=2).select("k"))
