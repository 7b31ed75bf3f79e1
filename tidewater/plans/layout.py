"""Partition and file layout control.

* ``cap_partitions`` - limit write parallelism (e.g. open DB connections).
* ``hash_layout`` / ``write_hash_layout`` - hash-shard a table by a key into a
  fixed number of shards, one directory per shard, so later readers of one
  shard (or a key lookup) touch one directory.
* ``read_split_conf`` - the file-split size that decides scan parallelism.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_COL = "shard"


def cap_partitions(df: DataFrame, n: int | None, shuffle: bool = True) -> DataFrame:
    """Write with ``n`` tasks (e.g. to cap open database connections).

    ``shuffle=False`` is ``coalesce(n)``: no shuffle and never more partitions
    than before, but it also narrows everything upstream in the same stage to
    ``n`` tasks. The default ``repartition(n)`` keeps the upstream work at full
    width and pays one shuffle of the (usually already reduced) output.

    The current partition count is deliberately not inspected: under AQE that
    would run the upstream shuffle stages once just to count.
    """
    if n is None:
        return df
    if n < 1:
        raise ValueError("partition cap must be >= 1")
    return df.repartition(n) if shuffle else df.coalesce(n)


def shard_of(keys: Sequence[str], n: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n)).cast("int")


def shards_for(df: DataFrame, rows_per_shard: int) -> int:
    """Number of shards that hold about ``rows_per_shard`` rows each."""
    if rows_per_shard < 1:
        raise ValueError("rows_per_shard must be >= 1")
    return max(1, -(-df.count() // rows_per_shard))


def shard_spreads(df: DataFrame, keys: Sequence[str], n: int, rows_per_task: int) -> DataFrame:
    """(shard, spread): how many tasks a shard needs at ``rows_per_task`` rows each,
    from one count by shard. One row a shard, however many rows a key has."""
    counts = df.groupBy(shard_of(keys, n).alias(SHARD_COL)).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.select(SHARD_COL, F.ceil(F.col("_rows") / F.lit(rows_per_task)).cast("int").alias("_spread"))


def hash_layout(
    df: DataFrame, keys: str | Sequence[str], n: int, spread: int | None = None, rows_per_task: int | None = None
) -> DataFrame:
    """Add ``shard = pmod(xxhash64(keys), n)`` and cluster rows by shard. Rows never
    move between shards, whichever tasks write them.

    * By default Spark's ``rebalance`` decides: AQE packs small shards into one task
      and splits one that is over the advisory partition size, so a key that holds a
      large share of the rows is written by many tasks.
    * ``rows_per_task`` counts the rows of each shard first (one aggregate, combined
      before its shuffle) and deals a shard to as many tasks as it needs, by a hash
      of the whole row: repeatable, and independent of AQE.
    * ``spread`` deals every shard to that many tasks.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if n < 1 or (spread is not None and spread < 1) or (rows_per_task is not None and rows_per_task < 1):
        raise ValueError("n, spread and rows_per_task must be >= 1")
    if spread is not None and rows_per_task is not None:
        raise ValueError("give spread or rows_per_task, not both")
    out = df.withColumn(SHARD_COL, shard_of(keys, n))
    if spread == 1:
        return out.repartition(n, SHARD_COL)
    salt = F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])
    if spread is not None:
        return out.repartition(n * spread, F.col(SHARD_COL), F.pmod(salt, F.lit(spread)))
    if rows_per_task is None:
        return out.hint("rebalance", SHARD_COL)
    spreads = shard_spreads(df, keys, n, rows_per_task)
    tasks = spreads.agg(F.sum("_spread")).first()[0] or 1  # one row; a count of tasks, so AQE leaves them as they are
    dealt = out.join(spreads, SHARD_COL, "left")
    dealt = dealt.withColumn("_part", F.pmod(salt, F.coalesce(F.col("_spread"), F.lit(1))))
    return dealt.repartition(int(tasks), F.col(SHARD_COL), F.col("_part")).select(*[F.col("`" + c.replace("`", "``") + "`") for c in out.columns])


def write_hash_layout(
    df: DataFrame, path: str, keys: str | Sequence[str], n: int, spread: int | None = None,
    mode: str = "errorifexists", rows_per_task: int | None = None,
) -> str:
    hash_layout(df, keys, n, spread, rows_per_task).write.mode(mode).partitionBy(SHARD_COL).parquet(path)
    return path


def read_shard(spark, path: str, shard: int) -> DataFrame:
    """One shard of a hash layout (partition pruning skips the others)."""
    return spark.read.parquet(path).filter(F.col(SHARD_COL) == shard)


def read_split_conf(split_mb: int = 1024) -> dict[str, str]:
    """Session settings for the scan split size (the original reads used 1024 MB)."""
    return {"spark.sql.files.maxPartitionBytes": f"{split_mb}m"}
