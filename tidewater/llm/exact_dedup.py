"""Exact dedup by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, quoted

WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of space and 0x09-0x0D becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _tagged(df: DataFrame, *keys: str) -> DataFrame:
    """A join key more, dropped after the join: what follows can't rely on the
    join's partitioning then, and AQE may split a join on a large group."""
    return df.withColumn("tag", F.xxhash64(*keys))


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", prefix: int = 64, digest: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id (doc_id of the row that stays),
    group_size, kept and full, the SHA-256 of the normalised text where it was
    needed, else null (or, under its own name, the column that ``digest`` names).

    Equal texts are those identical after ``normalised``. Rows are first grouped
    by normalised length, those whose length occurs twice by a hash of the first
    ``prefix`` characters, and only those whose length and prefix occur twice by
    the SHA-256 of the whole text. Without ``digest``, whole texts are read again
    for these rows alone. A caller that needs every text's SHA-256 anyway names
    its column in ``digest``; then no text is read twice or shuffled at all.

    Of equal texts, the row with the smallest doc_id stays. A null doc_id sorts
    after all others (keep_id is null if a group has nothing else). Of rows with
    the same doc_id and text, one stays. Null text counts as empty; empty texts
    are equal. Other columns are ignored; an empty table gives no rows. Counts
    and minima are reduced before each shuffle, so a group of a third of all rows
    sends one row per map task; joins of rows on such a group are skew joins,
    which AQE splits."""
    extra = [digest] if digest else []
    base = docs.select(
        quoted(key).cast("long").alias("doc_id"),
        normalised(quoted(text)).alias("norm"),
        *[quoted(c).alias("full") for c in extra],
    )
    signed = lambda df, *more: df.select("doc_id", *more, F.octet_length("norm").alias("len"), F.xxhash64(F.substring("norm", 1, prefix)).alias("head"))
    rows = checkpointed(signed(base, *(["full"] if digest else [])))

    # length, then prefix: counts of (len, head) are reduced before the shuffle
    counts = rows.groupBy("len", "head").agg(F.count("*").alias("c"))
    lengths = counts.groupBy("len").agg(F.sum("c").alias("c")).where("c > 1").select("len")
    heads = _tagged(counts.where("c > 1").select("len", "head").join(lengths, "len", "left_semi"), "len", "head")
    keys = ["tag", "len", "head"]
    if digest:
        surviving = _tagged(rows, "len", "head").join(heads, keys, "left_semi").select("doc_id", "len", "head", "full")
    else:
        again = _tagged(signed(base, "norm"), "len", "head")
        surviving = again.join(heads, keys, "left_semi").select("doc_id", "len", "head", F.sha2("norm", 256).alias("full"))
    # identical (doc_id, text) rows travel as one row and their number
    single = surviving.groupBy("doc_id", "len", "head", "full").agg(F.count("*").alias("m"))
    groups = (
        single.groupBy("len", "head", "full")
        .agg(F.min("doc_id").alias("keep_id"), F.sum("m").alias("group_size"))
        .where("group_size > 1")
    )
    joined = _tagged(single, "len", "head", "full").join(_tagged(groups, "len", "head", "full"), ["tag", "len", "head", "full"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        "full",
        F.explode(F.sequence(F.lit(1).cast("long"), "m")).alias("copy"),
    )
    kept = (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept")
    compared = joined.select("doc_id", "keep_id", "group_size", kept, "full")
    alone = _tagged(rows, "len", "head").join(heads, keys, "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        F.col("full") if digest else F.lit(None).cast("string").alias("full"),
    )
    out = alone.unionByName(compared)
    return out.withColumnRenamed("full", digest) if digest else out


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", prefix: int = 64) -> DataFrame:
    """``docs`` with all its columns and one row of each group of equal texts, by
    ``exact_groups``. Rows are dealt by text hash and doc_id together, so a large
    group of copies spreads over all tasks."""
    marks = (
        exact_groups(docs, key, text, prefix).where("group_size > 1")
        .groupBy("doc_id", "full").agg(F.max("kept").alias("stays"))
    )
    flag = lambda c: (F.coalesce(c, F.lit(0).cast("long")), c.isNull())
    k2, k3 = flag(F.col("doc_id"))
    marks = marks.select(F.col("full").alias("k1"), k2.alias("k2"), k3.alias("k3"), "stays")
    row = F.struct(*[quoted(c) for c in docs.columns])
    k2, k3 = flag(quoted(key).cast("long"))
    keyed = docs.select(F.sha2(normalised(quoted(text)), 256).alias("k1"), k2.alias("k2"), k3.alias("k3"), row.alias("row"))
    first = Window.partitionBy("k1", "k2", "k3").orderBy("k1")
    return (
        keyed.join(marks, ["k1", "k2", "k3"], "left")
        .where(F.coalesce("stays", F.lit(True)))
        .withColumn("nth", F.row_number().over(first)).where("nth = 1")
        .select("row.*")
    )
