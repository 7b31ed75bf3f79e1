"""Merges of a change set that is evaluated once.

``staged_changes`` removes duplicate keys and writes the change set to the shared
folder; every branch of the merge reads that copy, so a source that answers
differently each time it is read can neither lose nor double a key, and a lost
executor costs a re-read. The copy is deleted when the merge has been written.

``merge_staged`` is ``merge_state`` on such a copy. A bitmap of the change set's
keys first divides the target by a scan-side test: rows whose key is surely not in
the change set pass straight through, and only the others, about as many as the
change set has, are shuffled for a join. The bitmap has 16 bits for each changed
key and ``MAX_BITS`` bits at most (32 MB), so it may always be broadcast. A larger
change set fills a larger part of the bitmap: more rows are joined, with the same
result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .merge import (
    SaveMode,
    TableExistsError,
    align_to,
    any_key_null,
    check_incoming_columns,
    dedup_incoming,
    q,
    resolve_column,
    resolve_keys,
)

#: Bits of one bitmap row; fixed by ``bitmap_construct_agg``.
BUCKET_BITS = 4096 * 8
#: Bits of a whole key bitmap at most, and bits for each changed key.
MAX_BITS, BITS_PER_KEY = 1 << 28, 16

#: Key types whose equal values have equal hashes. Floating point has two zeros.
_HASHABLE = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType,
    T.TimestampType, T.TimestampNTZType, T.BooleanType, T.DecimalType, T.BinaryType,
)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder on whatever file system it is on."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).delete(where, True)


@contextmanager
def staged_changes(
    incoming: DataFrame,
    keys: str | Sequence[str] | None = None,
    order_by: str | Column | Sequence[str | Column] | None = None,
    keep: str | None = "last",
) -> Iterator[DataFrame]:
    """The change set with one row per complete key (``keep=None``: as it is),
    written once; the copy is gone after the ``with`` block, also on failure."""
    spark = incoming.sparkSession
    path = scratch_path(spark, "changes")
    names = incoming.columns
    numbers = {c: f"c{i}" for i, c in enumerate(names)}  # any name may stand in the copy's columns
    by = [order_by] if isinstance(order_by, (str, Column)) else list(order_by or [])
    if keep is None:
        plain = incoming.toDF(*numbers.values())
    elif all(isinstance(o, str) for o in by):
        plain = dedup_incoming(
            incoming.toDF(*numbers.values()), [numbers[k] for k in resolve_keys(incoming, keys)],
            [numbers[resolve_column(incoming, o)] for o in by], keep,
        )
    else:
        plain = dedup_incoming(incoming, keys, order_by, keep).toDF(*numbers.values())
    try:
        plain.write.parquet(path)
        yield spark.read.schema(plain.schema).parquet(path).toDF(*names)
    finally:
        remove_path(spark, path)


def hashable(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether equal keys hash alike (no floating point, nested or collated keys)."""
    types = [df.schema[k].dataType for k in keys]
    plain = {T.StringType().simpleString(), *("varchar", "char")}
    return all(isinstance(t, _HASHABLE) and (not isinstance(t, T.StringType) or t.simpleString().split("(")[0] in plain) for t in types)


def bitmap_bits(n_keys: int) -> int:
    """A power of two: ``BITS_PER_KEY`` for each key, one bucket at least and
    ``MAX_BITS`` at most."""
    return min(MAX_BITS, max(BUCKET_BITS, 1 << max(0, n_keys * BITS_PER_KEY - 1).bit_length()))


def _place(keys: Sequence[str], bits: int) -> Column:
    return F.expr(f"pmod(xxhash64({', '.join(map(q, keys))}), {bits}L)")


def key_bitmap(changes: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """(bucket, bitmap) of the hashed keys; ``bits / 8`` bytes at most in all."""
    place = _place(keys, bits)
    return changes.filter(~any_key_null(keys)).groupBy((place / BUCKET_BITS).cast("long").alias("bucket")).agg(
        F.bitmap_construct_agg(place % BUCKET_BITS).alias("bitmap")
    )


def split_by_bitmap(target: DataFrame, keys: Sequence[str], bitmap: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """``(rows whose key may be in the bitmap, rows whose key is not)``; no shuffle.
    Rows with a NULL key part are in neither."""
    cols = [F.col(f"`_t{i}`").alias(c) for i, c in enumerate(target.columns)]
    place = _place(keys, bits)
    rows = target.filter(~any_key_null(keys))
    tagged = rows.select(
        *[F.col(q(c)).alias(f"_t{i}") for i, c in enumerate(rows.columns)],
        (place / BUCKET_BITS).cast("long").alias("_bucket"), (place % BUCKET_BITS).cast("int").alias("_bit"),
    )
    small = F.broadcast(bitmap.select(F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap")))
    held = "shiftright(cast(conv(hex(substring(_bitmap, _bit div 8 + 1, 1)), 16, 10) as int), _bit % 8) & 1 = 1"
    joined = tagged.join(small, "_bucket", "left").withColumn("_held", F.coalesce(F.expr(held), F.lit(False)))
    return joined.filter("_held").select(*cols), joined.filter("NOT _held").select(*cols)


def merge_staged(
    target: DataFrame | None,
    changes: DataFrame,
    mode: SaveMode | str,
    keys: str | Sequence[str] | None = None,
    bits: int | None = None,
) -> DataFrame:
    """``merge_state`` for a change set without duplicate keys that is cheap and safe
    to read several times (``staged_changes``). Keys that do not hash by value, and
    modes without keys, take ``merge_state``'s own plan."""
    from .merge import merge_state

    mode = SaveMode.coerce(mode)
    if target is None or not mode.keyed:
        return merge_state(target, changes, mode, keys=keys, dedup=False)
    covered = check_incoming_columns(target, changes)
    keys = resolve_keys(target, keys if keys is not None else [changes.columns[0]])
    if not set(keys) <= set(covered) or not hashable(target, keys):
        return merge_state(target, changes, mode, keys=keys, dedup=False)
    changes = changes.toDF(*covered)
    cast = changes.select(*[F.col(q(c)).cast(target.schema[c].dataType).alias(c) for c in covered])
    # a key that changes when cast could meet another: leave such keys to the plain plan
    if any(target.schema[k].dataType != changes.schema[k].dataType for k in keys):
        return merge_state(target, changes, mode, keys=keys, dedup=False)
    if bits is None:
        bits = bitmap_bits(cast.count())
    maybe, never = split_by_bitmap(target, keys, key_bitmap(cast, keys, bits), bits)
    null_keyed = target.filter(any_key_null(keys))
    if mode is SaveMode.IGNORE_RECORD:
        # new rows are those whose key no target row has; only rows that may have one are asked
        complete = cast.filter(~any_key_null(keys))
        fresh = complete.join(maybe.select(*map(q, keys)), keys, "left_anti")
        rows = fresh.select(*map(q, cast.columns)).unionByName(cast.filter(any_key_null(keys)))
        return target.unionByName(align_to(target.schema, rows))
    merged = merge_state(maybe, cast, mode, keys=keys, dedup=False)
    return never.unionByName(null_keyed).unionByName(merged)


def merge_once(
    target: DataFrame | None,
    incoming: DataFrame,
    mode: SaveMode | str,
    write,
    keys: str | Sequence[str] | None = None,
    order_by: str | Column | Sequence[str | Column] | None = None,
    dedup: bool = True,
):
    """Stage ``incoming``, merge it and pass the new state to ``write``; returns what
    ``write`` returns. The change set is evaluated once."""
    mode = SaveMode.coerce(mode)
    if target is not None and mode is SaveMode.ERROR_IF_EXISTS:
        raise TableExistsError("target table already exists")
    if target is not None and mode.keyed:
        check_incoming_columns(target, incoming)
        named = resolve_keys(target, keys if keys is not None else [incoming.columns[0]])
        own = [resolve_column(incoming, k) for k in named]
    else:
        own = resolve_keys(incoming, keys) if mode.keyed else None
    keep = ("last" if mode is SaveMode.UPSERT else "first") if mode.keyed and dedup else None
    with staged_changes(incoming, own, order_by, keep) as changes:
        return write(merge_staged(target, changes, mode, keys))
