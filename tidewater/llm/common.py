"""Helpers shared by the operators of this package.

Text crosses into Python as UTF-8 bytes inside Arrow batches. Words are the
maximal runs outside space and 0x09-0x0D, which is what ``bytes.split()`` cuts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidewater.session import bounded_batches, checkpoint_dir

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
U64 = np.uint64


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def two_columns(df: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id`` and ``text`` alone, whatever else the table has. Texts go to Python in
    Arrow batches of bounded bytes."""
    bounded_batches(df.sparkSession)
    return df.select(quoted(key).cast("long").alias("doc_id"), quoted(text).alias("text"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared checkpoint folder; lost executors then cost
    a re-read and not a re-run."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def map_rows(df: DataFrame, run, *more: StructField) -> DataFrame:
    """``mapInArrow`` that returns all columns of ``df``, and ``more`` after them.
    Columns are numbered meanwhile, since it takes no names with dots in them. Rows go
    in Arrow batches of bounded bytes."""
    bounded_batches(df.sparkSession)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(run, StructType([*plain.schema.fields, *more])).toDF(*df.columns, *[f.name for f in more])


def words_of(text: bytes | None, lower: bool = False) -> list[bytes]:
    if not text:
        return []
    return (text.translate(LOWER) if lower else text).split()


class WordHash(dict):
    """word -> 64-bit hash, remembered up to ``limit`` words."""

    def __init__(self, limit: int = 1 << 16):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), element by element."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def shingle_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` words; a shorter text is one shingle."""
    if not len(h):
        return h
    n = min(n, len(h))
    m = len(h) - n + 1
    s = np.full(m, n, U64)
    for k in range(n):
        s = mix64(s * U64(0x9E3779B97F4A7C15) + h[k : k + m])
    return s


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(size, b, U64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=U64))
        return self.up[:n], self.down[:n]


class Windows:
    """Hash of every run of ``n`` words from prefix sums, O(1) a position."""

    def __init__(self, base: int):
        self.powers = Powers(base | 1)

    def at(self, h: np.ndarray, n: int) -> np.ndarray:
        m = len(h) - n + 1
        if m < 1:
            return np.empty(0, U64)
        up, down = self.powers.upto(len(h) + 1)
        sums = np.zeros(len(h) + 1, U64)
        np.cumsum(h * up[: len(h)], out=sums[1:])
        return mix64((sums[n:] - sums[:m]) * down[:m])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def join_counted(rows: DataFrame, table: DataFrame, key: str, total: int, share: int = 1024) -> DataFrame:
    """``rows`` joined with ``table`` on ``key``, where ``table`` has one row a key and
    the key's ``count`` in ``rows``, of ``total`` rows. Keys with more than
    1 / share of all rows are fewer than ``share``: those are broadcast and their rows
    stay where they are; the others are joined as usual."""
    hot = F.col("count") > total / share
    few, many = table.where(hot).drop("count"), table.where(~hot).drop("count")
    if few.isEmpty():
        return rows.join(many, key)
    cold = rows.join(F.broadcast(few.select(key)), key, "left_anti")
    return rows.join(F.broadcast(few), key).unionByName(cold.join(many, key))


def runs(batches: Iterator, keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Groups of equal, adjacent ``keys`` from sorted Arrow batches, as columns;
    a group that spans batches is joined. Only for groups of bounded size."""
    import pyarrow as pa

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        change = np.zeros(table.num_rows, bool)
        for k in keys:
            v = table.column(k).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cuts = np.flatnonzero(change)
        last = int(cuts[-1]) if len(cuts) else 0
        start = 0
        if last:
            columns = {c: table.column(c).slice(0, last).to_numpy() for c in table.column_names}
            for cut in cuts:
                yield {c: v[start:cut] for c, v in columns.items()}
                start = int(cut)
        held = table.slice(last)
    if held is not None and held.num_rows:
        yield {c: held.column(c).to_numpy() for c in held.column_names}
