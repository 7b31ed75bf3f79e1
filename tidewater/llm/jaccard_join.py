"""N-gram Jaccard join by parity sketches.

A set's parity sketch flips one position for each of its tokens, so the Hamming
distance of two sketches is at most the size of the sets' symmetric difference, D.
A similarity of num/den keeps D at (a + b)(den - num)/(den + num) or less, for sets
of a and b tokens, and a at num/den of b or more.

1. Equal texts become one class. A class is listed in the band of its size, and in
   the next one if a set linked with it can be there. A band cuts its sketch, one of
   so many positions that tokens hardly share any, into segments; a segment is known
   by the XOR of its tokens' 64-bit hashes. At most D segments differ, so sets that
   link agree in one of the first D + 1 segments that are not empty in either: a
   class lists that many (its own D, for its largest partner). A set that fills too
   few, a small one mostly, also lists each of its tokens, and so meets its like.
2. Classes of one list meet its most central member and a few random ones. Pairs are
   tested by size and by the Hamming distance of short bit sketches, 1 to 2 bits for
   each token, then of dense ones, 4 to 8 bits, then exactly on the words of both whole
   texts.
3. Lists whose members are not all in one component are compared within tasks, in
   pairs of blocks of bounded bytes, by their short sketches; pairs of different
   components that pass are tested and verified as the others are. No list is capped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.staged import bitmap_bits, key_bitmap, split_by_bitmap
from tidewater.session import scratch_path

from .common import U64, WordHash, join_counted, mix64, quoted, runs, shingle_hashes, signed, two_columns, words_of
from .components import connected_components

#: Bytes of short sketches in one block of a list.
BLOCK_BYTES = 1 << 20
#: Bytes of a short sketch at least, if the sketch has as many.
SHORT_BYTES = 16
#: Bits of a list's key.
KEY_BITS = 48
#: Rows of a hot pair side that share a copy of its text.
SHARE = 256


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: a lost executor costs a
    re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Bands:
    """Size bands: linked sets are in one band or in neighbouring ones."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.low = [1]
        # tokens a segment, so that more segments are filled than sets may differ in
        share = 1.15 * (1 + den / num) * (den - num) / (den + num)
        self.fill = 8.0
        while self.fill > 0.1 and (1 - np.exp(-self.fill)) / self.fill < share:
            self.fill *= 0.98

    def of(self, n: int) -> int:
        while self.low[-1] <= n:
            lo = self.low[-1]
            self.low.append(max(lo + 1, -(-8 * lo // 5), -(-lo * self.den // self.num)))
        return int(np.searchsorted(self.low, n, side="right")) - 1

    def largest_partner(self, n: int) -> int:
        return n * self.den // self.num

    def difference(self, a, b):
        """Most tokens that linked sets of a and b tokens can differ in."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def listings(self, n: int):
        """(band, segments, number of them to list) for a set of n tokens."""
        own = self.of(n)
        bands = [own]
        if self.of(self.largest_partner(n)) > own:
            bands.append(own + 1)
        for band in bands:
            self.of(self.low[band])  # the next band's edge
            top = self.low[band + 1] - 1
            yield band, int(np.ceil(top / self.fill)), self.difference(n, min(top, self.largest_partner(n))) + 1


def segment_keys(values: np.ndarray, bands: Bands) -> np.ndarray:
    """Keys of the lists that a set of distinct 64-bit tokens is in, ``KEY_BITS`` of a hash
    each: lists that fall together only mean more pairs to test."""
    out = []
    prints = mix64(values ^ U64(0xA24BAED4963EE407))
    if not len(values):
        return values
    place = mix64(values + U64(0x9E3779B97F4A7C15))
    for band, segments, wanted in bands.listings(len(values)):
        segment = ((place >> U64(32)) * U64(segments)) >> U64(32)
        order = np.argsort(segment, kind="stable")
        segment = segment[order]
        first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        mixed = np.bitwise_xor.reduceat(prints[order], first)
        out.append(mix64(mixed ^ mix64(segment[first] + U64(band << 40)))[:wanted])
        if len(first) < wanted:
            out.append(mix64(prints ^ mix64(np.full(1, (band << 40) | (1 << 39), U64))))
    return np.unique(np.concatenate(out) >> U64(64 - KEY_BITS))


def bit_sketch(values: np.ndarray) -> bytes:
    """Parity of the tokens at each of 4 to 8 bits a token, a power of two of them
    and 64 at least."""
    bits = max(64, 1 << (4 * len(values) - 1).bit_length())
    place = (mix64(values ^ U64(0xD1B54A32D192ED03)) & U64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits) & 1, bitorder="little").tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch of ``size`` bytes: parities of places that fall together."""
    x = np.frombuffer(sketch, U64)
    while 8 * len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def short_sketch(sketch: bytes) -> bytes:
    """A quarter of the sketch, 1 to 2 bits a token: tells most sets apart that do not
    link, and never two that do."""
    return folded(sketch, max(SHORT_BYTES, len(sketch) // 4)).tobytes()


def distance(x: bytes, y: bytes) -> int:
    size = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())


def _digests(docs: DataFrame, n: int) -> DataFrame:
    """doc_id and digest (of the lower-cased words; null without words) of every row.
    ``n_shingles`` is set where no class gives it: no words, or no doc_id."""

    def run(batches):
        hashes = WordHash()
        for batch in batches:
            digests, sizes = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text, lower=True)
                digests.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                sizes.append(0 if not words else None if key is not None else len(np.unique(shingle_hashes(hashes.array(words), n))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64())], names=["doc_id", "digest", "n_shingles"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, digest binary, n_shingles long")


def _may_have(rows: DataFrame, key: str, ids: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """``(rows whose key may be in ids, rows whose key is not)`` by a broadcast bitmap
    of the ids, 32 MB at most: where ids outgrow it, more rows are in the first part."""
    bits = bitmap_bits(most)
    return split_by_bitmap(rows, [key], key_bitmap(ids, [key], bits), bits)


def _texts(docs: DataFrame, nodes: DataFrame, classes: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """rep, n, dense and short sketch, list keys and text of each class, once: one pass cuts a
    text's words and hashes its shingles for all of them.

    A row whose doc_id has no other row, and whose text is in no smaller one, stands
    for its class and stays where it is; the rest are joined with the classes."""
    heads = classes.select(F.col("rep").alias("doc_id"), "digest", "times")
    others = nodes.join(heads, ["doc_id", "digest"], "left_anti").select("doc_id")
    several = nodes.groupBy("doc_id").agg(F.sum("times").alias("rows")).where("rows > 1").select("doc_id")
    others = written(others.unionByName(several), "jaccard-others")
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    rest, alone = _may_have(rows, "doc_id", others, others.count())
    out = _sketched(alone.select("doc_id", F.lit(None).cast("binary").alias("digest"), "text"), n, num, den)
    rest = rest.join(heads, "doc_id").select("doc_id", "digest", "text", "times")
    out = out.unionByName(_sketched(rest.where("times = 1").drop("times"), n, num, den))
    if not classes.where("times > 1").isEmpty():  # a doc_id that has this text in several rows
        out = out.unionByName(_sketched(rest.where("times > 1").drop("times"), n, num, den).dropDuplicates(["rep", "digest"]))
    return out


def _sketched(rows: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Dense sketches and list keys of rows whose text has the class's digest; a
    doc_id may have other texts too. A null digest stands for any text with words.
    Rows are handed on for each ``BLOCK_BYTES`` of
    text and keys, so a task holds little more than its longest text."""
    names = ["rep", "digest", "n", "sketch", "short", "text"]
    types = (pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary())

    def batch_of(out, keys):
        ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        values = pa.array(signed(np.concatenate([np.empty(0, U64), *keys])))
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(out, types)), pa.ListArray.from_arrays(pa.array(ends), values)], names=[*names, "keys"])

    def run(batches):
        hashes, bands = WordHash(), Bands(num, den)
        for batch in batches:
            out, keys, held = [[] for _ in names], [], 0
            for rep, digest, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text, lower=True)
                own = xxhash.xxh3_128_digest(b" ".join(words))
                if not words or digest not in (None, own):
                    continue
                values = np.unique(shingle_hashes(hashes.array(words), n))
                sketch = bit_sketch(values)
                for column, v in zip(out, (rep, own, len(values), sketch, short_sketch(sketch), text)):
                    column.append(v)
                keys.append(segment_keys(values, bands))
                held += len(text) + keys[-1].nbytes
                if held > BLOCK_BYTES:
                    yield batch_of(out, keys)
                    out, keys, held = [[] for _ in names], [], 0
            if keys:
                yield batch_of(out, keys)

    return rows.mapInArrow(run, "rep long, digest binary, n long, sketch binary, short binary, text binary, keys array<long>")


def _shared(keys: DataFrame) -> DataFrame:
    """Entries whose key another class has too. Keys are sorted, so the entry at
    hand and its neighbours are all that a task holds."""

    def run(batches):
        held = None  # the last entry, and whether its key came before it
        for batch in batches:
            key, rep = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(key):
                continue
            before = False
            if held:
                key, rep, before = np.append(held[0], key), np.append(held[1], rep), held[2]
            same = key[1:] == key[:-1]
            keep = np.append(before, same) | np.append(same, False)
            held = (key[-1:], rep[-1:], bool(keep[-1]))
            keep[-1] = False
            yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(rep[keep])], names=["key", "rep"])
        if held and held[2]:
            yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], names=["key", "rep"])

    return keys.repartition("key").sortWithinPartitions("key").mapInArrow(run, "key long, rep long")


def _sides(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """(a, b) with the named columns of both sides, as a_<name> and b_<name>. A class
    in very many pairs gets a copy of its row for each ``SHARE`` of them, dealt by
    the other side, so no task holds all pairs of a class. Rows of classes in no pair
    are left out before the shuffle."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("rep"))
    table, _ = _may_have(table.select("rep", *columns), "rep", ids, 2 * pairs.count())
    sides = [("a", "b"), ("b", "a")]
    dealt, copies = pairs, {}
    for c, other in sides:
        copies[c] = pairs.groupBy(c).agg(F.ceil(F.count("*") / SHARE).cast("int").alias("copies")).where("copies > 1")
        dealt = dealt.join(copies[c], c, "left")
        dealt = dealt.withColumn(f"copy_{c}", F.coalesce(F.pmod(F.xxhash64(other), F.col("copies")).cast("int"), F.lit(0))).drop("copies")
    for c, _ in sides:
        rows = table.select(F.col("rep").alias(c), *[F.col(x).alias(f"{c}_{x}") for x in columns]).join(copies[c], c, "left")
        rows = rows.withColumn(f"copy_{c}", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).drop("copies")
        dealt = dealt.join(rows, [c, f"copy_{c}"])
    return dealt


def _verified(pairs: DataFrame, texts: DataFrame, n: int, num: int, den: int, sketches: tuple[str, ...] = ("short", "sketch")) -> DataFrame:
    """Of the pairs (a, b), those whose ``sketches``, in turn, and then whole sets link."""
    bands = Bands(num, den)

    def near(batches):
        for batch in batches:
            keep = [
                den * min(na, nb) >= num * max(na, nb) and distance(sa, sb) <= bands.difference(na, nb)
                for na, nb, sa, sb in zip(*(batch.column(c).to_pylist() for c in ("a_n", "b_n", "a_bits", "b_bits")))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def shingles(text):
        w = words_of(text, lower=True)
        m = min(n, len(w))
        return {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if w else set()

    def link(batches):
        last, known = None, None
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column("a_text").to_pylist(), batch.column("b_text").to_pylist()):
                if ta != last:
                    last, known = ta, shingles(ta)
                other = shingles(tb)
                both = len(known & other)
                keep.append(both > 0 and den * both >= num * (len(known) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = written(pairs, "jaccard-pairs")
    for sketch in sketches:
        bits = texts.select("rep", "n", F.col(sketch).alias("bits"))
        pairs = written(_sides(pairs, bits, "n", "bits").mapInArrow(near, "a long, b long").distinct(), "jaccard-likely")
    rows = _sides(pairs, texts, "text").sortWithinPartitions("a")
    return written(rows.mapInArrow(link, "a long, b long").distinct(), "jaccard-links")


def _pairs_of(entries: DataFrame, heads: DataFrame, on: list[str]) -> DataFrame:
    met = entries.join(heads, on).where("rep != head")
    return met.select(F.least("rep", "head").alias("a"), F.greatest("rep", "head").alias("b"))


def _meetings(lists: DataFrame, turns: int) -> DataFrame:
    """Pairs (a, b): each class with the centre of its lists, the member in most
    lists, and with a random member of a part of each of its first ``turns`` ones."""
    often = lists.groupBy("rep").agg(F.count("*").alias("w"), F.expr(f"slice(array_sort(collect_list(key)), 1, {max(1, turns)})").alias("own"))
    often = written(often, "jaccard-often")
    centres = lists.join(often.select("rep", "w"), "rep").groupBy("key").agg(F.max(F.struct("w", (-F.col("rep")).alias("r"))).alias("c"), F.count("*").alias("members"))
    centres = written(centres.select("key", "members", (-F.col("c.r")).alias("head")), "jaccard-centres")
    pairs = _pairs_of(lists, centres.select("key", "head"), ["key"])
    for turn in range(turns):
        own = often.where(F.size("own") > turn).select("rep", F.col("own")[turn].alias("key")).join(centres.where("members > 2").select("key", "members"), "key")
        own = own.withColumn("part", F.pmod(F.xxhash64("rep", F.lit(turn)), F.ceil(F.col("members") / 16)))
        heads = own.groupBy("key", "part").agg(F.min(F.struct(F.xxhash64("rep", F.lit(-1 - turn)).alias("h"), "rep")).alias("c")).select("key", "part", F.col("c.rep").alias("head"))
        pairs = pairs.unionByName(_pairs_of(own.select("rep", "key", "part"), heads, ["key", "part"]))
    return pairs.distinct()


def _open_pairs(lists: DataFrame, texts: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of different labels in one list that pass the short sketches."""
    own = lists.join(labels, F.col("rep") == F.col("node"), "left").select("key", "rep", F.coalesce("label", "rep").alias("label"))
    sketches = texts.select("rep", "n", "short")
    sizes = own.join(sketches.select("rep", F.length("short").alias("bytes")), "rep").groupBy("key").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("members"), F.ceil(F.sum("bytes") / BLOCK_BYTES).cast("int").alias("blocks")
    )
    still = written(own.join(sizes.where("lo != hi AND members > 2").select("key", "blocks"), "key"), "jaccard-open")
    placed = still.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "label", "block")
    bands = Bands(num, den)

    def run(batches):
        for g in runs(batches, ["key", "i", "j"]):
            label, n, rep, block = g["label"], g["n"], g["rep"], g["block"]
            if len(rep) < 2 or (label == label[0]).all():
                continue
            size = min(map(len, g["short"]))
            bits = np.stack([folded(s, size) for s in g["short"]])
            # every pair of two labels has a member outside the largest label
            names, held = np.unique(label, return_counts=True)
            outside = label != names[held.argmax()]
            rows = np.flatnonzero(outside)
            step = max(1, (1 << 21) // bits.size)
            out = []
            for a in range(0, len(rows), step):
                r = rows[a : a + step]
                good = label[r][:, None] != label[None, :]
                good &= den * np.minimum(n[r][:, None], n[None, :]) >= num * np.maximum(n[r][:, None], n[None, :])
                good &= ~outside[None, :] | (r[:, None] < np.arange(len(rep))[None, :])
                if g["i"][0] != g["j"][0]:
                    good &= block[r][:, None] != block[None, :]
                x, y = np.nonzero(good)
                for c in range(0, len(x), 1 << 14):
                    p, q = r[x[c : c + (1 << 14)]], y[c : c + (1 << 14)]
                    far = np.bitwise_count(bits[p] ^ bits[q]).sum(axis=1, dtype=np.int64)
                    near = far <= bands.difference(n[p], n[q])
                    out.append(np.stack([np.minimum(rep[p], rep[q])[near], np.maximum(rep[p], rep[q])[near]]))
            if out:
                a, b = np.concatenate(out, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    keyed = placed.join(sketches, "rep").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return keyed.mapInArrow(run, "a long, b long").where("a != b").distinct()


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, num: int = 80, den: int = 100, meetings: int = 3
) -> DataFrame:
    """Components of texts with ``den * |A & B| >= num * |A | B|`` over distinct
    ``n``-word shingles (A-Z lower-cased; fewer words: the whole sequence).

    Returns one row per input row: doc_id, n_shingles and component_id (smallest
    doc_id that can be reached by links, itself included).

    Null or empty text, or white space alone: no shingles, linked with nothing. A
    null doc_id has no order: such a row is linked with nothing and has a null
    component_id. Rows that share a doc_id are one node, whatever their texts. Equal
    rows give equal rows. Other columns are ignored; an empty table gives no rows.
    Texts are taken whole at any length; a task holds one text's set at a time."""
    docs = two_columns(docs, key, text)
    base = written(_digests(docs, n), "jaccard-rows")
    nodes = written(base.where("doc_id IS NOT NULL AND digest IS NOT NULL").groupBy("digest", "doc_id").agg(F.count("*").alias("times")), "jaccard-nodes")
    classes = nodes.groupBy("digest").agg(F.min(F.struct("doc_id", "times")).alias("r"), F.count("*").alias("count"))
    classes = written(classes.select("digest", F.col("r.doc_id").alias("rep"), F.col("r.times").alias("times"), "count"), "jaccard-classes")
    texts = written(_texts(docs.where("doc_id IS NOT NULL"), nodes, classes, n, num, den), "jaccard-texts")
    lists = written(_shared(texts.select(F.explode("keys").alias("key"), "rep")), "jaccard-lists")
    links = _verified(_meetings(lists, meetings), texts, n, num, den)
    labels = connected_components(links)
    more = _verified(_open_pairs(lists, texts, labels, num, den), texts, n, num, den, ("sketch",))

    sized = classes.select("digest", "rep", "count").join(texts.select("digest", "n"), "digest")
    held_by = written(join_counted(nodes.select("doc_id", "digest"), sized, "digest", nodes.count()).select("doc_id", "digest", "rep", "n"), "jaccard-held")
    several = held_by.groupBy("doc_id").agg(F.min("rep").alias("a"), F.count("*").alias("times")).where("times > 1")
    same_id = held_by.join(several, "doc_id").select("a", F.col("rep").alias("b"))
    labels = connected_components(links.unionByName(more).unionByName(same_id))
    ids = (
        held_by.join(labels, F.col("rep") == F.col("node"), "left")
        .groupBy("doc_id").agg(F.min(F.coalesce("label", "rep")).alias("component"))
    )
    out = base.join(held_by.select("doc_id", "digest", "n"), ["doc_id", "digest"], "left").join(ids, "doc_id", "left")
    return out.select("doc_id", F.coalesce("n_shingles", "n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
