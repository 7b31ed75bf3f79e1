"""Benchmark decontamination: size-partitioned MinHash containment search.

One hash orders all shingles. A test item of q shingles that a document holds to
a share of num/den misses at most q - ceil(q * num / den) of them, so one of its
(that number + 1) smallest hash values is in the document: a MinHash sketch whose
length follows the item's size and that misses nothing.

1. Items are partitioned by shingle length and size, by powers of two. A partition
   keeps the largest value that its sketches retain, beyond which a document's
   values are not looked up, and the fewest shingles that a document needs.
2. All retained values go into one Bloom filter, 64 MB at most, that travels to the
   tasks: as keys of their partition, and as keys of their shingle length alone, which
   drop nearly all of a document's values at one look. One scan of the documents, many
   of them at a time, keeps those with a value in it: the rest is neither shuffled nor
   written. More values than the filter has room for let more documents through; the
   results are the same.
3. The kept documents' values are joined with the items' values. Values that very
   many documents have are dealt to several tasks.
4. Each candidate is checked on the exact shingles, strings and not hashes.

Items stay on Spark at any size of the item table; only the partitions, some dozens
of numbers, and the filter pass through the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, WordHash, join_counted, mix64, quoted, shingle_hashes, signed, two_columns, words_of
from .jaccard_join import _may_have, written

#: Bits of one row of ``bitmap_construct_agg``; of the filter for each value, and at most.
ROW_BITS = 1 << 15
BITS_PER_VALUE, MAX_BITS = 32, 1 << 29
PROBES = 8
#: Documents with one value that a task joins with that value's items.
SHARE = 1 << 16
#: Words of documents that are looked up at a time.
LOOKED_UP = 1 << 16


def shingle_values(h: np.ndarray, m: int) -> np.ndarray:
    """Hashes of all runs of ``m`` words in a row; none in a shorter text."""
    return mix64(shingle_hashes(h, m)) if len(h) >= m else np.empty(0, U64)


def partition_of(m: int, q: int) -> int:
    """Size partition of an item of ``q`` shingles of ``m`` words."""
    return m << 8 | q.bit_length()


def keyed(values: np.ndarray, part: int) -> np.ndarray:
    """Values as join keys of one partition."""
    return mix64(values ^ mix64(np.full(1, part, U64)))


def probe(keys: np.ndarray, i: int, bits: int) -> np.ndarray:
    return mix64(keys + U64((i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) & U64(bits - 1)


def _sketches(items: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """item_id, text, m, part, cut (largest retained value), keys and any_size (the
    same values as keys of all partitions of one shingle length) of each item with
    words."""

    def run(batches):
        hashes = WordHash()
        for batch in batches:
            out = [[] for _ in range(7)]
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text, lower=True)
                if not words:
                    continue
                m = min(n, len(words))
                values = np.unique(shingle_values(hashes.array(words), m))
                q = len(values)
                kept, part = values[: q - -(-q * num // den) + 1], partition_of(m, q)
                for column, v in zip(out, (item, text, m, part, int(signed(kept[-1:])[0]), signed(keyed(kept, part)), signed(keyed(kept, m)))):
                    column.append(v)
            types = (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 2)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["item_id", "text", "m", "part", "cut", "keys", "any_size"])

    return items.mapInArrow(run, "item_id long, text binary, m int, part int, cut long, keys array<long>, any_size array<long>")


def _filter(sketches: DataFrame) -> np.ndarray:
    """The Bloom filter over all keys, as bytes. Tasks set its bits; the driver lays
    the finished rows of it side by side."""
    count = sketches.agg(F.sum(F.size("keys") + F.size("any_size"))).first()[0] or 0
    bits = min(MAX_BITS, max(ROW_BITS, 1 << max(0, BITS_PER_VALUE * count - 1).bit_length()))

    def places(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy().view(U64)
            for i in range(PROBES):
                at = signed(probe(keys, i, bits))
                yield pa.RecordBatch.from_arrays([pa.array(at // ROW_BITS), pa.array(at % ROW_BITS)], names=["part", "bit"])

    rows = sketches.select(F.explode(F.concat("keys", "any_size")).alias("key")).mapInArrow(places, "part long, bit long")
    out = np.zeros(bits // 8, np.uint8)
    for r in rows.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        out[r["part"] * (ROW_BITS // 8) :][: ROW_BITS // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def filter_places(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places of the keys whose probes are all set."""
    at = np.arange(len(keys))
    for i in range(PROBES):
        if not len(at):
            break
        place = probe(keys[at] if i else keys, i, 8 * len(bits)).astype(np.int64)
        at = at[(bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1]
    return at


def in_filter(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The keys whose probes are all set."""
    return keys[filter_places(keys, bits)]


def looked_up(h: np.ndarray, counts: np.ndarray, parts: list, num: int, den: int, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, key) of the values in the filter, each once, by document. ``h`` has the
    word hashes of several documents end to end, ``counts`` how many each has."""
    owner = np.repeat(np.arange(len(counts)), counts)
    owners, found, last = [owner[:0]], [h[:0]], None
    for m, part, cut in parts:
        if m != last:
            values, last = shingle_values(h, m), m
            most = max(c for k, _, c in parts if k == m)
            inside = np.flatnonzero((owner[: len(values)] == owner[m - 1 :]) & (values <= U64(most)))  # runs of one document's words
            values, whose = values[inside], owner[inside]
            known = filter_places(keyed(values, m), bits)  # of any size; few are left
            values, whose = values[known], whose[known]
        least = 1 << (part & 255) - 1  # shingles of the partition's smallest item
        at = np.flatnonzero((values <= U64(cut)) & (den * np.maximum(counts - m + 1, 0) >= num * least)[whose])
        keys = keyed(values[at], part)
        kept = filter_places(keys, bits)
        owners.append(whose[at][kept])
        found.append(keys[kept])
    owner, keys = np.concatenate(owners), np.concatenate(found)
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    once = np.ones(len(keys), bool)
    once[1:] = (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])
    return owner[once], keys[once]


def _candidates(docs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """row, doc_id, text, keys of documents with a value in the filter; one scan."""
    unsigned = F.max(F.struct((F.col("cut") < 0).alias("high"), "cut"))["cut"].alias("cut")  # as unsigned numbers
    parts = [(r["m"], r["part"], r["cut"] % (1 << 64)) for r in sketches.groupBy("m", "part").agg(unsigned).collect()]
    sent = docs.sparkSession.sparkContext.broadcast((sorted(parts), _filter(sketches)))
    names = ["doc_id", "text", "keys"]
    types = (pa.int64(), pa.binary())

    def run(batches):
        parts, bits = sent.value
        hashes = WordHash()

        def looked(docs, texts, held):
            counts = np.array([len(h) for h in held], np.int64)
            owner, keys = looked_up(np.concatenate(held), counts, parts, num, den, bits)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else owner
            own = owner[first].tolist()
            ends = np.append(first, len(keys)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(keys)))
            return pa.RecordBatch.from_arrays([pa.array([docs[i] for i in own], types[0]), pa.array([texts[i] for i in own], types[1]), lists], names=names)

        for batch in batches:
            docs, texts, held, size = [], [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                words = words_of(text, lower=True)
                if not words:
                    continue
                for column, v in zip((docs, texts, held), (doc, text, hashes.array(words))):
                    column.append(v)
                size += len(words)
                if size >= LOOKED_UP:
                    yield looked(docs, texts, held)
                    docs, texts, held, size = [], [], [], 0
            if held:
                yield looked(docs, texts, held)

    found = docs.mapInArrow(run, "doc_id long, text binary, keys array<long>")
    return written(found.withColumn("row", F.monotonically_increasing_id()), "containment-documents")


def _pairs(candidates: DataFrame, sketches: DataFrame) -> DataFrame:
    """(row, item) with a retained value in common. A value that very many documents
    have gets a copy of its items for each ``SHARE`` of them."""
    hits = candidates.select("row", F.explode("keys").alias("key"))
    copies = hits.groupBy("key").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("copies")).where("copies > 1")
    dealt = hits.join(copies, "key", "left")
    dealt = dealt.withColumn("copy", F.coalesce(F.pmod(F.xxhash64("row"), F.col("copies")).cast("int"), F.lit(0)))
    held = sketches.select("item", F.explode("keys").alias("key")).join(copies, "key", "left")
    held = held.withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)))
    return dealt.drop("copies").join(held.drop("copies"), ["key", "copy"]).select("row", "item").distinct()


class Passages:
    """Shingles of one document, found by hash and compared word by word. Holds two
    numbers a word for each shingle length asked for."""

    def __init__(self, words: list[bytes], hashes: WordHash):
        self.words, self.hashes, self.h = words, hashes, hashes.array(words)
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def shared(self, item: list[bytes], m: int) -> tuple[int, int]:
        """(distinct shingles of the item, of them in the document)."""
        if m not in self.sorted:
            values = shingle_values(self.h, m)
            order = np.argsort(values, kind="stable")
            self.sorted[m] = values[order], order
        values, order = self.sorted[m]
        own = {tuple(item[i : i + m]): i for i in range(len(item) - m + 1)}
        at = shingle_values(self.hashes.array(item), m)[list(own.values())]
        both = 0
        for shingle, a, b in zip(own, np.searchsorted(values, at, "left"), np.searchsorted(values, at, "right")):
            both += any(tuple(self.words[i : i + m]) == shingle for i in map(int, order[a:b]))
        return len(own), both


def _found(docs: DataFrame, items: DataFrame, item_key: str, item_text: str, n: int, num: int, den: int) -> DataFrame:
    """doc_id, item_id, n_item, n_shared, and the SHA-256 of the document's text."""
    items = items.select(quoted(item_key).cast("long").alias("item_id"), quoted(item_text).cast("binary").alias("text"))
    sketches = _sketches(items.where("text IS NOT NULL").distinct(), n, num, den)
    sketches = written(sketches.withColumn("item", F.monotonically_increasing_id()), "containment-items")
    candidates = _candidates(docs, sketches, num, den)
    pairs = written(_pairs(candidates, sketches), "containment-pairs")
    texts = sketches.select("item", "item_id", "text").join(pairs.groupBy("item").agg(F.count("*").alias("count")), "item")
    asked = join_counted(pairs, texts, "item", pairs.count())
    both = candidates.select("row", F.lit(0).alias("side"), F.col("doc_id").alias("id"), "text").unionByName(
        asked.select("row", F.lit(1).alias("side"), F.col("item_id").alias("id"), "text")
    )
    names = ["doc_id", "item_id", "n_item", "n_shared", "digest"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())

    def run(batches):
        hashes = WordHash()
        doc = own = digest = None
        for batch in batches:
            out = [[] for _ in names]
            for side, key, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                words = words_of(text.as_py(), lower=True)
                if not side:  # a document comes before the items to look for in it
                    doc, own, digest = key, None, None
                    held = text
                    document = words
                    continue
                own = own or Passages(document, hashes)
                size, shared = own.shared(words, min(n, len(words)))
                if den * shared >= num * size:
                    digest = digest or hashlib.sha256(held.as_py()).hexdigest()
                    for column, v in zip(out, (doc, key, size, shared, digest)):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    ordered = both.repartition("row").sortWithinPartitions("row", "side")
    return ordered.mapInArrow(run, "doc_id long, item_id long, n_item long, n_shared long, digest string")


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    n: int = 5,
    num: int = 80,
    den: int = 100,
) -> DataFrame:
    """Pairs of a document and a test item of whose distinct ``n``-word shingles
    it holds at least ``num/den``: doc_id, item_id, n_item, n_shared, containment.

    Words are runs outside space and 0x09-0x0D with A-Z lower-cased. An item of
    fewer than ``n`` words is one shingle of its own length, found wherever a
    document has those words in a row. Null, empty or white-space items and documents
    match nothing. Null ids are returned as they are; repeated rows give repeated
    pairs, one for each document row and distinct item row. Extra columns are ignored;
    empty tables give no pairs. A task holds one document at a time, whole, with some
    numbers a word."""
    docs = two_columns(docs, key, text).withColumn("text", F.col("text").cast("binary"))
    found = _found(docs, items, item_key, item_text, n, num, den).drop("digest")
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    n: int = 5,
    num: int = 80,
    den: int = 100,
) -> DataFrame:
    """``docs`` without the rows that hold a test item by the rule of
    ``contained_items``, all columns kept. Whether a row goes depends on its text
    alone, so texts found are looked up by their SHA-256; a bitmap of those keeps the
    other rows out of the join."""
    found = _found(two_columns(docs, key, text).withColumn("text", F.col("text").cast("binary")), items, item_key, item_text, n, num, den)
    gone = written(found.select("digest").distinct(), "containment-found")
    at = docs.columns.index(text)
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    rows = rows.withColumn("digest", F.sha2(F.coalesce(F.col(f"c{at}"), F.lit("")).cast("binary"), 256))
    maybe, clean = _may_have(rows, "digest", gone, gone.count())
    return maybe.join(gone, "digest", "left_anti").select(*rows.columns).unionByName(clean).drop("digest").toDF(*docs.columns)
