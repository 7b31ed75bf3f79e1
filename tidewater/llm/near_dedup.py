"""MinHash near-dedup with bottom-k sketches from one hash function.

1. One pass hashes the distinct word shingles of each text and retains the ``k``
   smallest values (the bottom-k sketch). Texts with the same words collapse to
   one class at once, so a huge group of copies is one row from here on.
2. Inverted lists of the retained values generate overlaps. Two sets with a
   similarity of 0.8 share at least ``need`` of their retained values, so with
   the values put in order of rarity each class is listed under its first
   ``shared - need + 1`` values only; values held by one class are never listed.
3. Every list links its members to its most central one, whose retained values
   occur most often (the original, in a family of edited copies), and each class
   meets a few random members of its first lists: no more pairs than list entries. Each pair is
   tested by the union-sketch estimate and then exactly, on the full word shingles
   of both whole texts.
4. Classes in lists whose members are not yet all in one component are listed anew
   with sketches of ``wide`` values, which tell far more pairs apart. What is still
   open is compared in blocks of about ``block`` members, each pair of blocks in some
   task; only pairs of different components that pass the estimate leave it, each
   from one list, and they are verified exactly too. No list is capped.

``need`` for sketches that do not hold their whole set is the count below which
a pair of similarity 0.8 falls with a probability of about 1e-9 (a binomial
tail); for smaller sets it is exact.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, WordHash, checkpointed, quoted, runs, shingle_hashes, two_columns, words_of
from .components import connected_components

#: Members of a block that are compared with all others at a time; bounds memory, not the result.
AT_ONCE = 256


def needed_overlap(k: int, num: int, den: int, miss: float = 1e-9) -> int:
    """Largest overlap of two bottom-k sketches that a similarity of num/den
    stays under with a probability of ``miss`` at most."""
    p, total = num / den, 0.0
    for x in range(k + 1):
        total += comb(k, x) * p**x * (1 - p) ** (k - x)
        if total > miss:
            return max(1, x)
    return k


def sketch(docs: DataFrame, n: int, k: int) -> DataFrame:
    """doc_id, digest (of the lower-cased word sequence), n_shingles, sketch."""

    def run(batches):
        hashes = WordHash()
        for batch in batches:
            digests, sizes, kept = [], [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text, lower=True)
                digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
                values = np.unique(shingle_hashes(hashes.array(words), n))
                sizes.append(len(values))
                kept.append(values[:k].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "digest", "n_shingles", "sketch"],
            )

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, digest binary, n_shingles long, sketch binary"
    )


def _values(classes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            sketches = [np.frombuffer(s, np.int64) for s in batch.column("sketch").to_pylist()]
            times = [len(s) for s in sketches]
            yield pa.RecordBatch.from_arrays(
                [np.repeat(batch.column(c).to_numpy(), times) for c in ("rep", "n", "label")]
                + [np.concatenate([np.empty(0, np.int64), *sketches])],
                names=["rep", "n", "label", "value"],
            )

    return classes.select("rep", "n", "label", "sketch").mapInArrow(run, "rep long, n long, label long, value long")


def estimate_passes(x: np.ndarray, y: np.ndarray, nx: int, ny: int, k: int, num: int, den: int, need: int) -> bool:
    """Union-sketch estimate: of the k smallest values of both sketches, those in
    both. Exact where both sketches hold their whole sets."""
    if den * min(nx, ny) < num * max(nx, ny):
        return False
    union = np.union1d(x, y)[:k]
    both = np.intersect1d(x, y, assume_unique=True)
    shared = int(np.isin(both, union, assume_unique=True).sum())
    if nx <= k and ny <= k:
        return den * len(both) >= num * (nx + ny - len(both))
    return shared >= need


def _verified(pairs: DataFrame, texts: DataFrame, n: int, k: int, num: int, den: int) -> DataFrame:
    """Of the pairs (a, b), those that pass the estimate and then the exact test."""
    side = lambda c: texts.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"), F.col("text").alias(f"t{c}"))
    rows = pairs.join(side("b"), "b").join(side("a"), "a")
    need = needed_overlap(k, num, den)

    def shingles(text):
        w = words_of(text, lower=True)
        m = min(n, len(w))
        return {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if w else set()

    def run(batches):
        last, known = None, None
        for batch in batches:
            out = []
            for a, b, na, nb, sa, sb, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "na", "nb", "sa", "sb", "ta", "tb"))):
                if not estimate_passes(np.frombuffer(sa, U64), np.frombuffer(sb, U64), na, nb, k, num, den, need):
                    continue
                if ta is not last:
                    if ta != last:
                        known = shingles(ta)
                    last = ta
                other = shingles(tb)
                both = len(known & other)
                if both and den * both >= num * (len(known) + len(other) - both):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _blocks(members: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Candidate pairs of different labels from blocked lists: value, i, j, rep,
    label, own block, n, sketch, prefix. A pair comes from the list of the
    smallest value under which both are listed, and from no other."""
    need = needed_overlap(k, num, den)

    def open_members(sketches, label, least):
        """Members that still hold ``least`` values which other labels have too,
        counting only such members: all others can have no partner here."""
        owner = np.repeat(np.arange(len(sketches)), [len(s) for s in sketches])
        _, code = np.unique(np.concatenate(sketches), return_inverse=True)
        alive = np.ones(len(sketches), bool)
        while True:
            lo = np.full(code.max(initial=-1) + 1, np.iinfo(np.int64).max)
            hi = np.full(len(lo), np.iinfo(np.int64).min)
            np.minimum.at(lo, code, label[owner])
            np.maximum.at(hi, code, label[owner])
            useful = lo[code] != hi[code]
            held = alive & (np.bincount(owner[useful], minlength=len(sketches)) >= least)
            if (held == alive).all():
                return np.flatnonzero(held)
            alive = held
            keep = useful & alive[owner]
            owner, code = owner[keep], code[keep]

    def overlaps(sets):
        """A function: number of common values of the sets in some rows with all sets."""
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
        many = times[code] > 1
        _, code = np.unique(code[many], return_inverse=True)
        order = np.argsort(code, kind="stable")
        owner, code = owner[many][order], code[order]

        def shared(rows):
            total = np.zeros((len(rows), len(sets)), np.float32)
            for a in range(0, int(code.max(initial=-1)) + 1, 1024):  # a slice of the values at a time
                low, high = np.searchsorted(code, (a, a + 1024))
                grid = np.zeros((len(sets), int(code[high - 1]) - a + 1), np.float32)
                grid[owner[low:high], code[low:high] - a] = 1
                total += grid[rows] @ grid.T
            return total

        return shared

    def run(batches):
        for g in runs(batches, ["value", "i", "j"]):
            if len(g["rep"]) < 2 or (g["label"] == g["label"][0]).all():
                continue
            n, rep, label, block = g["n"], g["rep"], g["label"], g["block"]
            sketches = [np.frombuffer(s, U64) for s in g["sketch"]]
            least = np.where(n <= k, np.minimum(need, -(-num * n // den)), need)
            left = open_members(sketches, label, least)
            if len(left) < 2:
                continue
            n, rep, label, block, least = (v[left] for v in (n, rep, label, block, least))
            sketches = [sketches[x] for x in left]
            # every pair of two labels has a member outside the largest label
            names, size = np.unique(label, return_counts=True)
            rows = np.flatnonzero(label != names[size.argmax()])
            shared, earlier, found = overlaps(sketches), None, set()
            for at in range(0, len(rows), AT_ONCE):
                own = rows[at : at + AT_ONCE]
                good = label[own][:, None] != label[None, :]
                good &= den * np.minimum(n[own][:, None], n[None, :]) >= num * np.maximum(n[own][:, None], n[None, :])
                good &= (block[own][:, None] != block[None, :]) | (g["i"][0] == g["j"][0])
                share, sizes = shared(own), n[own][:, None] + n[None, :]
                good &= share >= np.maximum(least[own][:, None], least[None, :])
                whole = (n[own][:, None] <= k) & (n[None, :] <= k)
                good &= ~whole | (den * share >= num * (sizes - share))
                if not good.any():
                    continue
                earlier = earlier or overlaps([p[p < g["value"][0]] for p in g["prefix"][left]])
                good &= earlier(own) == 0
                for x, y in zip(own[np.nonzero(good)[0]], np.nonzero(good)[1]):
                    found.add((min(rep[x], rep[y]), max(rep[x], rep[y]), min(x, y), max(x, y)))
            out = [
                (a, b)
                for a, b, x, y in found
                if a != b and estimate_passes(sketches[x], sketches[y], n[x], n[y], k, num, den, need)
            ]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([int(p[i]) for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    keyed = members.repartition("value", "i", "j").sortWithinPartitions("value", "i", "j")
    return keyed.mapInArrow(run, "a long, b long")


def _listing(classes: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """rep, n, w (how often its values occur), prefix: the values that a class is
    listed under, in growing order. Only values under two labels or more count, as
    no others are common to a pair of different labels; classes that can have no
    partner are left out."""
    need = needed_overlap(k, num, den)
    values = _values(classes)
    common = (
        values.groupBy("value").agg(F.count("*").alias("df"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        .where("lo != hi").select("value", "df")
    )
    least = F.when(F.col("n") <= k, F.least(F.lit(need), F.ceil(F.col("n") * num / den))).otherwise(F.lit(need)).cast("int")
    return (
        values.join(common, "value")
        .groupBy("rep", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v"), F.sum("df").alias("w"))
        .withColumn("take", F.size("v") - least + 1)
        .where("take > 0")
        .select("rep", "n", "w", F.expr("array_sort(transform(slice(v, 1, take), x -> x.value))").alias("prefix"))
    )


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = 5,
    num: int = 80,
    den: int = 100,
    k: int = 48,
    block: int = 2048,
    meetings: int = 4,
    wide: int = 256,
) -> DataFrame:
    """Components of texts with ``den * |A & B| >= num * |A | B|`` over distinct
    ``n``-word shingles (A-Z lower-cased; fewer words: the whole sequence).

    Returns one row per input row: doc_id, n_shingles, component_id (smallest
    doc_id that can be reached) and kept (``doc_id = component_id``).

    Null or empty text, or white space alone: no shingles, linked with nothing.
    A null doc_id has no order: such a row is linked with nothing, kept, and has
    a null component_id. Rows that share a doc_id are one node. Other columns
    are ignored. An empty table gives an empty result. Texts of any length are
    shingled whole; only the ``k`` retained values and, for candidates, the text
    itself move between tasks."""
    docs = two_columns(docs, key, text)
    base = checkpointed(sketch(docs, n, k))
    linked = base.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = linked.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")
    ).withColumn("label", F.col("rep"))
    listed = checkpointed(_listing(classes, k, num, den))
    entries = listed.select("rep", "n", "w", F.explode("prefix").alias("value"))
    held = classes.select("rep", "sketch").join(listed.select("rep", "n"), "rep")
    texts = checkpointed(
        docs.where("doc_id IS NOT NULL").join(held, F.col("doc_id") == F.col("rep"))
        .select("rep", "n", "sketch", F.col("text").cast("binary").alias("text"))
    )

    centres = entries.groupBy("value").agg(
        F.max(F.struct("w", (-F.col("rep")).alias("r"), "n")).alias("c"), F.count("*").alias("members")
    ).where("members > 1").select("value", "members", (-F.col("c.r")).alias("centre"), F.col("c.n").alias("cn"))
    centres = checkpointed(centres)
    alike = f"rep != centre AND {den} * least(n, cn) >= {num} * greatest(n, cn)"
    pair = (F.least("centre", "rep").alias("a"), F.greatest("centre", "rep").alias("b"))
    stars = entries.join(centres, "value").where(alike).select(*pair)
    # each member also meets a random member of a part of its own few first lists,
    # which merges families whose members are not all close to the smallest one
    own = listed.select("rep", "n", F.posexplode(F.slice("prefix", 1, meetings)).alias("turn", "value")).join(centres.select("value", "members"), "value")
    own = own.withColumn("part", F.pmod(F.xxhash64("rep", "turn"), F.ceil(F.col("members") / 16)))
    head = F.min(F.struct(F.xxhash64("rep", F.lit(-1) - F.col("turn")), "rep", "n")).over(Window.partitionBy("value", "turn", "part"))
    own = own.withColumn("c", head).select("rep", "n", F.col("c.rep").alias("centre"), F.col("c.n").alias("cn"))
    stars = stars.unionByName(own.where(alike).select(*pair))
    stars = stars.distinct()
    links = checkpointed(_verified(stars, texts, n, k, num, den))
    labels = connected_components(links)

    # lists whose members are not all in one component: listed anew, by sketches
    # of ``wide`` values, and only what is then still open is compared
    def open_lists(entries):
        own = entries.join(labels, F.col("rep") == F.col("node"), "left").select("value", "rep", F.coalesce("label", "rep").alias("label"))
        sizes = own.groupBy("value").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("members"))
        return own.join(sizes.where("lo != hi").select("value", "members"), "value")

    pending = open_lists(entries.join(centres.where("members > 2").select("value"), "value")).select("rep").distinct()
    wider = checkpointed(sketch(texts.join(pending, "rep", "left_semi").select(F.col("rep").alias("doc_id"), "text"), n, wide)
                         .select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "sketch")
                         .join(labels, F.col("rep") == F.col("node"), "left")
                         .select("rep", "n", "sketch", F.coalesce("label", "rep").alias("label")))
    again = checkpointed(_listing(wider, wide, num, den))
    members = (
        open_lists(again.select("rep", F.explode("prefix").alias("value")))
        .withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("value", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "label", "block")
        .join(wider.select("rep", "n", "sketch").join(again.select("rep", "prefix"), "rep"), "rep")
    )
    more = _verified(_blocks(members, wide, num, den), texts, n, k, num, den)
    held_by = linked.select("doc_id", "digest").join(classes.select("digest", "rep"), "digest").select("doc_id", "rep").distinct()
    again = held_by.groupBy("doc_id").agg(F.min("rep").alias("a"), F.count("*").alias("times")).where("times > 1")
    same_id = held_by.join(again, "doc_id").select("a", F.col("rep").alias("b"))
    labels = connected_components(links.unionByName(more).unionByName(same_id))

    ids = (
        held_by.join(labels, F.col("rep") == F.col("node"), "left")
        .groupBy("doc_id").agg(F.min(F.coalesce("label", "rep")).alias("component"))
    )
    return (
        base.select("doc_id", "n_shingles")
        .join(ids, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with all columns and, of each component of ``near_duplicates``, the
    row with the smallest doc_id. Rows without a doc_id stay."""
    out = near_duplicates(docs, key, text, **options).where(~F.col("kept")).select("doc_id").distinct()
    rows = docs.select(quoted(key).cast("long").alias("doc_id"), F.struct(*map(quoted, docs.columns)).alias("row"))
    return rows.join(out, "doc_id", "left_anti").select("row.*")
