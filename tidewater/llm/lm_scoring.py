"""LM scoring with the subword lattice likelihood.

A word's lattice has an arc for each piece of an existing vocabulary, and one
across the whole word if it was seen in training. A word's probability is the sum
over all paths, by forward recursion in log space; a text's probability is the
product over its words and one end symbol.

Piece weights start from the vocabulary's scores and are then the expected piece
counts in the distinct training words under those weights (``rounds`` passes), with
the scores as prior. A path of pieces has one that starts with the word mark and
any number that don't, so these paths' weights add up to 1 over all words. The
whole-word arc weighs (c - D) / N, and the pieces share what is left, D V / N,
where D is the usual discount n1 / (n1 + 2 n2): a proper distribution.

Spark counts the words of all texts (that table grows with the corpus). Words
that are at least 1 in ``head`` of all tokens are ``head`` at most, whatever the
corpus: they go to the tasks and are scored during the scan. All other words are
counted per document and joined with the word table by word.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, quoted, words_of
from .pieces import Lattices, Trie, vocabulary

LOG10 = float(np.log(10.0))


def training(key: Column, folds: int, out: int) -> Column:
    """A row is learned from unless crc32 of its key as text falls on ``out``."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds != out, F.lit(False))


def _word_counts(docs: DataFrame, flush: int = 1 << 18) -> DataFrame:
    """word, n (in training texts), total; pre-added in the map tasks."""

    def run(batches):
        train, rest = Counter(), Counter()

        def emit():
            words = list(train.keys() | rest.keys())
            n = np.fromiter((train[w] for w in words), np.int64, len(words))
            other = np.fromiter((rest[w] for w in words), np.int64, len(words))
            train.clear()
            rest.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n), pa.array(n + other)], names=["word", "n", "total"])

        for batch in batches:
            for text, learn in zip(batch.column(0), batch.column(1).to_pylist()):
                (train if learn else rest).update(words_of(text.as_py(), lower=True))
                if len(train) + len(rest) >= flush:
                    yield emit()
        if train or rest:
            yield emit()

    parts = docs.select("text", "learn").mapInArrow(run, "word binary, n long, total long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def _slabs(batch, size: int = 1 << 20):
    """Slices of a batch of words with about ``size`` bytes of words."""
    lengths = np.array([len(w) + 2 for w in batch.column("word").to_pylist()], np.int64)
    cuts = np.searchsorted(np.cumsum(lengths), np.arange(size, int(lengths.sum()) + size, size))
    a = 0
    for b in [*(cuts + 1).tolist(), len(lengths)]:
        b = min(b, len(lengths))
        if b > a:
            yield batch.slice(a, b - a)
            a = b


def _expected(words: DataFrame, sent, logp: np.ndarray) -> np.ndarray:
    size = len(logp)

    def run(batches):
        trie, total = Trie(sent.value), np.zeros(size)
        for batch in batches:
            for part in _slabs(batch):
                lat = Lattices(trie, [b" " + w for w in part.column("word").to_pylist()])
                total += lat.expected(logp, np.ones(part.num_rows), size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["piece", "c"])

    sums = words.where("n > 0").select("word").mapInArrow(run, "piece int, c double").groupBy("piece").agg(F.sum("c").alias("c"))
    counts = np.zeros(size)
    for r in sums.collect():  # a row per piece of the vocabulary at most
        counts[r["piece"]] = r["c"]
    return counts


def _scored_words(words: DataFrame, sent, logp: np.ndarray, n_train: int, discount: float, left: float) -> DataFrame:
    """word, n, and lp: log10 of the summed probability of all its paths."""

    def run(batches):
        trie = Trie(sent.value)
        for batch in batches:
            for part in _slabs(batch):
                lat = Lattices(trie, [b" " + w for w in part.column("word").to_pylist()])
                by_piece = lat.totals(lat.forward(logp)) + (np.log(left) if left else -np.inf)
                whole = np.maximum(part.column("n").to_numpy() - discount, 0.0) / max(n_train, 1)
                with np.errstate(divide="ignore"):
                    lp = np.logaddexp(by_piece, np.log(whole)) / LOG10
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("word", "n")), pa.array(lp)], names=["word", "n", "lp"])

    return words.select("word", "n").mapInArrow(run, "word binary, n long, lp double")


def lattice_scores(
    docs: DataFrame,
    model: str,
    key: str = "doc_id",
    text: str = "text",
    folds: int = 5,
    out: int = 1,
    rounds: int = 2,
    prior: float = 1000.0,
    head: int = 1_000_000,
) -> DataFrame:
    """Score every whole text; learn from the rows of all folds but ``out``.

    Words are runs outside space and 0x09-0x0D, A-Z lower-cased; the end of a text
    is one more token. Returns one row per input row: doc_id, held_out, n_tokens,
    n_known (tokens seen in training), train_tokens, base_score (the smoothed
    word unigram) and score (log10 of the text's summed probability over all
    segmentations; it adds up to at most 1 over all texts).

    Null text counts as empty: one token, the end. A null doc_id is in no training
    fold and counts as held out. Rows that share a doc_id are scored apart; rows
    alike in doc_id and text are one row and its number until the end. With no
    training text, weights are the prior's and the unigram's counts are 0. Other
    columns are ignored; an empty table gives no rows. ``prior`` is the weight, in
    pieces, of the vocabulary's own scores."""
    sc = docs.sparkSession.sparkContext
    vocab = vocabulary(model)
    sent = sc.broadcast(vocab)
    learn = training(quoted(key), folds, out)
    docs = docs.select(quoted(key).cast("long").alias("doc_id"), quoted(text).cast("binary").alias("text"), learn.alias("learn"))
    words = checkpointed(_word_counts(docs))
    is_ = lambda c: F.sum((F.col("n") == c).cast("long")).alias(f"n{c}")
    facts = words.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum((F.col("n") > 0).cast("long")).alias("v"), is_(1), is_(2)).first()
    ends = docs.where("learn").count()  # an end for each training text
    n_train = (facts["n"] or 0) + ends
    distinct = (facts["v"] or 0) + (1 if ends else 0)
    n1, n2 = (facts["n1"] or 0) + (ends == 1), (facts["n2"] or 0) + (ends == 2)
    discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    left = discount * distinct / n_train if n_train else 0.5

    base = np.exp(vocab["logp"])
    p = base
    for _ in range(rounds):
        counts = _expected(words, sent, np.log(np.maximum(p, 1e-300)))
        p = (counts + prior * base) / (counts.sum() + prior)
    logp = np.log(np.maximum(p, 1e-300))
    end_lp = float(np.log10((ends - discount) / n_train if ends else 0.5))

    unit = 0.5 * (distinct + 1) + n_train
    model_of = (sent, logp, n_train, discount, left)
    common = words.where(F.col("total") * head >= F.lit(facts["total"] or 0))
    table = {bytes(r["word"]): (int(r["n"] > 0), float(np.log10((r["n"] + 0.5) / unit)), r["lp"]) for r in _scored_words(common, *model_of).collect()}
    known = sc.broadcast(table)
    end_base = float(np.log10((ends + 0.5) / unit))

    def split(batches):
        """Rows of rare words (row, word, times), and one row for each text with
        what its frequent words add up to; that row's word holds a space."""
        find = known.value.get
        for batch in batches:
            rows, words, times = [], [], []
            keys, facts = [], []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or b""
                row = xxhash.xxh3_64_intdigest(text, seed=xxhash.xxh3_64_intdigest(repr(d).encode())) - (1 << 63)
                n_known, b, s, own = int(ends > 0), end_base, end_lp, words_of(text, lower=True)
                for w, c in Counter(own).items():
                    hit = find(w)
                    if hit is None:
                        rows.append(row)
                        words.append(w)
                        times.append(c)
                    else:
                        n_known += c * hit[0]
                        b += c * hit[1]
                        s += c * hit[2]
                keys.append(row)
                facts.append((d, len(own) + 1, n_known, b, s))
            pad = [None] * len(rows)
            columns = [pad + [f[i] for f in facts] for i in range(5)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows + keys, pa.int64()),
                    pa.array(words + [b" %d" % k for k in keys], pa.binary()),
                    pa.array(times + [0] * len(keys), pa.int64()),
                    *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))),
                ],
                names=["row", "word", "times", "doc_id", "tokens", "seen", "b", "s"],
            )

    parts = docs.select("doc_id", "text").mapInArrow(
        split, "row long, word binary, times long, doc_id long, tokens long, seen long, b double, s double"
    )
    scored = _scored_words(words, *model_of)
    n = F.coalesce("n", F.lit(0))
    sums = parts.join(scored, "word", "left").groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("tokens").alias("n_tokens"),
        F.count("tokens").alias("m"),
        F.sum(F.coalesce("seen", F.when(n > 0, F.col("times")), F.lit(0))).alias("n_known"),
        F.sum(F.coalesce("b", F.col("times") * F.log10((n + 0.5) / unit))).alias("base_score"),
        F.sum(F.coalesce("s", F.col("times") * F.col("lp"))).alias("score"),
    )
    # m rows alike in doc_id and text came together: a share each
    return sums.select(
        "doc_id",
        (~training(F.col("doc_id"), folds, out)).alias("held_out"),
        "n_tokens",
        (F.col("n_known") / F.col("m")).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base_score") / F.col("m")).alias("base_score"),
        (F.col("score") / F.col("m")).alias("score"),
        F.explode(F.sequence(F.lit(1).cast("long"), "m")).alias("copy"),
    ).drop("copy")
