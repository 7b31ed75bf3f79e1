"""Toxicity scores over text restored by a noisy-channel decoder.

1. A character trigram model is counted over all texts.
2. Words that leetspeak, spacing or repetition may have disguised become a
   character lattice: a digit or sign may stand for a letter, a separator between
   single letters may be noise, a repeated letter may stand for one or two. The
   Viterbi path under channel costs and the character model restores the word.
   Once words are learned, the same arcs, with any sign as an optional separator,
   are also walked through those words, for every token as written that isn't a
   word of clean texts.
3. Words and word beginnings, as written and as restored, are the features of a
   logistic regression. It is fitted on ``sample`` labelled rows at most.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, quoted, two_columns

LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœßšž"
#: What a sign may stand for (fixed values).
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
}
SUBSTITUTED, KEPT_SIGN, KEPT_SPACE, SQUEEZED, HALVED = -1.5, -8.0, -3.0, -0.7, -6.0
SIDES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "@$")
LEFT = SIDES.replace("!", "").replace("|", "")
SIGN = r"[\w" + re.escape("".join(c for c in LEET if not c.isalnum())) + "]"
SPACED = re.compile(rf"(?<!\S){SIGN}(?:\s+{SIGN}){{2,}}(?!\S)")
DOTTED = re.compile(r"\S(?:[.\-_*~]\S){2,}")
DOUBLE = re.compile(r"(.)\1")
TRIPLE = re.compile(r"(.)\1\1")
RUN = re.compile(r"(.)\1*", re.S)
BEGINNINGS = (4, 5, 6)


class Alphabet:
    def __init__(self):
        self.size = len(LETTERS) + 1
        self.code = {c: i + 1 for i, c in enumerate(LETTERS)}
        self.table = np.zeros(1 << 16, np.int32)
        for c, i in self.code.items():
            self.table[ord(c)] = i

    def codes(self, text: str) -> np.ndarray:
        """Codes with runs of other characters as a single 0, and 0 at both ends."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        x = np.concatenate([[0], self.table[np.where(points < 1 << 16, points, 0)], [0]])
        stay = np.ones(len(x), bool)
        stay[1:] = (x[1:] != 0) | (x[:-1] != 0)
        return x[stay]


def character_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts over all texts; the table is bounded by the alphabet."""
    size = Alphabet().size

    def run(batches):
        alphabet, total = Alphabet(), np.zeros(size**3, np.int64)
        for batch in batches:
            held, left = [], len(batch.column(0))
            for text in batch.column(0):
                held.append(text.as_py() or "")
                left -= 1
                if left and sum(map(len, held[-64:])) < 1 << 16 and len(held) < 4096:
                    continue
                x = alphabet.codes("\n".join(held))
                held = []
                if len(x) > 2:
                    total += np.bincount((x[:-2] * size + x[1:-1]) * size + x[2:], minlength=size**3)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["gram", "c"])

    sums = docs.select("text").mapInArrow(run, "gram int, c long").groupBy("gram").agg(F.sum("c").alias("c"))
    counts = np.zeros(size**3, np.int64)
    for r in sums.collect():  # a row per trigram of the alphabet at most
        counts[r["gram"]] = r["c"]
    return counts.reshape(size, size, size)


def character_model(counts: np.ndarray, weight: float = 5.0) -> np.ndarray:
    """log p(c | a, b), each order backed by the one below."""
    one = counts.sum((0, 1)) + 1.0
    one = one / one.sum()
    pairs = counts.sum(0)
    two = (pairs + weight * one) / (pairs.sum(1, keepdims=True) + weight)
    three = (counts + weight * two) / (counts.sum(2, keepdims=True) + weight)
    return np.log(three).astype(np.float32)


class Decoder:
    def __init__(self, model: np.ndarray, limit: int = 1 << 17):
        self.alphabet, self.model = Alphabet(), model
        self.code, self.cache, self.limit = self.alphabet.code, {}, limit

    def _arcs(self, text: str, spaced: bool):
        """(emitted strings with costs) for each run of equal characters."""
        at = 0
        while at < len(text):
            end = at
            while end < len(text) and text[end] == text[at]:
                end += 1
            c, r = text[at], end - at
            if c in self.code:
                yield [(c, 0.0)] if r == 1 else [(c, SQUEEZED if r > 2 else HALVED), (c + c, 0.0 if r == 2 else SQUEEZED)]
            elif c in LEET:
                arcs = [(" ", KEPT_SIGN)] + [(x, SUBSTITUTED) for x in LEET[c]]
                yield arcs + [(x + x, 2 * SUBSTITUTED) for x in LEET[c] if r > 1]
            elif spaced:
                yield [("", 0.0), (" ", KEPT_SPACE)]
            else:
                yield [(" ", 0.0)]
            at = end

    def viterbi(self, text: str, spaced: bool = False) -> str:
        best = {(0, 0): (0.0, None)}
        for arcs in self._arcs(text, spaced):
            after: dict = {}
            for (a, b), (score, path) in best.items():
                for out, cost in arcs:
                    s, x, y = score + cost, a, b
                    for c in out:
                        k = self.code.get(c, 0)
                        if k or y:
                            s += self.model[x, y, k]
                            x, y = y, k
                    if (x, y) not in after or after[x, y][0] < s:
                        after[x, y] = (s, (path, out) if out else path)
            best = after
        score, path = max(((s + self.model[a, b, 0], p) for (a, b), (s, p) in best.items()), key=lambda t: t[0])
        parts = []
        while path:
            path, out = path
            parts.append(out)
        return "".join(reversed(parts))

    def words(self, token: str) -> tuple[str, ...]:
        """The token's words, as written and as restored."""
        known = self.cache.get(token)
        if known is None:
            if len(self.cache) >= self.limit:
                self.cache.clear()
            core = token.rstrip(SIDES).lstrip(LEFT)
            found = {core} if core else set()
            if " " in core:
                found = set(self.viterbi(core, True).split())
            elif not core.isalpha() or TRIPLE.search(core):
                if DOTTED.fullmatch(core):
                    found.update(self.viterbi(core, True).split())
                if any(c in self.code for c in core):
                    found.update(self.viterbi(core).split())
                    found.update(re.split(r"[^\w]+", core))
            known = self.cache[token] = tuple(w for w in found if len(w) > 1)
        return known

    def joined(self, low: str):
        """Words restored from single characters that stand apart."""
        for m in SPACED.finditer(low):
            if any(c.isalnum() for c in m[0]):
                yield from self.words(" ".join(m[0].split()))

    def restored(self, text: str) -> set[str]:
        low = text.lower()
        return {w for token in set(low.split()) for w in self.words(token)}.union(self.joined(low))


class Disguises:
    """Learned words behind a written form: the lattice's arcs, any sign as an optional
    separator, walked through the words' beginnings."""

    def __init__(self, words):
        self.words = {w for w in words if len(w) > 1}
        self.beginnings = {w[:k] for w in self.words for k in range(len(w) + 1)}

    @staticmethod
    @lru_cache(1 << 12)
    def _outs(c: str, r: int) -> tuple[str, ...]:
        letters = (c,) if c in LETTERS else tuple(LEET.get(c, ""))
        outs = letters + tuple(x + x for x in letters if r > 1)
        return outs if c.isalnum() else (*outs, "")

    def _walk(self, runs: list[tuple[str, ...]]):
        """The beginnings reached after each run."""
        at = {""}
        for outs in runs:
            at = {s + x for s in at for x in outs if s + x in self.beginnings}
            if not at:
                return
            yield at

    def of(self, token: str) -> set[str]:
        """The learned words that the whole token may stand for; none for one of them."""
        if token in self.words or not any(c in LETTERS for c in token):
            return set()
        at, known = {""}, self.beginnings
        for m in RUN.finditer(token):
            at = {s + x for s in at for x in self._outs(m[1], min(len(m[0]), 2)) if s + x in known}
            if not at:
                break
        return at & self.words

    def within(self, low: str):
        """Learned words of four letters or more among characters that stand apart."""
        for m in SPACED.finditer(low):
            runs = [self._outs(r[1], len(r[0])) for r in RUN.finditer("".join(m[0].split()))]
            for i in range(len(runs)):
                for at in self._walk(runs[i:]):
                    yield from (w for w in at if len(w) > 3 and w in self.words)


def learned(places) -> list[str]:
    return [f[1:] for f in places if f[0] == "="]


def features_of(word: str) -> list[str]:
    return ["=" + word, *[word[:k] for k in BEGINNINGS if len(word) >= k]]


def held_out(key: Column, folds: int = 3, out: int = 1) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == out, F.lit(True))


def _fit(rows: list, size: int, ridge: float = 0.003, steps: int = 600) -> np.ndarray:
    """Ridge logistic regression on presence features, by accelerated gradients;
    the last weight is the constant."""
    y = np.array([r[0] for r in rows], float)
    flat = np.concatenate([np.asarray(r[1], np.int64) for r in rows] + [np.empty(0, np.int64)])
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w, b = np.zeros(size), float(np.log(share / (1 - share)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        z = b + np.bincount(row, w[flat], len(rows))
        g = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        grad = np.append(np.bincount(flat, g[row], size) + ridge * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return np.append(w, b)


class Scorer(dict):
    """Scores texts; remembers each token's features, up to ``limit`` tokens."""

    def __init__(self, characters, places, weights, clean=frozenset(), limit: int = 1 << 19):
        super().__init__()
        self.disguises, self.clean = Disguises(learned(places)), clean
        self.decoder, self.places, self.weights, self.limit = Decoder(characters), places, weights.tolist(), limit

    def of_words(self, words) -> tuple[int, ...]:
        places = self.places
        return tuple({places[f] for w in words if len(w) > 1 for f in features_of(w) if f in places})

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= self.limit:
            self.clear()
        plain = token.isalpha() and not TRIPLE.search(token)
        words = (token,) if plain else self.decoder.words(token)
        if (not plain or DOUBLE.search(token)) and token not in self.clean:
            words = {*words, *self.disguises.of(token)}
        hit = self[token] = self.of_words(words)
        return hit

    def score(self, text: str | None) -> float:
        low = (text or "").lower()
        active = {i for hit in map(self.__getitem__, set(low.split())) if hit for i in hit}
        active.update(self.of_words(self.decoder.joined(low)))
        active.update(self.of_words(self.disguises.within(low)))
        z = self.weights[-1] + sum(self.weights[i] for i in active)
        return 1 / (1 + math.exp(-min(max(z, -40.0), 40.0)))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = 20_000, width: int = 4_000
) -> tuple:
    """(character model, feature -> place, weights, clean): bounded by the alphabet, by
    ``width`` features and by the sample, and so fit to be sent to every task. clean has
    the tokens that look like a disguised feature but are words of untoxic texts. Fit on labelled rows that are not held out: the ``sample`` of them with the
    smallest hash of doc_id. The character model takes all texts. A doc_id with
    several labels counts as toxic if one says so; null labels are left out."""
    plain = two_columns(docs, key, text)
    characters = character_model(character_counts(plain))
    known = (
        labels.select(quoted(key).cast("long").alias("id"), quoted(label).cast("int").alias("toxic"))
        .where(~held_out(F.col("id")) & F.col("toxic").isNotNull())
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    rows = plain.join(F.broadcast(known), plain["doc_id"] == known["id"]).select("toxic", "text")  # sample rows at most
    sent = docs.sparkSession.sparkContext.broadcast(characters)

    def every(batches):
        decoder = Decoder(sent.value)
        for batch in batches:
            toxic, marks = [], []
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = {f for w in decoder.restored(t.as_py() or "") for f in features_of(w)}
                toxic += [y] * len(own)
                marks += own
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(marks, pa.string())], names=["toxic", "mark"])

    sums = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = sums.get(1, 0), sums.get(0, 0)
    if not bad or not good:
        share = bad / (bad + good) if bad + good else 0.0
        return (characters, {}, np.array([float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6))))]), frozenset())
    odds = F.log((F.col("n1") + 0.5) / (bad + 1)) - F.log((F.col("n0") + 0.5) / (good + 1))
    best = (
        rows.mapInArrow(every, "toxic int, mark string")
        .groupBy("mark").agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0"))
        .where("n1 > 1").where(odds > 1).orderBy((odds * F.col("n1")).desc(), "mark").limit(width)
    )
    places = {r["mark"]: i for i, r in enumerate(best.collect())}
    chosen = docs.sparkSession.sparkContext.broadcast(places)

    def present(batches):
        decoder, known_marks = Decoder(sent.value), chosen.value
        disguises = Disguises(learned(known_marks))
        for batch in batches:
            out = [
                sorted({known_marks[f] for w in decoder.restored(t.as_py() or "") for f in features_of(w) if f in known_marks})
                for t in batch.column(1)
            ]
            alike = [sorted(w for w in set((t.as_py() or "").lower().split()) if disguises.of(w)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.list_(pa.int32())), pa.array(alike, pa.list_(pa.string()))], names=["toxic", "marks", "alike"]
            )

    fitted = rows.mapInArrow(present, "toxic int, marks array<int>, alike array<string>").collect()
    seen = [Counter(w for r in fitted if r["toxic"] == y for w in r["alike"]) for y in (0, 1)]
    clean = frozenset(w for w, n in seen[0].items() if n > 1 and n > seen[1][w])
    return characters, places, _fit([(r["toxic"], r["marks"]) for r in fitted], len(places)), clean


def toxicity_scores(docs: DataFrame, model: tuple, key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1) and predicted (1 if
    score >= threshold).

    Whole texts are scored in the scan, without a shuffle. Null text counts as
    empty, which scores the model's constant. A null doc_id is never learned from
    and counts as held out. Repeated rows score alike. Other columns are ignored;
    an empty table gives no rows. With no label of either kind, every score is the
    labels' mean (0 without labels)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        score = Scorer(*sent.value).score
        for batch in batches:
            values = np.array([score(t.as_py()) for t in batch.column(1)], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc_id", "score"])

    scored = two_columns(docs, key, text).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: tuple, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` without the rows predicted toxic, all columns kept; a filter on the scan."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches):
        score = Scorer(*sent.value).score
        for batch in batches:
            yield batch.filter(pa.array([score(t.as_py()) < threshold for t in batch.column(place)], pa.bool_()))

    return map_rows(docs, run)
