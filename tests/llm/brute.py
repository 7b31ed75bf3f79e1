"""Plain Python versions of the operators' results, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text, lower=False):
    text = text or ""
    return [w for w in SPACE.split(text.translate(LOW) if lower else text) if w]


def shingles(text, n):
    w = words(text, True)
    n = min(n, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def substring(rows, window=50):
    """doc_id -> (n_words, n_removed, sha256); doc_ids are distinct or null."""
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            if d is not None:
                k = tuple(w[i : i + window])
                first[k] = min(d, first.get(k, d))
    out = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def exact(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[SPACE.sub(" ", t or "")].append(d)
    out = []
    for t, ids in groups.items():
        keep = min((d for d in ids if d is not None), default=None)
        left = 1
        for d in ids:
            kept = d == keep and left > 0
            left -= kept
            out.append((d, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return out


def near(rows, n, num=80, den=100):
    """Rows with a doc_id; rows that share one are one node."""
    sets = [(d, shingles(t, n)) for d, t in rows]
    nodes = [(d, s) for d, s in sets if d is not None]
    parent = {d: d for d, _ in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(set)
    for i, (_, s) in enumerate(nodes):
        for x in s:
            where[x].add(i)
    for i, (d, s) in enumerate(nodes):
        share = Counter(j for x in s for j in where[x] if j < i)
        for j, c in share.items():
            if den * c >= num * (len(s) + len(nodes[j][1]) - c):
                a, b = sorted((root(d), root(nodes[j][0])))
                parent[b] = a
    return [(d, len(s), None if d is None else root(d), d is None or root(d) == d) for d, s in sets]


def contained(docs, items, n=5, num=80, den=100):
    """An item of fewer than n words is one shingle of its own length."""
    out = []
    for d, t in docs:
        for i, x in items:
            s = shingles(x, n)
            m = min(n, len(words(x)))
            own = shingles(t, m) if len(words(t)) >= m else set()
            both = len(s & own)
            if s and den * both >= num * len(s):
                out.append((d, i, len(s), both))
    return out


BASE = (
    ("assign", r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6),
    ("access", r"(AKIA[A-Z0-9]+)", 20),
    ("hex", r"([0-9a-f]+)", 24),
)


def base_secrets(text):
    spans = []
    for rank, (kind, pattern, least) in enumerate(BASE):
        spans += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m[1]) >= least]
    return [(k, a, b) for a, _, b, k in sorted(spans)]


def word_model(rows, folds=5, out=1):
    """Per row: held_out, n_tokens, n_known, train_tokens, base_score."""
    END = object()
    train = Counter()
    tagged = []
    for d, t in rows:
        held = d is None or zlib.crc32(str(d).encode()) % folds == out
        tokens = [*words(t, True), END]
        tagged.append((d, held, tokens))
        if not held:
            train.update(tokens)
    n, v = sum(train.values()), len(train)
    return [
        (d, held, len(tokens), sum(train[w] > 0 for w in tokens), n, sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens))
        for d, held, tokens in tagged
    ]


def lattice_probability(word, pieces):
    """Sum over all segmentations of ``word`` (bytes); pieces: surface -> weight."""
    p = [1.0] + [0.0] * len(word)
    for i in range(1, len(word) + 1):
        for j in range(i):
            for w in pieces.get(word[j:i], ()):
                p[i] += p[j] * w
    return p[-1]
