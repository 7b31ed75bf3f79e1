"""Sampled segmentation: long chunks, draws that do not depend on the batch, and
column names that clash in the pipeline's last stage."""

import os
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from test_operators import AWKWARD, awkward  # noqa: E402

from tidewater.llm import encoding, queries  # noqa: E402
from tidewater.llm.pieces import vocabulary  # noqa: E402


def test_walked_chunks_as_laid_out(monkeypatch):
    """The walk over a long chunk draws what the laid-out lattice draws."""
    vocab = vocabulary(queries.MODEL)
    sampler = encoding.Sampler(vocab, 1.0, 3)
    texts = [t.encode() for _, t in AWKWARD if t] + ["né▁ \U0001f600 abcabcabc".encode() * 20]
    laid = sampler.encode(list(range(len(texts))), texts)
    monkeypatch.setattr(encoding, "LONG", 0)
    walked = sampler.encode(list(range(len(texts))), texts)
    assert all((a == b).all() for a, b in zip(laid, walked))
    surface = vocab["surface"]
    assert [b"".join(surface[i] for i in ids.tolist()) for ids in walked] == texts


def test_draws_do_not_depend_on_the_batch(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [" ".join("".join(map(chr, rng.integers(97, 123, rng.integers(1, 12)))) for _ in range(300)).encode() for _ in range(20)]
    sampler = encoding.Sampler(vocabulary(queries.MODEL), 1.0, 0)
    together = sampler.encode(list(range(20)), texts)
    monkeypatch.setattr(encoding, "LAID", 64)
    for k in (0, 7, 19):
        assert (sampler.encode([k], [texts[k]])[0] == together[k]).all()


def test_long_chunk_without_a_space():
    sampler = encoding.Sampler(vocabulary(queries.MODEL), 1.0, 0)
    text = np.random.default_rng(4).integers(97, 123, encoding.LONG + 1000, dtype=np.uint8).tobytes()
    ids = sampler.encode([1], [text + b" and " + text[:9]])[0]
    assert encoding.Speller(vocabulary(queries.MODEL)).spell(ids).tobytes() == text + b" and " + text[:9]
    assert (sampler.encode([2, 1], [b"other", text + b" and " + text[:9]])[1] == ids).all()


def test_clashing_names_in_the_last_stage(spark):
    from pyspark.sql import functions as F

    names = ("pieces", "n_pieces", "decoded", "text_sha256", "lossless", "digest", "row", "r2")
    docs = awkward(spark).drop("a.b")
    for c in names:
        docs = docs.withColumn(c, F.lit(f"own {c}"))
    out = corpus_pipeline.sentencepiece(spark, docs, "")
    got = out.collect()
    assert len(got) == len(AWKWARD) and all(r[c] == f"own {c}" for r in got for c in names)
    assert all(r["lossless_new"] for r in got) and {"pieces_new", "n_pieces_new"} <= set(out.columns)


def test_memory_of_a_task():
    """The trie's table has rows for nodes with a next one alone, and the lattices of a
    slab of distinct words are laid out a part at a time."""
    import tracemalloc

    vocab = vocabulary(queries.MODEL)
    sampler = encoding.Sampler(vocab, 1.0, 0)
    trie = sampler.trie
    assert trie.step.nbytes < 24e6 and trie.step.any(axis=1).all()
    rng = np.random.default_rng(6)
    text = " ".join("".join(map(chr, rng.integers(97, 123, 9))) for _ in range(40_000)).encode()
    tracemalloc.start()
    try:
        ids = sampler.encode([1], [text])[0]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert encoding.Speller(vocab).spell(ids).tobytes() == text
    assert peak < 64e6


def test_lattices_are_laid_out_without_wide_sorts(monkeypatch):
    """Edges stand by the node they end in, a byte's own first, then shorter ones; they
    are put there by counting, and levels and parts are sorted by two-byte keys alone."""
    vocab = vocabulary(queries.MODEL)
    sampler = encoding.Sampler(vocab, 1.0, 0)
    texts = [t.encode() for _, t in AWKWARD if t] + [b"of the other things " * 40]
    chunks = [c for t in texts for c in encoding.CHUNK.findall(t)]
    number = {s: i for i, s in vocab["surface"].items() if i not in vocab["byte"]}
    want, base = [], 0
    for c in chunks:
        for end in range(1, len(c) + 1):
            want.append((base + end - 1, base + end, int(sampler.trie.byte[c[end - 1]])))
            want += [(base + at, base + end, number[c[at:end]]) for at in range(end - 1, -1, -1) if c[at:end] in number]
        base += len(c) + 1
    sorts, plain = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, *more, **named: sorts.append(a.dtype.itemsize) or plain(a, *more, **named))
    lat = encoding.Lattices(sampler.trie, chunks)
    assert list(zip(lat.src.tolist(), lat.dst.tolist(), lat.ids.tolist())) == want
    assert lat.first.tolist() == np.searchsorted(lat.dst, np.arange(base + 1)).tolist()
    sampler.encode(list(range(len(texts))), texts)
    assert sorts and max(sorts) <= 2
