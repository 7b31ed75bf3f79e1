"""SentencePiece encoding and decoding by forward filtering, backward sampling.

Forward: log weights of all paths through the piece lattice, for the distinct
chunks of a batch at once. Backward: from the end of each chunk, the last piece is
drawn in proportion to the weight of the paths that it ends, and so on to the
chunk's start. Draws come from a hash of seed, row key, chunk number and step, so
a row's segmentation depends on its key and text alone: not on batch, partition,
retry or cluster. Decoding joins the pieces' bytes and gives back the text.
"""

from __future__ import annotations

import itertools
import math
import re
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from .common import U64, map_rows, mix64, quoted
from .pieces import Lattices, Trie, vocabulary

CHUNK = re.compile(rb" *[^ \n]+| +|\n")
#: Bytes of text that are taken at a time, and bytes of distinct chunks that are laid
#: out at a time; they bound memory, not the result.
SLAB, LAID = 1 << 20, 1 << 16
#: Bytes of a chunk above which its lattice is walked and not laid out.
LONG = 1 << 16
#: Pieces that are spelled at a time.
SPELLED = 1 << 20


def mixed(x: int) -> int:
    """``mix64`` of one whole number."""
    return int(mix64(np.array([x & 0xFFFFFFFFFFFFFFFF], U64))[0])


def _parts(sizes: np.ndarray) -> list[int]:
    """First distinct chunk of each part: about ``LAID`` bytes, a long chunk on its own."""
    ends = np.cumsum(np.where(sizes > LONG, np.maximum(sizes, LAID + 1), sizes))
    out, at = [], 0
    while at < len(sizes):
        out.append(at)
        at = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LAID, side="right")))
    return out


class Sampler:
    def __init__(self, vocab: dict, temperature: float, seed: int):
        self.trie = Trie(vocab)
        self.logp = vocab["logp"] / temperature
        self.seed = seed
        weight = self.logp.tolist()
        self.by_surface = {s: (weight[i], i) for i, s in vocab["surface"].items() if i not in vocab["byte"]}
        self.by_byte = [(weight[i], i) for i in self.trie.byte.tolist()]
        # lengths of the pieces that end in each byte
        sizes = [set() for _ in range(256)]
        for surface in self.by_surface:
            sizes[surface[-1]].add(len(surface))
        self.sizes = [sorted(x) for x in sizes]

    def encode(self, keys: list, texts: list[bytes]) -> list[np.ndarray]:
        """Piece ids of each text."""
        number: dict[bytes, int] = defaultdict(itertools.count().__next__)
        which, counts, seeds = [np.empty(0, np.int64)], [], []
        for key, text in zip(keys, texts):
            chunks = CHUNK.findall(text)
            which.append(np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks)))
            counts.append(len(chunks))
            seeds.append(xxhash.xxh3_64_intdigest(repr(key).encode(), self.seed))
        counts = np.array(counts, np.int64)
        chunk = np.concatenate(which)
        nth = np.arange(len(chunk)) - np.repeat(np.cumsum(counts) - counts, counts)
        stream = mix64(np.repeat(np.array(seeds, U64), counts) + nth.astype(U64) * U64(0x9E3779B97F4A7C15))
        # distinct chunks by their number, so many bytes of them at a time
        distinct = list(number)
        lows = _parts(np.fromiter(map(len, distinct), np.int64, len(distinct)))
        sizes = np.diff([*lows, len(distinct)])
        part = np.repeat(np.arange(len(lows), dtype=np.uint16 if len(lows) < 1 << 16 else np.int64), sizes)[chunk]
        order = np.argsort(part, kind="stable")
        cuts = np.cumsum(np.bincount(part, minlength=len(lows))).tolist() if len(part) else []
        taken, steps, walked = np.zeros(len(chunk), np.int64), [], {}
        for low, high, a, b in zip(lows, [*lows[1:], len(distinct)], [0, *cuts], cuts):
            own = order[a:b]
            if len(distinct[low]) > LONG:
                for who, drawn in self._walk(distinct[low], own, stream):
                    walked[who] = drawn
                    taken[who] = len(drawn)
                continue
            found = self._draw(distinct[low:high], chunk[own] - low, stream[own])
            taken[own] = np.bincount(np.concatenate([who for who, _ in found]), minlength=len(own))
            steps.append((own, found))
        ends = np.cumsum(taken)
        ids = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        for own, found in steps:
            last = ends[own] - 1
            for step, (who, piece) in enumerate(found):
                ids[last[who] - step] = piece
        for who, drawn in walked.items():
            ids[ends[who] - len(drawn) : ends[who]] = drawn
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [ids[a:b] for a, b in zip(edges[:-1], edges[1:])]

    def _draw(self, chunks: list[bytes], chunk: np.ndarray, stream: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Last pieces of the chunks asked for, then the ones before them, and so on:
        (who, piece) of each step. ``chunk`` is an index into ``chunks``."""
        lat = Lattices(self.trie, chunks)
        alpha = lat.forward(self.logp)
        into = np.diff(lat.first)
        # share of a node's paths up to and with each edge into it; 1 at the last. Each
        # node's shares are added apart, so a chunk's bounds do not depend on the others
        bound = np.exp(alpha[lat.src] + self.logp[lat.ids] - np.repeat(alpha, into))
        rank, nodes = 1, np.flatnonzero(into > 1)
        while len(nodes):
            edge = lat.first[nodes] + rank
            bound[edge] += bound[edge - 1]
            rank += 1
            nodes = nodes[into[nodes] > rank]
        bound[lat.first[1:][into > 0] - 1] = 2.0
        node, start = lat.base[chunk + 1] - 1, lat.base[chunk]
        live, steps = np.arange(len(chunk), dtype=np.int32), []
        while len(live):
            u = (mix64(stream + U64(len(steps) + 1)) >> U64(11)).astype(np.float64) * 2.0**-53
            edge = lat.first[node]
            on = np.flatnonzero(bound[edge] <= u)
            while len(on):
                edge[on] += 1
                on = on[bound[edge[on]] <= u[on]]
            steps.append((live, lat.ids[edge]))
            node = lat.src[edge]
            on = np.flatnonzero(node > start)
            live, node, start, stream = live[on], node[on], start[on], stream[on]
        return steps

    def _walk(self, text: bytes, own: np.ndarray, stream: np.ndarray):
        """(who, pieces) of the occurrences ``own`` of one long chunk, node by node, with
        one double a byte: pieces are looked up again on the way back."""
        alpha = array("d", [0.0])
        for end in range(1, len(text) + 1):
            terms = [alpha[start] + w for start, w, _ in self._into(text, end)]
            top = max(terms)
            alpha.append(top + math.log(sum([math.exp(t - top) for t in terms])))
        for who in own.tolist():
            drawn, end, base = array("i"), len(text), int(stream[who])
            while end:
                u = (mixed(base + len(drawn) + 1) >> 11) * 2.0**-53
                edges = self._into(text, end)
                total, taken = 0.0, edges[-1]
                for edge in edges[:-1]:
                    total += math.exp(alpha[edge[0]] + edge[1] - alpha[end])
                    if total > u:
                        taken = edge
                        break
                drawn.append(taken[2])
                end = taken[0]
            yield who, np.frombuffer(drawn, np.int32)[::-1]

    def _into(self, text: bytes, end: int) -> list[tuple[int, float, int]]:
        """Pieces that end at ``end``: (start, log weight, id), a byte's own one first,
        then shorter ones before longer ones, as in the laid-out lattice."""
        out = [(end - 1, *self.by_byte[text[end - 1]])]
        for size in self.sizes[text[end - 1]]:
            found = self.by_surface.get(text[end - size : end]) if size <= end else None
            if found:
                out.append((end - size, *found))
        return out


class Speller:
    """Pieces to bytes, many texts at once."""

    def __init__(self, vocab: dict):
        surface = [vocab["surface"].get(i, b"") for i in range(vocab["size"])] + [b""]
        self.none = vocab["size"]
        self.flat = np.frombuffer(b"".join(surface), np.uint8)
        self.length = np.array([len(x) for x in surface], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def spell(self, ids: np.ndarray) -> np.ndarray:
        out = []
        for a in range(0, len(ids), SPELLED):
            own = ids[a : a + SPELLED].astype(np.int64)
            own[(own < 0) | (own > self.none)] = self.none
            length = self.length[own]
            ends = np.cumsum(length)
            out.append(self.flat[np.repeat(self.start[own] - ends + length, length) + np.arange(int(ends[-1]) if len(ends) else 0)])
        return np.concatenate([np.empty(0, np.uint8), *out])

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        return self.length[np.where((ids < 0) | (ids > self.none), self.none, ids)]

    def texts(self, column) -> pa.Array:
        """A list column of ids as a binary column; null stays null."""
        offsets = column.offsets.to_numpy()
        ids = column.values.to_numpy()[offsets[0] : offsets[-1]] if len(column) else np.empty(0, np.int32)
        ends = np.concatenate([[0], np.cumsum(self.sizes(ids))])
        cuts = ends[offsets - offsets[0]] if len(column) else np.zeros(1, np.int64)
        plain = pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(self.spell(ids).tobytes())])
        return pc.if_else(column.is_valid(), plain, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def sample_pieces(
    docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", temperature: float = 1.0, seed: int = 0,
    carry: tuple[str, ...] = (), into: str | None = None,
) -> DataFrame:
    """doc_id, pieces (ids of a sampled segmentation of the whole text), n_pieces, the
    columns named in ``carry`` and, if ``into`` names one, the text that the pieces
    spell, from the same pass; one row per input row.

    ``model`` is the vocabulary's file, read by the driver and sent to the tasks
    (it is bounded by the vocabulary). Null text gives null pieces, n_pieces and
    spelling, empty text an empty array. The draw is seeded by doc_id; a null doc_id is
    a key like another, and rows alike in doc_id and text get the same pieces. Other
    columns are ignored; an empty table gives no rows. Rows are encoded, and handed on,
    about ``SLAB`` bytes of text at a time; a run of characters without a space that is
    over ``LONG`` bytes is walked with one number a byte and takes linear time."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(model))
    docs = docs.select(quoted(key).cast("long").alias("doc_id"), quoted(text).cast("binary").alias("text"), *[quoted(c).alias(f"carry{i}") for i, c in enumerate(carry)])

    def run(batches):
        sampler = Sampler(sent.value, temperature, seed)
        speller = Speller(sent.value)

        def done(part, texts):
            out = sampler.encode(part.column(0).to_pylist(), texts)
            lengths = [len(x) for x in out]
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            missing = pa.array(part.column(1).is_null().to_numpy(zero_copy_only=False))
            pieces = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *out])), mask=missing)
            counts = pa.array(np.array(lengths, np.int64), mask=missing.to_numpy(zero_copy_only=False))
            more = [speller.texts(pieces)] if into else []
            names = ["doc_id", "pieces", "n_pieces", *part.schema.names[2:], *["spelled"] * len(more)]
            return pa.RecordBatch.from_arrays([part.column(0), pieces, counts, *part.columns[2:], *more], names=names)

        for batch in batches:
            start, held, size, column = 0, [], 0, batch.column(1)
            for i in range(batch.num_rows):
                held.append(column[i].as_py() or b"")
                size += len(held[-1])
                if size >= SLAB:
                    yield done(batch.slice(start, i + 1 - start), held)
                    start, held, size = i + 1, [], 0
            if held:
                yield done(batch.slice(start), held)

    schema = StructType([
        StructField("doc_id", LongType()), StructField("pieces", ArrayType(IntegerType())), StructField("n_pieces", LongType()),
        *docs.schema.fields[2:], *[StructField("spelled", BinaryType())] * bool(into),
    ])
    out = docs.mapInArrow(run, schema)
    if into:
        out = out.withColumn("spelled", F.col("spelled").cast("string"))
    return out.toDF("doc_id", "pieces", "n_pieces", *carry, *[into] * bool(into))


def decode_pieces(encoded: DataFrame, model: str, pieces: str = "pieces", into: str = "decoded") -> DataFrame:
    """All columns and the text that ``pieces`` spell; null pieces, null text.
    Ids outside the vocabulary spell nothing."""
    sent = encoded.sparkSession.sparkContext.broadcast(vocabulary(model))
    place = encoded.columns.index(pieces)
    raw = f"{into}_bytes"

    def run(batches):
        speller = Speller(sent.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, speller.texts(batch.column(place))], names=[*batch.schema.names, raw])

    return map_rows(encoded, run, StructField(raw, BinaryType())).withColumn(into, F.col(raw).cast("string")).drop(raw)
