"""Cross-tokenizer alignment by inverted pair bitmaps.

Two tokenizers cut the same bytes. Where tokens of both end at one byte, a group
ends; tokens of one group are linked.

1. A task numbers its documents in blocks. For each pair of linked ids, a block
   keeps the bitmap of the documents that hold it, and one bitmap for each binary
   digit of "links less one" (the multiplicity planes). A bitmap is a list of
   two-byte numbers, or plain bits where those are shorter.
2. Bitmaps of one pair and block are OR-merged in the task, and popcounted. Blocks
   share no document, so the sum over blocks is the number of documents that hold
   the pair; the planes' popcounts give the number of links.
3. The postings carry a pair's count back: each document of a bitmap gets the
   count, times the plane's weight.

A text is cut at single spaces between other characters. No token of a byte-level
pre-tokenizer, and no piece with the mark in its middle, crosses such a place, so
the parts are tokenized apart, each distinct part once.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import scratch_path

from .common import two_columns

CUT = re.compile(r"(?<=\S) (?=\S)")
#: Characters of text that are cut and numbered at a time.
SLAB = 1 << 20
#: Parts that tokenizer A reads as one text.
JOINED = 64
#: Distinct parts remembered by a task, if they have 16 characters each.
PARTS = 200_000
#: Documents and linked pairs after which a block ends; two bytes number a document.
BLOCK_DOCS, BLOCK_PAIRS = 1 << 16, 3 << 20

ROWS = (
    "block long, slot int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pair long, plane int, held long, bitmap binary"
)


def byte_level() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 characters
    are themselves, all other bytes follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, bpe_json: str, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(bpe_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        to_byte = byte_level()
        self.a_bytes = []
        for i in range(self.a.get_vocab_size()):
            entry = self.a.id_to_token(i) or ""
            known = all(c in to_byte for c in entry)
            self.a_bytes.append(bytes(to_byte[c] for c in entry) if known else entry.encode())
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        ]
        self.width = len(self.b_bytes)
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_spelled, self.b_spelled = Strings(self.a_bytes), Strings(self.b_bytes)
        # ids of A, then of B, in digits and the mark that follows them inside a group
        self.digits = Strings([b"%d," % i for n in (len(self.a_bytes), self.width) for i in range(n)])

    def encode(self, parts: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all parts as if a space stood before each, and their number by part, of A
        and of B, which adds the space itself. ``sizes``: bytes of each part and its space."""
        b, size_b = _flat(self.b.encode(parts, num_threads=1))
        texts = []
        for i in range(0, len(parts), JOINED):
            some = parts[i : i + JOINED]
            joined = all([p.strip() == p != "" for p in some])  # cut at single spaces again
            texts += [" " + " ".join(some)] if joined else [" " + p for p in some]
        a, _ = self._ids_of_a(texts)
        at, ends = np.cumsum(self.a_len[a]), np.cumsum(sizes)
        upto = np.searchsorted(at, ends, side="right")
        if np.array_equal(np.concatenate([[0], at])[upto], ends) and upto[-1:].sum() == len(a):
            size_a = np.diff(upto, prepend=0)
        else:  # a part's tokens have other bytes than the part
            a, size_a = self._ids_of_a([" " + p for p in parts])
        return a, size_a, b, size_b

    def _ids_of_a(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat([e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)])


class Strings:
    """Byte strings laid end to end, read many at once by their numbers."""

    def __init__(self, strings: list[bytes]):
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.length = np.array([len(x) for x in strings], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        return self.flat[_spread(self.start[numbers], self.length[numbers])]


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ..., ``sizes[i]`` numbers for each i."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class Parts:
    """What is known of each distinct part: tokens, groups, links, linked pairs
    with their number of links, and its share of the digest's input."""

    FIELDS = ("ok", "n_a", "n_b", "n_groups", "n_links", "n_pairs")

    def __init__(self, pair: Pair):
        self.tokens = pair
        self.clear()

    def clear(self):
        self.number: dict[str, int] = defaultdict(itertools.count().__next__)
        self.columns = {f: np.empty(0, np.int64) for f in self.FIELDS}
        self.pairs = self.times = np.empty(0, np.int64)
        self.spelled: list[bytes] = []
        self.chars = 0

    def numbers(self, parts: list[str]) -> np.ndarray:
        start = len(self.number)
        out = np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))
        if len(self.number) > start:
            self._add(list(itertools.islice(self.number, start, None)))
        return out

    def _add(self, parts: list[str]):
        t = self.tokens
        self.chars += sum(map(len, parts))
        whole = [b" " + p.encode() for p in parts]
        size = np.fromiter(map(len, whole), np.int64, len(whole))
        a, size_a, b, size_b = t.encode(parts, size)
        owner_a, owner_b = np.repeat(np.arange(len(parts)), size_a), np.repeat(np.arange(len(parts)), size_b)
        ok = self._same(whole, size, a, owner_a, t.a_spelled) & self._same(whole, size, b, owner_b, t.b_spelled)
        a, owner_a = a[ok[owner_a]], owner_a[ok[owner_a]]
        b, owner_b = b[ok[owner_b]], owner_b[ok[owner_b]]
        end_a, end_b = np.cumsum(t.a_len[a]), np.cumsum(t.b_len[b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        n = len(common)
        in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        owner = owner_a[np.cumsum(in_a) - 1] if n else np.empty(0, np.int64)
        # distinct ids of a group, with their times in it
        ka, times_a = np.unique(group_a * len(t.a_bytes) + a, return_counts=True)
        kb, times_b = np.unique(group_b * t.width + b, return_counts=True)
        ga, gb = ka // len(t.a_bytes), kb // t.width
        size = np.bincount(gb, minlength=n)
        first = np.cumsum(size) - size
        right = _spread(first[ga], size[ga])
        left = np.repeat(np.arange(len(ka)), size[ga])
        pairs = (ka[left] % len(t.a_bytes)) * t.width + kb[right] % t.width
        times = times_a[left] * times_b[right]
        count = lambda w, weights=None: np.bincount(w, weights, len(parts)).astype(np.int64)
        fresh = {
            "ok": ok.astype(np.int64), "n_a": count(owner_a), "n_b": count(owner_b), "n_groups": count(owner),
            "n_links": count(owner, in_a * in_b), "n_pairs": count(owner[ga[left]]),
        }
        for f in self.FIELDS:
            self.columns[f] = np.concatenate([self.columns[f], fresh[f]])
        self.pairs, self.times = np.concatenate([self.pairs, pairs]), np.concatenate([self.times, times])
        self.spelled += self._spell(len(parts), a, b, group_a, group_b, in_a, in_b, owner)

    @staticmethod
    def _same(whole: list[bytes], size: np.ndarray, ids: np.ndarray, owner: np.ndarray, spelled: Strings) -> np.ndarray:
        """Parts whose tokens' joined bytes are the part's own."""
        ok = np.bincount(owner, spelled.length[ids], len(size)) == size
        own = spelled.joined(ids[ok[owner]])
        other = np.flatnonzero(own != np.frombuffer(b"".join(itertools.compress(whole, ok.tolist())), np.uint8))
        ok[np.flatnonzero(ok)[np.searchsorted(np.cumsum(size[ok]), other, side="right")]] = False
        return ok

    def _spell(self, n, a, b, group_a, group_b, in_a, in_b, owner) -> list[bytes]:
        """``a1,a2|b1;`` of all groups of each of ``n`` parts."""
        t = self.tokens
        last_a, last_b = np.cumsum(in_a), np.cumsum(in_b)
        numbers = np.empty(len(a) + len(b), np.int64)
        numbers[np.arange(len(a)) + (last_b - in_b)[group_a]] = a
        numbers[np.arange(len(b)) + last_a[group_b]] = b + len(t.a_bytes)
        flat, ends = t.digits.joined(numbers), np.cumsum(t.digits.length[numbers])
        group_ends = last_a + last_b - 1
        flat[ends[group_ends - in_b] - 1] = ord("|")
        flat[ends[group_ends] - 1] = ord(";")
        cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, np.diff(ends[group_ends], prepend=0), n))]).astype(np.int64).tolist()
        flat = flat.tobytes()
        return [flat[x:y] for x, y in zip(cuts, cuts[1:])]


def _windows(text: str):
    """The text's parts, a window of about ``SLAB`` characters at a time."""
    start = 0
    while True:
        cut = CUT.search(text, start + SLAB) if len(text) - start > SLAB else None
        window = text[start : cut.start()] if cut else text[start:] if start else text
        plain = window.isprintable() and "  " not in window and window[:1] != " " and window[-1:] != " "
        yield window.split(" ") if plain else CUT.split(window)
        if cut is None:
            return
        start = cut.end()


class Block:
    """Linked pairs of the documents of one block, as postings."""

    def __init__(self):
        self.codes, self.times, self.size, self.docs = [], [], 0, 0

    def add(self, slots: np.ndarray, pairs: np.ndarray, times: np.ndarray):
        self.codes.append((pairs << 16) | slots)
        self.times.append(times)
        self.size += len(pairs)
        if self.size > 2 * BLOCK_PAIRS:
            self.merge()

    def merge(self):
        """OR of the postings so far; links of one pair and document add up."""
        code, times = np.concatenate([np.empty(0, np.int64), *self.codes]), np.concatenate([np.empty(0, np.int64), *self.times])
        order = np.argsort(code)
        code, times = code[order], times[order]
        cut = np.flatnonzero(np.concatenate([np.ones(min(1, len(code)), bool), code[1:] != code[:-1]]))
        self.codes, self.times = [code[cut]], [np.add.reduceat(times, cut) if len(cut) else times]
        self.size = len(cut)

    def bitmaps(self):
        """(pair, plane, held, bitmap) columns; plane -1 is the documents' own."""
        self.merge()
        code, more = self.codes[0], self.times[0] - 1
        out = [self._coded(code, -1)]
        for plane in range(int(more.max(initial=0)).bit_length()):
            out.append(self._coded(code[(more >> plane) & 1 == 1], plane))
        return out

    def _coded(self, code: np.ndarray, plane: int):
        pair, slot = code >> 16, (code & 0xFFFF).astype(np.uint16)
        start = np.flatnonzero(np.concatenate([np.ones(min(1, len(code)), bool), pair[1:] != pair[:-1]]))
        held = np.diff(np.append(start, len(code)))
        flat = slot.tobytes()
        bits = -(-self.docs // 8)
        offsets = np.concatenate([[0], np.cumsum(2 * held)])
        wide = np.flatnonzero(2 * held > bits + 1)
        if not len(wide):
            column = pa.Array.from_buffers(pa.large_binary(), len(held), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat)])
        else:
            parts = [flat[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            for w in wide.tolist():
                plain = np.zeros(8 * bits, bool)
                plain[slot[start[w] : start[w] + held[w]]] = True
                packed = np.packbits(plain, bitorder="little").tobytes()
                parts[w] = packed + b"\0" * (1 - len(packed) % 2)  # odd length: plain bits
            column = pa.array(parts, pa.large_binary())
        return pair[start], plane, held, column.cast(pa.binary())


def slots_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, document) of every document in a column of bitmaps."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    size = np.diff(offsets)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    listed = np.flatnonzero(size % 2 == 0)
    place = _spread(offsets[listed], size[listed])
    row, slot = np.repeat(listed, size[listed] // 2), data[place].astype(np.int64)
    slot = slot[0::2] | (slot[1::2] << 8)
    rows, slots = [row], [slot]
    for r in np.flatnonzero(size % 2).tolist():
        on = np.flatnonzero(np.unpackbits(data[offsets[r] : offsets[r + 1]], bitorder="little"))
        rows.append(np.full(len(on), r))
        slots.append(on)
    return np.concatenate(rows), np.concatenate(slots)


def pair_bitmaps(docs: DataFrame, bpe_json: str, piece_model: str) -> DataFrame:
    """Rows of two kinds from one pass over (doc_id, text): one for each document
    (``pair`` is null), and the bitmaps of each block."""
    with open(bpe_json, encoding="utf-8") as f:
        sent_json = f.read()
    with open(piece_model, "rb") as f:
        sent_model = f.read()
    sent = docs.sparkSession.sparkContext.broadcast((sent_json, sent_model))
    types = pa.schema([
        ("block", pa.int64()), ("slot", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pair", pa.int64()),
        ("plane", pa.int32()), ("held", pa.int64()), ("bitmap", pa.binary()),
    ])

    def batch_of(n, **columns):
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in types], schema=types)

    def run(batches):
        from pyspark import TaskContext

        parts = Parts(Pair(*sent.value))
        block, number = Block(), TaskContext.get().partitionId() << 24

        def close():
            for pair, plane, held, bitmap in block.bitmaps():
                for a in range(0, len(pair), 1 << 16):
                    n = len(pair[a : a + (1 << 16)])
                    yield batch_of(
                        n, block=pa.array(np.full(n, number)), pair=pa.array(pair[a : a + n]), plane=pa.array(np.full(n, plane, np.int32)),
                        held=pa.array(held[a : a + n]), bitmap=bitmap.slice(a, n),
                    )

        def several(texts):
            """Totals and digests of short texts, numbered and counted at once."""
            cut = [[] if not t else next(_windows(t)) for t in texts]
            which = parts.numbers([p for c in cut for p in c])
            return which, np.fromiter(map(len, cut), np.int64, len(cut))

        def measured(which, sizes, slots):
            owner = np.repeat(np.arange(len(sizes)), sizes)
            c = parts.columns
            bad = np.bincount(owner, 1 - c["ok"][which], len(sizes)) > 0
            totals = [np.bincount(owner, c[f][which], len(sizes)).astype(np.int64) for f in ("n_a", "n_b", "n_groups", "n_links")]
            sizes_ = c["n_pairs"]
            first = (np.cumsum(sizes_) - sizes_)[which]
            place = _spread(first, sizes_[which])
            return bad, totals, (np.repeat(slots[owner], sizes_[which]), parts.pairs[place], parts.times[place])

        def result(ids, slots, totals, digests):
            return batch_of(
                len(ids), block=pa.array(np.full(len(ids), number)), slot=pa.array(np.array(slots, np.int32)), doc_id=pa.array(ids, pa.int64()),
                **{f: pa.array(v) for f, v in zip(("n_a", "n_b", "n_groups", "n_links"), totals)}, groups_sha256=pa.array(digests, pa.string()),
            )

        def short(ids, texts):
            which, sizes = several(texts)
            slots = np.arange(block.docs, block.docs + len(ids))
            bad, totals, (slot, pair, times) = measured(which, sizes, slots)
            for t in totals:
                t[bad] = 0
            keep = ~bad[slot - block.docs]
            block.add(slot[keep], pair[keep], times[keep])
            ends, digests, spelled = np.cumsum(sizes).tolist(), [], parts.spelled
            which = which.tolist()
            for i, end in enumerate(ends):
                own = which[end - sizes[i] : end]
                digests.append("" if bad[i] or not own else hashlib.sha256(b"".join(map(spelled.__getitem__, own))[:-1]).hexdigest())
            block.docs += len(ids)
            return result(ids, slots, totals, digests)

        def long(key, text):
            """One text, a window at a time."""
            slot, totals, digest, held, bad = block.docs, np.zeros(4, np.int64), hashlib.sha256(), b"", False
            kept = Block()
            for window in _windows(text):
                which = parts.numbers(window)
                worse, more, (slots, pair, times) = measured(which, np.array([len(which)]), np.array([slot]))
                bad |= bool(worse[0])
                totals += np.concatenate(more)
                kept.add(slots, pair, times)
                digest.update(held)
                held = b"".join(map(parts.spelled.__getitem__, which.tolist()))
                forget()
            digest.update(held[:-1])
            if not bad:
                kept.merge()
                block.add(kept.codes[0] & 0xFFFF, kept.codes[0] >> 16, kept.times[0])
            block.docs += 1
            return result([key], [slot], np.where(bad, 0, totals).reshape(4, 1), ["" if bad else digest.hexdigest()])

        def forget():
            if len(parts.number) > PARTS or parts.chars > 16 * PARTS or len(parts.pairs) > 16 * PARTS:
                parts.clear()

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            at, n = 0, batch.num_rows
            sizes = pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64)
            while at < n:
                room = BLOCK_DOCS - block.docs
                end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at : at + room]), SLAB)))
                end = min(end, n, at + room)
                keys, held = ids.slice(at, end - at).to_pylist(), texts.slice(at, end - at).to_pylist()
                yield long(keys[0], held[0]) if end - at == 1 and len(held[0] or "") > SLAB else short(keys, held)
                forget()
                at = end
                if block.size >= BLOCK_PAIRS or block.docs >= BLOCK_DOCS:
                    yield from close()
                    block, number = Block(), number + 1
        yield from close()

    return docs.mapInArrow(run, ROWS)


def pair_counts(bitmaps: DataFrame) -> DataFrame:
    """pair, docs (documents that hold it linked) and links, from the popcounts."""
    weight = F.when(F.col("plane") < 0, F.lit(1)).otherwise(F.expr("shiftleft(1L, greatest(plane, 0))"))
    return bitmaps.groupBy("pair").agg(
        F.sum(F.when(F.col("plane") < 0, F.col("held")).otherwise(0)).alias("docs"), F.sum(F.col("held") * weight).alias("links")
    )


def _returned(postings: DataFrame) -> DataFrame:
    """block, slot, n_best, count_sum from (block, plane, bitmap, docs, best)."""

    def run(batches):
        current, sums = None, None

        def flush():
            on = np.flatnonzero(sums[1])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(on), current)), pa.array(on.astype(np.int32)), pa.array(sums[0][on]), pa.array(sums[1][on])],
                names=["block", "slot", "n_best", "count_sum"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            block = batch.column("block").to_numpy()
            weight = np.int64(1) << np.maximum(batch.column("plane").to_numpy(), 0).astype(np.int64)
            best = batch.column("best").to_numpy(zero_copy_only=False).astype(np.int64) * weight
            total = batch.column("docs").to_numpy() * weight
            cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(block)]):
                if block[a] != current:
                    if current is not None:
                        yield flush()
                    current, sums = int(block[a]), np.zeros((2, BLOCK_DOCS), np.int64)
                row, slot = slots_of(batch.column("bitmap").slice(a, b - a))
                np.add.at(sums[0], slot, best[a + row])
                np.add.at(sums[1], slot, total[a + row])
        if current is not None:
            yield flush()

    keyed = postings.repartition("block").sortWithinPartitions("block")
    return keyed.mapInArrow(run, "block long, slot int, n_best long, count_sum long")


def aligned_tokens(
    docs: DataFrame, bpe_json: str, piece_model: str, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Links between the tokens of a byte-level BPE (A, of " " and text) and a
    SentencePiece model (B, which adds the space). Returns two tables:

    documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, one row per input row. A pair's count is the number of rows
    whose text holds it linked; n_best counts the links whose pair has the highest
    count of its A id (ties included), count_sum adds up the links' counts.

    pairs: a, b, docs, links, best; one row for each linked pair of ids.

    Strings of special tokens are ordinary text. Null or empty text, and a text
    whose joined A or B bytes are not " " and the text (a literal mark), has no
    tokens: zeros, and '' for the digest. Null and repeated doc_ids keep their
    rows; each row counts as a document. Other columns are ignored; an empty table
    gives empty tables. A long text is read in windows, and a block of documents
    ends at ``BLOCK_PAIRS`` postings, so memory does not grow with the input. Sums
    are exact as long as they fit a long."""
    docs = two_columns(docs, key, text)
    spark = docs.sparkSession
    path = scratch_path(spark, "alignment")
    pair_bitmaps(docs, bpe_json, piece_model).write.parquet(path)
    rows = spark.read.schema(ROWS).parquet(path)
    with open(piece_model, "rb") as f:
        import sentencepiece

        width = sentencepiece.SentencePieceProcessor(model_proto=f.read()).get_piece_size()
    bitmaps = rows.where("pair IS NOT NULL").select("block", "pair", "plane", "held", "bitmap")
    counts = pair_counts(bitmaps).withColumn("a", F.expr(f"pair div {width}"))
    top = counts.groupBy("a").agg(F.max("docs").alias("most"))
    counts = counts.join(top, "a").select("pair", "a", (F.col("pair") % width).alias("b"), "docs", "links", (F.col("docs") == F.col("most")).alias("best"))
    scores_path = scratch_path(spark, "alignment-pairs")
    counts.write.parquet(scores_path)
    scores = spark.read.schema(counts.schema).parquet(scores_path)
    postings = bitmaps.select("block", "pair", "plane", "bitmap").join(scores.select("pair", "docs", "best"), "pair")
    back = _returned(postings.select("block", "plane", "bitmap", "docs", "best"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    out = (
        rows.where("pair IS NULL")
        .join(back, ["block", "slot"], "left")
        .select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
    )
    return out, scores.select("a", "b", "docs", "links", "best")
