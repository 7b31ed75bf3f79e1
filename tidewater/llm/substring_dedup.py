"""Substring dedup with difference-cover anchors.

D = {1, 5, 11, 24, 25, 27} is a perfect difference set modulo 31: for any two
positions i and j there is a shift below 31 that takes both into D modulo 31.
So two equal windows of 50 words hold equal runs of 20 words that start, in
either text, at a cover position. Only those runs (6 of 31 positions) are hashed
and dealt out; a run that occurs in two documents is an anchor.

1. Anchors: cover positions by hash. A map task that itself sees a run in several
   documents marks all its places and sends one of them on, so a passage that
   very many documents share sends a row per map task and not per document.
2. Extension: around its anchors, and only there, each document hashes its whole
   windows (96 bits). Windows that start in a document with a smaller id are
   removed; they too are dealt out once, by hash, and a map task that itself sees
   that document sends only its windows.
3. The words that those windows cover are cut from the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, WordHash, Windows, mix64, signed, two_columns, words_of

#: Perfect difference set modulo 31 (fixed values).
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
#: Bases of the prefix-sum hashes: anchors, and the two halves of a window's.
BASES = (0x8CB92BA72F3D8DD7, 0xC2B2AE3D27D4EB4F, 0x9FB21C651E98DF25)


def cover_positions(n_words: int, length: int) -> np.ndarray:
    starts = np.arange(0, n_words - length + 1)
    return starts[np.isin(starts % PERIOD, COVER)]


def _anchor_rows(docs: DataFrame, window: int, length: int, flush: int) -> DataFrame:
    """at (hash, or a spread key for places known to be shared), doc_id, pos, sure."""

    def combined(parts):
        """Of places whose hash the parts hold for several documents, all are
        sure; one of each hash goes on, to tell the other tasks."""
        at, doc, pos = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((doc, at))
        at, doc, pos = at[order], doc[order], pos[order]
        first = np.ones(len(at), bool)
        first[1:] = at[1:] != at[:-1]
        group = np.cumsum(first) - 1
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(at)) - 1
        shared = (doc[starts] != doc[ends])[group]
        send = ~shared | first
        spread = signed(mix64(doc[shared].view(U64) + mix64(pos[shared].astype(U64))))
        return pa.RecordBatch.from_arrays(
            [
                np.concatenate([at[send], spread]),
                np.concatenate([doc[send], doc[shared]]),
                np.concatenate([pos[send], pos[shared]]).astype(np.int32),
                np.concatenate([np.zeros(int(send.sum()), bool), np.ones(int(shared.sum()), bool)]),
            ],
            names=["at", "doc_id", "pos", "sure"],
        )

    def run(batches):
        hashes, windows = WordHash(), Windows(BASES[0])
        parts, held = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                if len(words) < window:
                    continue
                pos = cover_positions(len(words), length)
                at = signed(windows.at(hashes.array(words), length))[pos]
                parts.append((at, np.full(len(pos), doc, np.int64), pos))
                held += len(pos)
                if held >= flush:
                    yield combined(parts)
                    parts, held = [], 0
        if parts:
            yield combined(parts)

    return docs.mapInArrow(run, "at long, doc_id long, pos int, sure boolean")


def _shared(anchors: DataFrame) -> DataFrame:
    """(doc_id, pos) of anchors that occur in several documents.

    Rows arrive sorted by hash and document and are streamed: of a hash, only the
    places in its first document are held until a second document shows up."""

    def run(batches):
        hash_, doc_, waiting, open_ = None, None, [], False
        for batch in batches:
            at, doc, pos, sure = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("at", "doc_id", "pos", "sure"))
            out = sure.copy()
            plain = np.flatnonzero(~sure)
            early = []
            if len(plain):
                a, d = at[plain], doc[plain]
                first = np.ones(len(a), bool)
                first[1:] = a[1:] != a[:-1]
                group = np.cumsum(first) - 1
                starts = np.flatnonzero(first)
                ends = np.append(starts[1:], len(a)) - 1
                many = d[starts] != d[ends]
                if hash_ is not None and a[0] == hash_:
                    if open_ or d[ends[0]] != doc_:
                        many[0], early = True, waiting
                        waiting = []
                    head_doc, head = doc_, waiting
                else:
                    head_doc, head = d[starts[0]], []
                out[plain] = many[group]
                lone = ~many[group[-1]]
                last = slice(starts[-1], None)
                here = list(zip(d[last].tolist(), pos[plain][last].tolist())) if lone else []
                waiting = (head if len(starts) == 1 else []) + here if lone else []
                doc_ = head_doc if len(starts) == 1 else int(d[starts[-1]])
                hash_, open_ = int(a[-1]), bool(many[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    np.concatenate([doc[out], np.array([x[0] for x in early], np.int64)]),
                    np.concatenate([pos[out], np.array([x[1] for x in early], np.int32)]),
                ],
                names=["doc_id", "pos"],
            )

    dealt = anchors.repartition("at").sortWithinPartitions("at", "doc_id")
    return dealt.mapInArrow(run, "doc_id long, pos int")


def _window_rows(texts: DataFrame, window: int, length: int, flush: int) -> DataFrame:
    """at, tag (together a 96-bit hash), doc_id, start of every window that holds an
    anchor; sure: a smaller document of the same map task has it too."""
    reach = window - length

    def combined(parts):
        doc, start, at, tag = (np.concatenate([p[i] for p in parts]) for i in range(4))
        order = np.lexsort((doc, tag, at))
        doc, start, at, tag = doc[order], start[order], at[order], tag[order]
        first = np.ones(len(at), bool)
        first[1:] = (at[1:] != at[:-1]) | (tag[1:] != tag[:-1])
        sure = doc != doc[np.flatnonzero(first)][np.cumsum(first) - 1]
        at[sure] = signed(mix64(doc[sure].view(U64) + mix64(start[sure].astype(U64))))
        # back to the order of documents, in which ids repeat and pack well
        order = np.lexsort((start, doc))
        return pa.RecordBatch.from_arrays(
            [at[order], tag[order], doc[order], start[order].astype(np.int32), pa.array(sure[order])], names=["at", "tag", "doc_id", "start", "sure"]
        )

    def run(batches):
        hashes, one, two = WordHash(), Windows(BASES[1]), Windows(BASES[2])
        parts, held = [], 0
        for batch in batches:
            for doc, text, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                words = words_of(text.as_py())
                m = len(words) - window + 1
                if m < 1:
                    continue
                pos = places.values.to_numpy()
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, np.clip(pos - reach, 0, m), 1)
                np.add.at(edge, np.clip(pos + 1, 0, m), -1)
                start = np.flatnonzero(np.cumsum(edge)[:m])
                h = hashes.array(words)
                tag = (two.at(h, window)[start] >> U64(32)).astype(np.uint32).view(np.int32)
                parts.append((np.full(len(start), doc, np.int64), start, signed(one.at(h, window))[start], tag))
                held += len(start)
                if held >= flush:
                    yield combined(parts)
                    parts, held = [], 0
        if parts:
            yield combined(parts)

    return texts.mapInArrow(run, "at long, tag int, doc_id long, start int, sure boolean")


def _late(windows: DataFrame) -> DataFrame:
    """(doc_id, start, tag) of windows that start in a smaller document. Rows are
    sorted by hash and document and streamed: a window's first document is all
    that is remembered."""

    def run(batches):
        at_, tag_, first_ = None, None, None
        for batch in batches:
            at, tag, doc, start, sure = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("at", "tag", "doc_id", "start", "sure"))
            late = sure.copy()
            plain = np.flatnonzero(~sure)
            if len(plain):
                a, t, d = at[plain], tag[plain], doc[plain]
                head = np.ones(len(a), bool)
                head[1:] = (a[1:] != a[:-1]) | (t[1:] != t[:-1])
                lead = d[np.flatnonzero(head)]
                if a[0] == at_ and t[0] == tag_:
                    lead[0] = first_
                lead = lead[np.cumsum(head) - 1]
                late[plain] = d > lead
                at_, tag_, first_ = a[-1], t[-1], lead[-1]
            yield pa.RecordBatch.from_arrays([doc[late], start[late], tag[late]], names=["doc_id", "start", "tag"])

    dealt = windows.repartition("at").sortWithinPartitions("at", "tag", "doc_id")
    return dealt.mapInArrow(run, "doc_id long, start int, tag int")


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """Drop the words that removed windows cover. A row takes only the windows
    that it really holds (``tag``), should several rows share a doc_id."""

    def run(batches):
        hashes, two = WordHash(), Windows(BASES[2])
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, cuts in zip(batch.column(1), batch.column(2)):
                text = text.as_py()
                words = words_of(text)
                gone = 0
                if cuts.is_valid and len(words) >= window:
                    cuts = cuts.values.to_numpy()
                    start, tag = cuts >> 32, cuts.astype(np.uint32).view(np.int32)
                    own = (two.at(hashes.array(words), window) >> U64(32)).astype(np.uint32).view(np.int32)
                    start, tag = start[start < len(own)], tag[start < len(own)]
                    start = start[own[start] == tag]
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + window, -1)
                    stay = np.cumsum(edge)[:-1] == 0
                    gone = len(words) - int(stay.sum())
                    if gone:
                        words = [words[i] for i in np.flatnonzero(stay)]
                sizes.append(len(words) + gone)
                removed.append(gone)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return texts.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary")


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 50, flush: int = 1 << 20) -> DataFrame:
    """Remove each word covered by a run of ``window`` words that also starts in
    a document with a smaller doc_id; windows are judged on the input.

    Returns one row per input row: doc_id, n_words, n_removed and kept_text (the
    words that stay, joined by one space). Words are unchanged runs outside space
    and 0x09-0x0D.

    Null or empty text: no words, empty kept_text. A text of fewer words than the
    window loses nothing. A null doc_id has no order: such a row neither loses
    words nor makes others lose any. Rows that share a doc_id never remove one
    another's words. Other columns are ignored; an empty table gives no rows.
    ``window`` must be at least 32, for the anchors' length to be positive.
    ``flush`` places are combined at a time in a map task; it bounds memory and
    doesn't change the result."""
    length = window - PERIOD + 1
    if length < 2:
        raise ValueError(f"window must be at least {PERIOD + 1}")
    docs = two_columns(docs, key, text).withColumn("text", F.col("text").cast("binary"))
    ordered = docs.where("doc_id IS NOT NULL")
    anchors = _anchor_rows(ordered, window, length, flush)
    places = _shared(anchors).groupBy("doc_id").agg(F.collect_list("pos").alias("places"))
    late = _late(_window_rows(ordered.join(places, "doc_id"), window, length, flush))
    cuts = late.groupBy("doc_id").agg(F.collect_list(F.expr("shiftleft(cast(start AS bigint), 32) | (cast(tag AS bigint) & 4294967295)")).alias("cuts"))
    kept = _cut(ordered.join(cuts, "doc_id", "left").select("doc_id", "text", "cuts"), window)
    loose = _cut(docs.where("doc_id IS NULL").select("doc_id", "text", F.lit(None).cast(cuts.schema["cuts"].dataType).alias("cuts")), window)
    return kept.unionByName(loose).select("doc_id", "n_words", "n_removed", F.col("kept").cast("string").alias("kept_text"))
