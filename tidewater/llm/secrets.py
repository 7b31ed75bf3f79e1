"""Secret scan with a recursive decoding worklist.

A text's layers are worked off from a list: the text itself, then whatever its
URL escapes, Unicode escapes, base64 runs and compressed payloads unwrap to, and
so on until no layer yields a new one. A layer's digest is remembered, so layers
that decode into each other end. Each layer is scanned by the same patterns, and
each of its bytes knows the span of the original text that it came from.
"Remembered" means the digest together with that span: a payload that occurs
twice is unwrapped at both places.

Decoded layers are bytes, whatever their character set: the patterns are ASCII.
"""

from __future__ import annotations

import binascii
import hashlib
import mmap
import re
import tempfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import two_columns

#: Kinds in their order, and their patterns (fixed values).
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
NAMES = ("password", "passwd", "secret", "token", "api")
ASSIGN_BYTES, ACCESS_BYTES, HEX_BYTES = re.compile(ASSIGN.pattern.encode(), re.I), re.compile(ACCESS.pattern.encode()), re.compile(HEX.pattern.encode())

URL = re.compile(rb"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(rb"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
#: Escapes of a byte string literal. They are undone only where one holds a compressed payload.
LITERAL = re.compile(rb"\\x([0-9A-Fa-f]{2})|\\([0-7]{1,3})|\\([abfnrtv\\'\"])")
LITERAL_MAGIC = re.compile(rb"\\x1f\\x8b|\\037\\213|(?:x|\\x78|\\170)(?:\\x(?:01|5e|9c|da)|\\0?01|\\23[24]|\\332|\^)", re.I)
CONTROL = dict(zip(b"abfnrtv\\'\"", b"\a\b\f\n\r\t\v\\'\""))
#: Where a gzip or zlib payload may begin.
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")
#: Runs of base64, also over line breaks, and their parts: whole lines, and what no sign divides.
BASE64 = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-][A-Za-z0-9+/_\r\n-]{15,}={0,2}")
PARTS = (re.compile(rb"[A-Za-z0-9+/_-]{16,}"), re.compile(rb"[A-Za-z0-9+]{16,}"))
SIGNIFICANT = re.compile(rb"[^0-9a-f\r\n]")
#: Without any of these, a layer holds no secret and unwraps to nothing.
CAUSE = re.compile(rb"(?i:password|passwd|secret|token|api)|AKIA|[0-9a-f]{24}|%[0-9A-Fa-f]{2}|\\[uUx]|&#|[A-Za-z0-9+/_-][A-Za-z0-9+/_\r\n-]{15}|" + MAGIC.pattern)
STANDARD = bytes.maketrans(b"-_", b"+/")
PLUS = re.compile(rb"\++")
GZIP = b"\x1f\x8b\x08"
CHUNK = 1 << 16


def scan(text: str) -> list[tuple[str, int, int]]:
    """Spans of one layer: leftmost, non-overlapping per kind. Runs of hex digits
    and access keys are maximal, so a minimum length in their patterns drops the
    same matches as a later test would."""
    found = []
    low = text.lower()
    if any(name in low for name in NAMES):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def _scan_bytes(data) -> list[tuple[str, int, int]]:
    """``scan`` of a decoded layer."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN_BYTES.finditer(data) if m.end(2) - m.start(2) >= 6]
    found += [("access", m.start(), m.end()) for m in ACCESS_BYTES.finditer(data)]
    return found + [("hex", m.start(), m.end()) for m in HEX_BYTES.finditer(data)]


def _kinds(data) -> list[str]:
    """The kinds of secrets in a layer."""
    found = ["assign"] if any(m.end(2) - m.start(2) >= 6 for m in ASSIGN_BYTES.finditer(data)) else []
    return found + [kind for kind, p in (("access", ACCESS_BYTES), ("hex", HEX_BYTES)) if p.search(data)]


class Sink:
    """Bytes of a layer: beyond ``limit`` in a file without a name in the task's temp
    folder, which is then mapped and not read."""

    def __init__(self, limit: int):
        self.file, self.size, self.limit = tempfile.SpooledTemporaryFile(max(limit, 1)), 0, max(limit, 1)

    def write(self, data: bytes) -> None:
        self.file.write(data)
        self.size += len(data)

    def copy(self, data, a: int, b: int) -> None:
        for x in range(a, b, CHUNK):
            self.write(data[x : min(x + CHUNK, b)])

    def data(self):
        with self.file as f:
            if self.size > self.limit:
                f.flush()
                return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
            f.seek(0)
            return f.read()


class Layer:
    """Bytes and, per byte, the original span: arrays, or one span for all. A payload
    that reaches the layer's end ends at ``tail``."""

    def __init__(self, data, starts: np.ndarray | None = None, ends: np.ndarray | None = None, whole: tuple[int, int] | None = None, tail: int = 0):
        self.data, self.starts, self.ends, self.whole, self.tail = data, starts, ends, whole, tail

    @classmethod
    def of_text(cls, text: str) -> Layer:
        data = text.encode("utf-8", "surrogatepass")
        first = np.ones(len(data), bool) if len(data) == len(text) else (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
        starts = np.cumsum(first) - 1
        return cls(data, starts, starts + 1)

    def span(self, a: int, b: int) -> tuple[int, int]:
        if self.whole or a == b:
            return self.whole or (0, 0)
        return int(self.starts[a:b].min()), max(int(self.ends[a:b].max()), self.tail if b == len(self.data) else 0)

    def secrets(self) -> set[tuple[str, int, int]]:
        if self.whole:
            return {(kind, *self.whole) for kind in _kinds(self.data)}
        return {(kind, int(self.starts[a:b].min()), int(self.ends[a:b].max())) for kind, a, b in _scan_bytes(self.data)}


def _replaced(layer: Layer, pattern: re.Pattern, decode, limit: int) -> Layer | None:
    """The layer with each match decoded in place; None if nothing decodes."""
    data, at, out, starts, ends, changed = layer.data, 0, Sink(limit), [], [], False
    for m in pattern.finditer(data):
        new = decode(m)
        if new is None:
            continue
        changed = True
        out.copy(data, at, m.start())
        out.write(new)
        if not layer.whole:
            s, e, n = layer.starts[m.start() : m.end()], layer.ends[m.start() : m.end()], len(new)
            each = decode is _url
            starts += [layer.starts[at : m.start()], s[::3] if each else np.full(n, s[0])]
            ends += [layer.ends[at : m.start()], e[2::3] if each else np.full(n, e[-1])]
        at = m.end()
    if not changed:
        return None
    out.copy(data, at, len(data))
    if layer.whole:
        return Layer(out.data(), whole=layer.whole)
    return Layer(out.data(), np.concatenate([*starts, layer.starts[at:]]), np.concatenate([*ends, layer.ends[at:]]))


def _url(m: re.Match) -> bytes:
    return bytes.fromhex(m[0].replace(b"%", b"").decode())


def _escape(m: re.Match) -> bytes | None:
    digits = next((int(g, 16) for g in m.groups()[:5] if g), None)
    code = int(m[6]) if digits is None else digits
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return None
    return bytes([code]) if code < 256 else chr(code).encode()


def _literal(m: re.Match) -> bytes:
    if m[3]:
        return bytes([CONTROL[m[3][0]]])
    return bytes([int(m[1], 16) if m[1] else int(m[2], 8) & 255])


def _spaces(m: re.Match) -> bytes:
    return b" " * len(m[0])


def _decoded(layer: Layer, a: int, b: int, skip: int, limit: int, tail: int) -> Layer | None:
    """Base64 between two places of a layer, without line breaks and the first ``skip`` characters."""
    if layer.whole:
        out, held, x = Sink(limit), b"", a
        while x < b:
            held += layer.data[x : min(x + CHUNK, b)].translate(STANDARD, b"\r\n")
            x += CHUNK
            held, skip = held[skip:], max(0, skip - len(held))
            n = len(held) // 4 * 4
            out.write(binascii.a2b_base64(held[:n]))
            held = held[n:]
        if len(held) > 1:
            out.write(binascii.a2b_base64(held + b"=" * (4 - len(held))))
        return Layer(out.data(), whole=layer.whole) if out.size else None
    run = layer.data[a:b].translate(STANDARD, b"\r\n")[skip:]
    run = run[:-1] if len(run) % 4 == 1 else run
    raw = binascii.a2b_base64(run + b"=" * (-len(run) % 4))
    if not raw:
        return None
    if not CAUSE.search(raw):
        return Layer(raw, whole=(int(layer.starts[a]), int(layer.ends[b - 1])))
    code = np.frombuffer(layer.data[a:b], np.uint8)
    at = a + np.flatnonzero((code != 10) & (code != 13))[skip : skip + len(run)]
    i = np.arange(len(raw))
    return Layer(raw, layer.starts[at[4 * i // 3]], layer.ends[at[np.minimum(-(-4 * (i + 1) // 3), len(at)) - 1]], tail=tail)


def _base64(layer: Layer, limit: int):
    """Layers of each run, whose lines are joined, at its four alignments: a payload
    that starts or ends anywhere in the run is whole in one of them. Only the last
    characters of an unpadded one mix with what follows; so parts that end at a line
    break, '/', '_' or '-' within a group of four are decoded for themselves too."""
    data = layer.data
    for m in BASE64.finditer(data):
        a, b = m.span()
        while data[b - 1] in b"=\r\n":
            b -= 1
        if b - a < 16 or not SIGNIFICANT.search(data, a, b):
            continue
        tail = layer.span(*m.span())[1]
        for skip in range(4):
            yield _decoded(layer, a, b, skip, limit, tail)
        for part in PARTS:
            for p in part.finditer(data, a, b):
                x, y = p.span()
                for skip in range(4) if y < b else ():
                    if (y - x - skip) % 4 > 1:
                        yield _decoded(layer, x, y, skip, limit, layer.span(x, y)[1])


def _inflated(data, at: int, limit: int) -> tuple[Sink, int]:
    """(zlib or gzip payload inflated over all its members, where the last whole one
    ends or 0). Of a damaged or incomplete payload, what could be inflated."""
    out, d, end = Sink(limit), zlib.decompressobj(47), 0
    try:
        while at < len(data):
            piece = data[at : at + CHUNK]
            at += len(piece)
            while piece:
                out.write(d.decompress(piece, 16 * CHUNK))
                piece = d.unconsumed_tail
                if d.eof:
                    at = end = at - len(d.unused_data)
                    if data[end : end + 3] != GZIP:
                        return out, end
                    piece, d = b"", zlib.decompressobj(31)
        out.write(d.flush())
        end = at if d.eof else end
    except zlib.error:
        pass
    return out, end


def _payloads(layer: Layer, limit: int):
    """A layer for each compressed payload, wherever it starts, and whether it goes
    beyond the limit."""
    end = 0
    for m in MAGIC.finditer(layer.data):
        if m.start() < end:
            continue
        out, last = _inflated(layer.data, m.start(), limit)
        end = last or end
        if out.size:
            yield Layer(out.data(), whole=layer.span(m.start(), last or len(layer.data))), out.size > limit


def find_secrets(text: str, limit: int = 32 << 20) -> tuple[list, list, int, int]:
    """(base spans, spans of decoded layers, layers, payloads larger than ``limit``)."""
    over = 0

    def mark(layer):
        return (hashlib.blake2b(layer.data, digest_size=16).digest(), *layer.span(0, len(layer.data)))

    def unwrapped(layer, first=False):
        nonlocal over
        data = layer.data
        if not first:
            for inner, beyond in _payloads(layer, limit):
                over += beyond
                yield inner
        if data.find(b"%") >= 0:
            inner = _replaced(layer, URL, _url, limit)
            yield inner
            if inner is not None and MAGIC.search(inner.data):  # '+' may stand for a space
                yield _replaced(inner, PLUS, _spaces, limit)
        if data.find(b"\\") >= 0 or data.find(b"&#") >= 0:
            yield _replaced(layer, ESCAPE, _escape, limit)
            if LITERAL_MAGIC.search(data):
                yield _replaced(layer, LITERAL, _literal, limit)
        yield from _base64(layer, limit)

    base, added = scan(text), set()
    if not CAUSE.search(text.encode("utf-8", "surrogatepass")):
        return sorted(base, key=_order), [], 1, 0
    root = Layer.of_text(text)
    known, work = {mark(root)}, [unwrapped(root, True)]
    while work:  # one layer of each depth at a time is held
        inner = next(work[-1], work)
        if inner is work:
            work.pop()
        elif inner is not None and (key := mark(inner)) not in known:
            known.add(key)
            if CAUSE.search(inner.data):
                added |= inner.secrets()
                work.append(unwrapped(inner))
    # a part's span that ends within a group of its run's span is the same secret
    added = {(k, a, b) for k, a, b in added if not any((k, a, b + i) in added for i in range(1, 5))}
    return sorted(base, key=_order), sorted(added - set(base), key=_order), len(known), over


def _order(span: tuple[str, int, int]):
    return span[1], KINDS.index(span[0]), span[2]


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 32 << 20) -> DataFrame:
    """Secrets of every whole text, also inside nested encodings.

    Returns one row per input row: doc_id, base and decoded (arrays of kind, start
    and end in code points, end exclusive, by start, then kind, then end), layers
    (texts scanned) and oversized. A decoded span is the part of the original text
    that the secret was encoded in; one that equals a base span isn't repeated.

    Null text counts as empty: no spans. Null and repeated doc_ids are returned
    row for row. Other columns are ignored; an empty table gives no rows. Rows
    are scanned one at a time and nothing is shuffled. Compressed
    payloads are inflated and scanned to their end, over all members. One of more
    than ``limit`` bytes is kept in a file of the task's temp folder, so memory is
    bounded and that folder needs the room; ``oversized`` counts such payloads."""
    docs = two_columns(docs, key, text)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in batches:
            rows = [find_secrets(t.as_py() or "", limit) for t in batch.column(1)]
            spans = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in r[i]] for r in rows], pa.list_(span)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *spans, pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())],
                names=["doc_id", "base", "decoded", "layers", "oversized"],
            )

    kind = "array<struct<kind:string,start:bigint,end:bigint>>"
    return docs.mapInArrow(run, f"doc_id long, base {kind}, decoded {kind}, layers long, oversized long")
