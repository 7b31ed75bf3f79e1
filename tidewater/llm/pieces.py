"""The piece lattice of an existing subword vocabulary.

The vocabulary is read from a SentencePiece model file, named by the caller. It
is never trained. Its scores are merge ranks; rank r gets the weight 1 / (r + 1),
the usual form of a vocabulary sorted by frequency. Byte pieces come after all
ranked ones, so every byte string has a path through the lattice. Special pieces
are not part of it.

Spaces are written as the piece mark. No piece has the mark after another
character, and none has a line feed, so no path crosses from a non-space into a
space or over a line feed: a text is cut there into chunks, and its lattice is
the product of its chunks' lattices. A literal mark in a text is taken by byte
pieces alone, which keeps decoding lossless.
"""

from __future__ import annotations

import numpy as np

MARK = "▁".encode()


def vocabulary(path: str) -> dict:
    """Piece surfaces (bytes, mark as a space), ids and log weights; bounded by
    the vocabulary, so it may be sent to every task."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    plain = [i for i in ids if not sp.is_byte(i)]
    rank = {i: r for r, i in enumerate(sorted(plain, key=lambda i: (-sp.get_score(i), i)))}
    surface, byte_of = {}, {}
    for i in ids:
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_of[i] = int(piece[3:5], 16)
            surface[i] = bytes([byte_of[i]])
        else:
            surface[i] = piece.encode().replace(MARK, b" ")
    weight = np.full(sp.get_piece_size(), -np.inf)
    for i in ids:
        weight[i] = -np.log(rank.get(i, len(plain)) + 1.0)
    finite = np.isfinite(weight)
    weight[finite] -= np.log(np.exp(weight[finite]).sum())
    if len(byte_of) != 256:
        raise ValueError("the vocabulary needs all 256 byte pieces")
    if any(b" " in s.lstrip(b" ") or b"\n" in s for i, s in surface.items() if i not in byte_of):
        raise ValueError("a piece has the mark after another character, or a line feed")
    return {"size": len(weight), "surface": surface, "byte": byte_of, "logp": weight}


class Trie:
    """Byte trie of the pieces. ``step`` is a table node x byte -> node of the nodes that
    have a next one: those come first, so a node beyond the table ends there."""

    def __init__(self, vocab: dict):
        children: list[dict[int, int]] = [{}]
        piece = [-1]
        for i, s in vocab["surface"].items():
            if i in vocab["byte"]:
                continue
            node = 0
            for b in s:
                node = children[node].setdefault(b, len(children))
                if node == len(children):
                    children.append({})
                    piece.append(-1)
            piece[node] = i
        inner = np.array([bool(c) for c in children])
        order = np.argsort(~inner, kind="stable")  # the root stays first
        number = np.empty(len(children), np.int64)
        number[order] = np.arange(len(children))
        self.step = np.zeros((max(1, int(inner.sum())), 256), np.uint16 if len(children) <= 1 << 16 else np.int32)
        for n, c in enumerate(children):
            for b, m in c.items():
                self.step[number[n], b] = number[m]
        self.piece = np.array(piece, np.int32)[order]
        self.byte = np.zeros(256, np.int32)
        for i, b in vocab["byte"].items():
            self.byte[b] = i


class Lattices:
    """The lattices of many distinct chunks, laid end to end.

    Nodes are byte positions: chunk c owns nodes base[c] .. base[c] + len(c). The
    byte after each chunk is 0xFF, which no piece holds, so no edge leaves it.
    Edges are sorted by the node they end in."""

    def __init__(self, trie: Trie, chunks: list[bytes]):
        self.lengths = np.array([len(c) for c in chunks], np.int64)
        self.base = np.concatenate([[0], np.cumsum(self.lengths + 1)])
        flat = np.frombuffer(b"\xff".join([*chunks, b""]), np.uint8)  # a stop byte after each chunk
        nodes = len(flat)
        inside = np.ones(nodes, bool)
        inside[self.base[1:] - 1] = False
        place = np.flatnonzero(inside)
        src, dst, ids = [place], [place + 1], [trie.byte[flat[place]]]
        at, node, table = place, np.zeros(len(place), np.int64), trie.step.ravel()
        length = 0
        while len(at):
            node = table[node << 8 | flat[at + length]].astype(np.int64)
            alive = np.flatnonzero(node)
            at, node = at[alive], node[alive]
            length += 1
            piece = trie.piece[node]
            hit = np.flatnonzero(piece >= 0)
            src.append(at[hit])
            dst.append(src[-1] + length)
            ids.append(piece[hit])
            inner = np.flatnonzero(node < len(trie.step))
            at, node = at[inner], node[inner]
        into = np.bincount(np.concatenate(dst), minlength=nodes)
        self.first = np.concatenate([[0], np.cumsum(into)])  # edges into node v: first[v] : first[v+1]
        self.dst = np.repeat(np.arange(nodes), into)
        # edges of one length end in nodes of their own, shorter ones stand first
        self.src, self.ids = np.empty(len(self.dst), np.int64), np.empty(len(self.dst), np.int32)
        free = self.first[:-1].copy()
        for s, d, i in zip(src, dst, ids):
            place = free[d]
            free[d] = place + 1
            self.src[place], self.ids[place] = s, i
        self.nodes = nodes
        depth = np.arange(nodes) - np.repeat(self.base[:-1], self.lengths + 1)
        # edges level by level: all that end at in-chunk position 1, then 2, ...
        longest = int(self.lengths.max(initial=0))
        level = np.repeat(depth.astype(np.uint16 if longest < 1 << 16 else np.int64), into)
        self.by_level = np.argsort(level, kind="stable")
        self.level_ends = np.cumsum(np.bincount(level, minlength=longest + 1)) if len(level) else np.zeros(longest + 1, np.int64)

    def forward(self, logp: np.ndarray) -> np.ndarray:
        """log of the summed weight of all paths from its chunk's start, by node."""
        alpha = np.full(self.nodes, -np.inf)
        alpha[self.base[:-1]] = 0.0
        src, dst, weight = self.src[self.by_level], self.dst[self.by_level], logp[self.ids[self.by_level]]
        # where each node's edges begin; a level's nodes are lows[k] : lows[k+1] of these
        cut = np.flatnonzero(np.concatenate([np.ones(min(1, len(dst)), bool), dst[1:] != dst[:-1]]))
        lows = np.searchsorted(cut, self.level_ends).tolist()
        ends = self.level_ends.tolist()
        for a, b, low, high in zip(ends[:-1], ends[1:], lows[:-1], lows[1:]):
            if a < b:
                own = cut[low:high]
                alpha[dst[own]] = np.logaddexp.reduceat(alpha[src[a:b]] + weight[a:b], own - a)
        return alpha

    def totals(self, alpha: np.ndarray) -> np.ndarray:
        return alpha[self.base[1:] - 1] if len(self.lengths) else np.empty(0)

    def backward(self, logp: np.ndarray) -> np.ndarray:
        beta = np.full(self.nodes, -np.inf)
        beta[self.base[1:] - 1] = 0.0
        weight = logp[self.ids]
        by_src = np.lexsort((self.src, -self._source_depth()))
        level = self._source_depth()[by_src]
        cuts = np.flatnonzero(np.concatenate([[True], level[1:] != level[:-1]])) if len(level) else np.empty(0, np.int64)
        for a, b in zip(cuts, [*cuts[1:], len(level)]):
            e = by_src[a:b]
            s = self.src[e]
            cut = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            beta[s[cut]] = np.logaddexp.reduceat(beta[self.dst[e]] + weight[e], cut)
        return beta

    def _source_depth(self) -> np.ndarray:
        depth = np.arange(self.nodes) - np.repeat(self.base[:-1], self.lengths + 1)
        return depth[self.src]

    def expected(self, logp: np.ndarray, times: np.ndarray, size: int) -> np.ndarray:
        """Expected number of each piece if chunk c occurs times[c] times."""
        alpha, beta = self.forward(logp), self.backward(logp)
        chunk = np.repeat(np.arange(len(self.lengths)), self.lengths + 1)[self.src]
        share = np.exp(alpha[self.src] + logp[self.ids] + beta[self.dst] - self.totals(alpha)[chunk])
        return np.bincount(self.ids, share * times[chunk], size)


