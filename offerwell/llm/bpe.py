"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs.

The leaves of the tree are the ranks of the pairs of neighbouring symbols, each inner node is the smaller of its two
children with the leftmost position first; the root is therefore the next merge. A merge changes at most three leaves,
which are point updates of logarithmic cost, and encoding ends when the root holds no rank. Many pieces of similar length
are merged side by side: the trees of one width are the rows of one array.

A text is cut at ASCII white space into units whose split into pieces does not depend on their neighbours; a worker
keeps the ids of recent units, so that each distinct unit is encoded about once. Nothing is shuffled.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from offerwell.llm import text as tx

#: The split pattern of the byte-level vocabularies.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.iinfo(np.int64).max
#: Most bytes of text that are encoded and decoded at once; the arrays made on the way take some 50 times that.
SLICE = 1 << 20
#: Most pieces and units that a worker remembers; an entry takes some 200 bytes.
PIECES_HELD, UNITS_HELD = 100_000, 300_000
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: First bytes of white space characters outside ASCII, and separators that only some engines count as white space.
WIDE = np.zeros(256, bool)
WIDE[[0xC2, 0xE1, 0xE2, 0xE3, 0x1C, 0x1D, 0x1E, 0x1F]] = True


def wide_spaces(data: np.ndarray) -> np.ndarray:
    """Positions of white space characters outside ASCII."""
    at = np.flatnonzero(WIDE[data])
    if not len(at):
        return at
    ahead = np.concatenate([data, np.zeros(2, np.uint8)])
    a, b, c = data[at], ahead[at + 1], ahead[at + 2]
    found = (a < 0x20) | (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    found |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    found |= (a == 0xE2) & (b == 0x81) & (c == 0x9F) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
    return at[found]


class PairMerger:
    """Merges of one vocabulary, applied to byte strings by segment trees."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        symbols = tx.byte_symbols()
        self.size = max(vocabulary.values()) + 1
        self.token = [b""] * self.size
        for name, i in vocabulary.items():
            self.token[i] = bytes(symbols[c] for c in name) if all(c in symbols for c in name) else name.encode()
        self.byte_id = np.zeros(256, np.int64)
        for c, b in symbols.items():
            self.byte_id[b] = vocabulary[c]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where it never merges."""
        if not len(self.keys):
            return np.full(len(left), NONE)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NONE)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of every piece, as little-endian 32-bit integers."""
        out: list = [b""] * len(pieces)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = np.where(length > 1, 2 ** np.ceil(np.log2(np.maximum(length, 2))).astype(np.int64), 1)
        for w in np.unique(width):
            group = np.flatnonzero((width == w) & (length > 0))
            for start in range(0, len(group), max(1, (1 << 19) // int(w))):
                rows = group[start : start + max(1, (1 << 19) // int(w))]
                ids, counts = self._merge([pieces[i] for i in rows], length[rows], int(w))
                data, ends = ids.astype("<u4").tobytes(), np.cumsum(counts) * 4
                for i, a, b in zip(rows.tolist(), (ends - counts * 4).tolist(), ends.tolist()):
                    out[i] = data[a:b]
        return out

    def _merge(self, pieces: list[bytes], length: np.ndarray, width: int):
        """(ids of all pieces, number of ids of each); the trees are ``width`` leaves wide, one row per piece."""
        n = len(pieces)
        column = np.arange(width)
        inside = column[None, :] < length[:, None]
        symbol = np.full((n, width), -1, np.int64)
        symbol[inside] = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        if width == 1:
            return symbol[inside], length
        after = np.where(inside & (column[None, :] + 1 < length[:, None]), column[None, :] + 1, -1)
        before = np.broadcast_to(column - 1, (n, width)).copy()
        shift = int(width).bit_length()
        leaves = np.full((n, width), NONE)
        has = after >= 0
        at = np.nonzero(has)
        rank = self.ranks(symbol[at], symbol[at[0], at[1] + 1])
        leaves[at] = np.where(rank == NONE, NONE, (rank << shift) | at[1])
        tree = [leaves]
        while tree[-1].shape[1] > 1:
            tree.append(np.minimum(tree[-1][:, 0::2], tree[-1][:, 1::2]))
        root = tree[-1][:, 0]
        rows = np.flatnonzero(root != NONE)
        while len(rows):
            key = root[rows]
            here, made = key & ((1 << shift) - 1), self.merged[key >> shift]
            gone = after[rows, here]
            symbol[rows, here], symbol[rows, gone] = made, -1
            following, previous = after[rows, gone], before[rows, here]
            after[rows, here] = following
            f, p = np.flatnonzero(following >= 0), np.flatnonzero(previous >= 0)
            before[rows[f], following[f]] = here[f]
            leaves[rows, gone] = NONE
            leaf = np.full(len(rows), NONE)
            rank = self.ranks(made[f], symbol[rows[f], following[f]])
            leaf[f] = np.where(rank == NONE, NONE, (rank << shift) | here[f])
            leaves[rows, here] = leaf
            rank = self.ranks(symbol[rows[p], previous[p]], made[p])
            leaves[rows[p], previous[p]] = np.where(rank == NONE, NONE, (rank << shift) | previous[p])
            touched, at = np.concatenate([rows, rows, rows[p]]), np.concatenate([here, gone, previous[p]])
            for low, high in zip(tree, tree[1:]):
                at = at >> 1
                high[touched, at] = np.minimum(low[touched, 2 * at], low[touched, 2 * at + 1])
            rows = rows[root[rows] != NONE]
        live = symbol >= 0
        return symbol[live], live.sum(axis=1)


class ByteBpe:
    """Encoder and decoder of a byte-level tokenizer file."""

    def __init__(self, tokenizer: dict):
        import regex

        model = tokenizer["model"]
        self.merger = PairMerger(model["vocab"], model["merges"])
        self.special = {t["content"]: t["id"] for t in tokenizer.get("added_tokens") or []}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.pattern = regex.compile(PIECES)
        self.pieces = tx.Cache(self.merger.encode, PIECES_HELD)
        self.units = tx.Cache(self._encode_units, UNITS_HELD)
        table = list(self.merger.token)
        table += [b""] * (max([len(table) - 1, *self.special.values()]) + 1 - len(table))
        for name, i in self.special.items():
            table[i] = name.encode()
        self.token_length = np.array([len(t) for t in table], np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(table), np.uint8)

    def _encode_units(self, units: list[bytes]) -> list[bytes]:
        split = [self.pattern.findall(u.decode("utf-8")) for u in units]
        flat = [p.encode("utf-8") for pieces in split for p in pieces]
        ids, out, at = self.pieces.many(flat), [], 0
        for pieces in split:
            out.append(b"".join(ids[at : at + len(pieces)]))
            at += len(pieces)
        return out

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Start of every unit, and the end: words with one space before them, and what is left of the white space."""
        space = SPACE[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets[:-1]] = True
        inner = ~first[:-1]
        word = ~space
        after_space = np.zeros(len(data), bool)
        after_space[1:] = space[:-1]
        opens = word & after_space & inner  # a word that follows white space of its text
        blank = data == 0x20
        cut = np.zeros(len(data) + 1, bool)
        cut[:-1] = first[:-1]
        at = np.flatnonzero(opens)
        cut[at[~blank[at - 1]]] = True
        cut[at - 1] = True  # the last white space stands alone or before its word
        starts = space & inner
        starts[1:] &= ~space[:-1]
        cut[:-1] |= starts
        cut[-1] = True
        cut[offsets] = True
        for i in np.unique(np.searchsorted(offsets, wide_spaces(data), side="right") - 1):
            a, b = offsets[i], offsets[i + 1]  # a text with other white space is split as a whole
            sizes = [len(p.encode("utf-8")) for p in self.pattern.findall(data[a:b].tobytes().decode("utf-8"))]
            cut[a:b] = False
            cut[a + np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)] = True
        return np.flatnonzero(cut)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, position of each text's first id, with the end)."""
        segments, special = texts, None
        if any(pa.compute.any(pa.compute.match_substring(texts, s)).as_py() for s in self.special):
            parts = [self.special_cut.split(t) for t in texts.to_pylist()]
            segments = pa.array([p for cut in parts for p in cut[0::2]], pa.string())
            special = [[self.special[p] for p in cut[1::2]] for cut in parts]
        data, offsets = tx.raw(segments)
        if len(data):
            cuts = self._cuts(data, offsets)
            units = pa.Array.from_buffers(
                pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data.tobytes())]
            )
            codes, distinct = tx.coded(units)
            known = self.units.many(distinct)
            size = np.fromiter(map(len, known), np.int64, len(known)) // 4
            flat = np.frombuffer(b"".join(known), "<u4")
            start = np.cumsum(size) - size
            ids = flat[tx.ragged(start[codes], size[codes])]
            before = np.concatenate([[0], np.cumsum(size[codes])])
            bounds = before[np.searchsorted(cuts, offsets)]
        else:
            ids, bounds = np.empty(0, "<u4"), np.zeros(len(offsets), np.int64)
        if special is None:
            return ids, bounds
        out, sizes, at = [], [], 0
        for marks in special:
            whole = []
            for k in range(len(marks) + 1):
                whole.append(ids[bounds[at] : bounds[at + 1]])
                whole.append(np.array(marks[k : k + 1], "<u4"))
                at += 1
            out.append(np.concatenate(whole))
            sizes.append(len(out[-1]))
        return np.concatenate(out), np.concatenate([[0], np.cumsum(sizes)])

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """Text of each id sequence, special tokens included."""
        size = self.token_length[ids]
        data = self.token_bytes[tx.ragged(self.token_start[ids], size)]
        return tx.text_from_bytes(data, np.concatenate([[0], np.cumsum(size)])[bounds])


def encode_decode(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``docs`` with the columns ids (array of ids of the whole text) and decoded (the text of these ids).

    ``tokenizer`` is the path of a byte-level BPE tokenizer file, read on the driver. A null text counts as empty and
    has no ids and an empty decoded text. Rows are independent: repeated rows and ties give equal results, an empty table gives
    an empty table, extra columns pass through (columns named ids or decoded are replaced).
    """
    shared = tx.Shared(docs.sparkSession, tx.read_tokenizer(tokenizer))

    def run(text):
        coder = tx.made(shared, ByteBpe)
        ids, bounds = coder.encode(tx.text_array(text))
        return [tx.list_array(pa.array(ids.astype(np.int32)), bounds), coder.decode(ids, bounds)]

    return tx.attach(docs, run, "ids array<int>, decoded string", limit=SLICE, text=text)
