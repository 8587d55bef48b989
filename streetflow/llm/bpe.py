"""Byte-level BPE encoding and decoding with a public rank file.

Pre-tokenisation uses no regular expression. Every code point becomes one of a
few symbols (a class, with what its next one or two code points tell); each
symbol is a transition function over the states of a small automaton, and
composition of such functions is associative. So the state before every code
point comes from a block-wise prefix scan of numpy gathers over the composition
table, and a second table says where a piece begins. The slices between those
places go through pair merging once each, many in one step, and are then served
from a bounded cache. Token offsets (in bytes) are kept beside the ids, for decoding a part.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# symbols of the automaton
_LETTER, _NUMBER, _OTHER, _CUT1, _CUT2, _BLANK_LAST, _SPACE_LAST, _SPACE_MORE, _N_SYMBOLS = range(9)
# states: what the code points so far leave behind
_BEGIN, _IN_LETTERS, _IN_NUMBERS, _IN_OTHER, _IN_SPACE, _AFTER_BLANK, _ONE_MORE, _TWO_MORE, _N_STATES = range(9)

#: The code points of the Unicode property White_Space.
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004,
               0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

#: Code points that one step of the scan handles at a time, and rows of text a slice.
_BLOCK = 64
_SLICE_CHARS = 1 << 19
#: Pieces that a task keeps; bytes of pieces that are merged together (longer ones by themselves).
_CACHE = 1 << 17
_WIDTHS = (8, 12, 16, 24, 48)
_WIDTH_OF = [next(w for w in _WIDTHS if n <= w) for n in range(_WIDTHS[-1] + 1)]


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a piece begins at the symbol."""
    if state == _TWO_MORE:
        return _ONE_MORE, False
    if state == _ONE_MORE:
        return _BEGIN, False
    if symbol == _BLANK_LAST:
        return _AFTER_BLANK, True
    if symbol == _SPACE_LAST:
        return _BEGIN, True
    if symbol == _SPACE_MORE:
        return _IN_SPACE, state != _IN_SPACE
    goes_on = {_LETTER: _IN_LETTERS, _NUMBER: _IN_NUMBERS}.get(symbol, _IN_OTHER)
    if state in (goes_on, _AFTER_BLANK):
        return goes_on, False
    if symbol in (_CUT1, _CUT2):
        return (_ONE_MORE if symbol == _CUT1 else _TWO_MORE), True
    return goes_on, True


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(class of each code point, composition of functions, functions, begins, own).

    ``own`` has the function of each symbol and, after those, of each symbol
    that starts a text; composition closes the set of functions.
    """
    kind = np.full(0x110000, _OTHER, np.uint8)
    for c in range(0x110000):
        major = unicodedata.category(chr(c))[0]
        if major in "LN":
            kind[c] = _LETTER if major == "L" else _NUMBER
    kind[list(WHITE_SPACE)] = _SPACE_MORE
    functions = [tuple(_step(s, x)[0] for s in range(_N_STATES)) for x in range(_N_SYMBOLS)]
    functions += [(f[_BEGIN],) * _N_STATES for f in functions]
    index: dict[tuple[int, ...], int] = {}
    for f in functions:
        index.setdefault(f, len(index))
    own = np.array([index[f] for f in functions], np.uint16)
    known = list(index)
    for f in known:  # grows while it runs
        for g in functions:
            if (h := tuple(g[s] for s in f)) not in index:
                index[h] = len(index)
                known.append(h)
    compose = np.array([[index[tuple(g[s] for s in f)] for g in known] for f in known], np.uint16)
    begins = np.array([[_step(s, x)[1] for x in range(_N_SYMBOLS)] for s in range(_N_STATES)], bool)
    return kind, compose, np.array(known, np.uint8), begins, own


def _scan(f: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """Inclusive prefix compositions of a sequence of functions."""
    n, size = len(f), len(compose)
    if n <= 1:
        return f.copy()
    blocks = -(-n // _BLOCK)
    flat = compose.ravel()
    run = np.zeros((_BLOCK, blocks), np.uint16)  # padding composes to anything: nothing reads it
    padded = np.zeros(blocks * _BLOCK, np.uint16)
    padded[:n] = f
    steps = np.ascontiguousarray(padded.reshape(blocks, _BLOCK).T)
    run[0] = steps[0]
    for j in range(1, _BLOCK):
        run[j] = flat[run[j - 1].astype(np.int32) * size + steps[j]]
    if blocks > 1:
        total = _scan(run[-1, :-1], compose).astype(np.int32) * size
        run[:, 1:] = flat[total[None, :] + run[:, 1:]]
    return np.ascontiguousarray(run.T).ravel()[:n]


def piece_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Sorted positions of the code points at which a piece begins. ``points``
    are code points of several texts one after the other, ``text_starts`` the
    first position of each that is not empty."""
    kind, compose, functions, begins, own = _tables()
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    k = kind[points]
    first = np.zeros(n + 2, bool)
    first[text_starts] = True
    first[n:] = True
    space = k == _SPACE_MORE
    alone = np.zeros(n, bool)  # white space whose next code point, in its text, is none
    alone[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
    symbol = k.copy()
    symbol[alone] = _SPACE_LAST
    symbol[alone & (points == 0x20)] = _BLANK_LAST
    at = np.flatnonzero(points == 0x27)
    p1 = np.where(first[at + 1], 0, points[np.minimum(at + 1, n - 1)])
    p2 = np.where(first[at + 1] | first[at + 2], 0, points[np.minimum(at + 2, n - 1)])
    symbol[at[np.isin(p1, [ord(c) for c in "stmd"])]] = _CUT1
    for a, b in ("re", "ve", "ll"):
        symbol[at[(p1 == ord(a)) & (p2 == ord(b))]] = _CUT2
    state = functions[_scan(own[symbol + first[:n] * np.uint8(_N_SYMBOLS)], compose), _BEGIN]
    before = np.zeros(n, np.int64)
    before[1:] = state[:-1]
    return np.flatnonzero(begins[before, symbol] | first[:n])


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the adjacent pair of lowest rank, leftmost first, is
    merged until none has a rank. A heap of pairs and a linked list keep it
    near-linear for pieces of any length."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that begins here
    left = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    alive = bytearray(b"\1") * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i] if alive[i] else n
        if not alive[i] or j >= n or end[j] != stop:
            continue
        alive[j] = 0
        end[i] = stop
        if stop < n:
            left[stop] = i
            if (r := ranks.get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := left[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


@lru_cache(4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Merger:
    """Ids of pieces, many at a time.

    Pieces of one length are the rows of a matrix of token ids. Each step merges
    the leftmost pair of lowest rank of every row that has one; pairs are looked
    up in an open-addressing table of (left id, right id) -> id.
    """

    _NONE = np.int32(2**31 - 1)

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.cache: dict[str, tuple[int, ...]] = {}
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        pairs = {(ranks[t[:i]] << 32) | ranks[t[i:]]: r for t, r in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        key = np.fromiter(pairs.keys(), np.uint64, len(pairs))
        self.bits = max(4, (4 * len(key)).bit_length())
        self.keys = np.full(1 << self.bits, 2**64 - 1, np.uint64)
        self.values = np.full(1 << self.bits, self._NONE, np.int32)
        value = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] == np.uint64(2**64 - 1)
            self.keys[slot[free]] = key[free]  # of those that meet, one gets the slot
            settled = self.keys[slot] == key
            self.values[slot[settled]] = value[settled]
            key, value, slot = key[~settled], value[~settled], (slot[~settled] + 1) & (len(self.keys) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of left + right, or ``_NONE``."""
        key = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(key)
        out = np.full(len(key), self._NONE, np.int32)
        todo = np.arange(len(key))
        while len(todo):
            held = self.keys[slot]
            out[todo] = np.where(held == key, self.values[slot], out[todo])
            go = (held != key) & (held != np.uint64(2**64 - 1))
            todo, key, slot = todo[go], key[go], (slot[go] + 1) & (len(self.keys) - 1)
        return out

    def merge_rows(self, ids: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Merges all that can be in each row of a matrix of byte ids, in place;
        ``count``, the ids of each row, falls; the rest of a row is -1."""
        n, width = ids.shape
        rank = np.full((n, width), self._NONE, np.int32)
        pair = np.arange(width - 1)[None, :] < count[:, None] - 1
        rank[:, :-1][pair] = self.lookup(ids[:, :-1][pair], ids[:, 1:][pair])
        rows = np.arange(n)
        while len(rows):
            at = rank[rows].argmin(axis=1)
            best = rank[rows, at]
            go = best != self._NONE
            rows, at, best = rows[go], at[go], best[go]
            if not len(rows):
                break
            top = int(count[rows].max()) - 1
            shift = np.arange(top)[None, :] + (np.arange(top)[None, :] > at[:, None])
            shift += (rows * width)[:, None]
            ids[rows, :top] = ids.ravel()[shift]
            ids[rows, at] = best
            ids[rows, top] = -1
            rank[rows, :top] = rank.ravel()[shift]
            rank[rows, top] = self._NONE
            count[rows] -= 1
            for side in (at - 1, at):  # the two pairs that the new token is in
                ok = (side >= 0) & (side + 1 < count[rows])
                own = np.full(len(rows), self._NONE, np.int32)
                x, y = rows[ok], side[ok]
                own[ok] = self.lookup(ids[x, y], ids[x, y + 1])
                inside = side >= 0
                rank[rows[inside], side[inside]] = own[inside]

    def learn(self, pieces: set[str]) -> None:
        """Adds pieces to the cache."""
        ranks, cache = self.ranks, self.cache
        wide: dict[int, tuple[list[str], list[bytes]]] = {w: ([], []) for w in _WIDTHS}
        for piece in pieces:
            raw = piece.encode()
            if raw in ranks:
                cache[piece] = (ranks[raw],)
            elif len(raw) > _WIDTHS[-1]:
                cache[piece] = tuple(merge(raw, ranks))
            else:
                names, raws = wide[_WIDTH_OF[len(raw)]]
                names.append(piece)
                raws.append(raw)
        for width, (names, raws) in wide.items():
            for lo in range(0, len(raws), 1 << 14):
                part = raws[lo:lo + (1 << 14)]
                count = np.fromiter(map(len, part), np.int64, len(part))
                own = np.arange(width)[None, :] < count[:, None]
                ids = np.full(own.shape, -1, np.int32)
                ids[own] = self.byte[np.frombuffer(b"".join(part), np.uint8)]
                self.merge_rows(ids, count)
                ids, ends = ids[np.arange(width)[None, :] < count[:, None]].tolist(), np.cumsum(count).tolist()
                cache.update(zip(names[lo:lo + (1 << 14)], [
                    tuple(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)], strict=True))

    def encode(self, pieces: list[str]) -> Iterator[tuple[int, ...]]:
        kinds = set(pieces)
        new = kinds.difference(self.cache)
        if len(self.cache) + len(new) > _CACHE:
            self.cache.clear()
            new = kinds
        self.learn(new)
        return map(self.cache.__getitem__, pieces)


@lru_cache(4)
def _merger(path: str) -> Merger:
    return Merger(load_ranks(path))


@lru_cache(4)
def _tokens(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all tokens, first byte and length of each id)."""
    ranks = load_ranks(path)
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    size = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of slices of a bounded number of code points; null counts as empty."""
    lo, size, held = 0, 0, []
    for i, t in enumerate(column):
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= _SLICE_CHARS:
            yield lo, held
            lo, size, held = i + 1, 0, []
    if held:
        yield lo, held


def encode_texts(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of each text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    base = np.concatenate([[0], np.cumsum(lengths)])
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    starts = piece_starts(points, base[:-1][lengths > 0])
    cuts = starts.tolist()
    ids = list(_merger(path).encode([joined[x:y] for x, y in zip(cuts, [*cuts[1:], len(joined)], strict=True)]))
    at = np.searchsorted(starts, base).tolist()
    return [np.fromiter(chain.from_iterable(ids[a:b]), np.int32) for a, b in zip(at, at[1:], strict=False)]


def decode_ids(ids: np.ndarray, path: str) -> np.ndarray:
    """Bytes of a sequence of ids."""
    data, first, size = _tokens(path)
    own = size[ids]
    ends = np.cumsum(own)
    total = int(ends[-1]) if len(ends) else 0
    return data[np.repeat(first[ids] - ends + own, own) + np.arange(total)]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32), pa.int32()))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, offsets) of each row: token ids of the whole text without
    special tokens, and the byte at which each token begins.

    Null and empty texts have no tokens. Ids may be null or repeat; each row is
    encoded by itself. An empty table gives an empty result. Other columns are
    ignored. ``path`` is a rank file that every executor has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = _tokens(path)[2]
        for batch in batches:
            for lo, texts in _texts(batch.column(1)):
                ids = encode_texts(texts, path)
                offsets = [np.cumsum(size[x]) - size[x] for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)), _lists(ids), _lists(offsets)],
                    names=["doc_id", "ids", "offsets"])
        _merger.cache_clear()  # workers live on and serve other operators

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, ids array<int>, offsets array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids, offsets) with ``decoded``, the bytes of the ids
    (a text cut inside a code point need not be UTF-8)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = _tokens(path)[2]
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                column = part.column(1)
                ids = column.flatten().to_numpy(zero_copy_only=False)
                count = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())])
                ends = np.concatenate([[0], np.cumsum(size[ids])])[count]
                data = pa.Array.from_buffers(pa.large_binary(), len(part), [
                    None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(decode_ids(ids, path))])
                yield pa.RecordBatch.from_arrays([*part.columns, data.cast(pa.binary())],
                                                 names=["doc_id", "ids", "offsets", "decoded"])

    return encoded.select("doc_id", "ids", "offsets").mapInArrow(
        run, "doc_id long, ids array<int>, offsets array<int>, decoded binary")
