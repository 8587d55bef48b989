"""Alignment of two tokenizers' tokens over the same bytes.

``align`` encodes each text both ways and meets the two sorted lists of token
ends: the shorter drives an exponential search, then a binary one, into the
longer. Ends in both lists cut the tokens into groups, and differences of the
ranks found give each token the range of the other side's tokens that it overlaps.

``pair_counts`` counts, over all texts, how often two ids overlap;
``link_figures`` holds each text's links against those counts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetflow.llm.graph import staged

#: Code points of text that are aligned at a time, and links that are counted at a time.
_SLICE_CHARS = 1 << 18
_LINKS = 1 << 19
#: Every so many tokens of the driving list one is searched from the list's start, the rest from that one.
_STRIDE = 16
#: Pairs whose counts are sent to every task; the rarer ones are joined.
_HEAD = 1 << 18
#: A writer holds so much of the lists before they go to disk.
_ROW_GROUP = {"parquet.block.size": 1 << 24}

ALIGNED = "row long, doc_id long, a_ids binary, b_ids binary, a_spans binary"


# ------------------------------------------------------------------ intersection
def _seek(x: np.ndarray, long: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Index of the first element of ``long`` not below each x, searched from ``at``
    on in steps that double, then by halving the last step. The last element of
    ``long`` is not below any x."""
    lo, hi, step = at.copy(), at.copy(), 1
    act = np.flatnonzero(long[hi] < x)
    while len(act):
        lo[act] = hi[act] + 1
        hi[act] = np.minimum(hi[act] + step, len(long) - 1)
        act = act[long[hi[act]] < x[act]]
        step *= 2
    act = np.flatnonzero(lo < hi)
    while len(act):
        mid = (lo[act] + hi[act]) // 2
        less = long[mid] < x[act]
        lo[act[less]] = mid[less] + 1
        hi[act[~less]] = mid[~less]
        act = act[lo[act] < hi[act]]
    return lo


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rank of each element of one increasing list in another that ends alike."""
    if not len(short):
        return np.zeros(0, np.int64)
    lead = short[::_STRIDE]
    found = _seek(lead, long, np.zeros(len(lead), np.int64))
    return _seek(short, long, np.repeat(found, _STRIDE)[:len(short)])


def _within(count: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each run of ``count`` elements."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each a token the first b token that it overlaps and the number of them;
    both lists of ends increase, and end alike."""
    swap = len(b_end) < len(a_end)
    short, long = (b_end, a_end) if swap else (a_end, b_end)
    last = gallop(short, long)
    first = np.zeros(len(short), np.int64)
    first[1:] = last[:-1] + (long[last[:-1]] == short[:-1])
    count = last - first + 1
    if not swap:
        return first, count
    b_of = np.repeat(np.arange(len(short)), count)  # links by b token, and so by a token
    a_links = np.bincount(np.repeat(first, count) + _within(count), minlength=len(long))
    return b_of[np.cumsum(a_links) - a_links] if len(b_of) else first, a_links


# -------------------------------------------------------------------- tokenizers
class Side:
    """Ids of whole texts after a space by one tokenizer, and the bytes of its tokens."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], tokens: list[bytes]) -> None:
        self.encode = encode
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def __call__(self, texts: list[str], raw: list[bytes]) -> tuple[list[np.ndarray], list[bool]]:
        """Ids of each text, and whether the bytes of its tokens, joined, are ``raw``."""
        ids = [np.array(x, np.int64) for x in self.encode(texts)]
        flat = np.concatenate(ids)
        count = self.size[flat]
        joined = self.data[np.repeat(self.first[flat], count) + _within(count)].tobytes()
        ends = np.append(0, np.cumsum(count))[np.cumsum([0, *map(len, ids)])].tolist()
        return ids, [joined[x:y] == r for x, y, r in zip(ends, ends[1:], raw, strict=False)]


@lru_cache(2)
def byte_level(path: str) -> Side:
    """A byte-level BPE file of the tokenizers library. Where its ids are in the order
    of its merges, as in such files, tiktoken merges by the ids themselves (which is
    three times as fast); otherwise the library does."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocabulary, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    tokens = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        tokens[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    made = [vocabulary[x + y] for x, y in merges]
    if made == sorted(made) and set(range(made[0])) == {vocabulary[c] for c in byte_of}:
        import tiktoken

        ranks = {tokens[i]: i for i in [*range(made[0]), *made]}
        ordinary = tiktoken.Encoding("byte level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return Side(lambda texts: [ordinary.encode_ordinary(" " + t) for t in texts], tokens)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are plain text
    return Side(lambda texts: [e.ids for e in tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)], tokens)


@lru_cache(2)
def sentence_pieces(path: str) -> Side:
    """A model of the sentencepiece library, which puts a space before a text itself."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    tokens = [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace("\u2581", " ").encode()
              for i, n in enumerate(map(model.id_to_piece, range(model.get_piece_size())))]
    return Side(lambda texts: model.encode(texts, num_threads=1), tokens)


# ------------------------------------------------------------------------- align
def _encoded(texts: list[str], a: Side, b: Side) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids of the texts by either side; none where a side's bytes are not those of the text after a space."""
    some = [t for t in texts if t]
    if not some:
        return [np.zeros(0, np.int64)] * len(texts), [np.zeros(0, np.int64)] * len(texts)
    raw = [b" " + t.encode() for t in some]
    (a_ids, a_good), (b_ids, b_good) = a(some, raw), b(some, raw)
    rows = iter(zip(a_ids, b_ids, np.logical_and(a_good, b_good), strict=True))
    none = np.zeros(0, np.int64)
    pairs = [(x, y) if good else (none, none) for x, y, good in (next(rows) if t else (none, none, True) for t in texts)]
    return [x for x, _ in pairs], [y for _, y in pairs]


def _packed(arrays: list[np.ndarray]) -> pa.BinaryArray:
    """Each array as its 32-bit integers."""
    ends = np.cumsum([0, *map(len, arrays)]) * 4
    flat = np.concatenate(arrays).astype("<i4") if arrays else np.zeros(0, "<i4")
    return pa.Array.from_buffers(pa.large_binary(), len(arrays), [None, pa.py_buffer(ends), pa.py_buffer(flat)]).cast(pa.binary())


def _unpacked(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(the integers of all rows, their number in each row)."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    flat = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat.view("<i4").astype(np.int64), np.diff(ends) // 4


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    lo, size, held = 0, 0, []
    for i, t in enumerate(column):
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= _SLICE_CHARS:
            yield lo, held
            lo, size, held = i + 1, 0, []
    if held:
        yield lo, held


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, a_ids, b_ids, a_spans) of each row: the ids of the text after a
    space by the byte-level file ``a_path`` and by the sentencepiece model ``b_path``
    (files that every executor has), and for each a token the number of b tokens that
    it overlaps, below 0 where a group ends with it. The lists are packed as 32-bit
    integers; ``lists`` unpacks them.

    ``row`` numbers the rows. Texts that are null or empty, or that a tokenizer
    changes, have no tokens. Ids may be null or repeat; each row is aligned by
    itself; other columns are ignored; an empty table gives none. The result is a
    written table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(a_path), sentence_pieces(b_path)
        for batch in batches:
            for lo, texts in _texts(batch.column(2)):
                a_ids, b_ids = _encoded(texts, a, b)
                # the lists of a slice are one list: every text's end is an end on both sides
                first, links = overlaps(np.cumsum(a.size[np.concatenate(a_ids)]), np.cumsum(b.size[np.concatenate(b_ids)]))
                cut = np.cumsum([len(x) for x in a_ids])[:-1]
                ends = np.append(first[1:], sum(map(len, b_ids))) == first + links
                spans = np.split(np.where(ends, -links, links), np.cumsum([len(x) for x in a_ids])[:-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)), batch.column(1).slice(lo, len(texts)), _packed(a_ids),
                     _packed(b_ids), _packed(spans)], names=["row", "doc_id", "a_ids", "b_ids", "a_spans"])

    return staged(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                              F.col(text_col).cast("string").alias("text")).mapInArrow(run, ALIGNED), "aligned", **_ROW_GROUP)


class Links:
    """Links of a batch of aligned rows: positions, ids and rows of both ends, flat.
    ``first`` and ``count`` are the range of b tokens of each a token, ``last``
    whether a group ends with it."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.a_ids, self.n_a = _unpacked(batch.column("a_ids"))
        self.b_ids, self.n_b = _unpacked(batch.column("b_ids"))
        spans, _ = _unpacked(batch.column("a_spans"))
        self.count, self.last = np.abs(spans), spans < 0
        # the next token's range begins with this one's last b token, or after it where a group ends
        step = self.count - 1 + self.last
        self.first = np.cumsum(step) - step
        self.a = np.repeat(np.arange(len(self.a_ids)), self.count)
        self.b = np.repeat(self.first, self.count) + _within(self.count)
        self.row = np.repeat(np.repeat(np.arange(batch.num_rows), self.n_a), self.count)
        self.key = (self.a_ids[self.a] << 32) | self.b_ids[self.b]


def lists(aligned: DataFrame) -> DataFrame:
    """Aligned rows with plain lists: (row, doc_id, a_ids, b_ids, a_first, a_links),
    the last two being the first b token that each a token overlaps and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            x = Links(part)
            first = x.first - np.repeat(np.cumsum(x.n_b) - x.n_b, x.n_a)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"),
                 *(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(v, pa.int32()))
                   for v, n in ((x.a_ids, x.n_a), (x.b_ids, x.n_b), (first, x.n_a), (x.count, x.n_a)))],
                names=["row", "doc_id", "a_ids", "b_ids", "a_first", "a_links"])

    return aligned.mapInArrow(
        run, "row long, doc_id long, a_ids array<int>, b_ids array<int>, a_first array<int>, a_links array<int>")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of a bounded number of tokens; one longer row is its own."""
    for batch in batches:
        ends = np.append(0, np.cumsum(pc.binary_length(batch.column("a_ids")).to_numpy() // 4))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + _LINKS // 2, "right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n, best) of every pair of ids that overlap somewhere: the number of
    links, and whether no other pair of that b has more. A written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            key, n = np.unique(Links(part).key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key >> 32), pa.array(key & 0xFFFFFFFF), pa.array(n)],
                                             names=["a", "b", "n"])

    counts = aligned.mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    # one b has at most as many pairs as the other side has ids
    return staged(counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b"))), "pairs")


def _head(pairs: DataFrame) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(least count, keys in order, counts, best) of the most frequent pairs, at most ``_HEAD``."""
    doubling = F.length(F.bin("n"))  # n is below 2 to that power
    left, power = _HEAD, 63
    sizes = {r[0]: r[1] for r in pairs.groupBy(doubling).count().collect()}  # 63 rows at most
    while power and sizes.get(power, 0) <= left:
        left -= sizes.get(power, 0)
        power -= 1
    least = 1 << power
    top = pairs.where(F.col("n") >= least).select(
        (F.shiftleft("a", 32) + F.col("b")).alias("key"), "n", "best").toArrow()
    key, n, best = (top.column(c).to_numpy() for c in ("key", "n", "best"))
    order = np.argsort(key)
    return least, key[order], n[order], best[order]


def link_figures(aligned: DataFrame, pairs: DataFrame, digest: Callable[[Links], list] | None = None) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum[, digest]) of
    every aligned row: its tokens, groups and links, those links whose pair counts
    most for its b id, and the sum of the links' counts. ``digest`` makes a string
    of each row of a slice.

    The counts of the most frequent pairs, a bounded number, go to every task. Of
    the rarer ones a row sends each pair once through a join, so that no
    frequent pair is a large group there.
    """
    spark = aligned.sparkSession
    least, *head = _head(pairs)
    held = spark.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = held.value
        for part in _parts(batches):
            x, rows = Links(part), part.num_rows
            at = np.minimum(np.searchsorted(keys, x.key), max(len(keys) - 1, 0))
            hit = keys[at] == x.key if len(keys) else np.zeros(len(x.key), bool)
            per = lambda row, value: np.bincount(row, value, rows)
            low = [per(x.row[hit], counts[at[hit]] & 0xFFFFFF), per(x.row[hit], counts[at[hit]] >> 24)]  # whole in doubles
            total = low[0].astype(np.int64) + (low[1].astype(np.int64) << 24)
            order = np.lexsort((x.key[~hit], x.row[~hit]))
            row, key = x.row[~hit][order], x.key[~hit][order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
            begin = np.flatnonzero(new)
            times = np.diff(np.append(begin, len(row)))
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row[begin], minlength=rows))]).astype(np.int32)
            rare = pa.StructArray.from_arrays([pa.array(key[begin] >> 32), pa.array(key[begin] & 0xFFFFFFFF),
                                               pa.array(times.astype(np.int64))], names=["a", "b", "m"])
            a_row = np.repeat(np.arange(rows), x.n_a)
            yield pa.RecordBatch.from_arrays([
                part.column("row"), part.column("doc_id"), pa.array(x.n_a.astype(np.int64)), pa.array(x.n_b.astype(np.int64)),
                pa.array(per(a_row, x.last).astype(np.int64)), pa.array(np.bincount(x.row, minlength=rows)),
                pa.array(per(x.row[hit], best[at[hit]]).astype(np.int64)), pa.array(total),
                pa.ListArray.from_arrays(pa.array(offsets), rare),
                pa.array(digest(x) if digest else [None] * rows, pa.string())], names=names)

    schema = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, head_best long, head_sum long, "
              "rare array<struct<a: long, b: long, m: long>>, digest string")
    names = [c.split()[0] for c in re.sub("<.*>", "", schema).split(", ")]
    figures = staged(aligned.mapInArrow(run, schema), "links", **_ROW_GROUP)
    rare = (
        figures.select("row", F.inline("rare")).join(pairs.where(F.col("n") < least), ["a", "b"])
        .groupBy("row").agg(F.sum(F.expr("if(best, m, 0L)")).alias("rare_best"), F.sum(F.expr("m * n")).alias("rare_sum"))
    )
    zero = F.lit(0).cast("long")
    out = figures.drop("rare").join(rare, "row", "left").select(
        "row", "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("head_best") + F.coalesce("rare_best", zero)).alias("n_best"),
        (F.col("head_sum") + F.coalesce("rare_sum", zero)).alias("count_sum"), "digest")
    return out if digest else out.drop("digest")


def group_texts(x: Links) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each row: decimal ids of the groups, in order."""
    a_last = x.last
    last = np.flatnonzero(a_last)
    b_last = np.zeros(len(x.b_ids), bool)
    b_last[x.first[last] + x.count[last] - 1] = True
    a_group = np.cumsum(a_last) - a_last  # groups before each token
    b_group = np.cumsum(b_last) - b_last
    before_a = np.append(0, np.cumsum(np.bincount(b_group, minlength=len(last))))[a_group] if len(last) else a_group
    through_a = np.cumsum(np.bincount(a_group, minlength=len(last)))[b_group] if len(last) else b_group
    spot = np.concatenate([np.arange(len(x.a_ids)) + before_a, np.arange(len(x.b_ids)) + through_a])
    order = np.empty(len(spot), np.int64)
    order[spot] = np.concatenate([x.a_ids * 3 + a_last, x.b_ids * 3 + 2 * b_last])
    written = _written(int(order.max()) // 3 + 1 if len(order) else 0)
    ends = np.cumsum(x.n_a + x.n_b).tolist()
    values = order.tolist()
    return ["".join([written[i] for i in values[lo:hi]])[:-1] for lo, hi in zip([0, *ends], ends, strict=False)]


_WRITTEN: list[str] = []


def _written(n: int) -> list[str]:
    """Each id below ``n`` (a vocabulary's size) followed by a comma, a bar and a semicolon."""
    for i in range(len(_WRITTEN) // 3, n):
        _WRITTEN.extend((f"{i},", f"{i}|", f"{i};"))
    return _WRITTEN
