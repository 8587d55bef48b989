"""Ranked lexical search by pipelined term partitioning.

The terms of a bundle of items are dealt to owners, the rarest (of greatest
weight) to the first. Documents lie in slices. For every slice the bundle starts
with no accumulators, and goes through the owners one after the other: at each
stage a cogroup brings the slice's sparse accumulators (item, document, score)
and the owner's postings of that slice together, and integer contributions
are added. Between stages, accumulators that can no longer reach an item's best
are left out: a score only grows, by no more than the greatest contributions of the terms
to come, and the scores so far already bound the last rank from below. So the
result is that of adding everything.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetflow.llm import textscan
from streetflow.llm.graph import staged

#: Different texts of items, and bytes of them, that are searched at a time.
_ITEMS, _ITEM_BYTES = 256, 1 << 22
#: Documents of a slice, which also has no more bytes than ``textscan.slices`` gives (a longer document is its own).
_DOCS = 2048
#: Shares of the postings up to which each owner's terms go, rarest first.
_OWNERS = (0.05, 0.2, 0.5, 1.0)

_BLOCK = ("slice long, ids array<long>, docs long, words long, length array<long>, doc array<int>, term array<int>, "
          "tf array<int>, own array<int>, df array<int>")
_POSTING = "owner int, slice long, doc array<int>, term array<int>, score array<long>, own array<int>, peak array<long>"
_BUNDLE = ("slice long, ids array<long>, item array<int>, doc array<int>, score array<long>, top_item array<int>, "
           "top_score array<long>")

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Terms:
    """Terms of a slice of texts, given as UTF-8 bytes: maximal runs of ASCII letters
    and digits and of what is not ASCII, A-Z lower-cased. ``start``/``end`` are
    byte positions, ``row`` the text, ``hash`` 64 bits of a term's bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data = data = textscan._LOWER[data]
        inside = _TERM[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1] | edge[1:-1]
        ends[:-1] &= ~inside[1:] | edge[1:-1]
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        up, down = textscan._powers_to(len(data) + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(textscan._BYTE[data] * up[:len(data)], out=total[1:])
            h = (total[self.end] - total[self.start]) * down[self.start]
            self.hash = textscan.mix(h + (self.end - self.start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class Vocabulary:
    """Numbered terms; terms are found by hash and then compared by their bytes."""

    def __init__(self, texts: list[str]) -> None:
        raw = [t.encode() for t in texts]
        offsets = np.cumsum([0, *map(len, raw)])
        found = Terms(np.frombuffer(b"".join(raw), np.uint8), offsets)
        data = found.data.tobytes()
        words = [data[x:y] for x, y in zip(found.start.tolist(), found.end.tolist(), strict=True)]
        number: dict[bytes, int] = {}
        self.items = [Counter() for _ in texts]  # term -> occurrences, of every text
        hashes = []
        for word, row, h in zip(words, found.row.tolist(), found.hash, strict=True):
            if word not in number:
                number[word] = len(number)
                hashes.append(h)
            self.items[row][number[word]] += 1
        self.size = np.array([len(w) for w in number], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(number), np.uint8)
        hashes = np.array(hashes, np.uint64)
        self.order = np.lexsort((np.arange(len(hashes)), hashes))
        self.hash = hashes[self.order]

    def __len__(self) -> int:
        return len(self.size)

    def find(self, terms: Terms) -> tuple[np.ndarray, np.ndarray]:
        """(indexes of those terms that are in the vocabulary, their numbers)."""
        if not len(self):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, out = np.searchsorted(self.hash, terms.hash), []
        while True:  # once more for every further term of the same hash
            ok = np.flatnonzero((at < len(self.hash)) & (self.hash[np.minimum(at, len(self.hash) - 1)] == terms.hash))
            if not len(ok):
                break
            number = self.order[at[ok]]
            same = self.size[number] == terms.end[ok] - terms.start[ok]
            ok, number, at = ok[same], number[same], at + 1
            size = self.size[number]
            differ = terms.data[_ranges(terms.start[ok], size)] != self.data[_ranges(self.first[number], size)]
            right = np.bincount(np.repeat(np.arange(len(ok)), size), differ, len(ok)) == 0
            out.append((ok[right], number[right]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2


def _array(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def blocks(docs: DataFrame, vocabulary: Vocabulary, id_col: str, text_col: str) -> DataFrame:
    """Slices of documents with the places of the vocabulary's terms: a row has the
    ids and lengths (in terms) of its documents, (doc, term, tf) of every
    document's terms, and each term's number of documents. A written table."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)  # no more terms than a bundle of items has bytes

    def one(number: int, ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        terms = Terms(data, offsets)
        at, term = held.value.find(terms)
        key, tf = np.unique(terms.row[at] << 32 | term, return_counts=True)
        own, df = np.unique(key & 0xFFFFFFFF, return_counts=True)
        length = np.bincount(terms.row, minlength=len(ids))
        return pa.RecordBatch.from_arrays([
            pa.array([TaskContext.get().partitionId() << 32 | number]),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([int((length > 0).sum())]), pa.array([int(length.sum())]), _array(length, pa.int64()),
            _array(key >> 32, pa.int32()), _array(key & 0xFFFFFFFF, pa.int32()), _array(tf, pa.int32()),
            _array(own, pa.int32()), _array(df, pa.int32())], names=[c.split()[0] for c in _BLOCK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for lo, hi, data, offsets in textscan.slices(batch.column(1)):
                for x in range(lo, hi, _DOCS):
                    y = min(hi, x + _DOCS)
                    a, b = offsets[x - lo], offsets[y - lo]
                    yield one(number, batch.column(0).slice(x, y - x), data[a:b], offsets[x - lo:y - lo + 1] - a)
                    number += 1

    return staged(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                  .mapInArrow(run, _BLOCK), "slices")


@dataclass
class Plan:
    """What every task needs of a bundle: bounded by the items' terms."""

    weight: np.ndarray  # of every term
    owner: np.ndarray  # of every term
    docs: int  # with at least one term
    words: int
    items: int
    begin: np.ndarray  # items of term t and occurrences there: [begin[t]:begin[t + 1]]
    item: np.ndarray
    times: np.ndarray

    @staticmethod
    def of(vocabulary: Vocabulary, df: np.ndarray, docs: int, words: int) -> Plan:
        weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        order = np.argsort(-weight, kind="stable")
        share = np.cumsum(df[order]) / max(1, df.sum())
        owner = np.empty(len(df), np.int64)
        owner[order] = np.minimum(np.searchsorted(_OWNERS, share), len(_OWNERS) - 1)
        rows = sorted((t, i, q) for i, terms in enumerate(vocabulary.items) for t, q in terms.items())
        t, item, times = np.array(rows, np.int64).reshape(-1, 3).T
        return Plan(weight, owner, docs, words, len(vocabulary.items), np.searchsorted(t, np.arange(len(df) + 1)), item, times)

    def contributions(self, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        m = 75 + (25 * length * self.docs) // max(1, self.words)
        return self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))

    def still(self, peak: np.ndarray, stage: int) -> np.ndarray:
        """The most that each item can gain after a stage."""
        late = self.owner > stage
        terms = np.repeat(np.arange(len(self.owner)), np.diff(self.begin))
        out = np.zeros(self.items, np.int64)
        np.add.at(out, self.item, np.where(late[terms], peak[terms], 0) * self.times)
        return out


def postings(slices: DataFrame, plan: Plan) -> DataFrame:
    """Contributions by owner and slice, with each term's greatest one; a written
    table with a folder for each owner."""
    held = slices.sparkSession.sparkContext.broadcast(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = held.value
        for batch in batches:
            for i in range(batch.num_rows):
                length, doc, term, tf = (batch.column(c)[i].values.to_numpy().astype(np.int64)
                                         for c in ("length", "doc", "term", "tf"))
                score = p.contributions(term, tf, length[doc])
                for k in range(len(_OWNERS)):
                    at = np.flatnonzero((p.owner[term] == k) & (score > 0))
                    own, back = np.unique(term[at], return_inverse=True)
                    peak = np.zeros(len(own), np.int64)
                    np.maximum.at(peak, back, score[at])
                    yield pa.RecordBatch.from_arrays([
                        pa.array([k], pa.int32()), batch.column("slice").slice(i, 1), _array(doc[at], pa.int32()),
                        _array(term[at], pa.int32()), _array(score[at], pa.int64()), _array(own, pa.int32()),
                        _array(peak, pa.int64())], names=[c.split()[0] for c in _POSTING.split(", ")])

    return staged(slices.select("slice", "length", "doc", "term", "tf").mapInArrow(run, _POSTING), "postings", ["owner"])


def _stage(bundles: DataFrame, own: DataFrame, plan: Plan, stage: int, least: np.ndarray, gain: np.ndarray, top: int) -> DataFrame:
    """The bundles after an owner: its contributions added, and of every item's
    accumulators those that may still reach ``least``, the score of its last rank
    so far, with ``gain`` more to come. After the last owner, each item's best."""
    held = bundles.sparkSession.sparkContext.broadcast((plan, least, gain))
    final = stage == len(_OWNERS) - 1

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        p, low, more = held.value
        row = left.slice(0, 1).to_batches()[0]
        ids, item, doc, score = (row.column(c)[0].values for c in ("ids", "item", "doc", "score"))
        n = len(ids)
        where, value = [item.to_numpy().astype(np.int64) * n + doc.to_numpy()], [score.to_numpy()]
        for batch in right.to_batches():
            for i in range(batch.num_rows):
                doc, term, gained = (batch.column(c)[i].values.to_numpy().astype(np.int64) for c in ("doc", "term", "score"))
                count = p.begin[term + 1] - p.begin[term]
                at = _ranges(p.begin[term], count)
                where.append(p.item[at] * n + np.repeat(doc, count))
                value.append(np.repeat(gained, count) * p.times[at])
        total = np.zeros(p.items * n, np.int64)
        for x, v in zip(where, value, strict=True):
            # halves of 31 bits: sums of doubles are exact, however the rows come
            total += np.bincount(x, v & 0x7FFFFFFF, len(total)).astype(np.int64)
            total += np.bincount(x, v >> 31, len(total)).astype(np.int64) << 31
        at = np.flatnonzero(total)
        item, score = at // max(n, 1), total[at]
        keep = score + more[item] >= low[item]
        at, item, score = at[keep], item[keep], score[keep]
        doc = at % max(n, 1)
        key = ids.to_numpy(zero_copy_only=False) if not ids.null_count else np.where(
            ids.is_null().to_numpy(zero_copy_only=False), np.iinfo(np.int64).max, ids.fill_null(0).to_numpy())
        order = np.lexsort((key[doc], -score, item))
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        best = order[rank < top]
        if final:
            item, doc, score = item[best], doc[best], score[best]
        return pa.Table.from_arrays([
            row.column("slice"), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids), _array(item, pa.int32()),
            _array(doc, pa.int32()), _array(score, pa.int64()), _array(item if final else item[best], pa.int32()),
            _array(score if final else score[best], pa.int64())], names=[c.split()[0] for c in _BUNDLE.split(", ")])

    return staged(bundles.groupBy("slice").cogroup(own.groupBy("slice")).applyInArrow(add, _BUNDLE), f"bundles-{stage}")


def _last_rank(bundles: DataFrame, items: int, top: int) -> np.ndarray:
    """The score of every item's last rank so far, 0 where there are fewer documents."""
    by = Window.partitionBy("item").orderBy(F.desc("score"))
    rows = (
        bundles.select(F.explode(F.arrays_zip("top_item", "top_score")).alias("x")).select(
            F.col("x.top_item").alias("item"), F.col("x.top_score").alias("score"))
        .withColumn("r", F.row_number().over(by)).where(F.col("r") <= top)  # tasks send so many of an item
        .where(F.col("r") == top).select("item", "score").collect()  # a bundle's items at most
    )
    out = np.zeros(items, np.int64)
    for r in rows:
        out[r["item"]] = r["score"]
    return out


def _search_bundle(docs: DataFrame, numbers: list[int], texts: list[str], top: int, id_col: str, text_col: str) -> DataFrame:
    """(number, rank, doc_id, score) for a bundle of texts."""
    spark = docs.sparkSession
    vocabulary = Vocabulary(texts)
    slices = blocks(docs, vocabulary, id_col, text_col)
    total = slices.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    df = np.zeros(len(vocabulary), np.int64)
    counts = slices.select(F.explode(F.arrays_zip("own", "df")).alias("x")).groupBy("x.own").agg(F.sum("x.df").alias("n"))
    for r in counts.collect():  # a bundle's terms at most
        df[r["own"]] = r["n"]
    plan = Plan.of(vocabulary, df, total["docs"] or 0, total["words"] or 0)
    owned = postings(slices, plan)
    peak = np.zeros(len(vocabulary), np.int64)
    for r in owned.select(F.explode(F.arrays_zip("own", "peak")).alias("x")).groupBy("x.own").agg(
            F.max("x.peak").alias("n")).collect():
        peak[r["own"]] = r["n"]
    ints, longs = F.array().cast("array<int>"), F.array().cast("array<long>")
    bundles = slices.select("slice", "ids", ints.alias("item"), ints.alias("doc"), longs.alias("score"),
                            ints.alias("top_item"), longs.alias("top_score"))
    least = np.zeros(len(texts), np.int64)
    for stage in range(len(_OWNERS)):
        own = owned.where(F.col("owner") == stage).select("slice", "doc", "term", "score")
        bundles = _stage(bundles, own, plan, stage, least, plan.still(peak, stage), top)
        if stage < len(_OWNERS) - 1:
            least = _last_rank(bundles, len(texts), top)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    name = F.element_at(F.lit(numbers).cast("array<long>"), F.col("item") + 1)
    return (
        bundles.select("ids", F.explode(F.arrays_zip("item", "doc", "score")).alias("x"))
        .select(F.col("x.item").alias("item"), F.expr("get(ids, x.doc)").alias("doc_id"), F.col("x.score").alias("score"))
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        .select(name.alias("number"), "rank", "doc_id", "score")
    )


def search(docs: DataFrame, items: DataFrame, top: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_text: str = "text") -> DataFrame:
    """The rows of ``items`` (as struct ``row``) with rank, doc_id and score of their
    ``top`` highest-scoring rows of ``docs``, equal scores by ascending doc_id, null
    ids last; scores are above 0.

    Null texts have no terms; items without terms, or none of whose terms is in a
    document, give no rows, nor do empty tables. Every row of either table counts by
    itself, repeated ones too; equal item texts are searched once. Items go in
    bundles of a bounded number and size (a longer text is a bundle of its own), each
    of which reads the documents once.
    """
    rows = items.select(F.struct(*items.columns).alias("row"), F.col(item_text).cast("string").alias("text"))
    texts = staged(rows.where("text is not null and text <> ''").groupBy("text").agg(F.lit(1).alias("one"))
                   .select("text", F.monotonically_increasing_id().alias("number")), "items")
    size = texts.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    several = max(-(-size["n"] // _ITEMS), -(-(size["bytes"] or 0) // _ITEM_BYTES))
    found = None
    for k in range(several):
        bundle = texts.where(F.pmod(F.xxhash64("text"), F.lit(several)) == k).orderBy("number").collect()
        if bundle:
            part = _search_bundle(docs, [r["number"] for r in bundle], [r["text"] for r in bundle], top, id_col, text_col)
            found = part if found is None else found.union(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "number long, rank int, doc_id long, score long")
    return rows.join(texts, "text").join(found, "number").select("row", "rank", "doc_id", "score")
