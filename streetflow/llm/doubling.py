"""Substring dedup by level-wise doubling of word windows.

A window of ``words`` words can only repeat in another document if each of its
shorter windows does. So the first level looks at windows of half that length
(``(words + 1) // 2``), and only where one repeats across documents are windows
of twice the length (capped at ``words``) formed and counted.

At the first level not every window is needed: of each run of ``words`` words
the half window with the smallest hash stands for the run. Equal runs pick
equal half windows, so no repeat is missed, and a quarter of all positions go
through the shuffle. Whole copies of a text are told
by their digests, and skip the second level. Both levels are grouped minima and maxima (summed before
the shuffle) and a join on the hash, so that a passage that a third of all
documents share never gathers in one group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetflow.llm.graph import staged
from streetflow.llm.similar import SMALL_ROWS
from streetflow.llm.textscan import Words, as_long, mix, slices

_U = np.uint64
_ROWS = 1 << 16
#: Bits of a half window's hash; equal hashes of different windows only cost work.
_HALF_BITS = 48


def picked(h: np.ndarray, whole: np.ndarray, span: int) -> np.ndarray:
    """Positions of the leftmost smallest of every ``span`` consecutive window
    hashes that are whole together; sorted."""
    n = len(h) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best = h[:n].copy()
    at = np.arange(n)
    for j in range(1, span):
        smaller = h[j:j + n] < best
        np.copyto(best, h[j:j + n], where=smaller)
        np.copyto(at, np.arange(j, j + n), where=smaller)
    return np.unique(at[whole])


def _emit(names: list[str], columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(columns[0]), _ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c[a:a + _ROWS]) for c in columns], names=names)


def _half_windows(docs: DataFrame, words: int, half: int) -> DataFrame:
    """(h, doc, at): sampled half windows; ``at`` is the word position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            variant = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, data, offsets in slices(batch.column(2)):
                w = Words(data, offsets, lower=False)
                h = w.windows(half) >> _U(64 - _HALF_BITS)
                at = picked(h, w.whole(words), words - half + 1)
                row = w.row[at]
                place = at - w.first[row] + (variant[lo:hi][row] << 40)
                yield from _emit(["h", "doc", "at"], [as_long(h[at]), ids[lo:hi][row], place])

    return docs.mapInArrow(run, "h long, doc long, at long")


def _windows_around(docs: DataFrame, words: int, half: int) -> DataFrame:
    """(h, doc, at): whole windows whose half window (``spots``) repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            variant = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            spots = batch.column(3)
            for lo, hi, data, offsets in slices(batch.column(2)):
                w = Words(data, offsets, lower=False)
                h, whole = w.windows(words), w.whole(words)
                base = w.windows(half) >> _U(64 - _HALF_BITS)
                chosen = []
                for r in range(lo, hi):
                    a, b = int(w.first[r - lo]), int(w.first[r - lo + 1])
                    n = b - a - words + 1
                    if n <= 0 or spots[r].as_py() is None:
                        continue
                    # a window counts if the half window that it picks is a spot
                    spot = np.zeros(b - a, bool)
                    spot[np.asarray(spots[r].values, dtype=np.int64) & ((1 << 40) - 1)] = True
                    span = words - half + 1
                    best, at = base[a:a + n].copy(), np.arange(n)
                    for j in range(1, span):
                        smaller = base[a + j:a + j + n] < best
                        np.copyto(best, base[a + j:a + j + n], where=smaller)
                        np.copyto(at, np.arange(j, j + n), where=smaller)
                    chosen.append(a + np.flatnonzero(spot[at]))
                if chosen:
                    at = np.concatenate(chosen)
                    assert whole[at].all()
                    row = w.row[at]
                    place = at - w.first[row] + (variant[lo:hi][row] << 40)
                    yield from _emit(["h", "doc", "at"], [as_long(h[at]), ids[lo:hi][row], place])

    return docs.mapInArrow(run, "h long, doc long, at long")


def _cover(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_words, n_removed, text): words left after removing those that a
    listed window covers (``spots``: window starts, or null), or all those of a ``copy``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                n, gone, text = [], [], []
                for t, spots, copy in zip(*part.columns[2:], strict=True):
                    tokens = (t.as_py() or "").encode().split()  # of bytes, so at ASCII white space
                    kept = tokens
                    if copy.as_py() and len(tokens) >= words:
                        kept = []
                    elif spots.as_py():
                        step = np.zeros(len(tokens) + 1, np.int64)
                        at = np.unique(np.asarray(spots.values, dtype=np.int64) & ((1 << 40) - 1))
                        step[at] += 1
                        step[at + words] -= 1
                        kept = [x for x, k in zip(tokens, (np.cumsum(step[:-1]) == 0).tolist(), strict=True) if k]
                    n.append(len(tokens))
                    gone.append(len(tokens) - len(kept))
                    text.append(b" ".join(kept).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(text, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "text"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_removed long, text string")


def _repeated(windows: DataFrame, first_too: bool) -> DataFrame:
    """(doc, spots): places of the windows whose hash other documents have too;
    without ``first_too``, only where a smaller document has it."""
    seen = windows.groupBy("h").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high")
    hit = windows.join(seen.select("h", "low"), "h")
    return (hit if first_too else hit.where("doc > low")).groupBy(
        "doc", F.shiftright("at", 40).cast("int").alias("variant")).agg(F.collect_set("at").alias("spots"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    words: int = 13) -> DataFrame:
    """(doc_id, n_words, n_removed, text) of each row of ``docs``: ``text`` holds
    the kept words, joined by one space.

    Words are runs of anything but ASCII white space, unchanged. A word goes if
    a window of ``words`` words of its document covers it whose word sequence
    also starts in a document with a smaller id; all windows are judged on the
    input. Null texts have no words; texts with fewer than ``words`` words stay
    whole, as do rows with a null id, which also count as nobody's copy. Rows
    that repeat an id are judged each by its own text, and none is smaller than
    the other. An empty table gives an empty result. Other columns are ignored.
    """
    half = (words + 1) // 2
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    named = docs.where("doc_id is not null")
    # texts of an id that has several are told apart by their rank
    several = named.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("low"),
                                          F.max(F.xxhash64("text")).alias("high")).where("low <> high")
    if several.isEmpty():
        docs = docs.select("doc_id", F.lit(0).alias("variant"), "text")
    else:
        rank = F.dense_rank().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
        docs = docs.select("doc_id", (rank - 1).alias("variant"), "text")

    def joined(found: DataFrame, others_too: bool) -> DataFrame:
        """Texts with what was found in them (spots, copy). If that is a bounded
        number of documents, only their texts are shuffled."""
        found = found.withColumnRenamed("doc", "doc_id")
        keys, columns = ["doc_id", "variant"], ["doc_id", "variant", "text", "spots", "copy"]
        if found.count() > SMALL_ROWS:
            return docs.join(found, keys, "left" if others_too else "inner").select(*columns)
        ids = F.broadcast(found.select(*keys))
        out = docs.join(ids, keys, "left_semi").join(found, keys).select(*columns)
        if others_too:
            rest = docs.where("doc_id is null").unionByName(
                docs.where("doc_id is not null").join(ids, keys, "left_anti"))
            out = out.unionByName(rest.withColumn("spots", F.lit(None).cast("array<bigint>")).withColumn(
                "copy", F.lit(None).cast("boolean")).select(*columns))
        return out

    # a whole copy of a smaller document's text is covered by that one, and covers nothing that it does not
    named = docs.where("doc_id is not null").select("doc_id", "variant", F.md5("text").alias("digest"))
    low = named.groupBy("digest").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    copies = staged(named.join(low, "digest").where("doc_id > low").select(
        F.col("doc_id").alias("doc"), "variant").distinct(), "copies")

    long_enough = docs.where("doc_id is not null")
    spots = staged(_repeated(_half_windows(long_enough, words, half), first_too=True).join(
        copies, ["doc", "variant"], "left_anti").withColumn("copy", F.lit(False)), "spots")
    longer = staged(_windows_around(joined(spots, others_too=False), words, half), "windows")
    found = staged(_repeated(longer, first_too=False).withColumn("copy", F.lit(False)).unionByName(
        copies.select("doc", "variant", F.lit(None).cast("array<bigint>").alias("spots"), F.lit(True).alias("copy"))),
        "found")
    return _cover(joined(found, others_too=True), words)
