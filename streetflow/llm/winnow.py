"""Benchmark decontamination by winnowing; DataFrame functions only.

Of each run of ``words`` words the smallest hash of its k-grams is the run's
fingerprint, with k half the run. A document and an item that share a run share
its fingerprint, so joining the distinct fingerprints of both finds every pair
that shares one; the pairs are then extended to the exact windows. Items
shorter than a window are one window of their own length, and are
fingerprinted, joined and extended at that length in the same way.

The benchmark's tables are written to the shared folder first, so that Spark
knows their size and broadcasts them only if they are small.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetflow.llm.graph import staged

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: what separates words once A-Z are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text: A-Z lowered, split at ASCII characters other than a-z and 0-9."""
    # lower() on all-ASCII texts only: elsewhere it would change other letters too
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), SEPARATORS), "")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once a row, even inside a lambda."""
    return F.transform(F.array(value), use)[0]


def sliding_min(values: Column, span: int) -> Column:
    """Smallest of each ``span`` consecutive elements, from each element on (fewer
    at the end): minima of 2, 4, ... elements, then of two overlapping ones."""
    reach = 1
    while reach < span:
        step = min(reach, span - reach)
        values = _bound(values, lambda a, step=step: F.transform(a, lambda x, i: F.least(x, F.get(a, i + step))))
        reach += step
    return values


def fingerprints(hashes: Column, n: Column, length: int) -> Column:
    """Distinct smallest k-gram hashes of every run of ``length`` words, k being
    ``(length + 1) // 2``; empty for fewer words. ``hashes`` are the ``n`` words'."""
    k = (length + 1) // 2
    grams = _bound(hashes, lambda h: F.transform(
        F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)])))
    mins = F.slice(sliding_min(grams, length - k + 1), F.lit(1), n - length + 1)
    return F.when(n >= length, F.array_distinct(mins)).otherwise(F.array().cast("array<bigint>"))


def windows(words: Column, length: Column) -> Column:
    """Every run of ``length`` words, joined by a space."""
    return _bound(words, lambda ws: F.when(F.size(ws) >= length, F.transform(
        F.sequence(F.lit(1), F.size(ws) - length + 1), lambda i: F.array_join(F.slice(ws, i, length), " "))))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                  item_id_col: str = "item_id", item_text_col: str = "text", words: int = 10) -> DataFrame:
    """(doc_id, t, n_words, n_hit, items) of each row of ``docs``: xxhash64 of the
    text, its words, those that lie inside an occurrence of an item's window,
    and the sorted ids (as strings) of the items with occurring windows.

    Null texts have no words; items without words have no window; an item with
    fewer than ``words`` words is one window. Rows may repeat or lack an id:
    each is judged by its own text. Items without id mark words but are not
    listed. Without documents the result is empty; without items nothing is
    hit. Other columns are ignored.
    """
    items = staged(
        items.select(F.col(item_id_col).alias("item_id"), words_of(F.col(item_text_col).cast("string")).alias("ws"))
        .where(F.size("ws") > 0).withColumn("l", F.least(F.size("ws"), F.lit(words))), "items")
    lengths = sorted(r["l"] for r in items.select("l").distinct().collect())  # at most `words` values

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("t"), "text")
    hashed = keyed.select("doc_id", "t", words_of(F.col("text")).alias("ws")).select(
        "doc_id", "t", F.size("ws").alias("n"), F.transform("ws", lambda w: F.xxhash64(w)).alias("h"))
    marks = staged(
        hashed.select("doc_id", "t", "n", *[fingerprints(F.col("h"), F.col("n"), x).alias(f"f{x}") for x in lengths]),
        "fingerprints")

    candidates = None
    for x in lengths:
        own = items.where(F.col("l") == x).select(
            F.size("ws").alias("n"), F.transform("ws", lambda w: F.xxhash64(w)).alias("h"))
        own = staged(own.select(F.explode(fingerprints(F.col("h"), F.col("n"), x)).alias("f")).distinct(), "marks")
        found = marks.select("doc_id", "t", F.explode(f"f{x}").alias("f")).join(own, "f", "left_semi").select(
            "doc_id", "t", F.lit(x).alias("l")).distinct()
        candidates = found if candidates is None else candidates.union(found)
    rows = marks.select("doc_id", "t", F.col("n").cast("long").alias("n_words"))
    if candidates is None:
        return rows.select("doc_id", "t", "n_words", F.lit(0).cast("long").alias("n_hit"),
                           F.array().cast("array<string>").alias("items"))

    candidates = staged(candidates.groupBy("doc_id", "t").agg(F.collect_set("l").alias("ls")), "candidates")
    exact = staged(
        items.select("item_id", "l", F.explode(windows(F.col("ws"), F.col("l"))).alias("w"))
        .groupBy("w", "l").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids")), "windows")
    same = (keyed["doc_id"].eqNullSafe(candidates["doc_id"])) & (keyed["t"] == candidates["t"])
    suspects = keyed.join(candidates, same).select(
        keyed["doc_id"], keyed["t"], "text", F.explode("ls").alias("l")).dropDuplicates(["doc_id", "t", "l"])
    hits = (
        suspects.select("doc_id", "t", "l", F.posexplode(windows(words_of(F.col("text")), F.col("l"))).alias("at", "w"))
        .join(exact, ["l", "w"])
        .groupBy("doc_id", "t").agg(
            F.collect_set(F.struct("at", "l")).alias("at"), F.collect_set("ids").alias("ids"))
        .select(
            "doc_id", "t",
            F.size(F.array_distinct(F.flatten(F.transform(
                "at", lambda x: F.sequence(x["at"], x["at"] + x["l"] - 1))))).cast("long").alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten("ids"))).alias("items"))
    )
    same = (rows["doc_id"].eqNullSafe(hits["doc_id"])) & (rows["t"] == hits["t"])
    return rows.join(hits, same, "left").select(
        rows["doc_id"], rows["t"], "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
