"""MinHash near-dedup with bottom-k sketches from one hash function.

1. One scan turns each text into its set of shingle hashes; kept are the set's
   size, a 128-bit digest and its ``k`` smallest hashes (the bottom-k sketch).
2. Documents with equal sets (equal digests) form one class; only its smallest
   id goes on.
3. Inverted lists of retained values generate candidates. A pair at the
   threshold shares at least ``need`` retained values but for a chance under
   1e-9, so it also shares one of the ``len(sketch) - need + 1`` rarest values
   of either; only those are listed. Sets of at most ``100 k / percent``
   shingles are their own sketch, so those of under ``k``, whose partners have
   no more, have an exact bound.
4. The overlap of two sketches within the bottom-k of their union estimates
   their Jaccard similarity; pairs more than 6 standard deviations under the
   threshold go.
5. The others are verified by exact Jaccard on the full sets.

No list is expanded into all its pairs. Each member is paired with the list's
leader, the one with the fewest values of its own. Where that does not join all
members of a list to one family, the members outside its largest are held
against the list inside tasks, by their sketches. Where a family's verified links leave
several components, the members outside its largest one are held against the
whole family in the same way, by their full sets. A group of thousands of near copies
thus costs rows in proportion to its size, and no link between two components
is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from streetflow.llm.graph import components, staged
from streetflow.llm.similar import across, candidates, verified
from streetflow.llm.textscan import Words, as_long, mix, slices

_U = np.uint64


def shingle_sets(column: pa.Array, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text of a batch. Texts with
    fewer words than ``length`` have one shingle, their whole sequence; texts
    without words none."""
    for lo, hi, data, offsets in slices(column):
        w = Words(data, offsets, lower=True)
        h = w.windows(length)
        whole = w.whole(length)
        for r in range(hi - lo):
            a, b = int(w.first[r]), int(w.first[r + 1])
            if b - a >= length:
                s = np.unique(h[a:b - length + 1])
                assert whole[a:b - length + 1].all()
            elif b > a:
                one = w.hash[a:b]
                s = mix(np.bitwise_xor.reduce(mix(one + np.arange(b - a, dtype=_U)), keepdims=True) + _U(b - a))
            else:
                s = one = np.zeros(0, _U)
            yield lo + r, s


def _pack(s: np.ndarray) -> bytes:
    return s.tobytes()


def _unpack(sets: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b.as_buffer(), _U) for b in sets]


#: Flipped, so that hashes keep their order as signed longs.
_SIGN = _U(1 << 63)


def _sketch_set(sketches: pa.Array) -> list[np.ndarray]:
    return [v.values.to_numpy().view(_U) ^ _SIGN for v in sketches]


def _key(s: np.ndarray) -> bytes:
    """128-bit digest of a set."""
    with np.errstate(over="ignore"):
        return (np.add.reduce(s, keepdims=True).tobytes()
                + np.add.reduce(mix(s ^ _U(0x5851F42D4C957F2D)), keepdims=True).tobytes())


_SKETCH = StructType([
    StructField("doc_id", LongType()), StructField("t", LongType()), StructField("n_shingles", LongType()), StructField("key", BinaryType()),
    StructField("sketch", ArrayType(LongType()))])
_SET = StructType([StructField("key", BinaryType()), StructField("shingles", BinaryType())])


def sketches(docs: DataFrame, length: int, k: int, wide: int) -> DataFrame:
    """(doc_id, t, n_shingles, key, sketch) of each row (doc_id, t, text); ``sketch``
    is ascending: the ``k`` smallest, or the whole set if it has at most ``wide``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key, sketch = [], [], []
            for _, s in shingle_sets(batch.column(2), length):
                n.append(len(s))
                key.append(_key(s))
                sketch.append(as_long(s[:k if len(s) > wide else wide] ^ _SIGN))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                 pa.array(sketch, pa.list_(pa.int64()))], names=_SKETCH.names)

    return docs.mapInArrow(run, _SKETCH)


def full_sets(docs: DataFrame, length: int) -> DataFrame:
    """(key, sorted shingle hashes, packed) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 512):
                sets = [s for _, s in shingle_sets(batch.slice(part, 512).column(0), length)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_key(s) for s in sets], pa.binary()), pa.array([_pack(s) for s in sets], pa.binary())],
                    names=_SET.names)

    return docs.select("text").mapInArrow(run, _SET)


def need_of(k: int, threshold: float) -> int:
    """Retained values that two sketches at the threshold share but for a chance of
    about 1e-9: the binomial's mean less 6 standard deviations."""
    return max(1, int(k * threshold - 6.5 * sqrt(k * threshold * (1 - threshold))))


def _sets_of(ids: DataFrame, reps: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """(id, shingles) of the classes in ``ids``, from their texts."""
    wanted = reps.join(ids.distinct(), "id", "left_semi").select("id", "key", "rep")
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["rep"]), "left_semi")
    sets = full_sets(texts, length).dropDuplicates(["key"])
    return wanted.join(sets, "key").select("id", "shingles")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = 5,
                    percent: int = 80, k: int = 64) -> DataFrame:
    """(doc_id, t, n_shingles, component_id, kept) of each row of ``docs``, ``t``
    being xxhash64 of the text.

    Words are runs of anything but ASCII white space, with A-Z lowered. Rows
    link if 100 * |intersection| >= percent * |union| of their shingle sets.
    Null or wordless texts have no shingles, link with nothing and are their
    own component. Of a component the smallest id is kept. Rows that repeat an
    id are compared each by its own text; a null id is never a component's id
    unless all its rows have none, and never kept. An empty table gives an
    empty result. Other columns are ignored.
    """
    text = F.col(text_col).cast("string")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text"))
    need = need_of(k, percent / 100)
    wide = max(k, 100 * k // percent)  # no set of up to k has a larger partner
    rows = staged(sketches(docs, length, k, wide), "sketches")
    reps = staged(
        rows.where("n_shingles > 0").groupBy("key").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
        .withColumn("id", F.monotonically_increasing_id()), "reps")

    # each set's rarest retained values; a value that one set alone has cannot make a pair
    postings = reps.select("id", "n", F.explode("sketch").alias("v"))
    often = postings.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    sure = F.when(F.col("n") >= k, F.lit(need)).otherwise(F.ceil(F.col("n") * percent / 100))
    listed = staged(
        postings.join(often, "v").groupBy("id").agg(
            F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "v"))).alias("by_df"))
        # the rarest: those that no other set has come first, then by_df
        .withColumn("prefix", F.size("by_df") - sure + 1)
        .where("prefix > 0")
        .select("id", "n", (F.when(F.col("n") > wide, k).otherwise(F.col("n")) - F.size("by_df")).alias("p"),
                F.explode(F.slice("by_df", 1, F.col("prefix").cast("int"))).alias("x"))
        .select("id", "n", "p", F.col("x.v").alias("v")),
        "postings")

    def alike(pairs: DataFrame) -> DataFrame:
        """Pairs whose union sketch does not rule them out."""
        side = reps.select("id", "sketch")
        both = pairs.join(side.toDF("a", "s_a"), "a").join(side.toDF("b", "s_b"), "b")
        union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, k)
        shared = F.size(F.array_intersect(F.array_intersect(union, "s_a"), "s_b"))
        least = F.when(F.size(union) < k, F.ceil(F.size(union) * percent / 100)).otherwise(F.lit(need))
        return both.where(shared >= least).select("a", "b")

    # sketches that share `need` values, or percent of less, have at least this share of their union
    loose = min(percent, 100 * need // (k + wide - need))
    like = staged(candidates(listed, percent, alike, reps.select("id", "sketch"), _sketch_set, loose), "pairs")
    sets = staged(_sets_of(like.select(F.col("a").alias("id")).union(like.select("b")), reps, docs, length), "sets")
    links = staged(verified(like, sets, _unpack, percent), "links")
    family = components(like, "a", "b").toDF("id", "family")
    part = components(links, "a", "b").toDF("id", "part")
    members = family.join(part, "id", "left").select("id", "family", F.coalesce("part", "id").alias("part"))
    links = links.union(staged(across(members, sets, _unpack, percent), "links"))

    named = reps.select("key", "id", "rep").join(components(links, "a", "b").toDF("id", "part"), "id", "left").withColumn(
        "part", F.coalesce("part", "id"))
    named = named.join(named.groupBy("part").agg(F.min("rep").alias("component_id")), "part").select(
        "key", "component_id")
    return (
        rows.select("doc_id", "t", "n_shingles", "key").join(named, "key", "left")
        .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
        .select("doc_id", "t", "n_shingles", "component_id",
                F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    )
