"""Embedding near-dedup by collision-counting projections.

Vectors are projected on random directions, where two unit vectors at cosine c
lie N(0, 2 - 2c) apart. Projections are cut in windows of ``WIDTH``, at a random
offset each; ``depth`` of them together make a table's cell, and ``tables``
tables are made, so that a pair at the threshold meets in some cell but for a
chance of ``miss``, while a cell holds few unrelated vectors. Both numbers
follow from the number of vectors alone.

Inside a cell, pairs that a product of matrices in single precision leaves within
reach count their query-centred window collisions over many single projections
(``|p - q| <= reach``). The count that a pair at the threshold passes but for a
chance of about 1e-6 decides which pairs have their exact cosine taken. A link
counts in the first table that its pair meets in, and tasks put out link counts
and spanning edges, not pairs.

The number of tables grows with that of vectors. So tables go in passes, each of
which writes every vector at most as often as ``_PASS_BYTES`` allow, once at
least, and its shuffle files go before the next: disk does not follow the tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetflow.llm.graph import components, staged
from streetflow.llm.similar import small

WIDTH = 2.4
_CELL = 512  # members of a cell's block
_COUNTED = 64  # single projections whose collisions are counted
_PASS_BYTES = 1 << 28  # vectors that a pass writes to its tables' cells, if one table has no more
_SLACK = 1e-4  # above what rounding to single precision moves a cosine
_EARLIER = 8  # earlier tables in which pairs are looked for at once


def meeting(width: float, sd: float) -> float:
    """Chance that two points N(0, sd**2) apart share a window at a random offset."""
    z = width / sd
    return erf(z / sqrt(2)) - 2 * sd / width * (1 - exp(-z * z / 2)) / sqrt(2 * pi)


def shape_of(n: int, threshold: float, miss: float = 5e-4, crowd: int = 64) -> tuple[int, int]:
    """(depth, tables): so many unrelated vectors, ``crowd`` at most, meet one by
    chance in a table; a pair at the threshold meets in some table but for ``miss``."""
    close, far = meeting(WIDTH, sqrt(2 - 2 * threshold)), meeting(WIDTH, sqrt(2))
    depth = max(1, ceil(log(max(n, 1) / crowd) / -log(far)))
    return depth, ceil(log(miss) / log(1 - close**depth))


def _directions(dims: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dims]).standard_normal((dims, count))


def _units(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _keys(units: np.ndarray, depth: int, tables: range, total: int) -> np.ndarray:
    """Cells of unit vectors in ``tables`` of ``total``."""
    dims = units.shape[1]
    part = slice(tables.start * depth, tables.stop * depth)
    shift, directions = _windows(dims, depth * total)
    place = np.floor((units @ directions[:, part] + shift[part]) / WIDTH).astype(np.int64).view(np.uint64).reshape(
        len(units), len(tables), depth)
    h = np.full((len(units), len(tables)), dims, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(depth):
            h = (h + place[:, :, j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


@lru_cache(8)
def _windows(dims: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    return np.random.default_rng([7, dims]).uniform(0, WIDTH, count), _directions(dims, count, 1)


def _vectors(column: pa.Array) -> list[np.ndarray]:
    values, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(pc.list_value_length(column).to_numpy())
    return np.split(values.astype(np.float64), ends[:-1]) if len(column) else []


def _cells(vectors: DataFrame, depth: int, tables: range, total: int, bare: bool = False) -> DataFrame:
    """(id, w, x, t, key): rows of ``vectors`` (id, w, embedding), for each of ``tables``, with
    the vector's bytes (floats if they hold it exactly and else doubles, told apart by
    a last byte; ``bare`` leaves them out) and its cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                batch = whole.slice(lo, 512)
                rows = _vectors(batch.column(2))
                keys = np.zeros((len(rows), len(tables)), np.int32)
                for dims in {len(r) for r in rows}:
                    at = [i for i, r in enumerate(rows) if len(r) == dims]
                    keys[at] = _keys(_units(np.stack([rows[i] for i in at])), depth, tables, total)
                x = pa.nulls(len(rows), pa.binary()) if bare else pa.array([_bytes(r) for r in rows], pa.binary())
                for n, t in enumerate(tables):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), x, pa.array(np.full(len(rows), t, np.int32)),
                         pa.array(keys[:, n])], names=["id", "w", "x", "t", "key"])

    return vectors.mapInArrow(run, "id long, w long, x binary, t int, key int")


def _bytes(v: np.ndarray) -> bytes:
    with np.errstate(over="ignore"):
        short = v.astype(np.float32)
    return short.tobytes() + b"f" if (short == v).all() else v.tobytes() + b"d"


def _vector(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.float32 if b[-1:] == b"f" else np.float64, (len(b) - 1) // (4 if b[-1:] == b"f" else 8))


def _least_count(threshold: float, reach: float) -> int:
    p = erf(reach / sqrt(2 - 2 * threshold) / sqrt(2))
    return max(0, int(_COUNTED * p - 5 * sqrt(_COUNTED * p * (1 - p))))


class _Found:
    """Links of the cells of a task: counts by id, and edges that span what is linked."""

    def __init__(self, threshold: float, depth: int, total: int) -> None:
        self.threshold, self.reach = threshold, sqrt(2 - 2 * threshold)
        self.depth, self.total = depth, total
        self.least = _least_count(threshold, self.reach)
        self.links: dict[int, int] = {}
        self.edges: list[tuple[int, int]] = []

    def cell(self, table: int, rows: list[tuple]) -> None:
        """rows: (side, id, w, x); pairs within a cell, or between the sides 0 and 1 of two blocks."""
        if len(rows) < 2:
            return
        by_dims: dict[int, list[tuple]] = {}
        for r in rows:
            v = _vector(r[3])
            by_dims.setdefault(len(v), []).append((*r[:3], v))
        for group in by_dims.values():
            sides = np.array([r[0] for r in group])
            ids = np.array([r[1] for r in group], np.int64)
            w = [r[2] for r in group]
            x = _units(np.stack([r[3] for r in group]))
            a, b = (np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)) if sides.any() else [np.arange(len(group))] * 2
            short = x.astype(np.float32)
            close = short[a] @ short[b].T >= self.threshold - _SLACK
            if not sides.any():
                close = np.triu(close, 1)
            i, j = np.nonzero(close)
            if not len(i):
                continue
            i, j = a[i], b[j]
            some = np.unique(np.concatenate([i, j]))
            p = np.zeros((len(x), _COUNTED))
            p[some] = x[some] @ _directions(x.shape[1], _COUNTED, 2)
            parent = list(range(len(group)))

            def root(v: int, parent: list[int] = parent) -> int:
                while parent[v] != v:
                    parent[v] = parent[parent[v]]
                    v = parent[v]
                return v

            found = []
            for lo in range(0, len(i), 1 << 14):
                y, z = i[lo:lo + (1 << 14)], j[lo:lo + (1 << 14)]
                passed = (np.abs(p[y] - p[z]) <= self.reach).sum(axis=1) >= self.least
                y, z = y[passed], z[passed]
                good = (x[y] * x[z]).sum(axis=1) >= self.threshold
                found.append((y[good], z[good]))
            y, z = (np.concatenate(side) for side in zip(*found, strict=True))
            for lo in range(0, table, _EARLIER):  # pairs that met before are another cell's
                if not len(y):
                    break
                some, place = np.unique(np.concatenate([y, z]), return_inverse=True)
                keys = _keys(x[some], self.depth, range(lo, min(lo + _EARLIER, table)), self.total)
                new = (keys[place[:len(y)]] != keys[place[len(y):]]).all(axis=1)
                y, z = y[new], z[new]
            for u, v in zip(y.tolist(), z.tolist(), strict=True):
                self.links[int(ids[u])] = self.links.get(int(ids[u]), 0) + w[v]
                self.links[int(ids[v])] = self.links.get(int(ids[v]), 0) + w[u]
                if (ru := root(u)) != (rv := root(v)):
                    parent[ru] = rv
                    self.edges.append((int(ids[u]), int(ids[v])))

    def batches(self) -> Iterator[pa.RecordBatch]:
        """(a, b, n): an edge (n null), or a count of links of a (b null)."""
        a = [*self.links, *(e[0] for e in self.edges)]
        b = [None] * len(self.links) + [e[1] for e in self.edges]
        n = [*self.links.values()] + [None] * len(self.edges)
        self.links, self.edges = {}, []
        for lo in range(0, len(a), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[part], pa.int64()), pa.array(b[part], pa.int64()), pa.array(n[part], pa.int64())],
                names=["a", "b", "n"])


def _compare(cells: DataFrame, threshold: float, depth: int, total: int) -> DataFrame:
    """Streams cells, sorted, through ``_Found``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows, at = _Found(threshold, depth, total), [], None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for table, key, p, q, *row in zip(*columns, strict=True):
                if (table, key, p, q) != at:
                    if at is not None:
                        found.cell(at[0], rows)
                    rows, at = [], (table, key, p, q)
                rows.append(tuple(row))
            if len(found.links) > 1 << 16:
                yield from found.batches()
        if at is not None:
            found.cell(at[0], rows)
        yield from found.batches()

    return cells.mapInArrow(run, "a long, b long, n long")


def _pass(kinds: DataFrame, threshold: float, depth: int, tables: range, total: int) -> DataFrame:
    """Links (a, b, n) of the pairs that meet first in one of ``tables``."""
    vectors = kinds.select("id", "w", "embedding")
    # cells beyond a block are cut in blocks, and pairs of blocks compared
    crowded = staged(_cells(vectors, depth, tables, total, bare=True).groupBy("t", "key").agg(
        F.count("*").alias("g")).where(F.col("g") > _CELL).select(
        "t", "key", F.ceil(F.col("g") / _CELL).cast("int").alias("nb")), "crowded")
    own = F.pmod(F.xxhash64("id"), F.col("nb")).cast("int")
    blocks = _cells(vectors, depth, tables, total).join(small(crowded), ["t", "key"], "left").withColumn(
        "nb", F.coalesce("nb", F.lit(1))).withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    blocks = blocks.select(
        "t", "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "id", "w", "x")
    return staged(_compare(blocks.repartition("t", "key", "p", "q").sortWithinPartitions("t", "key", "p", "q"),
                           threshold, depth, total), "links")


def _usable(v: Column) -> Column:
    """Whether a vector has a direction."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(v, number) & F.exists(v, lambda x: x != 0), F.lit(False))


def near_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *,
                 threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of ``embeddings``.

    Two rows link if the cosine of their vectors, in doubles, is at least
    ``threshold``. Vectors that are null, empty, zero, or hold a null or
    non-finite component link with nothing, and vectors of different lengths
    not with each other. Rows with equal vectors link. ``component_id`` is the
    smallest id reachable by links, its own included. Rows that repeat an id
    are vectors of their own; a null id is no component's unless all its rows
    have none, and never kept. An empty table gives an empty result. Other
    columns are ignored.
    """
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"),
                             F.col(vector_col).cast("array<double>").alias("embedding"))
    rows = rows.select("vec_id", F.when(_usable(F.col("embedding")), F.col("embedding")).alias("embedding"))
    # shuffle files go when the execution that wrote them ends, and with it each pass
    embeddings.sparkSession.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    # -0.0 and 0.0 are one value here as in grouping
    kinds = staged(rows.where("embedding is not null").groupBy("embedding").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("w")).withColumn("id", F.monotonically_increasing_id()), "kinds")
    size = kinds.agg(F.count("*").alias("n"), F.sum(8 * F.size("embedding") + 24).alias("bytes")).first()
    depth, tables = shape_of(size["n"], threshold)
    each = max(1, min(tables, _PASS_BYTES // max(1, size["bytes"] or 0)))
    found = None
    for lo in range(0, tables, each):
        links = _pass(kinds, threshold, depth, range(lo, min(lo + each, tables)), tables)
        found = links if found is None else found.union(links)

    part = components(found.where("b is not null"), "a", "b").toDF("id", "part")
    count = found.where("n is not null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    kinds = kinds.join(part, "id", "left").join(count, "id", "left").withColumn("part", F.coalesce("part", "id"))
    least = kinds.groupBy("part").agg(F.min("first").alias("component_id"))
    kinds = kinds.join(least, "part").select(
        F.col("embedding").alias("kind"), (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id")
    return rows.join(kinds, F.col("embedding") == F.col("kind"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("kind").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("kind").isNull() & F.col("vec_id").isNotNull() | (F.col("vec_id") == F.col("component_id")),
                   F.lit(False)).alias("kept"))

