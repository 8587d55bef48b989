"""Connected components by joins, and staging in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetflow.session import checkpoint_dir, scratch_dir


def staged(df: DataFrame, name: str, partition_by: list[str] | None = None, **options: str | int) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared checkpoint folder:
    computed once, with its lineage cut, and readable from every executor.
    ``options`` are the writer's."""
    path = scratch_dir(df.sparkSession, name)
    df.write.options(**({"compression": "zstd"} | options)).parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _stars(e: DataFrame) -> bool:
    """Whether every node a has one edge (a, b), and no b is an a."""
    ends = e.select(F.col("a").alias("n"), F.lit(1).alias("x"), F.lit(0).alias("y")).union(
        e.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("n").agg(F.sum("x").alias("x"), F.max("y").alias("y")).where("x > 1 or x + y > 1").isEmpty()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every node of an undirected edge list, the
    component being the smallest node reachable.

    Alternating large-star and small-star steps over (node, smaller neighbour)
    edges; each step is a grouped minimum and a join on the node, so a hub's
    edges are never gathered in one group. Rounds grow with the logarithm of
    the longest path. Null ends and loops are ignored; no edges give no rows.
    """
    u_, v_ = F.col(u), F.col(v)
    e = cut(
        edges.where(u_.isNotNull() & v_.isNotNull() & (u_ != v_))
        .select(F.greatest(u_, v_).alias("a"), F.least(u_, v_).alias("b"))
        .distinct()
    )
    while not _stars(e):
        # large star: every larger neighbour of a node moves to the node's least neighbour
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e1 = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: every smaller neighbour of a node, and the node, move to the least of them
        low1 = e1.groupBy("a").agg(F.min("b").alias("m"))
        moved = e1.join(low1, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = cut(moved.union(low1.select("a", F.col("m").alias("b"))).distinct())
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def sample_by_hash(df: DataFrame, key: str, n: int) -> DataFrame:
    """At most ``n`` rows, those of least hash of ``key``. Rows are cut down where
    they are read, so that tasks do not each send ``n`` rows to be merged."""
    place, span = F.pmod(F.xxhash64(key), F.lit(1 << 30)), 1 << 30
    total = df.count()
    if total > n:
        df = df.where(place < int(span * min(1.0, 1.2 * n / total)))
    return df.orderBy(place, key).limit(n)
