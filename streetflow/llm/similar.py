"""Shared steps of the near-duplicate operators: from inverted lists to links.

Ids are unique longs; ``payload`` is what a member's exact set is unpacked from
inside a task (``unpack`` gives the sorted distinct hashes of many members).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetflow.llm.graph import components, cut, staged

Unpack = Callable[[pa.Array], list[np.ndarray]]
_PAIR = "a long, b long"
#: Rows of a table of a few longs that may be broadcast.
SMALL_ROWS = 500_000
#: Elements of its lists.
SMALL_ITEMS = 2_000_000
#: Members, and members outside the largest component, of one block of a family.
_MEMBERS, _REST = 1024, 256
#: Values of a block's sets that are counted at once.
_VALUES = 1024


def small(df: DataFrame, rows: int = SMALL_ROWS, lists: str | None = None) -> DataFrame:
    """A staged table of narrow rows, marked for broadcast if it has at most
    ``rows`` of them, and its column ``lists`` at most ``SMALL_ITEMS`` elements of a few
    numbers in all; beyond that the join shuffles."""
    n = df.agg(F.count("*").alias("n"), F.sum(F.size(lists) if lists else F.lit(0)).alias("items")).first()
    return F.broadcast(df) if n["n"] <= rows and (n["items"] or 0) <= SMALL_ITEMS else df


def candidates(listed: DataFrame, percent: int, alike: Callable[[DataFrame], DataFrame], payloads: DataFrame,
               unpack: Unpack, loose: int) -> DataFrame:
    """Pairs (a, b) from inverted lists (v, id, n, p), n being the size of a set:
    enough of them that whatever alike members share a list are connected.

    Every member is paired with its list's leader, the member of least p, and
    ``alike`` filters those pairs. Where a list's members are not all connected
    then, those outside its largest part are attached to that part, and held
    against it and each other in blocks inside tasks; pairs whose payloads' sets
    share ``loose`` percent connect them.
    """
    lead = listed.groupBy("v").agg(
        F.min_by(F.struct("id", "n"), F.struct("p", F.xxhash64("id"), "id")).alias("lead"))
    stars = listed.join(lead.select("v", F.col("lead.id").alias("other"), F.col("lead.n").alias("m")), "v").where(
        f"id <> other and 100 * least(n, m) >= {percent} * greatest(n, m)").select(
        F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")).distinct()
    like = staged(alike(stars), "pairs")
    part = components(like, "a", "b").toDF("id", "part")
    members = listed.select("v", "id").join(part, "id", "left").withColumn("part", F.coalesce("part", "id"))
    main = members.groupBy("v", "part").agg(F.count("*").alias("c")).groupBy("v").agg(
        F.max(F.struct("c", "part")).alias("top"), F.sum("c").alias("g"), F.count("*").alias("parts")
    ).where("parts > 1 and g > 2").select(F.col("v").alias("list"), F.col("top.part").alias("family"))
    rest = staged(members.join(main, (F.col("v") == F.col("list")) & (F.col("part") != F.col("family"))).select(
        "family", "id", "part").distinct(), "attached")
    families = rest.select("family").distinct()
    own = families.join(part.toDF("member", "family"), "family", "left").select(
        "family", F.coalesce("member", "family").alias("id"), F.col("family").alias("part"), F.lit(False).alias("rest"))
    found = blocks(own.union(rest.withColumn("rest", F.lit(True))), payloads, unpack, loose)
    return like.union(found).distinct()


def verified(pairs: DataFrame, payloads: DataFrame, unpack: Unpack, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for sets in _sets_of(batch, unpack):
                p, q = sorted(sets, key=len)
                at = np.searchsorted(q, p)
                at[at == len(q)] = 0
                both = int((q[at] == p).sum()) if len(q) else 0
                good.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return (
        pairs.join(payloads.toDF("a", "set_a"), "a").join(payloads.toDF("b", "set_b"), "b")
        .select("a", "b", "set_a", "set_b").mapInArrow(run, _PAIR)
    )


def _sets_of(batch: pa.RecordBatch, unpack: Unpack) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for lo in range(0, batch.num_rows, 256):  # few are held at once
        yield from zip(*(unpack(batch.column(c).slice(lo, 256)) for c in (2, 3)), strict=True)


def across(members: DataFrame, payloads: DataFrame, unpack: Unpack, percent: int) -> DataFrame:
    """Links (a, b) between the parts of each family: (id, family, part) rows.
    Rows outside a family's largest part meet all its rows."""
    main = members.groupBy("family", "part").agg(F.count("*").alias("c")).groupBy("family").agg(
        F.max(F.struct("c", "part")).alias("top"), F.sum("c").alias("g"), F.count("*").alias("parts")
    ).where("parts > 1 and g > 2").select("family", F.col("top.part").alias("main"))
    return blocks(members.join(main, "family").withColumn("rest", F.expr("part <> main")), payloads, unpack, percent)


def _alike(x: list[np.ndarray], y: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether 100 * intersection >= percent * union, for each set of ``x`` (rows) and of ``y``."""
    size_x, size_y = (np.array([len(s) for s in sets]) for sets in (x, y))
    owner_x, owner_y = (np.repeat(np.arange(len(size)), size) for size in (size_x, size_y))
    values, flat_x = np.unique(np.concatenate(x), return_inverse=True)
    flat_y = np.concatenate(y)
    at = np.minimum(np.searchsorted(values, flat_y), max(len(values) - 1, 0))
    same = values[at] == flat_y if len(values) else np.zeros(len(flat_y), bool)
    flat_y, owner_y = at[same], owner_y[same]  # values of no set of x count in sizes only
    by_x, by_y = np.argsort(flat_x, kind="stable"), np.argsort(flat_y, kind="stable")
    flat_x, owner_x, flat_y, owner_y = flat_x[by_x], owner_x[by_x], flat_y[by_y], owner_y[by_y]
    both = np.zeros((len(x), len(y)), np.float32)  # whole numbers, exact up to 2**24
    for lo in range(0, len(values), _VALUES):
        (a, c), (b, d) = (np.searchsorted(flat, (lo, lo + _VALUES)) for flat in (flat_x, flat_y))
        width = min(_VALUES, len(values) - lo)
        m, n = np.zeros((len(x), width), np.float32), np.zeros((len(y), width), np.float32)
        m[owner_x[a:c], flat_x[a:c] - lo] = 1
        n[owner_y[b:d], flat_y[b:d] - lo] = 1
        both += m @ n.T
    return 100 * both.astype(np.int64) >= percent * (size_x[:, None] + size_y - both.astype(np.int64))


def blocks(members: DataFrame, payloads: DataFrame, unpack: Unpack, percent: int) -> DataFrame:
    """Links (a, b) of the members with ``rest`` with all members of their family:
    (family, id, part, rest) rows. Of the links in a block, those that connect
    its parts come out, not all.

    Families are cut in blocks of members and of ``rest``, each pair of which
    is a group of its own; small families share groups. Rows grow with the
    number of blocks, not of pairs.
    """
    shape = members.groupBy("family").agg(F.count("*").alias("g"), F.count_if("rest").alias("r")).where(
        "r > 0").select("family", F.ceil(F.col("g") / _MEMBERS).cast("int").alias("nm"),
                        F.ceil(F.col("r") / _REST).cast("int").alias("nr"))
    rows = cut(members.select("family", "id", "part", "rest").join(shape, "family"))
    shared = max(1, rows.where("nm = 1 and nr = 1").count() // _MEMBERS)
    single = (F.col("nm") == 1) & (F.col("nr") == 1)
    block = F.when(single, F.pmod(F.xxhash64("family"), F.lit(shared))).otherwise(F.xxhash64("family", "i", "j"))
    h = F.xxhash64("id")
    # role: 0 member, 1 of rest, 2 both, so that a family of one block has each row once
    whole = rows.withColumn("role", F.when(single & F.col("rest"), 2).otherwise(0)).withColumn(
        "i", F.pmod(h, "nm").cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nr") - 1)))
    rest = rows.where(F.col("rest") & ~single).withColumn("role", F.lit(1)).withColumn(
        "j", F.pmod(h, "nr").cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("nm") - 1)))
    cells = whole.unionByName(rest).join(payloads.toDF("id", "payload"), "id").select(
        block.alias("block"), "family", "i", "j", "role", "id", "part", "payload")

    def run(table: pa.Table) -> pa.Table:
        family, i, j, role, ids, part = (
            table.column(c).to_pylist() for c in ("family", "i", "j", "role", "id", "part"))
        sets = unpack(table.column("payload").combine_chunks())
        cell: dict[tuple, tuple[list, list]] = {}
        for n, at in enumerate(zip(family, i, j, strict=True)):
            members, rest = cell.setdefault(at, ([], []))
            if role[n] != 1:
                members.append(n)
            if role[n] != 0:
                rest.append(n)
        a, b = [], []
        for members, rest in cell.values():
            if not members or not rest:
                continue
            good = _alike(*([sets[n] for n in rows] for rows in (rest, members)), percent)
            parent: dict[int, int] = {}

            def root(v: int, parent: dict[int, int] = parent) -> int:
                while (up := parent.get(v, v)) != v:
                    parent[v] = parent.get(up, up)
                    v = up
                return v

            for x, y in zip(*(at.tolist() for at in np.nonzero(good)), strict=True):
                p, q = rest[x], members[y]
                u, v = root(part[p]), root(part[q])
                if u != v:
                    parent[u] = v
                    a.append(max(ids[p], ids[q]))
                    b.append(min(ids[p], ids[q]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return cells.groupBy("block").applyInArrow(run, _PAIR)
