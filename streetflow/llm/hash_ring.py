"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands on the ring at several points (virtual nodes). A row goes to
the first shard clockwise of its key's place; where that shard is full, it goes
on clockwise to the next that is not. Shards hold equal numbers of rows, so
balance is guaranteed, and only what overflows leaves its first shard.

Rows arrive in a fixed order: by turn (a hash), then by arc of the ring, then by
their values. Rows of one turn and arc, a cell, share their clockwise order of
shards, so the counts of the cells (their number is fixed by the ring) tell at
which row each shard fills up; every row's shard and slot follow from its rank in its
cell. All of it is DataFrame and SQL functions.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetflow.llm.graph import staged

#: Bits of a rank inside a cell: the time of a row is its cell's number followed by its rank.
_RANK_BITS = 40
_NEVER = 1 << 62
#: Copies of a row that one task puts out.
_CHUNK = 1 << 20


@dataclass(frozen=True)
class Ring:
    """Places of the shards; a parameter, the same for all data.

    ``virtual`` nodes a shard; ``turns`` is the number of steps in which rows
    arrive. At most 1,024 shards (the order of shards from every arc is a
    constant of the plan)."""

    shards: int
    virtual: int = 64
    turns: int = 32

    def __post_init__(self) -> None:
        if not 1 <= self.shards <= 1024 or self.virtual < 1 or self.turns < 1:
            raise ValueError("1 to 1,024 shards, at least one virtual node and one turn")

    @cached_property
    def bits(self) -> int:
        """The ring has 2**bits places, about eight for each virtual node."""
        return max(4, (8 * self.shards * self.virtual - 1).bit_length())

    @cached_property
    def points(self) -> list[tuple[int, int]]:
        """Sorted (place, shard). Of shards that meet at a place the lowest stays;
        one that stays nowhere gets the next free place of its first node."""
        size, held = 1 << self.bits, {}

        def place(shard: int, node: int) -> int:
            digest = hashlib.md5(f"{shard}/{node}".encode()).digest()
            return int.from_bytes(digest[:8], "big") >> (64 - self.bits)  # first bits: a finer ring keeps the places

        for shard in range(self.shards):
            for node in range(self.virtual):
                held.setdefault(place(shard, node), shard)
        for shard in set(range(self.shards)).difference(held.values()):
            at = place(shard, 0)
            while at in held:
                at = (at + 1) % size
            held[at] = shard
        return sorted(held.items())

    @cached_property
    def arc_of(self) -> list[int]:
        """The arc, that is the index of the first point clockwise, of every place."""
        out, k = [], 0
        for at in range(1 << self.bits):
            while k < len(self.points) and self.points[k][0] < at:
                k += 1
            out.append(k % len(self.points))
        return out

    @cached_property
    def clockwise(self) -> list[list[int]]:
        """From every arc on, the shards in the order in which they are met."""
        own = [shard for _, shard in self.points]
        return [list(dict.fromkeys(own[k:] + own[:k])) for k in range(len(own))]


def _array(values: list) -> str:
    return "array(" + ",".join(_array(v) if isinstance(v, list) else f"{v}" for v in values) + ")"


def _cell(ring: Ring, key: Column, rest: list[Column]) -> Column:
    arc = F.get(F.expr(_array(ring.arc_of)), F.shiftrightunsigned(F.xxhash64(key), 64 - ring.bits).cast("int"))
    return F.pmod(F.xxhash64(F.lit("turn"), key, *rest), F.lit(ring.turns)) * len(ring.points) + arc


def _fill_times(ring: Ring, cells: DataFrame, slack: float) -> list[int]:
    """For every shard the time of the last row that it takes. ``cells``: (cell, n),
    a row for each cell. One fold over the cells in their order."""
    arcs, shards = len(ring.points), ring.shards
    room = (f"total div {shards} + if(s < total % {shards}, 1, 0)" if slack == 0
            else f"cast(ceil({1 + slack} * total / {shards}) as bigint)")
    fold = f"""
        aggregate(cells, named_struct('free', free, 'full', transform(free, f -> if(f = 0, -1L, {_NEVER}L))),
          (state, c) -> aggregate(
            get({_array(ring.clockwise)}, cast(c.cell % {arcs} as int)),
            named_struct('rest', c.n, 'free', state.free, 'full', state.full),
            (x, s) -> if(x.rest = 0 or get(x.free, s) = 0, x, named_struct(
              'rest', x.rest - least(x.rest, get(x.free, s)),
              'free', transform(x.free, (f, i) -> if(i = s, f - least(x.rest, f), f)),
              'full', transform(x.full, (f, i) -> if(i = s and get(x.free, s) <= x.rest,
                 shiftleft(c.cell, {_RANK_BITS}) + c.n - x.rest + get(x.free, s), f)))),
            x -> named_struct('free', x.free, 'full', x.full)),
          state -> state.full)"""
    return cells.agg(F.array_sort(F.collect_list(F.struct("cell", "n"))).alias("cells"), F.sum("n").alias("total")).select(
        "cells", F.expr(f"transform(sequence(0L, {shards - 1}L), s -> coalesce({room}, 0L))").alias("free")
    ).select(F.expr(fold)).first()[0]


def _ranges(ring: Ring, cells: DataFrame, full: list[int]) -> DataFrame:
    """(cell, start, stop, shard, slot): the ranks start to stop - 1 of a cell go to
    a shard, the first of them to that slot."""
    # at time t a shard is full if its own is less: so it takes the ranks up to ``upto``, less those taken before it
    upto = F.least("n", F.greatest(F.lit(0), F.get(F.expr(_array([f"{t}L" for t in full])), "shard")
                                   - F.shiftleft("cell", _RANK_BITS)))
    before = Window.partitionBy("cell").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    of_shard = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    order = F.get(F.expr(_array(ring.clockwise)), (F.col("cell") % len(ring.points)).cast("int"))
    return (
        cells.select("cell", "n", F.posexplode(order).alias("pos", "shard")).withColumn("upto", upto)
        .withColumn("start", F.coalesce(F.max("upto").over(before), F.lit(0)).cast("long"))
        .withColumn("stop", F.greatest("upto", "start")).where("stop > start")
        .select("cell", "start", "stop", "shard",
                F.coalesce(F.sum(F.col("stop") - F.col("start")).over(of_shard), F.lit(0)).cast("long").alias("slot"))
    )


def assign(docs: DataFrame, ring: Ring, keep: tuple[str, ...] = (), slack: float = 0.0, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, *keep, first_shard, shard, slot): one row for each row of ``docs``.

    ``slack`` 0 lets shards differ by one row at most; with more, each holds up to
    (1 + slack) times its share and fewer rows move when rows or shards come or go.
    ``size`` is the text's bytes and one; ``first_shard`` the shard that the key's
    place alone tells; slots count each shard's rows from 0 without gaps.

    A null text counts as empty, null ids are one key. Rows that repeat in all of
    these columns are interchangeable and are counted before they are dealt, so a
    key or text of a third of all rows is no large group anywhere; rows of one key
    and other texts arrive in different turns. ``keep`` names further columns to
    carry, of types that can be grouped and sorted. An empty table gives none.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                      F.crc32(text.cast("binary")).alias("text_crc32"),
                      *[F.col(f"`{c}`").alias(f"k_{i}") for i, c in enumerate(keep)])
    values = own.columns
    groups = staged(own.groupBy(*values).agg(F.count("*").alias("n")).withColumn(
        "cell", _cell(ring, F.col("doc_id"), [F.col("text_crc32"), F.col("size")]).cast("long")), "ring-groups")
    counts = staged(groups.groupBy("cell").agg(F.sum("n").alias("n"), F.max("n").alias("most")), "ring-cells")
    cells = counts.select("cell", "n")
    ranges = _ranges(ring, cells, _fill_times(ring, cells, slack))
    ranked = Window.partitionBy("cell").orderBy(*values).rowsBetween(Window.unboundedPreceding, -1)
    # not more ranges than cells and shards
    pieces = groups.withColumn("at", F.coalesce(F.sum("n").over(ranked), F.lit(0)).cast("long")).join(
        F.broadcast(ranges), "cell").where("at < stop and at + n > start").withColumn(
        "from", F.greatest("at", "start")).withColumn("n", F.least(F.expr("at + n"), "stop") - F.col("from")).withColumn(
        "slot", F.expr("slot + from - start"))
    if not counts.where(F.col("most") > _CHUNK).isEmpty():  # copies without number: many tasks put them out
        pieces = pieces.withColumn("part", F.explode(F.expr(f"sequence(0L, n - 1, {_CHUNK}L)"))).withColumn(
            "slot", F.expr("slot + part")).withColumn("n", F.least(F.expr("n - part"), F.lit(_CHUNK))).repartition(
            "shard", "slot")
    first = F.get(F.expr(_array([shard for _, shard in ring.points])), (F.col("cell") % len(ring.points)).cast("int"))
    return pieces.select(
        "doc_id", "size", "text_crc32", *[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)], first.alias("first_shard"),
        "shard", F.explode(F.expr("sequence(slot, slot + n - 1)")).alias("slot"))


def write_shards(assigned: DataFrame, path: str) -> None:
    """Files of ``assigned`` in a folder for each shard, rows by slot inside a file;
    AQE splits a large shard into several files."""
    assigned.hint("rebalance", "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
