import random
import zlib
from collections import Counter

from helpers_llm import clashing, docs_of
from pyspark.sql import functions as F

from streetflow.llm import hash_ring
from streetflow.llm.queries import sharding


def walked(ring, rows, room):
    """Rows (cell, values), one after the other in the order of arrival, each clockwise to the first shard with room."""
    free, slots, out = list(room), Counter(), []
    for cell, values in sorted(rows, key=lambda r: (r[0], [(v is not None, v) for v in r[1]])):
        shard = next(s for s in ring.clockwise[cell % len(ring.points)] if free[s])
        free[shard] -= 1
        out.append((*values, shard, slots[shard]))
        slots[shard] += 1
    return out


def some_docs(n=400, seed=3):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "bé", "", None, f"text {i}", "long " * 50])) for i in range(n)]
    return rows + [(7, "again")] * 90 + [(7, f"other {i}") for i in range(60)] + [(None, "no id"), (None, None), (None, None)]


def test_equals_a_walk_row_by_row(spark):
    for shards, virtual, turns, rows in ((8, 16, 8, some_docs()), (3, 2, 1, some_docs(40)), (5, 4, 4, [(1, "x")] * 3),
                                         (1, 3, 2, some_docs(9)), (8, 16, 8, [])):
        ring = hash_ring.Ring(shards, virtual, turns)
        docs = clashing(docs_of(spark, rows))
        got = [tuple(r) for r in hash_ring.assign(docs, ring).select("doc_id", "size", "text_crc32", "shard", "slot").collect()]
        cell = hash_ring._cell(ring, F.col("doc_id"), [F.col("crc"), F.col("size")])
        text = F.coalesce("text", F.lit(""))
        placed = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                             F.crc32(text.cast("binary")).alias("crc")).withColumn("cell", cell).collect()
        n = len(rows)
        room = [n // shards + (s < n % shards) for s in range(shards)]
        expected = walked(ring, [(r["cell"], (r["doc_id"], r["size"], r["crc"])) for r in placed], room)
        key = lambda r: [(v is not None, v) for v in r]
        assert sorted(got, key=key) == sorted(expected, key=key)


def test_sizes_checksums_and_law(spark):
    rows = some_docs()
    got = sharding(docs_of(spark, rows)).collect()
    sums = lambda x: Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in x)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sums(rows)
    count = Counter(r["shard"] for r in got)
    assert set(count) == set(range(8)) and max(count.values()) - min(count.values()) <= 1
    for s in count:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(count[s]))
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}


def test_few_rows_move(spark):
    """Most rows stay where their key's place alone puts them; a ninth shard takes
    about its share, and others hardly exchange rows."""
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    eight = hash_ring.assign(docs, hash_ring.Ring(8))
    assert eight.where("shard = first_shard").count() > 0.85 * 20000
    nine = hash_ring.assign(docs, hash_ring.Ring(9)).select("doc_id", F.col("shard").alias("then"))
    moved = eight.join(nine, "doc_id").where("shard <> then")
    assert moved.where("then < 8").count() < 0.25 * 20000
    free = hash_ring.assign(docs, hash_ring.Ring(8), slack=0.5)
    assert free.where("shard = first_shard").count() == 20000


def test_a_key_with_a_third_of_the_rows(spark, monkeypatch):
    """One row a hundred thousand times: counted once, put out by several tasks."""
    monkeypatch.setattr(hash_ring, "_CHUNK", 1 << 14)
    same = spark.range(100_000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("copy").alias("text"))
    docs = same.union(spark.range(200_000).select("id", F.concat(F.lit("t"), F.col("id")).alias("text")))
    got = hash_ring.assign(docs, hash_ring.Ring(8))
    count = got.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m")).collect()
    assert sorted(r["n"] for r in count) == [37500] * 8
    assert all(r["d"] == r["n"] and r["m"] == r["n"] - 1 for r in count)


def test_files_and_kept_columns(spark, tmp_path):
    rows = some_docs(50)
    out = str(tmp_path / "shards")
    hash_ring.write_shards(hash_ring.assign(docs_of(spark, rows), hash_ring.Ring(4), keep=("text", "source")), out)
    read = spark.read.parquet(out)
    assert Counter((r["doc_id"], r["text"]) for r in read.collect()) == Counter(rows)
    assert read.select("shard").distinct().count() == 4
