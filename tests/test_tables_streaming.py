import datetime as dt
import json
import os

from pyspark.sql import functions as F

from helpers import d
from streetflow.plans.tables import TableStore
from streetflow.streaming.ingest import ingest


def test_range_replace_clears_empty_day(spark, tmp_store):
    old = spark.createDataFrame([(d("2024-01-01"), 1), (d("2024-01-02"), 2), (d("2024-01-03"), 3)],
                                "date_rome date, v int")
    tmp_store.overwrite("t", old, ["date_rome"])
    new = spark.createDataFrame([(d("2024-01-02"), 20)], "date_rome date, v int")
    tmp_store.replace_range("t", new, "date_rome", d("2024-01-02"), d("2024-01-03"))
    got = sorted((r.date_rome, r.v) for r in tmp_store.read("t").collect())
    assert got == [(d("2024-01-01"), 1), (d("2024-01-02"), 20)]


def test_range_replace_is_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    """Days 1 to 6; a replace of 3 to 4 fails in a task, before the pointer moves, and while it moves."""
    import pytest

    from streetflow.operators import incremental as INC

    store = TableStore(spark, str(tmp_path / "t"))
    days = spark.range(60).select("id", F.expr("date'2024-01-01' + int(id % 6)").alias("day"))
    store.overwrite("t", days, ["day"])
    span = d("2024-01-03"), d("2024-01-04")
    lost = F.when(F.col("id") == 21, F.raise_error(F.lit("lost"))).otherwise(F.col("id") + 100).alias("id")

    def per_day():
        return sorted((r["day"].day, r["n"], r["m"]) for r in store.read("t").groupBy("day").agg(
            F.count("*").alias("n"), F.max("id").alias("m")).collect())

    before = per_day()
    with pytest.raises(Exception, match="lost"):
        store.replace_range("t", days.select(lost, "day"), "day", *span)
    assert per_day() == before
    new = days.where("id < 30").select((F.col("id") + 100).alias("id"), "day")
    for name in ("commit", "_move"):
        def failing(*args, **kw):
            raise OSError("killed")
        monkeypatch.setattr(store, name, failing)
        with pytest.raises(OSError):
            store.replace_range("t", new, "day", *span)
        monkeypatch.undo()
        assert per_day() == before
    held = store.read("t")
    store.replace_range("t", new.where("day <> date'2024-01-04'"), "day", *span)
    assert per_day() == [(1, 10, 54), (2, 10, 55), (3, 5, 126), (5, 10, 58), (6, 10, 59)]
    assert held.count() == 60  # frames that read the old days go on
    done = store.days("t")
    assert done.count() == 6 and INC.islands(done, (d("2024-01-01"), d("2024-01-06"))) == []
    assert store.partitions("t", "day") == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-05", "2024-01-06"]
    # a range that loses all its rows
    store.replace_range("t", new.where("false"), "day", d("2024-01-01"), d("2024-01-06"))
    assert store.read("t").count() == 0 and store.read("t").columns == ["id", "day"] and store.days("t").count() == 6


def test_appends_are_whole_and_tables_of_a_set_move_together(spark, tmp_path, monkeypatch):
    import pytest

    store = TableStore(spark, str(tmp_path / "t"), sets={"both": ("a", "b")})
    rows = spark.range(10).select("id", F.lit("x y/é").alias("part"))
    store.append("a", rows, ["part"])
    store.append("b", rows.drop("part"))
    assert sorted(r[0] for r in store.read("a").select("part").distinct().collect()) == ["x y/é"]

    def failing(*args):
        raise OSError("killed")

    new = {"a": store.appended("a", rows, ["part"]), "b": store.appended("b", rows.drop("part"))}
    monkeypatch.setattr(store, "_move", failing)
    with pytest.raises(OSError):
        store.commit(new)
    monkeypatch.undo()
    assert (store.read("a").count(), store.read("b").count()) == (10, 10)
    store.commit(new)
    assert (store.read("a").count(), store.read("b").count()) == (20, 20)
    assert store.read("a").where("part = 'x y/é'").count() == 20
    store.append("a", rows.withColumn("part", F.lit(None).cast("string")), ["part"])
    assert store.read("a").where("part is null").count() == 10


def test_a_batch_reads_no_positions_of_landed_days(spark, tmp_path):
    """Files of the first positions are removed: another batch of that day still lands,
    since only the narrow table of snapshots is read; a snapshot that comes again needs them."""
    from streetflow.plans import daily

    raw = tmp_path / "raw"
    raw.mkdir()
    store = daily.open_store(spark, str(tmp_path / "t"))
    for k in range(3):
        (raw / f"a{k}.json").write_text(_snapshot(1711965600 + k, ["1", "2"]))
        ingest(spark, str(raw), store, str(tmp_path / "ck"))
    assert store.read(daily.BRONZE).count() == 6 and store.read(daily.LANDED).count() == 3
    reads = []
    real = store.read
    store.read = lambda name: reads.append(name) or real(name)
    (raw / "b.json").write_text(_snapshot(1711965700, ["1"]))
    ingest(spark, str(raw), store, str(tmp_path / "ck"))
    assert daily.BRONZE not in reads and daily.LANDED in reads
    (raw / "c.json").write_text(_snapshot(1711965700, ["1", "9"]))  # again, with one more vehicle
    ingest(spark, str(raw), store, str(tmp_path / "ck"))
    assert daily.BRONZE in reads
    assert real(daily.BRONZE).count() == 8 and real(daily.LANDED).count() == 4


def test_a_batch_killed_before_its_commit_lands_once(spark, tmp_path):
    import pytest

    from streetflow.plans import daily

    raw = tmp_path / "raw"
    raw.mkdir()
    store = daily.open_store(spark, str(tmp_path / "t"))
    (raw / "a.json").write_text(_snapshot(1711965600, ["1", "2"]))
    real = store._move

    def failing(pointer, text):
        raise OSError("killed")

    store._move = failing
    with pytest.raises(Exception, match="killed"):
        ingest(spark, str(raw), store, str(tmp_path / "ck"))
    assert not store.exists(daily.BRONZE) and not store.exists(daily.LANDED)
    store._move = real
    ingest(spark, str(raw), store, str(tmp_path / "ck"))
    assert store.read(daily.BRONZE).count() == 2 and store.read(daily.LANDED).count() == 1


def test_retention_and_orphans(spark, tmp_store):
    ts = spark.createDataFrame([(d("2024-01-01"), "t1", "h1"), (d("2024-01-05"), "t2", "h1"),
                                (d("2024-01-01"), "t3", "h2")], "static_date date, trip_id string, shape_hash string")
    tmp_store.overwrite("trip_shape", ts, ["static_date"])
    ss = spark.createDataFrame([("h1", 1), ("h2", 2)], "shape_hash string, way_id long")
    tmp_store.overwrite("shape_streets", ss)
    tmp_store.drop_before("trip_shape", "static_date", d("2024-01-02"))
    tmp_store.keep_referenced("shape_streets", "shape_hash", tmp_store.read("trip_shape"))
    assert [r.shape_hash for r in tmp_store.read("shape_streets").collect()] == ["h1"]


def test_keyed_replace_is_idempotent(spark, tmp_store):
    tmp_store.overwrite("s", spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"))
    new = spark.createDataFrame([("b", 20), ("c", 3)], "k string, v int")
    for _ in range(2):
        tmp_store.replace_keys("s", new, new, "k")
    assert sorted(tuple(r) for r in tmp_store.read("s").collect()) == [("a", 1), ("b", 20), ("c", 3)]
    # a key that was worked on and has no row any more goes too
    tmp_store.replace_keys("s", new.where("false"), new.where("k = 'c'"), "k")
    assert sorted(tuple(r) for r in tmp_store.read("s").collect()) == [("a", 1), ("b", 20)]


def _files(folder):
    return {str(p) for p in folder.rglob("part-*")}


def test_failed_write_keeps_the_published_table(spark, tmp_path):
    """A task failure in the middle of a publish leaves the old table, and the gate sees it."""
    import pytest

    from streetflow.operators import quality as QC

    store = TableStore(spark, str(tmp_path / "t"))
    streets = spark.range(100).select(F.col("id").alias("way_id"))
    store.overwrite("street_speed", streets)
    bad = spark.range(100).select(F.when(F.col("id") == 57, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("way_id"))
    with pytest.raises(Exception, match="lost"):
        store.overwrite("street_speed", bad)
    assert store.read("street_speed").count() == 100
    gate = QC.street_retention(spark.range(1).select(F.col("id").alias("way_id")), store.read("street_speed")).first()
    assert gate["passed"] is False
    # killed between the write and the move of the pointer: the same, and the next write cleans up
    store.write_version("street_speed", streets.where("way_id < 3"))
    assert store.read("street_speed").count() == 100
    held = store.read("street_speed")
    store.overwrite("street_speed", held.where("way_id < 50"))  # may read what it replaces
    assert store.read("street_speed").count() == 50 and held.count() == 100
    # leftovers of the failed and the killed write go once they are old, and what the last commit replaced stays
    folder = tmp_path / "t" / "street_speed"
    store.vacuum("street_speed")
    assert len(list(folder.iterdir())) > 2
    store.vacuum("street_speed", dt.timedelta(0))
    assert len(list(folder.iterdir())) == 2 and held.count() == 100


def test_existence_does_not_hang_on_success_markers(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    store.overwrite("a", spark.range(3))
    for p in (tmp_path / "t").rglob("*_SUCCESS*"):
        p.unlink()
    assert store.exists("a") and store.read("a").count() == 3 and not store.exists("b")


def test_partitioned_writes_keep_few_files_a_day(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    rows = spark.range(0, 20000, 1, 16).select("id", F.expr("date'2024-01-01' + int(id % 10)").alias("day"))
    store.overwrite("a", rows, ["day"])
    per_day = [len(list(p.glob("part-*"))) for p in (tmp_path / "t").rglob("day=*")]
    assert len(per_day) == 10 and max(per_day) <= 2, per_day


def _snapshot(ts, entities):
    return json.dumps({"header": {"timestamp": ts}, "entity": [
        {"id": e, "vehicle": {"trip": {"trip_id": "T1", "route_id": "R1"}, "vehicle": {"id": "V" + e},
                              "position": {"latitude": 41.9, "longitude": 12.5}, "timestamp": ts - 5}}
        for e in entities]})


def test_stream_reads_only_new_files(spark, tmp_path):
    raw = tmp_path / "raw" / "date=2024-04-01" / "hour=10"
    raw.mkdir(parents=True)
    store = TableStore(spark, str(tmp_path / "tables"))
    ck = str(tmp_path / "ck")
    (raw / "a.json").write_text(_snapshot(1711965600, ["1", "2"]))
    (raw / "junk.json").write_text("{not json")
    (raw / "empty.json").write_text(json.dumps({"header": {"timestamp": 1711965620}, "entity": []}))
    ingest(spark, str(tmp_path / "raw"), store, ck, timeout_s=300)
    assert store.read("bronze_positions").count() == 2
    reasons = sorted(r.reason for r in store.read("bronze_rejects").collect())
    assert reasons == ["malformed", "no vehicles"]
    # second pass: one new file, and a second copy of an already landed snapshot
    (raw / "b.json").write_text(_snapshot(1711965640, ["3"]))
    (raw / "a_copy.json").write_text(_snapshot(1711965600, ["1", "2"]))
    ingest(spark, str(tmp_path / "raw"), store, ck, timeout_s=300)
    b = store.read("bronze_positions")
    assert b.count() == 3
    assert b.where(F.col("date") == F.lit(dt.date(2024, 4, 1))).count() == 3


def test_ingest_loses_nothing(spark, tmp_path):
    """Missing ids and header times, an indented file, bad bytes, repeated snapshots, a replayed batch."""
    raw = tmp_path / "raw"
    raw.mkdir()
    store = TableStore(spark, str(tmp_path / "tables"))
    anonymous = json.loads(_snapshot(1711965600, ["1", "2", "3", "4", "5"]))
    for e in anonymous["entity"]:
        del e["id"]
    (raw / "anonymous.json").write_text(json.dumps(anonymous))
    for i in range(4):  # no header time: the newest vehicle's counts
        m = json.loads(_snapshot(1711965700 + i, [f"h{i}"]))
        del m["header"]["timestamp"]
        (raw / f"headless{i}.json").write_text(json.dumps(m))
    (raw / "indented.json").write_text(json.dumps(json.loads(_snapshot(1711965800, ["a", "b"])), indent=2))
    timeless = json.loads(_snapshot(1711965900, ["t"]))
    del timeless["header"]["timestamp"], timeless["entity"][0]["vehicle"]["timestamp"]
    (raw / "timeless.json").write_text(json.dumps(timeless))
    (raw / "bytes.json").write_bytes(b"\xff\xfe{}\x80")
    (raw / "blank.json").write_text("\n  \n")
    strict = TableStore(spark, str(tmp_path / "strict"))
    ingest(spark, str(raw), strict, str(tmp_path / "ck0"))  # header times only
    assert strict.read("bronze_positions").count() == 5 + 2
    assert strict.read("bronze_rejects").where("reason = 'no time'").count() == 5
    land = lambda ck: ingest(spark, str(raw), store, str(tmp_path / ck), on_missing_header="max")
    land("ck")
    b = store.read("bronze_positions")
    assert b.count() == 5 + 4 + 2 and b.where("feed_timestamp is null or date is null").count() == 0
    reasons = sorted(tuple(r) for r in store.read("bronze_rejects").selectExpr(
        "element_at(split(source_file, '/'), -1)", "reason").collect())
    assert reasons == [("bytes.json", "malformed"), ("timeless.json", "no time")]
    # the same again under other names, and the whole stream replayed from its start
    (raw / "anonymous_copy.json").write_text(json.dumps(anonymous))
    land("ck")
    land("ck2")
    assert store.read("bronze_positions").count() == 11
    assert store.read("bronze_rejects").count() == 2


def test_first_delivered_wins(spark):
    from streetflow.operators.positions import land_if_absent

    rows = spark.createDataFrame([(2, "late", "e", 10, "b"), (1, "early", "e", 10, "z"), (3, "n", None, 10, "c"),
                                  (3, "n", None, 10, "c"), (4, "m", None, 10, "d"), (5, "x", "e", None, "q"),
                                  (5, "x", "e", None, "q")],
                                 "delivered int, v string, entity_id string, feed_timestamp int, source_file string")
    got = sorted(r.v for r in land_if_absent(rows, None).collect())
    assert got == ["early", "n", "n", "x", "x"]
    landed = spark.createDataFrame([(10, None)], "feed_timestamp int, entity_id string")
    assert sorted(r.v for r in land_if_absent(rows, landed).collect()) == ["early", "x", "x"]
    # one release per day (SRC7): the key is the day alone
    rel = spark.createDataFrame([(d("2024-01-01"), "b"), (d("2024-01-01"), "a"), (d("2024-01-02"), "c")],
                                "static_date date, source_file string")
    got = land_if_absent(rel, rel.where("source_file = 'c'"), ["static_date"]).collect()
    assert [r.source_file for r in got] == ["a"]


def test_decoder_errors_go_to_rejects(spark, tmp_path):
    from streetflow.sources import snapshots as SN

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "good.bin").write_bytes(b"e1,1711965600")
    (raw / "bad.bin").write_bytes(b"\xff")
    (raw / "none.bin").write_bytes(b"\n")

    def codec(content):
        for line in content.decode().split():
            eid, ts = line.split(",")
            yield {"entity_id": eid, "vehicle_id": "v", "vehicle_timestamp": int(ts)}

    store = TableStore(spark, str(tmp_path / "t"))
    ingest(spark, str(raw), store, str(tmp_path / "ck"), glob="*.bin", decoder=lambda f: SN.decode_with(f, codec, "max"))
    row = store.read("bronze_positions").first()
    assert (row.entity_id, row.feed_timestamp.timestamp()) == ("e1", 1711965600)
    assert sorted(r.reason for r in store.read("bronze_rejects").collect()) == [
        "malformed: UnicodeDecodeError", "no vehicles"]


def test_release_scan_prunes_content(spark, tmp_path):
    import io
    import zipfile

    from streetflow.sources import schedule_files as SF

    for day, trips in (("2024-01-01", "t1,S1\nt2,\n"), ("2024-01-02", "t3,S2\n")):
        p = tmp_path / "static" / f"date={day}"
        p.mkdir(parents=True)
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            z.writestr("trips.txt", "﻿trip_id,shape_id\n" + trips)
            z.writestr("shapes.txt", "﻿shape_id,shape_pt_sequence,shape_pt_lat,shape_pt_lon\nS1,1,41.9,12.5\n")
        (p / "release.zip").write_bytes(buf.getvalue())
    rel = SF.scan_releases(spark, str(tmp_path / "static"))
    sizes = SF.release_sizes(rel)
    plan = sizes._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]
    assert sorted(r.trip_id for r in SF.decode_trips(rel).collect()) == ["t1", "t3"]
    assert [r.seq for r in SF.decode_shapes(rel).collect()] == [1, 1]
    assert os.path.exists(tmp_path / "static")


def test_pluggable_decoder_runs_in_arrow_batches(spark, tmp_path):
    """A per-file Python codec (here: a toy 'id;vehicle;lat;lon;ts' text format)."""
    from streetflow import schemas
    from streetflow.sources import snapshots as SN

    p = tmp_path / "snap.bin"
    p.write_bytes(b"e1;V1;41.9;12.5;1711965600\ne2;V2;41.91;12.51;1711965601\n")
    files = spark.read.format("binaryFile").schema(schemas.BINARY_FILE).load(str(p))

    def codec(content):
        for line in content.decode().splitlines():
            eid, vid, lat, lon, ts = line.split(";")
            yield {"entity_id": eid, "vehicle_id": vid, "latitude": float(lat), "longitude": float(lon),
                   "vehicle_timestamp": int(ts), "feed_timestamp": int(ts)}

    rows = SN.to_bronze(SN.decode_with(files, codec)).orderBy("entity_id").collect()
    assert [(r.vehicle_id, r.latitude) for r in rows] == [("V1", 41.9), ("V2", 41.91)]
    assert rows[0].date == dt.date(2024, 4, 1)


def test_all_partitions_retired_reads_empty(spark, tmp_path):
    from streetflow.plans import daily

    store = daily.open_store(spark, str(tmp_path / "t"))
    assert not store.exists(daily.SEGMENTS)
    one = spark.createDataFrame([("V1", d("2024-01-01"))], "vehicle_id string, date_rome date")
    seg = spark.createDataFrame([], daily.table_schemas()[daily.SEGMENTS]).unionByName(one, allowMissingColumns=True)
    store.overwrite(daily.SEGMENTS, seg, ["date_rome"])
    assert store.read(daily.SEGMENTS).count() == 1
    store.drop_before(daily.SEGMENTS, "date_rome", d("2024-02-01"))
    assert store.exists(daily.SEGMENTS)
    empty = store.read(daily.SEGMENTS)
    assert empty.count() == 0 and "date_rome" in empty.columns


def test_scratch_goes_under_the_session_checkpoint_dir(spark):
    from streetflow.session import checkpoint_dir, scratch_dir

    base = spark.sparkContext.getCheckpointDir()
    assert base and checkpoint_dir(spark) == base
    assert scratch_dir(spark, "x").startswith(base.rstrip("/") + "/x-")


def test_decoder_holds_a_chunk_of_a_file(monkeypatch):
    """Of 5,000 entities of a file, never more than two chunks are alive; a file that goes
    bad at its end, or lacks a time, gives its reject alone."""
    from streetflow import schemas
    from streetflow.sources import snapshots as SN

    alive, most = [0], [0]

    class Entity(dict):
        def __init__(self, **kw):
            super().__init__(**kw)
            alive[0] += 1
            most[0] = max(most[0], alive[0])

        def __del__(self):
            alive[0] -= 1

    def codec(content):
        for i in range(5000):
            yield Entity(feed_timestamp=None if content == b"late" and i == 4999 else 1000, vehicle_timestamp=i,
                         entity_id=f"e{i}")
        if content == b"bad":
            raise ValueError

    monkeypatch.setattr(SN, "_CHUNK", 100)
    monkeypatch.setattr(SN, "_SPOOL", 1000)
    names = [f.name for f in schemas.SNAPSHOT_ENTITY.fields]
    of = lambda content, rule="null": [r for rows in SN._decoded(content, codec, names, rule) for r in rows]
    good = of(b"good")
    assert [r[names.index("entity_id")] for r in good] == [f"e{i}" for i in range(5000)]
    assert {r[-1] for r in good} == {None} and most[0] <= 200
    assert [r[-1] for r in of(b"bad")] == ["malformed: ValueError"]
    assert [r[-1] for r in of(b"late")] == ["no time"]
    assert of(b"late", "max")[-1][names.index("feed_timestamp")] == 4999
