"""The daily job: increment by day gives the full rebuild; re-running is a no-op."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from streetflow.plans import daily
from streetflow.plans import views as V
from streetflow.plans.tables import TableStore
from streetflow.schemas import SEGMENT_STREETS
from streetflow.sources import fixtures as fx
from streetflow.sources import snapshots as SN

SF = "/root/testdata/sf0.001"
SF_DIR = SF


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _inputs(spark):
    return V.release_files(spark, SF), fx.shapes(spark, SF), fx.trips(spark, SF)


def _run(spark, store, today, releases_until=None):
    rel, pts, trp = _inputs(spark)
    if releases_until is not None:
        rel = rel.where(F.col("static_date") <= F.lit(releases_until))
    daily.segments_job(store, today)
    daily.lines_job(store, rel, pts, trp, today)
    daily.segment_streets_job(store, today)


def test_increment_equals_rebuild(spark, tmp_path):
    full = TableStore(spark, str(tmp_path / "full"))
    inc = TableStore(spark, str(tmp_path / "inc"))
    for st in (full, inc):
        st.create_schema()
        st.overwrite(daily.BRONZE, fx.positions(spark, SF), ["date"])
        daily.load_streets(st, fx.ways(spark, SF))
    _run(spark, full, dt.date(2024, 4, 6))
    _run(spark, inc, dt.date(2024, 3, 30), releases_until=dt.date(2024, 3, 30))
    assert inc.read(daily.SEGMENTS).agg(F.max("date_rome")).first()[0] == dt.date(2024, 3, 29)
    _run(spark, inc, dt.date(2024, 4, 6))
    cols = ["vehicle_id", "to_ts", "speed_kmh", "date_rome"]
    assert _rows(inc.read(daily.SEGMENTS).select(*cols)) == _rows(full.read(daily.SEGMENTS).select(*cols))
    cols = ["vehicle_id", "date_rome", "hour_rome", "way_id", "speed_kmh", "snap_m"]
    a, b = inc.read(daily.SEGMENT_STREETS).select(*cols), full.read(daily.SEGMENT_STREETS).select(*cols)
    assert a.count() > 0 and _rows(a) == _rows(b)
    # a second run on the same day changes nothing
    _run(spark, inc, dt.date(2024, 4, 6))
    assert _rows(inc.read(daily.SEGMENT_STREETS).select(*cols)) == _rows(b)


def test_bronze_job_lands_and_checks_freshness(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "t"))
    store.create_schema()
    raw = str(tmp_path / "raw")
    SN.snapshot_messages(fx.positions(spark, SF)).write.partitionBy("date", "hour").text(raw)
    newest = fx.positions(spark, SF).agg(F.max("feed_timestamp")).first()[0]
    daily.bronze_job(spark, store, raw, newest + dt.timedelta(minutes=30), glob="*.txt")
    assert store.read(daily.BRONZE).count() == fx.positions(spark, SF).count()
    with pytest.raises(AssertionError):
        daily.bronze_job(spark, store, raw, newest + dt.timedelta(hours=3), glob="*.txt")
    # nothing new on the second pass
    assert store.read(daily.BRONZE).count() == fx.positions(spark, SF).count()


def test_lines_from_release_files(spark, tmp_path):
    """Release zips on disk -> the same line matches and trip geometries as the decoded tables."""
    from streetflow.sources import schedule_files as SF

    static = tmp_path / "static"
    for r in SF.pack_releases(fx.shapes(spark, SF_DIR), fx.trips(spark, SF_DIR)).collect():  # test setup only
        d = static / f"date={r.static_date.isoformat()}"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"part-{r.part}.zip").write_bytes(bytes(r.content))
    a = TableStore(spark, str(tmp_path / "a"))
    b = TableStore(spark, str(tmp_path / "b"))
    for st in (a, b):
        st.create_schema()
        daily.load_streets(st, fx.ways(spark, SF_DIR))
    rel, pts, trp = _inputs(spark)
    daily.lines_job(a, rel, pts, trp, dt.date(2024, 4, 6))
    new = daily.lines_job_from_files(spark, b, str(static), dt.date(2024, 4, 6))
    assert len(new) == 5
    cols = ["static_date", "trip_id", "shape_id", "shape_hash"]
    assert _rows(a.read(daily.TRIP_SHAPE).select(*cols)) == _rows(b.read(daily.TRIP_SHAPE).select(*cols))
    cols = ["shape_hash", "way_id", "points", "span_m"]
    assert _rows(a.read(daily.SHAPE_STREETS).select(*cols)) == _rows(b.read(daily.SHAPE_STREETS).select(*cols))


def test_one_release_a_day(spark, tmp_path):
    """All files that first deliver a day's release land; a later delivery changes nothing."""
    store = daily.open_store(spark, str(tmp_path / "t"))
    schema = "static_date date, length long, content binary"
    day1, day2 = dt.date(2024, 4, 1), dt.date(2024, 4, 2)
    daily.land_releases(store, spark.createDataFrame([(day1, 2, b"ab"), (day1, 1, b"c")], schema))
    daily.land_releases(store, spark.createDataFrame([(day1, 3, b"xyz"), (day2, 1, b"d")], schema))
    before = store.entry(daily.RELEASES)
    got = daily.land_releases(store, spark.createDataFrame([(day2, 2, b"zz")], schema))
    assert sorted((r.static_date, bytes(r.content)) for r in got.collect()) == [(day1, b"ab"), (day1, b"c"), (day2, b"d")]
    assert store.entry(daily.RELEASES) == before
    empty = daily.open_store(spark, str(tmp_path / "e"))
    assert daily.land_releases(empty, spark.createDataFrame([], schema)).count() == 0


def test_street_extract_reader(spark, tmp_path):
    import json

    elements = [
        {"type": "way", "id": 7, "tags": {"highway": "primary", "name": "A"},
         "geometry": [{"lat": 41.9, "lon": 12.5}, {"lat": 41.91, "lon": 12.5}]},
        {"type": "node", "id": 8, "lat": 1.0, "lon": 2.0},
        {"type": "way", "id": 9, "tags": {"highway": "primary"}},
        {"type": "way", "id": 10, "geometry": [{"lat": 41.9, "lon": 12.5}]},
    ]
    (tmp_path / "tile").mkdir()
    (tmp_path / "a.json").write_text(json.dumps({"elements": elements}, indent=1))
    (tmp_path / "tile" / "b.json").write_text(json.dumps({"elements": elements[:1]}))
    from streetflow.operators import streets as ST
    from streetflow.sources.street_extracts import read_ways

    ways = read_ways(spark, str(tmp_path))
    assert sorted(r.way_id for r in ways.collect()) == [7, 7, 10]
    assert [(r.way_id, r.tags["name"]) for r in ST.select_ways(ways).collect()] == [(7, "A")]


def test_empty_street_source_leaves_the_table(spark, tmp_path):
    store = daily.open_store(spark, str(tmp_path / "t"))
    store.create_schema()
    daily.load_streets(store, fx.ways(spark, SF))
    before = store.read(daily.EDGES).count()
    with pytest.raises(Exception, match="street ways"):
        daily.load_streets(store, fx.ways(spark, SF).where("false"))
    assert store.read(daily.EDGES).count() == before > 0


def test_one_run_from_raw_files_to_export(spark, tmp_path):
    """Snapshots, release zips and a street extract on disk, through to the export and the report;
    a second run rewrites no line match and opens no zip."""
    from streetflow.sources import schedule_files as SF_

    raw, static, ways = str(tmp_path / "raw"), tmp_path / "static", str(tmp_path / "ways")
    SN.snapshot_messages(fx.positions(spark, SF)).write.partitionBy("date", "hour").text(raw)
    for r in SF_.pack_releases(fx.shapes(spark, SF), fx.trips(spark, SF)).collect():  # test setup only
        folder = static / f"date={r.static_date.isoformat()}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"part-{r.part}.zip").write_bytes(bytes(r.content))
    elements = fx.ways(spark, SF).selectExpr(
        "to_json(named_struct('type', 'way', 'id', way_id, 'tags', tags, 'geometry', geometry)) as e").collect()
    (tmp_path / "ways").mkdir()
    (tmp_path / "ways" / "extract.json").write_text('{"elements": [\n' + ",\n".join(r.e for r in elements) + "]}")
    store = daily.open_store(spark, str(tmp_path / "t"))
    now = fx.positions(spark, SF).agg(F.max("feed_timestamp")).first()[0] + dt.timedelta(minutes=5)
    cfg = daily.DEFAULT
    import dataclasses

    cfg = dataclasses.replace(cfg, min_day_share=0.0, min_segments=1)
    run = lambda: daily.run_from_files(spark, store, dt.date(2024, 4, 6), now, raw, str(static), ways,
                                       str(tmp_path / "out"), raw_glob="*.txt", cfg=cfg)
    report = dict(run().steps)["report"]
    assert report["ways"] > 0 and report["segments"] == store.read(daily.SEGMENTS).count()
    exported = daily.open_export(spark, str(tmp_path / "out")).read(daily.SPEED).count()
    assert exported == store.read(daily.SPEED).count() > 0
    lines = _files(tmp_path / "t" / daily.SHAPE_STREETS)
    assert dict(run().steps)["new releases"] == []
    assert _files(tmp_path / "t" / daily.SHAPE_STREETS) == lines


def _files(folder):
    return {str(p) for p in folder.rglob("part-*")}


def _gold_inputs(spark, store):
    ways = [(i, "S", "primary", 0, 41.9, 12.5 + i / 1000, 41.9, 12.5005 + i / 1000, 40.0) for i in range(4)]
    store.overwrite(daily.EDGES, spark.createDataFrame(ways, daily.table_schemas()[daily.EDGES]))

    def snapped(kinds, speed):
        rows = [(dt.date(2024, 4, 2), 1, 8, f"v{k}", "r", w, "S", "primary", speed, 1.0) for w in kinds for k in range(3)]
        store.overwrite(daily.SEGMENT_STREETS, spark.createDataFrame(rows, SEGMENT_STREETS), ["date_rome"])

    return snapped


def test_publish_and_export_fail_whole(spark, tmp_path, monkeypatch):
    """A failure at any step of publishing leaves the map a whole old set, and speeds
    and geometry never differ; the next run goes through."""
    import dataclasses

    store = daily.open_store(spark, str(tmp_path / "t"))
    store.create_schema()
    snapped = _gold_inputs(spark, store)
    cfg = dataclasses.replace(daily.DEFAULT, min_segments=1, min_street_share=0.0)
    out = str(tmp_path / "out")
    snapped([0, 1], 20.0)
    daily.gold_job(store, dt.date(2024, 4, 3), cfg=cfg, export_to=out)

    def sets():
        shown = daily.open_export(spark, out)
        return [sorted(r.way_id for r in s.read(t).select("way_id").distinct().collect())
                for s in (store, shown) for t in (daily.SPEED, daily.GEOMETRY)]

    assert sets() == [[0, 1]] * 4
    snapped([1, 2, 3], 30.0)
    real_write, real_move = TableStore.write_version, TableStore._move
    for step in range(6):  # four writes, two moves of a pointer
        calls = iter(range(100))

        def failing(real, step=step, calls=calls):
            def call(self, *args, **kw):
                if next(calls) == step:
                    raise OSError("lost")
                return real(self, *args, **kw)
            return call

        monkeypatch.setattr(TableStore, "write_version", failing(real_write))
        monkeypatch.setattr(TableStore, "_move", failing(real_move))
        with pytest.raises(OSError):
            daily.gold_job(store, dt.date(2024, 4, 3), cfg=cfg, export_to=out)
        monkeypatch.undo()
        speeds, geometry, map_speeds, map_geometry = sets()
        assert map_speeds == map_geometry == [0, 1] and speeds == geometry
        assert speeds == ([1, 2, 3] if step == 5 else [0, 1])
    daily.gold_job(store, dt.date(2024, 4, 3), cfg=cfg, export_to=out)
    assert sets() == [[1, 2, 3]] * 4


def test_task_failure_in_an_export_keeps_the_map(spark, tmp_path):
    out = daily.open_export(spark, str(tmp_path / "out"))
    good = spark.range(50).select(F.col("id").alias("way_id"))
    bad = good.select(F.when(F.col("way_id") == 40, F.raise_error(F.lit("lost"))).otherwise(F.col("way_id")).alias("way_id"))
    store = TableStore(spark, str(tmp_path / "out"), sets={"export": ("a", "b")})
    store.commit({t: store.write_version(t, good) for t in ("a", "b")})
    with pytest.raises(Exception, match="lost"):
        store.commit({t: store.write_version(t, df) for t, df in (("a", good.limit(1)), ("b", bad))})
    assert store.read("a").count() == store.read("b").count() == 50
    assert not out.exists(daily.SPEED)


def test_a_missing_middle_day_is_computed_and_an_empty_one_remembered(spark, tmp_path):
    store = daily.open_store(spark, str(tmp_path / "t"))
    store.create_schema()
    store.overwrite(daily.BRONZE, fx.positions(spark, SF), ["date"])
    today = dt.date(2024, 4, 6)
    first = daily.segments_job(store, today)
    assert first == [(dt.date(2024, 1, 7), dt.date(2024, 4, 5))]
    whole = _rows(store.read(daily.SEGMENTS).select("vehicle_id", "to_ts", "date_rome"))
    assert daily.segments_job(store, today) == []  # days without rows are known
    entry = store.entry(daily.SEGMENTS)
    lost = [p for p, v in sorted(entry.parts.items()) if v][1:3]
    store.commit({daily.SEGMENTS: entry.but({p: v for p, v in entry.parts.items() if p not in lost})})
    assert len(_rows(store.read(daily.SEGMENTS))) < len(whole)
    again = daily.segments_job(store, today)
    assert [day for s, e in again for day in daily.days_of(s, e)] == lost
    assert _rows(store.read(daily.SEGMENTS).select("vehicle_id", "to_ts", "date_rome")) == whole


def test_gold_by_weekdays_equals_a_rebuild(spark, tmp_path):
    """A new day, a changed one and a retired one: bit for bit the table of a full run, and
    only their weekdays are written; a weekday that loses its rows loses its partition."""
    import dataclasses
    import random

    cfg = dataclasses.replace(daily.DEFAULT, min_segments=2, min_street_share=0.0)
    days = [dt.date(2024, 4, 1) + dt.timedelta(days=i) for i in range(9)]  # from a Monday on

    def rows(day, seed):
        r = random.Random(f"{day}{seed}")
        return [(day, day.weekday(), r.randrange(7, 9), f"v{r.randrange(4)}", f"r{r.randrange(3)}", r.randrange(3), "S",
                 "primary", r.uniform(0, 60), r.uniform(0, 25)) for _ in range(40)]

    frame = lambda x: spark.createDataFrame(x, SEGMENT_STREETS)
    store = daily.open_store(spark, str(tmp_path / "t"))
    _gold_inputs(spark, store)
    store.overwrite(daily.SEGMENT_STREETS, frame([x for day in days[:8] for x in rows(day, 0)]), ["date_rome"])
    daily.gold_job(store, days[8], cfg=cfg, enforce_checks=False)
    first = store.entry(daily.SPEED)
    daily.gold_job(store, days[8], cfg=cfg, enforce_checks=False)
    assert store.entry(daily.SPEED) == first  # nothing new
    # Tuesday the 9th comes, Wednesday the 3rd changes, Monday the 1st goes
    store.replace_range(daily.SEGMENT_STREETS, frame(rows(days[8], 0)), "date_rome", days[8], days[8])
    store.replace_range(daily.SEGMENT_STREETS, frame(rows(days[2], 1)), "date_rome", days[2], days[2])
    store.drop_before(daily.SEGMENT_STREETS, "date_rome", days[1])
    daily.gold_job(store, days[8], cfg=cfg, enforce_checks=False)
    now = store.entry(daily.SPEED)
    assert {p for p in now.parts if now.parts[p] != first.parts[p]} == {"0", "1", "2"}
    full = daily.open_store(spark, str(tmp_path / "full"))
    _gold_inputs(spark, full)
    full.overwrite(daily.SEGMENT_STREETS, store.read(daily.SEGMENT_STREETS), ["date_rome"])
    daily.gold_job(full, days[8], cfg=cfg, enforce_checks=False)
    assert _rows(store.read(daily.SPEED)) == _rows(full.read(daily.SPEED)) and store.read(daily.SPEED).count() > 20
    # the last Thursday goes
    store.replace_range(daily.SEGMENT_STREETS, frame([]), "date_rome", days[3], days[3])
    daily.gold_job(store, days[8], cfg=cfg, enforce_checks=False)
    assert store.read(daily.SPEED).where("dow = 3").count() == 0
    # another rule for rows: all of it again
    daily.gold_job(store, days[8], cfg=dataclasses.replace(cfg, min_segments=10**6), enforce_checks=False)
    assert store.read(daily.SPEED).count() == 0
