"""The daily job: every stage reads the tables the previous stages wrote.

Task order (as the reference's job): bronze -> vehicle_segments; route lines
(independent); segment_streets after both; gold last with checks, publish and
export. Each stage processes only the days / releases / geometries not done
yet, so re-running a finished day is a no-op and a failed run is repaired by
running it again.

Tables under ``store.root`` (see ``tables`` for their folders)::

    bronze_positions by date, landed_snapshots by date (one pointer)
    vehicle_segments by date_rome      trip_shape by static_date
    street_edges                       shape_streets
    segment_streets by date_rome       street_speed by dow, street_geometry (one pointer)

Exports are a store of their own with street_speed and street_geometry under one
pointer (``open_export``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.config import DEFAULT, Config
from streetflow.operators import incremental as INC
from streetflow.operators import quality as QC
from streetflow.operators import schedule as SCH
from streetflow.operators import segments as S
from streetflow.operators import speed as SP
from streetflow.operators import streets as ST
from streetflow.operators.positions import land_if_absent
from streetflow.plans import stages
from streetflow.plans.tables import Entry, TableStore, days_of

BRONZE = "bronze_positions"
LANDED = "landed_snapshots"
SEGMENTS = "vehicle_segments"
EDGES = "street_edges"
TRIP_SHAPE = "trip_shape"
SHAPE_STREETS = "shape_streets"
SEGMENT_STREETS = "segment_streets"
SPEED = "street_speed"
GEOMETRY = "street_geometry"
RELEASES = "releases"
DECODED = "decoded_releases"


def table_schemas() -> dict:
    """Declared schemas of the job's tables (partition columns last, as read back)."""
    from pyspark.sql.types import StructType

    from streetflow import schemas as SC

    def last(schema, col):
        fields = [f for f in schema.fields if f.name != col] + [schema[col]]
        return StructType(fields)

    return {
        BRONZE: last(SC.VEHICLE_POSITIONS, "date"),
        LANDED: last(SC.LANDED_SNAPSHOTS, "date"),
        SEGMENTS: last(SC.VEHICLE_SEGMENTS, "date_rome"),
        EDGES: SC.STREET_EDGES,
        TRIP_SHAPE: last(SC.TRIP_SHAPE, "static_date"),
        SHAPE_STREETS: SC.SHAPE_STREETS,
        SEGMENT_STREETS: last(SC.SEGMENT_STREETS, "date_rome"),
        SPEED: last(SC.STREET_SPEED, "dow"),
        GEOMETRY: SC.STREET_GEOMETRY,
    }


def open_store(spark: SparkSession, root: str) -> TableStore:
    """The job's table store at ``root`` (a folder on shared storage). What lands
    and what is published changes together."""
    return TableStore(spark, root, table_schemas(), {"landed": (BRONZE, LANDED), "published": (SPEED, GEOMETRY)})


def open_export(spark: SparkSession, root: str) -> TableStore:
    """The exported tables (SNK9, SRC15), which the map reads: one set of files
    until the next is whole."""
    return TableStore(spark, root, {SPEED: table_schemas()[SPEED], GEOMETRY: table_schemas()[GEOMETRY]},
                      {"export": (SPEED, GEOMETRY)})


def _speed_by_weekdays(store: TableStore, cfg: Config, full_refresh: bool) -> Entry:
    """street_speed as a written, uncommitted table (AG9), by weekday: a row of it
    has one weekday, and so has a day, so days that came, went or changed since the
    published table was made touch their weekdays only. Those are aggregated again
    from all their days, a seventh of the history for a new day; the files of the
    others stay as they are."""
    days = {day: versions for day, versions in store.entry(SEGMENT_STREETS).parts.items() if versions}
    sources = {"days": days, "config": repr(cfg)}
    old = store.entry(SPEED)
    weekday_of = lambda day: dt.date.fromisoformat(day).weekday()
    if old is None or full_refresh or old.sources.get("config") != sources["config"]:
        touched = set(range(7))
    else:
        then = old.sources["days"]
        touched = {weekday_of(day) for day in days | then if days.get(day) != then.get(day)}
    if old is not None and not touched:
        return old
    of = [dt.date.fromisoformat(day) for day in days if weekday_of(day) in touched]
    rows = SP.street_speed(store.read(SEGMENT_STREETS).where(F.col("date_rome").isin(of)), cfg)
    new = store.write_version(SPEED, rows, ["dow"])
    return new.but((old.parts if old else {}) | {str(dow): [] for dow in touched} | new.parts, sources)


@dataclass
class RunLog:
    steps: list = field(default_factory=list)

    def add(self, step: str, detail) -> None:
        self.steps.append((step, detail))


def bronze_job(spark: SparkSession, store: TableStore, raw_dir: str, now_utc: dt.datetime,
               glob: str = "*.json", cfg: Config = DEFAULT, log: RunLog | None = None) -> None:
    """Land new snapshot files (one availableNow pass), then require the
    newest snapshot to be fresh (SRC1-SRC6, SNK1, DQ1). Raises when stale."""
    from streetflow.streaming.ingest import ingest

    ingest(spark, raw_dir, store, f"{store.root}/_checkpoints/{BRONZE}", table=BRONZE, glob=glob)
    failed = QC.failures(QC.freshness(store.read(BRONZE), now_utc, cfg))
    if log:
        log.add("freshness", failed or "fresh")
    if failed:
        raise AssertionError("; ".join(failed))


def load_streets(store: TableStore, ways: DataFrame, cfg: Config = DEFAULT) -> None:
    """Street ways -> street_edges, full rebuild; an empty source leaves the
    table untouched (DQ5). Run on demand; a full refresh of the line matches
    should follow."""
    edges = ST.edges(ST.select_ways(ways, cfg), cfg)
    written = store.write_version(EDGES, edges)
    ST.require_rows(store.read_entry(EDGES, written), "street ways")  # checks the written copy
    store.commit({EDGES: written})


Days = list[tuple[dt.date, dt.date]]


def _by_days(store: TableStore, table: str, days: Days, rebuild: bool, rows) -> None:
    """Write ``rows(start, end)`` of each island of days; a rebuild replaces the table."""
    for start, end in days:
        if rebuild:
            store.overwrite(table, rows(start, end), ["date_rome"], days_of(start, end))
        else:
            store.replace_range(table, rows(start, end), "date_rome", start, end)


def segments_job(store: TableStore, today_local: dt.date, full_refresh: bool = False, cfg: Config = DEFAULT,
                 log: RunLog | None = None) -> Days:
    """bronze -> vehicle_segments for the complete local days not worked on yet,
    those between others too (INC1, SRC14, SNK3, SNK6)."""
    rebuild = full_refresh or not store.exists(SEGMENTS)
    days = INC.islands(store.days(SEGMENTS), INC.span(today_local, cfg=cfg), rebuild)
    if log:
        log.add("segments days", days)
    _by_days(store, SEGMENTS, days, rebuild,
             lambda start, end: S.vehicle_segments(store.read(BRONZE), cfg, start, end))
    if store.exists(SEGMENTS):
        store.drop_before(SEGMENTS, "date_rome", today_local - dt.timedelta(days=cfg.history_days))
    return days


def lines_job(store: TableStore, releases: DataFrame, points: DataFrame, trips: DataFrame, today: dt.date,
              full_refresh: bool = False, cfg: Config = DEFAULT, log: RunLog | None = None) -> list:
    """Schedule releases -> shape_streets + trip_shape (INC3-INC7, SNK4, SNK5, SNK7).

    ``releases`` is the release metadata (static_date, length); ``points`` and
    ``trips`` the decoded tables of those releases, or ``points`` is a function
    of the new dates returning both. Geometries are matched once;
    shape_streets is written before trip_shape because "done" is read from
    trip_shape (INC7).
    """
    rebuild = full_refresh or not (store.exists(TRIP_SHAPE) and store.exists(SHAPE_STREETS))
    loaded = None if rebuild else store.read(TRIP_SHAPE).select("static_date").distinct()
    # one row per release: kept for the cutoff, the new dates and retention
    accepted = SCH.release_acceptance(releases, loaded, cfg).persist()
    new = SCH.new_releases(accepted, today, loaded, cfg)
    new_dates = [r[0] for r in new.orderBy("static_date").collect()]  # a few dates
    cutoff = SCH.version_cutoff(accepted, today, cfg).first()[0]
    if log:
        log.add("new releases", new_dates)
    if not rebuild and cutoff is not None:
        # retention: releases before the cutoff, then geometries nobody uses
        if store.drop_before(TRIP_SHAPE, "static_date", cutoff):
            store.keep_referenced(SHAPE_STREETS, "shape_hash", store.read(TRIP_SHAPE))
    accepted.unpersist()
    if not new_dates:
        return []
    if callable(points):  # decode only the new releases (see lines_job_from_files)
        pts, trp = points(new_dates)
    else:
        pts = points.where(F.col("static_date").isin(new_dates))
        trp = trips.where(F.col("static_date").isin(new_dates))
    known = None if rebuild else store.read(TRIP_SHAPE)
    lines = stages.lines_stage(pts, trp, store.read(EDGES), known, cfg, persist=True)
    if rebuild:
        store.overwrite(SHAPE_STREETS, lines.shape_streets)
    else:
        store.replace_keys(SHAPE_STREETS, lines.shape_streets, lines.new_shapes, "shape_hash")
    if rebuild:
        store.overwrite(TRIP_SHAPE, lines.trip_shape, ["static_date"])
    else:
        store.overwrite_partitions(TRIP_SHAPE, lines.trip_shape, ["static_date"])
    lines.hashes.unpersist()
    lines.search.unpersist()
    return new_dates


def land_releases(store: TableStore, files: DataFrame) -> DataFrame:
    """The landed release files (static_date, length, content) with those of ``files``
    whose day has none yet (SRC7): a day's release lands once, with all files that
    deliver it at that time, and is never replaced."""
    files = files.select("static_date", "length", "content")
    landed = store.read(RELEASES).select("static_date").distinct() if store.exists(RELEASES) else None
    days = land_if_absent(files.select("static_date").distinct(), landed, ["static_date"])
    if landed is None or not days.isEmpty():
        store.append(RELEASES, files.join(days, "static_date", "left_semi"), ["static_date"])
    return store.read(RELEASES)


def lines_job_from_files(spark: SparkSession, store: TableStore, static_path: str, today: dt.date,
                         glob: str = "*.zip", full_refresh: bool = False, cfg: Config = DEFAULT,
                         log: RunLog | None = None) -> list:
    """``lines_job`` over release zips in ``date=YYYY-MM-DD`` folders (SRC7-SRC10).

    Files are landed first, one release a day. Acceptance reads their sizes only
    (the content column is pruned); only the new releases are then read and
    decoded (a partition filter on the release date, applied before the decode)."""
    from streetflow.sources import schedule_files as SF

    files = land_releases(store, SF.scan_releases(spark, static_path, glob))

    def decoded(new_dates):
        # each file is opened once: both members are decoded and written, and read from there
        sel = files.where(F.col("static_date").isin(new_dates))
        store.overwrite(DECODED, SF.decode_releases(sel), ["member"])
        rows = store.read(DECODED)
        return SF.shape_rows(rows), SF.trip_rows(rows)

    return lines_job(store, SF.release_sizes(files), decoded, None, today, full_refresh, cfg, log)


def segment_streets_job(store: TableStore, today_local: dt.date, full_refresh: bool = False,
                        cfg: Config = DEFAULT, log: RunLog | None = None) -> Days:
    """vehicle_segments -> segment_streets, a day only once the next day's
    schedule is known (INC2, JN7-JN13, WN5, WN6, SNK3, SNK6)."""
    if not store.exists(TRIP_SHAPE) or not store.exists(SEGMENTS):
        return []
    rebuild = full_refresh or not store.exists(SEGMENT_STREETS)
    newest = store.read(TRIP_SHAPE).agg(F.max("static_date")).first()[0]
    days = INC.islands(store.days(SEGMENT_STREETS), INC.span(today_local, newest, gated=True, cfg=cfg), rebuild)
    if log:
        log.add("segment_streets days", days)

    def rows(start: dt.date, end: dt.date) -> DataFrame:
        segs = store.read(SEGMENTS).where(F.col("date_rome").between(F.lit(start), F.lit(end)))
        return stages.segment_streets_stage(segs, store.read(TRIP_SHAPE), store.read(SHAPE_STREETS),
                                            store.read(EDGES), cfg)

    _by_days(store, SEGMENT_STREETS, days, rebuild, rows)
    if store.exists(SEGMENT_STREETS):
        store.drop_before(SEGMENT_STREETS, "date_rome", today_local - dt.timedelta(days=cfg.history_days))
    return days


def gold_job(store: TableStore, today_local: dt.date, now_utc: dt.datetime | None = None,
             cfg: Config = DEFAULT, export_to: str | None = None, log: RunLog | None = None,
             enforce_checks: bool = True, full_refresh: bool = False) -> DataFrame:
    """segment_streets -> staged street_speed -> checks -> published with its
    geometry -> exports (AG9, FIL11, DQ1-DQ4, SNK8, SNK9, AG14). Raises, publishing
    nothing, when a check fails. Everything is written before anything changes;
    then speeds and geometry change in one step, and the exported files, which the
    map reads, in another: the map has a whole set, old or new, at any time."""
    staged = {SPEED: _speed_by_weekdays(store, cfg, full_refresh)}
    speed = store.read_entry(SPEED, staged[SPEED])
    found = [QC.day_completeness(store.read(SEGMENT_STREETS), today_local - dt.timedelta(days=1), cfg),
             QC.street_retention(speed, store.read(SPEED) if store.exists(SPEED) else None, cfg)]
    if now_utc is not None and store.exists(BRONZE):
        found.insert(0, QC.freshness(store.read(BRONZE), now_utc, cfg))
    failed = QC.failures(QC.checks(*found))
    if log:
        log.add("failed checks", failed)
    if failed and enforce_checks:
        raise AssertionError("failed checks: " + "; ".join(failed))
    staged[GEOMETRY] = store.write_version(GEOMETRY, SP.street_geometry(store.read(EDGES), speed))
    if export_to:
        out = open_export(store.spark, export_to)
        exported = {t: out.write_version(t, store.read_entry(t, entry)) for t, entry in staged.items()}
    store.commit(staged)  # SNK8: both tables in one step
    if export_to:
        out.commit(exported)
    if log:
        log.add("published", True)
    return store.read(SPEED)


def run_daily(spark: SparkSession, store: TableStore, today_local: dt.date, releases: DataFrame,
              points: DataFrame, trips: DataFrame, now_utc: dt.datetime | None = None, full_refresh: bool = False,
              cfg: Config = DEFAULT, enforce_checks: bool = True) -> RunLog:
    """The whole daily job after ingestion, in the reference's task order."""
    log = RunLog()
    store.create_schema()
    segments_job(store, today_local, full_refresh, cfg, log)
    lines_job(store, releases, points, trips, today_local, full_refresh, cfg, log)
    segment_streets_job(store, today_local, full_refresh, cfg, log)
    gold_job(store, today_local, now_utc, cfg, log=log, enforce_checks=enforce_checks, full_refresh=full_refresh)
    _report(store, log)
    return log


def run_from_files(spark: SparkSession, store: TableStore, today_local: dt.date, now_utc: dt.datetime, raw_dir: str,
                   static_path: str, ways_path: str | None = None, export_to: str | None = None,
                   full_refresh: bool = False, raw_glob: str = "*.json", cfg: Config = DEFAULT) -> RunLog:
    """One run from raw files to publish and export (SRC17): snapshots, schedule
    zips and, on demand or the first time, a street extract. Any failed check
    stops it; run again, it goes on where it stopped."""
    from streetflow.sources.street_extracts import read_ways

    log = RunLog()
    store.create_schema()
    if ways_path is not None and (full_refresh or not store.exists(EDGES)):
        load_streets(store, read_ways(spark, ways_path), cfg)
    bronze_job(spark, store, raw_dir, now_utc, raw_glob, cfg, log)
    segments_job(store, today_local, full_refresh, cfg, log)
    lines_job_from_files(spark, store, static_path, today_local, full_refresh=full_refresh, cfg=cfg, log=log)
    segment_streets_job(store, today_local, full_refresh, cfg, log)
    gold_job(store, today_local, now_utc, cfg, export_to, log, full_refresh=full_refresh)
    _report(store, log)
    return log


def _report(store: TableStore, log: RunLog) -> None:
    """The run's figures into its log (AG17): a few rows."""
    for table in table_schemas():
        store.vacuum(table)
    rows = QC.run_report(store.read(EDGES), store.read(TRIP_SHAPE), store.read(SEGMENTS)).collect()
    log.add("report", {r["metric"]: r["value"] for r in rows})

