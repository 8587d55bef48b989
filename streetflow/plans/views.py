"""Query views over the fixtures: one function per registered key.

Each takes (spark, sf_dir) and returns a DataFrame whose columns are aliased to
the oracle's names. Timestamps are shown as epoch seconds (``*_epoch``) so the
comparison does not depend on how an engine prints zone-aware values.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.config import DEFAULT, DOW_NAMES
from streetflow.functions.geo import midpoint
from streetflow.functions.timefns import epoch_s, weekday
from streetflow.operators import grid as G
from streetflow.operators import incremental as INC
from streetflow.operators import match as M
from streetflow.operators import positions as P
from streetflow.operators import quality as QC
from streetflow.operators import schedule as SCH
from streetflow.operators import segments as S
from streetflow.operators import serving as SV
from streetflow.operators import speed as SP
from streetflow.operators import streets as ST
from streetflow.plans import stages
from streetflow.session import prepare
from streetflow.sources import fixtures as fx


# The fixture as a finished daily run: every stage table written once per
# (session, sf_dir) under the shared checkpoint folder. Views apply the operator
# under test to the tables it reads in the pipeline.
_WORLDS: dict = {}
TODAY_LOCAL = dt.date(2024, 4, 6)


def release_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release metadata (static_date, length) standing in for the schedule
    files: the size grows with the trips the release lists."""
    t = fx.trips(spark, sf_dir).groupBy("static_date").count()
    return t.select("static_date", (F.col("count") * 64 + 6400).cast("long").alias("length"))


def world(spark: SparkSession, sf_dir: str):
    from streetflow.plans import daily
    from streetflow.session import scratch_dir

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WORLDS:
        prepare(spark)
        store = daily.open_store(spark, scratch_dir(spark, "fixture-run"))
        store.create_schema()
        store.overwrite(daily.BRONZE, fx.positions(spark, sf_dir), ["date"])
        daily.load_streets(store, fx.ways(spark, sf_dir))
        daily.run_daily(spark, store, TODAY_LOCAL, release_files(spark, sf_dir), fx.shapes(spark, sf_dir),
                        fx.trips(spark, sf_dir), enforce_checks=False)
        _WORLDS[key] = store
    return _WORLDS[key]


def _table(spark, sf_dir, name):
    return world(spark, sf_dir).read(name)


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "vehicle_segments")


def positions_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return P.clean(fx.positions(spark, sf_dir)).select(
        "entity_id", "vehicle_id", "trip_id", "route_id",
        epoch_s("feed_timestamp").alias("feed_epoch"), epoch_s("vehicle_timestamp").alias("vehicle_epoch"),
        "latitude", "longitude", "date",
    )


def positions_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return P.dedupe(P.clean(fx.positions(spark, sf_dir))).select(
        "entity_id", "vehicle_id", "trip_id",
        epoch_s("feed_timestamp").alias("feed_epoch"), epoch_s("vehicle_timestamp").alias("vehicle_epoch"),
        "latitude", "longitude",
    )


SEG_COLS = ["vehicle_id", "trip_id", "route_id", "from_epoch", "to_epoch", "duration_s", "distance_m", "speed_kmh",
            "from_lat", "from_lon", "to_lat", "to_lon"]


def _seg_view(segs: DataFrame) -> DataFrame:
    return segs.withColumn("from_epoch", epoch_s("from_ts")).withColumn("to_epoch", epoch_s("to_ts"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _seg_view(S.segments(P.clean(fx.positions(spark, sf_dir)))).select(*SEG_COLS)


def _fresh_segments(positions: DataFrame) -> DataFrame:
    return S.with_local_time(S.segments(P.clean(positions)))


def segments_local_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    segs = S.local_days(_fresh_segments(_table(spark, sf_dir, "bronze_positions")),
                        dt.date(2024, 3, 26), dt.date(2024, 4, 3))
    return _seg_view(segs).select("vehicle_id", "to_epoch", "date_rome", "hour_rome", weekday("date_rome").alias("dow"))


def route_hour_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first end-to-end slice, straight from the positions."""
    prepare(spark)
    return SP.route_hour_speed(_fresh_segments(fx.positions(spark, sf_dir)))


# ----------------------------------------------------------------- streets


def _edges(spark, sf_dir):
    return _table(spark, sf_dir, "street_edges")


def _fresh_edges(spark, sf_dir):
    return stages.edges_stage(fx.ways(spark, sf_dir))


def _ways_view(ways: DataFrame) -> DataFrame:
    return ways.select("way_id", F.col("tags")["name"].alias("street"), F.col("tags")["highway"].alias("highway"),
                       F.size("geometry").alias("vertices"))


def ways_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _ways_view(ST.select_ways(fx.ways(spark, sf_dir)))


def ways_with_vertex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other rule: ways that cross the box without a vertex in it do not count."""
    prepare(spark)
    return _ways_view(ST.select_ways(fx.ways(spark, sf_dir), dataclasses.replace(DEFAULT, ways_in_box="vertex")))


def ways_from_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ways written as extract documents, one for each partition and 200 ways, and
    read back from the files (SRC11); nodes and ways without geometry are in them."""
    from streetflow.session import scratch_dir
    from streetflow.sources.street_extracts import read_ways

    prepare(spark)
    ways = fx.ways(spark, sf_dir).withColumn("kind", F.lit("way"))
    nodes = ways.where("way_id % 10 = 0").select(F.lit("node").alias("kind"), "way_id", "tags", "geometry")
    bare = ways.where("way_id % 10 = 1").select("kind", (F.col("way_id") + 10**9).alias("way_id"), "tags",
                                                F.lit(None).cast(ways.schema["geometry"].dataType).alias("geometry"))
    elements = ways.unionByName(nodes).unionByName(bare).select(
        F.struct(F.col("kind").alias("type"), F.col("way_id").alias("id"), "tags", "geometry").alias("e"),
        F.spark_partition_id().alias("p"), F.floor(F.monotonically_increasing_id() / 200).alias("tile"))
    path = scratch_dir(spark, "extracts")
    elements.groupBy("p", "tile").agg(F.to_json(F.struct(F.collect_list("e").alias("elements"))).alias("value")).select(
        "value", F.concat_ws("-", "p", "tile").alias("tile")).write.partitionBy("tile").text(path)
    return _ways_view(ST.select_ways(read_ways(spark, path, "*.txt")))


def street_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JVM and C-library sine/cosine may differ in the last bit, so the view
    shows haversine lengths to the micrometre."""
    prepare(spark)
    return _fresh_edges(spark, sf_dir).withColumn("length_m", F.round("length_m", 6))


def street_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of doubles depend on the engine's addition order, so the view shows
    them to the micrometre."""
    prepare(spark)
    return ST.street_length(_edges(spark, sf_dir)).select("way_id", F.round("street_m", 6).alias("street_m"))


def edge_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    e = _edges(spark, sf_dir).select("way_id", "seq", *G.EDGE_GEOM, "length_m")
    return G.edge_cells(e).select("way_id", "seq", "cell_lat", "cell_lon")


# ---------------------------------------------------------------- schedule

def _reps_named(reps: DataFrame) -> DataFrame:
    return reps.select("shape_hash", F.col("static_date").alias("rep_date"), F.col("shape_id").alias("rep_shape"))


def _lines(spark, sf_dir):
    return stages.lines_stage(fx.shapes(spark, sf_dir), fx.trips(spark, sf_dir), _edges(spark, sf_dir))


LOADED = ("2024-03-27",)
TODAY = dt.date(2024, 6, 27)


def release_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return SCH.release_acceptance(release_files(spark, sf_dir))


def release_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three more releases: one cut to half the size of the last, one a tenth larger
    than that, which is held against it though it was rejected, and a whole one."""
    prepare(spark)
    files = release_files(spark, sf_dir)
    last = files.agg(F.max_by("length", "static_date").alias("length"))
    more = last.select(F.inline(F.array(*[
        F.struct(F.lit(dt.date(2024, 4, day)).alias("static_date"), F.floor(F.col("length") * share).cast("long").alias("length"))
        for day, share in ((7, 0.5), (8, 0.55), (9, 1.0))])))
    return SCH.release_acceptance(files.unionByName(more))


def version_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return SCH.version_cutoff(SCH.release_acceptance(release_files(spark, sf_dir)), TODAY)


def new_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    loaded = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in LOADED], "static_date date")
    acc = SCH.release_acceptance(release_files(spark, sf_dir), loaded)
    return SCH.new_releases(acc, TODAY, loaded)


def trips_with_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return SCH.trips_with_shape(fx.trips(spark, sf_dir))


def shape_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines sharing one geometry, shown by their representative (hash text is engine-specific)."""
    prepare(spark)
    h = SCH.shape_hashes(fx.shapes(spark, sf_dir))
    reps = _reps_named(SCH.representatives(h))
    return h.join(reps, "shape_hash").select("static_date", "shape_id", "rep_date", "rep_shape")


def representative_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    lines = _lines(spark, sf_dir)
    return lines.new_shapes.select("static_date", "shape_id")


def used_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return SCH.used_points(fx.shapes(spark, sf_dir), fx.trips(spark, sf_dir))


def unmatched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geometries of releases after 2024-03-30 not seen in the earlier ones."""
    prepare(spark)
    h = SCH.shape_hashes(SCH.used_points(fx.shapes(spark, sf_dir), fx.trips(spark, sf_dir)))
    cut = F.lit(dt.date(2024, 3, 30))
    known = h.where(F.col("static_date") <= cut)
    new = SCH.representatives(h.where(F.col("static_date") > cut))
    return SCH.unmatched(new, known).select("static_date", "shape_id")


def _with_rep(df: DataFrame, lines) -> DataFrame:
    return df.join(_reps_named(lines.new_shapes), "shape_hash").drop("shape_hash")


def line_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    lines = _lines(spark, sf_dir)
    return _with_rep(lines.samples, lines)


def neighbour_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    lines = _lines(spark, sf_dir)
    s = lines.samples.withColumn("cell_lat", G.grid_cell("lat")).withColumn("cell_lon", G.grid_cell("lon"))
    return _with_rep(G.neighbour_cells(s), lines).select("rep_date", "rep_shape", "seq", "step", "cell_lat", "cell_lon")


def line_nearest_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    lines = _lines(spark, sf_dir)
    return _with_rep(lines.matched.select("shape_hash", "seq", "step", "way_id", "snap_m"), lines)


def shape_streets(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    lines = _lines(spark, sf_dir)
    return _with_rep(lines.shape_streets, lines).withColumn("street_m", F.round("street_m", 6))


def trip_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    lines = _lines(spark, sf_dir)
    return _with_rep(lines.trip_shape, lines)


# ------------------------------------------------------ version lookup, snap

def _day_versions(spark, sf_dir, lines=None):
    days = _segments(spark, sf_dir).select("date_rome").distinct()
    return M.day_versions(days, _table(spark, sf_dir, "trip_shape").select("static_date").distinct())


class _Stored:
    """Stage tables of the line matching, as written by the daily run."""

    def __init__(self, spark, sf_dir):
        self.trip_shape = _table(spark, sf_dir, "trip_shape")
        self.shape_streets = _table(spark, sf_dir, "shape_streets")
        h = self.trip_shape.select("static_date", "shape_id", "shape_hash").distinct()
        self.new_shapes = SCH.representatives(h)


def release_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _day_versions(spark, sf_dir).where("priority = 1").select("date_rome", "static_date")


def next_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _day_versions(spark, sf_dir).where("priority = 2").select("date_rome", "static_date")


def trip_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    lines = _Stored(spark, sf_dir)
    th = M.trip_lookup(_day_versions(spark, sf_dir, lines), lines.trip_shape)
    return _with_rep(th, lines)


def route_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    lines = _Stored(spark, sf_dir)
    th = M.trip_lookup(_day_versions(spark, sf_dir, lines), lines.trip_shape)
    re = M.route_edges(lines.shape_streets, th.select("shape_hash").distinct(), _edges(spark, sf_dir))
    return _with_rep(re.select("shape_hash", "way_id", "seq"), lines)


def point_edge_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (segment midpoint, edge) pair sharing a grid neighbourhood with
    the exact point-to-edge distance, over the whole street network."""
    prepare(spark)
    segs = _segments(spark, sf_dir).select(
        "vehicle_id", epoch_s("to_ts").alias("to_epoch"),
        ((F.col("from_lat") + F.col("to_lat")) / 2).alias("lat"),
        ((F.col("from_lon") + F.col("to_lon")) / 2).alias("lon"),
    )
    search = G.searchable_edges(_edges(spark, sf_dir))
    return G.candidates(segs, search).select("vehicle_id", "to_epoch", "way_id", F.col("edge_seq").alias("seq"), "snap_m")


def nearest_way_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest edge within the snap limit of every segment's midpoint, over the
    whole network: no edge in reach is missed, as the grid's default search may."""
    prepare(spark)
    cfg = dataclasses.replace(DEFAULT, exact_radius=True)
    mids = _segments(spark, sf_dir).select(
        "vehicle_id", epoch_s("to_ts").alias("to_epoch"), midpoint("from_lat", "to_lat").alias("lat"),
        midpoint("from_lon", "to_lon").alias("lon"))
    found = G.nearest_within(mids, _edges(spark, sf_dir), ["vehicle_id", "to_epoch"], cfg=cfg, hot=G.hot_tiles(mids, cfg=cfg))
    return found.select("vehicle_id", "to_epoch", "way_id", "snap_m")


def _segment_streets(spark, sf_dir):
    return _table(spark, sf_dir, "segment_streets")


def segment_nearest_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    lines = _Stored(spark, sf_dir)
    return stages.segment_streets_stage(_segments(spark, sf_dir), lines.trip_shape, lines.shape_streets,
                                        _edges(spark, sf_dir))


def street_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return SP.street_speed(_segment_streets(spark, sf_dir), DEFAULT).select(
        "way_id", "street", "highway", "dow", "hour_rome", "segments", "vehicles", "routes", "days",
        "avg_speed_kmh", "median_speed_kmh", "moving_share", "snap_m")


def _published(spark, sf_dir):
    return _table(spark, sf_dir, "street_speed")


def street_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published polylines flattened to one row per vertex."""
    prepare(spark)
    geo = SP.street_geometry(_edges(spark, sf_dir), _published(spark, sf_dir))
    return geo.select("way_id", F.posexplode("path").alias("vertex", "xy")).select(
        "way_id", "vertex", F.col("xy")[0].alias("lon"), F.col("xy")[1].alias("lat")
    )


# ------------------------------------------------------------ quality gates

NOW = dt.datetime(2024, 4, 4, 0, 30, 0)        # UTC
YESTERDAY = dt.date(2024, 4, 1)
CHECK_VIEW = ["check_name", "passed", "skipped", "value", "threshold"]


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return QC.freshness(fx.positions(spark, sf_dir), NOW).select(*CHECK_VIEW)


def day_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return QC.day_completeness(_segment_streets(spark, sf_dir), YESTERDAY).select(*CHECK_VIEW)


def _previous(speed: DataFrame) -> DataFrame:
    """A previous publication standing in for the published table: the same
    streets on two more hours of the week."""
    return speed.where(F.col("hour_rome") >= 1)


def street_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    speed = _published(spark, sf_dir)
    return QC.street_retention(speed.where(F.col("hour_rome") >= 2), _previous(speed)).select(*CHECK_VIEW)


def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    speed = _published(spark, sf_dir)
    return QC.checks(
        QC.freshness(fx.positions(spark, sf_dir), NOW),
        QC.day_completeness(_segment_streets(spark, sf_dir), YESTERDAY),
        QC.street_retention(speed.where(F.col("hour_rome") >= 2), _previous(speed)),
    ).select(*CHECK_VIEW)


def _days_loaded(spark: SparkSession, sf_dir: str, until: dt.date) -> DataFrame:
    return _segments(spark, sf_dir).where(F.col("date_rome") <= F.lit(until)).select(F.col("date_rome").alias("day"))


def days_to_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded through 2024-03-30, today 2024-04-05."""
    prepare(spark)
    return INC.missing_days(_days_loaded(spark, sf_dir, dt.date(2024, 3, 30)), *INC.span(dt.date(2024, 4, 5)))


def days_to_process_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, today 2024-04-07, waiting for the next day's schedule."""
    prepare(spark)
    newest = _table(spark, sf_dir, "trip_shape").agg(F.max("static_date")).first()[0]
    return INC.missing_days(_days_loaded(spark, sf_dir, dt.date(2024, 3, 30)),
                            *INC.span(dt.date(2024, 4, 7), newest, gated=True))


def days_with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the first, but 2024-03-28 and 2024-03-29 were never written."""
    prepare(spark)
    loaded = _days_loaded(spark, sf_dir, dt.date(2024, 3, 31)).where(
        ~F.col("day").isin(dt.date(2024, 3, 28), dt.date(2024, 3, 29)))
    return INC.missing_days(loaded, *INC.span(dt.date(2024, 4, 5)))


# ----------------------------------------------------------------- serving
NOW_LOCAL = dt.datetime(2024, 4, 2, 10, 0, 0)  # a Tuesday, 10:00 in Rome


def _map(spark, sf_dir):
    speed = _published(spark, sf_dir)
    return speed, SV.load(speed, _table(spark, sf_dir, "street_geometry"))


def map_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    _, view = _map(spark, sf_dir)
    return view.select("way_id", "dow", "dow_name", "hour_rome", "median_speed_kmh",
                       F.size("path").alias("vertices"), F.col("path")[0][0].alias("lon0"),
                       F.col("path")[0][1].alias("lat0"))


def nearest_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return SV.nearest_slot(_published(spark, sf_dir), NOW_LOCAL)


def _slot_view(spark, sf_dir):
    speed, view = _map(spark, sf_dir)
    slot = SV.nearest_slot(speed, NOW_LOCAL).select(
        F.col("dow").alias("_dow"), F.col("hour_rome").alias("_hour"))
    # one-row slot, broadcast; keeps the chosen weekday and hour
    v = view.join(F.broadcast(slot), (F.col("dow") == F.col("_dow")) & (F.col("hour_rome") == F.col("_hour")), "left_semi")
    return v


def map_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    speed, view = _map(spark, sf_dir)
    slot = SV.nearest_slot(speed, NOW_LOCAL).first()  # one row
    if slot is None:
        sel = SV.select_slot(view, "", -1)
    else:
        sel = SV.select_slot(view, DOW_NAMES[slot["dow"]], int(slot["hour_rome"]))
    return sel.select("way_id", "dow", "hour_rome", "median_speed_kmh", "speed_class", "swatch", "moving_pct")


def legend_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return SV.legend_totals(_slot_view(spark, sf_dir))


def street_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return SV.street_table(_slot_view(spark, sf_dir))


# ------------------------------------------------- snapshots, landing, report

def snapshot_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    st = P.snapshot_time(fx.positions(spark, sf_dir), on_missing_header="max")
    return st.select("source_file", epoch_s("snapshot_ts").alias("snapshot_epoch"), "entities", "valid")


def land_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every snapshot delivered twice; days through 2024-03-29 already landed."""
    prepare(spark)
    pos = fx.positions(spark, sf_dir)
    landed = pos.where(F.col("date") <= F.lit(dt.date(2024, 3, 29)))
    out = P.land_if_absent(pos.unionByName(pos), landed)
    return out.select(epoch_s("feed_timestamp").alias("feed_epoch"), "entity_id", "vehicle_id",
                      epoch_s("vehicle_timestamp").alias("vehicle_epoch"))


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return QC.run_report(_edges(spark, sf_dir), _table(spark, sf_dir, "trip_shape"), _segments(spark, sf_dir))


# ------------------------------------------------ streaming, decode, sinks
def _store(spark, name):
    from streetflow.plans import daily
    from streetflow.session import scratch_dir

    store = daily.open_store(spark, scratch_dir(spark, name))
    store.create_schema()
    return store


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots written as JSON feed files under date=/hour= directories,
    landed by one availableNow streaming pass, read back from bronze."""
    from streetflow.sources import snapshots as SN
    from streetflow.streaming.ingest import ingest

    prepare(spark)
    store = _store(spark, "ingest")
    raw = store.path("raw")
    SN.snapshot_messages(fx.positions(spark, sf_dir)).write.partitionBy("date", "hour").text(raw)
    ingest(spark, raw, store, store.path("_checkpoint"), glob="*.txt")
    return _bronze_view(store.read("bronze_positions"))


def _bronze_view(b: DataFrame) -> DataFrame:
    return b.select(epoch_s("feed_timestamp").alias("feed_epoch"), "entity_id", "vehicle_id", "trip_id", "route_id",
                    "latitude", "longitude", epoch_s("vehicle_timestamp").alias("vehicle_epoch"), "date")


def stream_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positions as a stream, in no order, and its segments; snapshots of one
    more vehicle, months later, let the watermark pass all others."""
    from streetflow import schemas
    from streetflow.session import scratch_dir
    from streetflow.streaming.segments import prepare_state, segment_stream

    prepare(spark)
    prepare_state(spark)
    src, out, state = (scratch_dir(spark, f"stream-{x}") for x in ("in", "out", "state"))
    pos = fx.positions(spark, sf_dir).select(*[f.name for f in schemas.VEHICLE_POSITIONS.fields])
    for months in (0, 3, 6):  # three passes, each going on from the state of the one before
        later = F.make_interval(months=F.lit(months))
        moved = {c: F.col(c) + later for c in ("feed_timestamp", "vehicle_timestamp")}
        arrived = P.clean(pos).limit(1).withColumns(moved).withColumn("vehicle_id", F.lit("later")) if months else pos
        arrived.write.mode("append").parquet(src)
        stream = spark.readStream.schema(schemas.VEHICLE_POSITIONS).parquet(src)
        q = segment_stream(stream, disorder="20 days").writeStream.format("parquet").option(
            "checkpointLocation", state).option("path", out).trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return _seg_view(spark.read.parquet(out)).select(*SEG_COLS)


def decode_with_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same snapshot files decoded by a Python codec in Arrow batches (UDF1). A file
    is a task's unit of work, so an hour's messages are as many files as they call for."""
    import io
    import json

    from streetflow.session import scratch_dir
    from streetflow.sources import snapshots as SN

    def codec(content: bytes):
        for line in io.BytesIO(content):  # no copy of a file, and no list of its lines
            message = json.loads(line)
            for e in message["entity"]:
                v = e["vehicle"]
                yield {"feed_timestamp": message["header"]["timestamp"], "entity_id": e["id"],
                       "vehicle_id": v["vehicle"]["id"], "trip_id": v["trip"].get("trip_id"),
                       "route_id": v["trip"].get("route_id"), "latitude": v["position"]["latitude"],
                       "longitude": v["position"]["longitude"], "vehicle_timestamp": v["timestamp"]}

    prepare(spark)
    raw = scratch_dir(spark, "codec")
    SN.snapshot_messages(fx.positions(spark, sf_dir)).write.partitionBy("date", "hour").option(
        "maxRecordsPerFile", 500).text(raw)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(raw)
    return _bronze_view(SN.to_bronze(SN.decode_with(files, codec).where("reject is null")))


def one_release_a_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases through 2024-03-30 land, then all are delivered again with other trips:
    of the days that have a release the first stays. Trips as decoded from what landed."""
    from streetflow.plans import daily
    from streetflow.sources import schedule_files as SF

    prepare(spark)
    store = _store(spark, "releases")
    points, trips = fx.shapes(spark, sf_dir), fx.trips(spark, sf_dir)
    first = F.col("static_date") <= F.lit(dt.date(2024, 3, 30))
    daily.land_releases(store, SF.pack_releases(points.where(first), trips.where(first)))
    again = trips.withColumn("trip_id", F.concat("trip_id", F.lit("-again")))
    return SF.decode_trips(daily.land_releases(store, SF.pack_releases(points, again)))


def decode_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases packed as zips (one per day), decoded back to trips."""
    from streetflow.sources import schedule_files as SF

    prepare(spark)
    packed = SF.pack_releases(fx.shapes(spark, sf_dir), fx.trips(spark, sf_dir))
    return SF.decode_trips(packed)


def range_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments first built with a 30 s gap limit, then days 2024-03-28..31
    rebuilt with the defaults: the table mixes both, by day."""
    from streetflow.plans import daily

    prepare(spark)
    store = _store(spark, "range-replace")
    bronze = _table(spark, sf_dir, daily.BRONZE)
    old = S.vehicle_segments(bronze, dataclasses.replace(DEFAULT, max_gap_s=30, track_bucket_s=3600))
    store.overwrite(daily.SEGMENTS, old, ["date_rome"])
    start, end = dt.date(2024, 3, 28), dt.date(2024, 3, 31)
    store.replace_range(daily.SEGMENTS, S.vehicle_segments(bronze, DEFAULT, start, end), "date_rome", start, end)
    t = store.read(daily.SEGMENTS)
    return t.select("vehicle_id", epoch_s("to_ts").alias("to_epoch"), "duration_s", "date_rome")


def retention_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    from streetflow.plans import daily

    prepare(spark)
    store = _store(spark, "retention")
    store.overwrite(daily.SEGMENTS, _segments(spark, sf_dir), ["date_rome"])
    store.drop_before(daily.SEGMENTS, "date_rome", dt.date(2024, 3, 30))
    return store.read(daily.SEGMENTS).select("vehicle_id", epoch_s("to_ts").alias("to_epoch"), "date_rome")


def _two_runs(spark, sf_dir, name):
    """Route lines loaded in two runs: releases through 2024-03-30, then all."""
    from streetflow.plans import daily

    store = _store(spark, name)
    store.overwrite(daily.EDGES, _edges(spark, sf_dir))
    rel = release_files(spark, sf_dir)
    pts, trp = fx.shapes(spark, sf_dir), fx.trips(spark, sf_dir)
    first = rel.where(F.col("static_date") <= F.lit(dt.date(2024, 3, 30)))
    daily.lines_job(store, first, pts, trp, TODAY_LOCAL)
    daily.lines_job(store, rel, pts, trp, TODAY_LOCAL)
    return store


def _stored_reps(trip_shape_df):
    return _reps_named(SCH.representatives(trip_shape_df.select("static_date", "shape_id", "shape_hash").distinct()))


def keyed_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    from streetflow.plans import daily

    prepare(spark)
    store = _two_runs(spark, sf_dir, "keyed-replace")
    ss = store.read(daily.SHAPE_STREETS).join(_stored_reps(store.read(daily.TRIP_SHAPE)), "shape_hash")
    return ss.select("rep_date", "rep_shape", "way_id", "points", "snap_m", F.round("street_m", 6).alias("street_m"),
                     "span_m")


def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    from streetflow.plans import daily

    prepare(spark)
    store = _two_runs(spark, sf_dir, "partition-replace")
    ts = store.read(daily.TRIP_SHAPE)
    return ts.join(_stored_reps(ts), "shape_hash").select("static_date", "trip_id", "shape_id", "rep_date",
                                                           "rep_shape")


def orphan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases before 2024-04-02 retired; line matches nobody uses removed."""
    from streetflow.plans import daily

    prepare(spark)
    store = _two_runs(spark, sf_dir, "orphans")
    store.drop_before(daily.TRIP_SHAPE, "static_date", dt.date(2024, 4, 2))
    store.keep_referenced(daily.SHAPE_STREETS, "shape_hash", store.read(daily.TRIP_SHAPE))
    ss = store.read(daily.SHAPE_STREETS).join(_stored_reps(store.read(daily.TRIP_SHAPE)), "shape_hash")
    return ss.select("rep_date", "rep_shape", "way_id", "points", "span_m")


def _gold_store(spark, sf_dir, name):
    from streetflow.plans import daily

    store = _store(spark, name)
    store.overwrite(daily.SEGMENT_STREETS, _segment_streets(spark, sf_dir), ["date_rome"])
    store.overwrite(daily.EDGES, _edges(spark, sf_dir))
    return store


def staged_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold staged, checked (yesterday 2024-04-02 against its week; first
    publish) and published; the published table read back."""
    from streetflow.plans import daily

    prepare(spark)
    store = _gold_store(spark, sf_dir, "publish")
    daily.gold_job(store, dt.date(2024, 4, 3))
    return store.read(daily.SPEED).select(*SPEED_COLS)


def speed_by_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published for the days through 2024-03-30, then with the later ones and without
    the earliest: only the weekdays of these days are aggregated again."""
    from streetflow.plans import daily

    prepare(spark)
    store = _store(spark, "increments")
    store.overwrite(daily.EDGES, _edges(spark, sf_dir))
    snapped = _segment_streets(spark, sf_dir)
    days = snapped.agg(F.min("date_rome"), F.max("date_rome")).first()
    first = F.col("date_rome") <= F.lit(dt.date(2024, 3, 30))
    store.overwrite(daily.SEGMENT_STREETS, snapped.where(first), ["date_rome"])
    daily.gold_job(store, dt.date(2024, 4, 6), enforce_checks=False)
    if days[0] is not None:
        store.replace_range(daily.SEGMENT_STREETS, snapped, "date_rome", dt.date(2024, 3, 31), days[1])
        store.drop_before(daily.SEGMENT_STREETS, "date_rome", days[0] + dt.timedelta(days=1))
    daily.gold_job(store, dt.date(2024, 4, 6), enforce_checks=False)
    return store.read(daily.SPEED).select(*SPEED_COLS)


SPEED_COLS = ["way_id", "street", "highway", "dow", "hour_rome", "segments", "vehicles", "routes", "days",
              "avg_speed_kmh", "median_speed_kmh", "moving_share", "snap_m"]


def export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published speed and geometry exported as Parquet, read back as the map
    reads them (SNK9, SRC15): one row per street, weekday and hour with its
    vertex count."""
    from streetflow.plans import daily

    prepare(spark)
    store = _gold_store(spark, sf_dir, "export")
    out = f"{store.root}/export"
    daily.gold_job(store, dt.date(2024, 4, 3), export_to=out)
    exported = daily.open_export(spark, out)
    speed, geo = exported.read(daily.SPEED), exported.read(daily.GEOMETRY)
    return speed.join(geo.select("way_id", F.size("path").alias("vertices")), "way_id").select(*SPEED_COLS, "vertices")
