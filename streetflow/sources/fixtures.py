"""Pipeline inputs derived from the provided ``events`` table.

The test data hold no GPS feed, so positions, street ways, trips and route
lines are computed from ``events`` by plain arithmetic (the same arithmetic is
written in DuckDB SQL for the oracle). Thirty days of events are squeezed into
72 minutes per vehicle; vehicle ``u`` drives on day ``u % 10`` from 22:00 UTC
on 2024-03-25 + that day, so tracks cross local midnight and the 2024-03-31
clock change.

Street ways are the fixed test grid (48 main streets, 48 parallels 11 m to the
north, 11 crossings) plus ways built from blocks of eight consecutive events,
placed well north of every track, so the street network grows with the data
without changing any match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow import schemas

# Fixed values of the fixture definitions.
EPOCH_2024 = 1704067200          # 2024-01-01 00:00 UTC
TRACK_START = 1711404000         # 2024-03-25 22:00 UTC
RELEASES = ("2024-03-27", "2024-03-28", "2024-03-30", "2024-04-02", "2024-04-05")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "user_id", "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("epoch_s")
    )


def positions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position rows with repeats, stale copies, out-of-box points and missing trips.

    Columns: user_id, event_id, copy, vehicle_ts, feed_ts (epoch s), vehicle_id,
    trip_id, route_id, lat, lon.
    """
    q = _ev(spark, sf_dir).select(
        "user_id",
        "event_id",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("event_id") % 3)).alias("copy"),
        F.floor((F.col("epoch_s") - EPOCH_2024) / 600.0).cast("long").alias("k"),
    )
    u, e, k, copy = F.col("user_id"), F.col("event_id"), F.col("k"), F.col("copy")
    base = F.lit(TRACK_START) + (u % 10) * 86400 + k
    return q.select(
        "user_id",
        "event_id",
        "copy",
        base.cast("long").alias("vehicle_ts"),
        (base + copy * 30 + F.when(e % 50 == 0, 500).otherwise(10)).cast("long").alias("feed_ts"),
        F.concat(F.lit("V"), u.cast("string")).alias("vehicle_id"),
        F.when(e % 41 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("T"), u.cast("string"), F.lit("_"), F.floor(k / 1500.0).cast("int").cast("string")))
        .alias("trip_id"),
        F.concat(F.lit("R"), (u % 8).cast("string")).alias("route_id"),
        F.when(e % 97 == 0, F.lit(45.0))
        .otherwise(F.lit(41.89) + (u % 8) * 0.001 + ((e % 7) - 3) * 0.00004)
        .alias("lat"),
        (F.lit(12.45) + 0.00005 * k + (((e * 37) % 11) - 5) * 0.0002).alias("lon"),
    )


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture positions in the bronze ``vehicle_positions`` schema.

    ``entity_id`` is the zero-padded event id, so its text order is the numeric
    order used to break feed-time ties.
    """
    raw = positions_raw(spark, sf_dir)
    feed = F.timestamp_seconds("feed_ts")
    cols = {
        "source_file": F.concat(F.lit("fixture/"), F.col("feed_ts").cast("string"), F.lit(".json")),
        "feed_timestamp": feed,
        "entity_id": F.lpad(F.col("event_id").cast("string"), 12, "0"),
        "is_deleted": F.lit(None).cast("boolean"),
        "trip_id": F.col("trip_id"),
        "route_id": F.col("route_id"),
        "direction_id": F.lit(None).cast("int"),
        "start_date": F.lit(None).cast("string"),
        "start_time": F.lit(None).cast("string"),
        "schedule_relationship": F.lit(None).cast("int"),
        "vehicle_id": F.col("vehicle_id"),
        "vehicle_label": F.lit(None).cast("string"),
        "license_plate": F.lit(None).cast("string"),
        "latitude": F.col("lat"),
        "longitude": F.col("lon"),
        "bearing": F.lit(None).cast("double"),
        "odometer": F.lit(None).cast("double"),
        "speed": F.lit(None).cast("double"),
        "stop_id": F.lit(None).cast("string"),
        "current_stop_sequence": F.lit(None).cast("int"),
        "current_status": F.lit(None).cast("int"),
        "occupancy_status": F.lit(None).cast("int"),
        "vehicle_timestamp": F.timestamp_seconds("vehicle_ts"),
        "date": F.to_date(feed),
        "ingested_at": feed,
    }
    return raw.select(*[cols[f.name].alias(f.name) for f in schemas.VEHICLE_POSITIONS.fields])


def _grid_ways(spark: SparkSession) -> DataFrame:
    """The fixed test grid as ways: 96 east-west streets of 9 vertices, 11 crossings of 2."""
    kind = F.explode(F.sequence(F.lit(1), F.lit(2))).alias("kind")
    r = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("r")
    j = F.explode(F.sequence(F.lit(0), F.lit(5))).alias("j")
    one = spark.range(1)
    mains = one.select(kind).select("kind", r).select("kind", "r", j)
    way_id = (1000 * F.col("kind") + 10 * F.col("r") + F.col("j")).cast("long")
    lat = F.lit(41.89) + F.col("r") * 0.001 + (F.col("kind") - 1) * 0.0001
    mains = mains.select(
        way_id.alias("way_id"),
        F.transform(
            F.sequence(F.lit(0), F.lit(8)),
            lambda s: F.struct(lat.alias("lat"), (F.lit(12.445) + F.col("j") * 0.04 + s * 0.005).alias("lon")),
        ).alias("geometry"),
    )
    cross = one.select(F.explode(F.sequence(F.lit(0), F.lit(10))).alias("j")).select(
        (3000 + F.col("j")).cast("long").alias("way_id"),
        F.array(
            F.struct((F.lit(41.8895) + F.col("j") * 0.0).alias("lat"), (F.lit(12.4475) + F.col("j") * 0.02).alias("lon")),
            F.struct((F.lit(41.8975) + F.col("j") * 0.0).alias("lat"), (F.lit(12.4475) + F.col("j") * 0.02).alias("lon")),
        ).alias("geometry"),
    )
    grid = mains.unionByName(cross)
    w = F.col("way_id")
    highway = F.when(w < 2000, "primary").when(w < 3000, "residential").otherwise("tertiary")
    return grid.select(
        "way_id",
        F.create_map(F.lit("highway"), highway, F.lit("name"), F.concat(F.lit("Street "), w.cast("string"))).alias("tags"),
        "geometry",
    )


def _block_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways built from blocks of eight consecutive events (so groups are bounded),
    placed north of latitude 41.95: far from every track and route line.

    Tags cycle through kept and dropped classes; some ways have one vertex, no
    vertex, no name, or lie outside the box, and service ways open to buses are
    listed twice, as a union of two source queries returns them.
    """
    ev = events(spark, sf_dir).select("event_id")
    b = F.floor(F.col("event_id") / 8).cast("long")
    pos = (F.col("event_id") % 8).cast("int")
    lat = F.when(b % 19 == 0, F.lit(45.0)).otherwise(F.lit(41.95) + (b % 120) * 0.001 + pos * 0.00001)
    lon = F.lit(12.25) + (F.floor(b / 120) % 40) * 0.01 + pos * 0.0002
    keep = ~((b % 13 == 0) & (pos > 0)) & (b % 17 != 0)
    vertices = ev.select(
        b.alias("block"),
        pos.alias("pos"),
        F.when(keep, F.struct(lat.alias("lat"), lon.alias("lon"))).alias("vertex"),
    )
    ways = vertices.groupBy("block").agg(
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("vertex").isNotNull(), F.struct("pos", "vertex")))),
            lambda x: x["vertex"],
        ).alias("geometry")
    )
    kind = F.col("block") % 7
    highway = F.element_at(
        F.array(*[F.lit(x) for x in ("primary", "residential", "service", "service", "footway", "living_street", "busway")]),
        (kind + 1).cast("int"),
    )
    name = F.when(F.col("block") % 9 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("Via "), F.col("block").cast("string"))
    )
    tags = F.when(
        kind == 2, F.create_map(F.lit("highway"), highway, F.lit("name"), name, F.lit("psv"), F.lit("yes"), F.lit("bus"), F.lit("designated"))
    ).otherwise(F.create_map(F.lit("highway"), highway, F.lit("name"), name))
    out = ways.select((F.col("block") + 100000).alias("way_id"), tags.alias("tags"), "geometry")
    copies = F.when(F.col("tags")["psv"] == "yes", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return out.select("*", F.explode(copies).alias("copy")).drop("copy")


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw street ways (way_id, tags map, geometry array<struct<lat,lon>>), as a
    downloaded extract would give them."""
    return _grid_ways(spark).unionByName(_block_ways(spark, sf_dir)).unionByName(_corner_ways(spark, sf_dir))


def _corner_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways of two vertices outside the box at its north-east corner, from the
    events: some cut the corner, others pass it by."""
    n = F.col("event_id")
    past = F.when(n % 2 == 0, F.lit(0.0)).otherwise(F.lit(0.002))
    corner = F.array(F.struct((F.lit(42.0985) + past).alias("lat"), F.lit(12.7505).alias("lon")),
                     F.struct((F.lit(42.1005) + past).alias("lat"), F.lit(12.7485).alias("lon")))
    return events(spark, sf_dir).where(n % 150 < 2).select(
        (n + 500_000_000).alias("way_id"), F.create_map(F.lit("highway"), F.lit("trunk")).alias("tags"),
        corner.alias("geometry"))


def _release_list():
    """The five releases as an array<struct<static_date, n>> literal."""
    return F.array(*[F.struct(F.to_date(F.lit(d)).alias("static_date"), F.lit(i).alias("n")) for i, d in enumerate(RELEASES)])


def _line_of(user) -> Column:
    """(r, block) of the route line that a user's trips run on: eight corridors, and
    a variant of each for every 64 users, so that lines grow with the events."""
    return F.struct((user % 8).alias("r"), F.floor(user / 64).cast("long").alias("block"))


def _line_id(line) -> Column:
    return F.concat(F.lit("S"), line["r"].cast("string"), F.lit("_"), line["block"].cast("string"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five releases; every trip is missing from some of them, and some trips
    have no line."""
    users = _ev(spark, sf_dir).select("user_id").distinct()
    u = users.select("user_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("i"))
    return (
        u.select("user_id", "i", F.inline(_release_list()))
        .where((F.col("user_id") + F.col("i") + F.col("n")) % 6 != 0)
        .select(
            "static_date",
            F.concat(F.lit("T"), F.col("user_id").cast("string"), F.lit("_"), F.col("i").cast("string")).alias("trip_id"),
            F.when((F.col("user_id") + 2 * F.col("i")) % 13 == 0, F.lit(""))
            .otherwise(_line_id(_line_of(F.col("user_id")))).alias("shape_id"),
        )
    )


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route lines of 25 points per release, from the users of the events; lines
    of corridor 2 move 1 m from the fourth release on. For every line there is
    one more that no trip uses."""
    lines = _ev(spark, sf_dir).select(_line_of(F.col("user_id")).alias("line")).distinct()
    pts = lines.select("line", F.explode(F.sequence(F.lit(0), F.lit(24))).alias("seq"),
                       ).select("line", "seq", F.explode(F.array(F.lit(""), F.lit("x"))).alias("spare"))
    r, block = F.col("line.r"), F.col("line.block")
    shift = F.when((r == 2) & (F.col("n") >= 3), F.lit(0.00001)).otherwise(F.lit(0.0))
    return pts.select("line", "seq", "spare", F.inline(_release_list())).select(
        "static_date",
        F.concat(_line_id(F.col("line")), "spare").alias("shape_id"),
        F.col("seq").cast("int").alias("seq"),
        (F.lit(41.89002) + r * 0.001 + shift + block * 0.000001).alias("lat"),
        (F.lit(12.44) + F.col("seq") * 0.01).alias("lon"),
    )
