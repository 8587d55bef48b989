"""Speed segments between consecutive fixes of a vehicle (WN1, WN2, FIL4-FIL8, SC9).

A vehicle's track is cut into time buckets of ``cfg.track_bucket_s`` seconds so
that one vehicle never lands in a single task, however many fixes it has. A fix
that lies within ``cfg.max_gap_s`` of its bucket's end also goes to the next
bucket, as context: whatever is earlier could not make a segment with a fix of
that bucket anyway, so the cut gives exactly the whole-track result. All copies
of a fix share its time and so travel together; copies are dropped and fixes
paired in the one clustering by (vehicle, bucket), after one scan and one
shuffle. A bucket holds at most one distinct fix per second.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetflow.config import DEFAULT, Config
from streetflow.functions.geo import haversine_m, speed_kmh
from streetflow.functions.timefns import epoch_s, local_date, local_hour
from streetflow.operators.positions import FIRST_SIGHTING

def pair_fixes(fixes: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Attach the previous fix of the same vehicle, across trips (WN2), and drop
    fixes without one (FIL4) or with none in the last ``max_gap_s`` seconds of
    the bucket before. Of copies of a fix the first sighting counts (WN1). Adds
    prev_ts, prev_lat, prev_lon, prev_trip_id.
    """
    at = epoch_s("vehicle_timestamp")
    own = F.floor(at / cfg.track_bucket_s).cast("long")
    late = (own + 1) * cfg.track_bucket_s - at <= cfg.max_gap_s
    spread = fixes.select(
        "*", own.alias("_own"), F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))).alias("_bucket"))
    track = Window.partitionBy("vehicle_id", "_bucket").orderBy("vehicle_timestamp", *FIRST_SIGHTING)
    # the sort of the first window serves the second
    single = spread.withColumn("_before", F.lag("vehicle_timestamp").over(track)).where(
        F.col("_before").isNull() | (F.col("_before") < F.col("vehicle_timestamp")))
    last = F.lag(F.struct("vehicle_timestamp", "latitude", "longitude", "trip_id")).over(track)
    return single.withColumn("_last", last).where("_last is not null and _own = _bucket").select(
        *fixes.columns, F.col("_last.vehicle_timestamp").alias("prev_ts"), F.col("_last.latitude").alias("prev_lat"),
        F.col("_last.longitude").alias("prev_lon"), F.col("_last.trip_id").alias("prev_trip_id"))


def segments(fixes: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Segments of consecutive fixes on the same trip with a 5..90 s gap and a
    speed up to 100 km/h (FIL4-FIL7, SC1, SC6, PRJ1). ``fixes`` are cleaned
    positions, copies included. Output has the ``vehicle_segments`` columns
    except the local date and hour."""
    return between(pair_fixes(fixes, cfg), cfg)


def between(paired: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Fixes with their previous one -> segments (FIL5-FIL7, SC1, SC6, PRJ1)."""
    duration = epoch_s("vehicle_timestamp") - epoch_s("prev_ts")
    seg = (
        paired.where(F.col("trip_id") == F.col("prev_trip_id"))
        .withColumn("duration_s", duration)
        .where(F.col("duration_s").between(cfg.min_gap_s, cfg.max_gap_s))
        .withColumn("distance_m", haversine_m("prev_lat", "prev_lon", "latitude", "longitude", cfg.earth_radius_m))
        .withColumn("speed_kmh", speed_kmh("distance_m", "duration_s"))
        .where(F.col("speed_kmh") <= cfg.max_speed_kmh)
    )
    return seg.select(
        "vehicle_id",
        "trip_id",
        "route_id",
        "direction_id",
        F.col("prev_ts").alias("from_ts"),
        F.col("vehicle_timestamp").alias("to_ts"),
        "duration_s",
        "distance_m",
        "speed_kmh",
        F.col("prev_lat").alias("from_lat"),
        F.col("prev_lon").alias("from_lon"),
        F.col("latitude").alias("to_lat"),
        F.col("longitude").alias("to_lon"),
    )


def with_local_time(segs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Add date_rome and hour_rome of the segment end (SC9)."""
    return segs.withColumn("date_rome", local_date("to_ts", cfg.zone)).withColumn(
        "hour_rome", local_hour("to_ts", cfg.zone)
    )


def local_days(segs: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Keep segments whose local date is in start..end (FIL8)."""
    return segs.where(F.col("date_rome").between(F.lit(start), F.lit(end)))


def vehicle_segments(positions: DataFrame, cfg: Config = DEFAULT, start: dt.date | None = None,
                     end: dt.date | None = None) -> DataFrame:
    """Bronze positions -> silver ``vehicle_segments`` rows for local days
    start..end (all days when no range is given)."""
    from streetflow.operators import positions as P

    src = positions
    if start is not None and end is not None:
        src = P.days_between(src, start, end)
    segs = with_local_time(segments(P.clean(src, cfg), cfg), cfg)
    if start is not None and end is not None:
        segs = local_days(segs, start, end)
    return segs
