"""Explicit schemas of every table the pipeline reads or writes."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _s(*fields):
    return StructType([StructField(n, t) for n, t in fields])


# One decoded vehicle entity of a snapshot; epochs are seconds.
SNAPSHOT_ENTITY = _s(
    ("feed_timestamp", LongType()), ("entity_id", StringType()), ("is_deleted", BooleanType()),
    ("trip_id", StringType()), ("route_id", StringType()), ("direction_id", IntegerType()),
    ("start_date", StringType()), ("start_time", StringType()), ("schedule_relationship", IntegerType()),
    ("vehicle_id", StringType()), ("vehicle_label", StringType()), ("license_plate", StringType()),
    ("latitude", DoubleType()), ("longitude", DoubleType()), ("bearing", DoubleType()),
    ("odometer", DoubleType()), ("speed", DoubleType()),
    ("stop_id", StringType()), ("current_stop_sequence", IntegerType()),
    ("current_status", IntegerType()), ("occupancy_status", IntegerType()),
    ("vehicle_timestamp", LongType()),
)

VEHICLE_POSITIONS = _s(
    ("source_file", StringType()), ("feed_timestamp", TimestampType()), ("entity_id", StringType()),
    ("is_deleted", BooleanType()), ("trip_id", StringType()), ("route_id", StringType()),
    ("direction_id", IntegerType()), ("start_date", StringType()), ("start_time", StringType()),
    ("schedule_relationship", IntegerType()), ("vehicle_id", StringType()), ("vehicle_label", StringType()),
    ("license_plate", StringType()), ("latitude", DoubleType()), ("longitude", DoubleType()),
    ("bearing", DoubleType()), ("odometer", DoubleType()), ("speed", DoubleType()),
    ("stop_id", StringType()), ("current_stop_sequence", IntegerType()), ("current_status", IntegerType()),
    ("occupancy_status", IntegerType()), ("vehicle_timestamp", TimestampType()), ("date", DateType()),
    ("ingested_at", TimestampType()),
)

#: One row per snapshot that has landed.
LANDED_SNAPSHOTS = _s(("feed_timestamp", TimestampType()), ("date", DateType()))

VEHICLE_SEGMENTS = _s(
    ("vehicle_id", StringType()), ("trip_id", StringType()), ("route_id", StringType()),
    ("direction_id", IntegerType()), ("from_ts", TimestampType()), ("to_ts", TimestampType()),
    ("duration_s", LongType()), ("distance_m", DoubleType()), ("speed_kmh", DoubleType()),
    ("from_lat", DoubleType()), ("from_lon", DoubleType()), ("to_lat", DoubleType()),
    ("to_lon", DoubleType()), ("date_rome", DateType()), ("hour_rome", IntegerType()),
)

WAYS = _s(
    ("way_id", LongType()),
    ("tags", MapType(StringType(), StringType())),
    ("geometry", ArrayType(_s(("lat", DoubleType()), ("lon", DoubleType())))),
)

STREET_EDGES = _s(
    ("way_id", LongType()), ("street", StringType()), ("highway", StringType()), ("seq", LongType()),
    ("from_lat", DoubleType()), ("from_lon", DoubleType()), ("to_lat", DoubleType()),
    ("to_lon", DoubleType()), ("length_m", DoubleType()),
)

RELEASE_FILE = _s(("static_date", DateType()), ("length", LongType()), ("content", BinaryType()))
SHAPE_POINTS = _s(("static_date", DateType()), ("shape_id", StringType()), ("seq", IntegerType()),
                  ("lat", DoubleType()), ("lon", DoubleType()))
TRIPS = _s(("static_date", DateType()), ("trip_id", StringType()), ("shape_id", StringType()))
TRIP_SHAPE = _s(("static_date", DateType()), ("trip_id", StringType()), ("shape_id", StringType()),
                ("shape_hash", StringType()))
SHAPE_STREETS = _s(("shape_hash", StringType()), ("way_id", LongType()), ("points", LongType()),
                   ("snap_m", DoubleType()), ("street_m", DoubleType()), ("span_m", DoubleType()))
SEGMENT_STREETS = _s(
    ("date_rome", DateType()), ("dow", IntegerType()), ("hour_rome", IntegerType()),
    ("vehicle_id", StringType()), ("route_id", StringType()), ("way_id", LongType()),
    ("street", StringType()), ("highway", StringType()), ("speed_kmh", DoubleType()), ("snap_m", DoubleType()),
)
STREET_SPEED = _s(
    ("way_id", LongType()), ("street", StringType()), ("highway", StringType()), ("dow", IntegerType()),
    ("hour_rome", IntegerType()), ("segments", LongType()), ("vehicles", LongType()), ("routes", LongType()),
    ("days", LongType()), ("avg_speed_kmh", DoubleType()), ("median_speed_kmh", DoubleType()),
    ("moving_share", DoubleType()), ("snap_m", DoubleType()),
)
STREET_GEOMETRY = _s(("way_id", LongType()), ("path", ArrayType(ArrayType(DoubleType()))))

BINARY_FILE = _s(
    ("path", StringType()), ("modificationTime", TimestampType()), ("length", LongType()), ("content", BinaryType())
)
