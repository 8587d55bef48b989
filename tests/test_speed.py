import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from streetflow.config import DEFAULT
from streetflow.operators import positions as P
from streetflow.operators import speed as SP


def _ss(spark, groups):
    rows = []
    for way, speeds in groups.items():
        for i, v in enumerate(speeds):
            rows.append((dt.date(2024, 1, 1 + i % 3), 0, 8, f"V{i % 4}", f"R{i % 2}", way, None, "primary", v, 3.0))
    return spark.createDataFrame(rows, "date_rome date, dow int, hour_rome int, vehicle_id string, route_id string, "
                                       "way_id long, street string, highway string, speed_kmh double, snap_m double")


def test_min_segments_threshold(spark):
    out = SP.street_speed(_ss(spark, {1: [10.0] * 19, 2: [10.0] * 20})).collect()
    assert [(r.way_id, r.segments, r.vehicles, r.routes, r.days) for r in out] == [(2, 20, 4, 2, 3)]
    assert out[0].street is None


def test_median_is_lower_middle_and_moving_share(spark):
    low = dataclasses.replace(DEFAULT, min_segments=1)
    r = SP.street_speed(_ss(spark, {1: [float(x) for x in range(0, 20, 2)]}), low).first()
    assert r.median_speed_kmh == 8.0 and r.avg_speed_kmh == 9.0
    r = SP.street_speed(_ss(spark, {1: [1.0, 1.1]}), low).first()
    assert r.moving_share == 0.5


def test_geometry_in_seq_order(spark):
    edges = spark.createDataFrame([(7, 2, 1.2, 2.2, 1.3, 2.3), (7, 0, 1.0, 2.0, 1.1, 2.1), (7, 1, 1.1, 2.1, 1.2, 2.2)],
                                  "way_id long, seq long, from_lat double, from_lon double, to_lat double, to_lon double")
    pub = spark.createDataFrame([(7,)], "way_id long")
    path = SP.street_geometry(edges, pub).first().path
    assert path == [[2.0, 1.0], [2.1, 1.1], [2.2, 1.2], [2.3, 1.3]]


def test_snapshot_time_fallback(spark):
    ts = F.to_timestamp
    df = spark.createDataFrame([("a", None, "2024-01-01 10:00:05", "e1"), ("a", None, "2024-01-01 10:00:09", "e2"),
                                ("b", "2024-01-01 11:00:00", "2024-01-01 10:59:50", "e3"), ("c", None, None, None)],
                               "source_file string, f string, v string, entity_id string")
    df = df.select("source_file", ts("f").alias("feed_timestamp"), ts("v").alias("vehicle_timestamp"), "entity_id")
    off = {r.source_file: (r.snapshot_ts, r.valid) for r in P.snapshot_time(df).collect()}
    on = {r.source_file: (r.snapshot_ts, r.valid) for r in P.snapshot_time(df, "max").collect()}
    assert off["a"] == (None, False) and on["a"] == (dt.datetime(2024, 1, 1, 10, 0, 9), True)
    assert off["b"][1] and on["b"][0] == dt.datetime(2024, 1, 1, 11, 0)
    assert not off["c"][1] and not on["c"][1]
