import datetime as dt
import math

from pyspark.sql import functions as F

from streetflow.functions import classify, geo, timefns


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_grid_cell_floors(spark):
    assert one(spark, geo.grid_cell(F.lit(-0.0001))) == -1
    assert one(spark, geo.grid_cell(F.lit(0.0001))) == 0


def test_point_edge_distance_cases(spark):
    # zero-length edge: distance to its start
    z = one(spark, geo.point_edge_m(F.lit(41.9001), F.lit(12.5), F.lit(41.9), F.lit(12.5), F.lit(41.9), F.lit(12.5)))
    assert abs(z - 0.0001 * 111320) < 1e-6
    # beyond the end: distance to that end
    b = one(spark, geo.point_edge_m(F.lit(41.9), F.lit(12.502), F.lit(41.9), F.lit(12.5), F.lit(41.9), F.lit(12.501)))
    assert abs(b - 0.001 * 82800) < 1e-6
    # beside the middle: perpendicular
    m = one(spark, geo.point_edge_m(F.lit(41.9001), F.lit(12.5005), F.lit(41.9), F.lit(12.5), F.lit(41.9), F.lit(12.501)))
    assert abs(m - 0.0001 * 111320) < 1e-6


def test_haversine_matches_python(spark):
    h = one(spark, geo.haversine_m(F.lit(41.9), F.lit(12.5), F.lit(41.91), F.lit(12.52)))
    la1, lo1, la2, lo2 = map(math.radians, (41.9, 12.5, 41.91, 12.52))
    a = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    assert abs(h - 2 * 6371000 * math.asin(math.sqrt(a))) < 1e-6


def test_local_time_across_dst(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 30, 23, 30),), (dt.datetime(2024, 3, 31, 1, 30),)],
                               "ts timestamp")
    rows = df.select(timefns.local_date("ts").alias("d"), timefns.local_hour("ts").alias("h")).collect()
    assert [(r.d, r.h) for r in rows] == [(dt.date(2024, 3, 31), 0), (dt.date(2024, 3, 31), 3)]


def test_weekday_monday_is_zero(spark):
    assert one(spark, timefns.weekday(F.lit(dt.date(2024, 1, 1)))) == 0


def test_speed_class_right_closed_bins(spark):
    vals = [0.0, None, float("nan"), 5.0, 5.1, 30.0, 30.1]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert [r[0] for r in df.select(classify.speed_class("v")).collect()] == [0, 0, 0, 1, 2, 5, 6]


def test_moving_pct_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.29,)], "s double")
    assert [r[0] for r in df.select(classify.moving_pct("s")).collect()] == [12, 29]


def test_colour_and_names(spark):
    assert one(spark, classify.css_rgb(classify.class_colour(F.lit(0)))) == "rgb(252,206,37)"
    assert one(spark, classify.weekday_name(F.lit(6))) == "Sunday"


def test_speed_zero_duration_is_null(spark):
    assert one(spark, geo.speed_kmh(F.lit(10.0), F.lit(0))) is None
