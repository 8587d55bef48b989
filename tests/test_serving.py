import datetime as dt

from streetflow import schemas
from streetflow.operators import serving as SV


def _speed(spark, slots):
    return spark.createDataFrame([(s // 24, s % 24) for s in slots], "dow int, hour_rome int")


def _at(slot):
    # 2024-01-01 is a Monday
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=slot)


def test_nearest_slot(spark):
    def best(slots, now):
        r = SV.nearest_slot(_speed(spark, slots), _at(now)).first()
        return r.dow * 24 + r.hour_rome

    assert best([10, 30], 20) == 10
    assert best([20], 20) == 20
    assert best([2, 167], 0) == 167


def test_legend_empty_view(spark):
    v = spark.createDataFrame([], "segments long, days long")
    assert SV.legend_totals(v).count() == 0


def test_order_of_the_map_views(spark):
    """Drawn highest median first, so that slow streets lie on top; listed slowest first."""
    speed = spark.createDataFrame(
        [(w, f"S{w}", "primary", 1, 8, 30, 3, 1, 2, m, m, 0.5, 1.0) for w, m in ((1, 12.0), (2, 40.5), (3, 7.5), (4, 25.0))],
        schemas.STREET_SPEED).repartition(3)
    geometry = spark.createDataFrame([(w, [[12.5, 41.9], [12.6, 41.9]]) for w in (1, 2, 3, 4)], schemas.STREET_GEOMETRY)
    view = SV.load(speed, geometry)
    assert [r.median_speed_kmh for r in SV.select_slot(view, "Tuesday", 8).collect()] == [40.5, 25.0, 12.0, 7.5]
    assert [r.median_speed_kmh for r in SV.street_table(view).collect()] == [7.5, 12.0, 25.0, 40.5]
    assert SV.select_slot(view, "Tuesday", 9).count() == 0
