"""Physical-plan properties that matter at scale."""

import datetime as dt

from streetflow.operators import positions as P
from streetflow.plans import daily
from streetflow.plans import views as V

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bronze_scan_is_partition_pruned(spark):
    store = V.world(spark, SF)
    scan = P.days_between(store.read(daily.BRONZE), dt.date(2024, 3, 28), dt.date(2024, 3, 29))
    p = _plan(scan)
    assert "PartitionFilters: [isnotnull(date" in p and "2024-03-27" in p


def test_dedupe_limits_before_shuffle(spark):
    store = V.world(spark, SF)
    p = _plan(P.dedupe(store.read(daily.BRONZE)))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_segment_matching_has_no_cartesian_or_python(spark):
    df = V.segment_nearest_way(spark, SF)
    p = _plan(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, bad


def test_street_speed_uses_partial_aggregation(spark):
    p = _plan(V.street_speed(spark, SF))
    assert "partial_percentile_approx" in p and "partial_collect_set" in p and "Expand" not in p


def test_points_of_lines_are_never_broadcast(spark):
    """AQE goes by the points' size before they expand: 42 MB went to the driver at 6 times sf0.1."""
    from pyspark.sql import functions as F

    from streetflow.operators import match as M

    lines = spark.range(50).select(F.lit(dt.date(2024, 4, 1)).alias("static_date"),
                                   F.col("id").cast("string").alias("shape_id")).distinct()
    points = lines.select("*", F.explode(F.sequence(F.lit(1), F.lit(2000))).alias("seq")).select(
        "*", F.lit(41.9).alias("lat"), (F.col("seq") / 1000).alias("lon"))
    got = M.line_points(points, lines.withColumn("shape_hash", F.md5("shape_id")))
    assert got.count() == 100_000
    p = _plan(got)
    assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p, p


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_segments_and_gold_stay_in_the_jvm(spark):
    from streetflow.operators import segments as S

    store = V.world(spark, SF)
    for df in (S.vehicle_segments(store.read(daily.BRONZE)), V.street_speed(spark, SF), V.map_slot(spark, SF)):
        p = _plan(df)
        for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "CartesianProduct"):
            assert bad not in p, bad


def test_segments_take_one_scan_and_one_shuffle(spark):
    """De-duplication and pairing share one clustering by vehicle and bucket."""
    from streetflow.operators import segments as S

    store = V.world(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it will run
    try:
        p = _plan(S.vehicle_segments(store.read(daily.BRONZE)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("FileScan") == 1 and p.count("Exchange ") == 1 and p.count("Sort [") == 1, p
