import datetime as dt

import pytest

from helpers import d, positions
from streetflow.operators import incremental as INC
from streetflow.operators import quality as QC

NOW = dt.datetime(2024, 4, 5, 12, 0, 0)
NOW_S = int(NOW.replace(tzinfo=dt.timezone.utc).timestamp())


def test_freshness(spark):
    for age, ok in ((3600, True), (3601, False)):
        df = positions(spark, [dict(vts=NOW_S - age, fts=NOW_S - age)])
        assert QC.freshness(df, NOW).first()["passed"] is ok
    empty = positions(spark, [dict(vts=NOW_S - 5 * 86400, fts=NOW_S - 5 * 86400)])
    assert QC.freshness(empty, NOW).first()["passed"] is False


def _daily(spark, counts):
    rows = []
    for day, n in counts.items():
        rows += [(d(day),)] * n
    return spark.createDataFrame(rows, "date_rome date")


def test_day_completeness(spark):
    base = {"2024-03-25": 10, "2024-03-26": 20, "2024-03-28": 30, "2024-03-31": 40}
    r = QC.day_completeness(_daily(spark, {**base, "2024-04-01": 12}), d("2024-04-01")).first()
    assert (r.passed, r.threshold) == (False, 12.5)
    assert QC.day_completeness(_daily(spark, {**base, "2024-04-01": 13}), d("2024-04-01")).first().passed
    r = QC.day_completeness(_daily(spark, {"2024-04-01": 1}), d("2024-04-01")).first()
    assert r.passed and r.skipped


def test_street_retention(spark):
    pub = spark.createDataFrame([(i,) for i in range(100)], "way_id long")
    for n, ok in ((89, False), (90, True)):
        new = spark.createDataFrame([(i,) for i in range(n)], "way_id long")
        assert QC.street_retention(new, pub).first().passed is ok
    assert QC.street_retention(pub, None).first().skipped


def test_failures_named_together(spark):
    pub = spark.createDataFrame([(i,) for i in range(100)], "way_id long")
    new = spark.createDataFrame([(1,)], "way_id long")
    stale = positions(spark, [dict(vts=NOW_S - 9000, fts=NOW_S - 9000)])
    with pytest.raises(AssertionError) as e:
        QC.raise_if_failed(QC.checks(QC.freshness(stale, NOW), QC.street_retention(new, pub)))
    assert "freshness" in str(e.value) and "street_retention" in str(e.value)


def _islands(spark, done, days, rebuild=False):
    return INC.islands(spark.createDataFrame([(d(x),) for x in done], "day date"), days, rebuild)


def test_day_ranges(spark):
    today = d("2024-04-05")
    last = d("2024-04-04")
    assert INC.span(today) == (d("2024-01-06"), last)
    assert _islands(spark, ["2024-04-03"], INC.span(today)) == [(last, last)]
    assert _islands(spark, ["2024-04-03", "2024-04-04"], INC.span(today)) == []
    assert _islands(spark, [], INC.span(today)) == [(d("2024-01-06"), last)]
    assert _islands(spark, ["2024-04-03"], INC.span(today), rebuild=True) == [(d("2024-01-06"), last)]
    # done days outside the history do not count; nor do days before the first
    assert _islands(spark, ["2023-12-01", "2024-04-09"], INC.span(today)) == [(d("2024-01-06"), last)]


def test_day_range_waits_for_the_schedule(spark):
    today = d("2024-04-05")
    days = INC.span(today, newest_release=d("2024-04-04"), gated=True)
    assert _islands(spark, ["2024-04-02"], days) == [(d("2024-04-03"), d("2024-04-03"))]
    assert INC.span(today, newest_release=None, gated=True) is None
    assert _islands(spark, ["2024-04-02"], INC.span(today, newest_release=d("2024-04-03"), gated=True)) == []


def test_holes_are_islands_of_their_own(spark):
    done = ["2024-03-20", "2024-03-23", "2024-03-24", "2024-03-26", "2024-04-03"]
    assert _islands(spark, done, INC.span(d("2024-04-05"))) == [
        (d("2024-03-21"), d("2024-03-22")), (d("2024-03-25"), d("2024-03-25")), (d("2024-03-27"), d("2024-04-02")),
        (d("2024-04-04"), d("2024-04-04"))]
