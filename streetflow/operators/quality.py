"""Data-quality gates (DQ1-DQ4, AG1, AG10-AG12).

Each check is a one-row DataFrame ``(check, passed, skipped, value, limit, detail)``
computed by Spark; only these few rows ever reach the driver, in ``raise_if_failed``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetflow.config import DEFAULT, Config

CHECK_COLS = ["check_name", "passed", "skipped", "value", "threshold", "detail"]


def _row(check: str, passed, skipped, value, limit, detail) -> list:
    return [
        F.lit(check).alias("check_name"),
        passed.cast("boolean").alias("passed"),
        skipped.cast("boolean").alias("skipped"),
        value.cast("double").alias("value"),
        limit.cast("double").alias("threshold"),
        detail.cast("string").alias("detail"),
    ]


def freshness(positions: DataFrame, now: dt.datetime, cfg: Config = DEFAULT) -> DataFrame:
    """Newest snapshot since yesterday must be at most ``freshness_max_lag_s``
    old (DQ1, AG1). No rows since yesterday fails. ``now`` is a UTC datetime."""
    utc = now if now.tzinfo else now.replace(tzinfo=dt.timezone.utc)  # naive means UTC
    since = utc.astimezone(dt.timezone.utc).date() - dt.timedelta(days=1)
    lag = F.lit(int(utc.timestamp())) - F.unix_seconds(F.max("feed_timestamp"))
    agg = positions.where(F.col("date") >= F.lit(since)).agg(lag.alias("lag_s"))
    lim = float(cfg.freshness_max_lag_s)
    return agg.select(*_row(
        "freshness",
        F.coalesce(F.col("lag_s") <= lim, F.lit(False)),
        F.lit(False),
        F.col("lag_s"),
        F.lit(lim),
        F.when(F.col("lag_s").isNull(), F.lit("none came since the day before"))
        .otherwise(F.format_string("the last one came %d minutes before the run", (F.col("lag_s") / 60).cast("long"))),
    ))


def day_completeness(segment_streets: DataFrame, yesterday: dt.date, cfg: Config = DEFAULT) -> DataFrame:
    """Yesterday needs at least ``min_day_share`` of the median daily count of
    the ``baseline_days`` before it (DQ2, AG10, AG11). Days without rows are
    absent from the baseline, not zero; no baseline skips the check."""
    start = yesterday - dt.timedelta(days=cfg.baseline_days)
    daily = (
        segment_streets.where(F.col("date_rome").between(F.lit(start), F.lit(yesterday)))
        .groupBy("date_rome")
        .count()
    )
    y = F.lit(yesterday)
    agg = daily.agg(
        F.median(F.when(F.col("date_rome") < y, F.col("count"))).alias("usual"),
        F.coalesce(F.sum(F.when(F.col("date_rome") == y, F.col("count"))), F.lit(0)).alias("latest"),
    )
    limit = F.lit(cfg.min_day_share) * F.col("usual")
    skipped = F.col("usual").isNull()
    return agg.select(*_row(
        "day_completeness",
        skipped | (F.col("latest") >= limit),
        skipped,
        F.col("latest"),
        limit,
        F.format_string("the day has %d; the median of the days before it is %s", F.col("latest"), F.col("usual").cast("string")),
    ))


def street_retention(staging: DataFrame, published: DataFrame | None, cfg: Config = DEFAULT) -> DataFrame:
    """The new table needs at least ``min_street_share`` of the published
    streets (DQ3, AG12); skipped on the first publish."""
    if published is None:
        new = staging.agg(F.count_distinct("way_id").alias("streets"))
        return new.select(*_row("street_retention", F.lit(True), F.lit(True), F.col("streets"),
                                F.lit(None), F.lit("first publish")))
    both = (
        staging.select("way_id", F.lit(True).alias("_new"))
        .unionByName(published.select("way_id", F.lit(False).alias("_new")))
        .agg(
            F.count_distinct(F.when(F.col("_new"), F.col("way_id"))).alias("streets"),
            F.count_distinct(F.when(~F.col("_new"), F.col("way_id"))).alias("published"),
        )
    )
    limit = F.lit(cfg.min_street_share) * F.col("published")
    return both.select(*_row(
        "street_retention",
        F.col("streets") >= limit,
        F.lit(False),
        F.col("streets"),
        limit,
        F.format_string("staging holds %d ways, the published table %d", F.col("streets"), F.col("published")),
    ))


def checks(*results: DataFrame) -> DataFrame:
    """All check rows together (DQ4)."""
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def failures(check_rows: DataFrame) -> list[str]:
    """Failed checks as text; only the few check rows reach the driver."""
    failed = check_rows.where(~F.col("passed")).select("check_name", "detail").collect()
    return [f"{r['check_name']}: {r['detail']}" for r in failed]


def raise_if_failed(check_rows: DataFrame) -> None:
    """One error naming every failed check; nothing is published (DQ4)."""
    failed = failures(check_rows)
    if failed:
        raise AssertionError("failed checks: " + "; ".join(failed))


def run_report(edges: DataFrame, trip_shape: DataFrame, segments: DataFrame) -> DataFrame:
    """Row counts, distinct geometries and street kilometres of a run, as
    (metric, value) (AG17, AG13). Each table is read once."""
    number = lambda c: c.cast("double")
    tables = (
        edges.agg(number(F.count("*")).alias("edges"), F.round(F.sum("length_m") / 1000, 3).alias("street_km"),
                  number(F.count_distinct("way_id")).alias("ways")),
        trip_shape.agg(number(F.count_distinct("shape_hash")).alias("geometries"),
                       number(F.count_distinct("static_date")).alias("releases")),
        segments.agg(number(F.count("*")).alias("segments")),
    )
    out = None
    for t in tables:
        rows = t.unpivot([], list(t.columns), "metric", "value")
        out = rows if out is None else out.unionByName(rows)
    return out
