"""Which days a run processes (INC1, INC2, AG2, AG3).

Every day of the history up to yesterday that has not been worked on is missing,
also one between days that have been. Missing days come in islands, each of
which is a unit of work.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetflow.config import DEFAULT, Config


def span(today: dt.date, newest_release: dt.date | None = None, gated: bool = False,
         cfg: Config = DEFAULT) -> tuple[dt.date, dt.date] | None:
    """(first, last) of the days that the history should have (SC10): today -
    history_days to yesterday. When ``gated`` a day also waits for the next day's
    schedule: last = min(yesterday, newest_release - 1), and no release at all
    means nothing to do."""
    end = today - dt.timedelta(days=1)
    if gated:
        if newest_release is None:
            return None
        end = min(end, newest_release - dt.timedelta(days=1))
    return today - dt.timedelta(days=cfg.history_days), end


def missing_days(done: DataFrame, first: dt.date, last: dt.date, rebuild: bool = False) -> DataFrame:
    """(start_date, end_date) of each island of days in first..last that are not in
    ``done`` (day). Days before the earliest of ``done`` are not missing: history
    begins there. With none, or on a rebuild, all of first..last is one island.

    Gaps and islands over a calendar: days of an island have the same distance
    to their rank. The windows run over one row per day of the history."""
    worked_on = done.where(F.lit(not rebuild) & F.col("day").isNotNull()).select("day", F.lit(1).alias("done"))
    calendar = done.sparkSession.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("day"), F.lit(0).alias("done"))
    upto, ever = Window.orderBy("day"), Window.partitionBy(F.lit(0))
    open_days = (
        calendar.unionByName(worked_on).groupBy("day").agg(F.max("done").alias("done"))
        .withColumn("begun", F.max("done").over(upto)).withColumn("any", F.max("done").over(ever))
        .where(F.expr("done = 0 and begun = any")).where(F.col("day").between(F.lit(first), F.lit(last)))
    )
    return open_days.withColumn("island", F.date_sub("day", F.row_number().over(upto))).groupBy("island").agg(
        F.min("day").alias("start_date"), F.max("day").alias("end_date")).select("start_date", "end_date")


def islands(done: DataFrame, days: tuple[dt.date, dt.date] | None, rebuild: bool = False) -> list[tuple[dt.date, dt.date]]:
    """The missing days as the jobs work them off, earliest first: a few dates."""
    if days is None or days[0] > days[1]:
        return []
    return [tuple(r) for r in missing_days(done, *days, rebuild).orderBy("start_date").collect()]
