"""Cleaning and de-duplicating raw vehicle positions (FIL1-FIL3, WN1, SRC4, SRC5, SRC14)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetflow.config import DEFAULT, Config
from streetflow.functions.geo import in_box
from streetflow.functions.timefns import epoch_s


#: Order in which copies of a fix were seen.
FIRST_SIGHTING = ("feed_timestamp", "entity_id", "source_file")


def days_between(positions: DataFrame, start: dt.date, end: dt.date, date_col: str = "date") -> DataFrame:
    """Partition-pruned scan of a date range, starting one day early so the
    first day has its predecessor fixes (SRC14)."""
    return positions.where(F.col(date_col).between(F.lit(start - dt.timedelta(days=1)), F.lit(end)))


def clean(positions: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Drop fixes without time or vehicle, outside the box, or older than
    ``max_staleness_s`` at feed time (FIL1-FIL3). Future vehicle times pass."""
    return positions.where(
        F.col("vehicle_timestamp").isNotNull()
        & F.col("vehicle_id").isNotNull()
        & in_box("latitude", "longitude", cfg)
        & ((epoch_s("feed_timestamp") - epoch_s("vehicle_timestamp")) <= cfg.max_staleness_s)
    )


def dedupe(positions: DataFrame) -> DataFrame:
    """Keep the earliest sighting of every (vehicle, vehicle time) (WN1).

    Ties on feed time are broken by entity id and source file, so the result
    is deterministic. Planned as a top-1 window: Spark applies the limit per
    map partition before the shuffle, so a huge group of copies of one fix is
    cut down where it is read.
    """
    first_seen = Window.partitionBy("vehicle_id", "vehicle_timestamp").orderBy(*FIRST_SIGHTING)
    return positions.withColumn("_copy", F.row_number().over(first_seen)).where(F.col("_copy") == 1).drop("_copy")


def snapshot_ts(header: Column, newest: Column, on_missing_header: str = "null") -> Column:
    """A snapshot's time (SRC4): its header's, or - with ``"max"`` - where it has none
    the newest of its vehicles'. The one rule for all readers of snapshots."""
    if on_missing_header not in ("null", "max"):
        raise ValueError("on_missing_header must be 'null' or 'max'")
    return F.coalesce(header, newest) if on_missing_header == "max" else header


def snapshot_time(decoded: DataFrame, on_missing_header: str = "null") -> DataFrame:
    """Time of each snapshot file by ``snapshot_ts``. A file with no vehicle or no
    usable time is ``valid = false``.

    Input: one row per decoded entity with ``source_file, feed_timestamp,
    vehicle_timestamp`` (timestamps); a file with no entity has one row with a
    NULL ``entity_id``.
    """
    agg = decoded.groupBy("source_file").agg(
        snapshot_ts(F.max("feed_timestamp"), F.max("vehicle_timestamp"), on_missing_header).alias("snapshot_ts"),
        F.count("entity_id").alias("entities"),
    )
    return agg.select("source_file", "snapshot_ts", "entities",
                      ((F.col("entities") > 0) & F.col("snapshot_ts").isNotNull()).alias("valid"))


def land_if_absent(new_rows: DataFrame, landed: DataFrame | None, keys=("feed_timestamp", "entity_id")) -> DataFrame:
    """Rows of ``new_rows`` that are not landed yet (SRC5/SRC7): a second copy
    of a snapshot is dropped, never overwrites the first.

    ``keys`` are the snapshot's key and, where rows are finer than snapshots,
    the entity's. Of rows with equal keys the first delivered stays: the least
    ``delivered`` (if there is such a column), then source file. Rows whose
    entity is NULL cannot be told apart by key, so they count as a whole: all
    of the first file that delivers any for a snapshot land, and none if some
    are landed. Rows whose snapshot key is NULL are never taken for copies.
    Only rows of snapshots that are landed already are compared by entity.
    """
    snapshot, *entity = keys
    order = [c for c in ("delivered", "source_file") if c in new_rows.columns]
    first = Window.partitionBy(*keys).orderBy(*(order or keys))
    told = F.col(snapshot).isNotNull()
    for k in entity:
        told &= F.col(k).isNotNull()
    fresh = new_rows.where(told).withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy")
    untold = None
    if entity:
        untold = new_rows.where(F.col(snapshot).isNotNull() & ~told)
        if "source_file" in new_rows.columns:
            of = untold.groupBy(F.col(snapshot).alias("_snapshot")).agg(
                F.min(F.struct(*order))["source_file"].alias("_file"))
            untold = untold.join(of, (F.col(snapshot) == F.col("_snapshot")) & (F.col("source_file") == F.col("_file")),
                                 "left_semi")
    if landed is not None:
        times = landed.select(snapshot).distinct()
        again = fresh.join(times, snapshot, "left_semi")
        known = landed.select(*keys).join(fresh.select(snapshot).distinct(), snapshot, "left_semi").distinct()
        fresh = fresh.join(times, snapshot, "left_anti").unionByName(again.join(known, list(keys), "left_anti"))
        if untold is not None:
            some = landed.where(" or ".join(f"{k} is null" for k in entity)).select(snapshot).distinct()
            untold = untold.join(some, snapshot, "left_anti")
    out = fresh if untold is None else fresh.unionByName(untold)
    return out.unionByName(new_rows.where(F.col(snapshot).isNull())).select(*new_rows.columns)
