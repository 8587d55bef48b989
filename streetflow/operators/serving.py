"""Queries behind the map (SV1-SV5): every one is a plain Spark plan over the
two exported tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetflow.config import WEEK_HOURS
from streetflow.functions.classify import class_colour, css_rgb, moving_pct, speed_class, weekday_name

METRIC = "median_speed_kmh"


def load(street_speed: DataFrame, street_geometry: DataFrame) -> DataFrame:
    """Speeds with weekday names and [lon, lat] double paths (SV1, SC19, SC21, JN15)."""
    geo = street_geometry.select(
        "way_id", F.transform("path", lambda p: F.array(p[0].cast("double"), p[1].cast("double"))).alias("path")
    )
    return street_speed.withColumn("dow_name", weekday_name("dow")).join(geo, "way_id")


def select_slot(view: DataFrame, dow_name, hour) -> DataFrame:
    """One weekday and hour with speed class, colour, swatch text and moving
    percent, highest median first (SV2, FIL14, SC17, SC18, SC20, SO2).
    ``dow_name``/``hour`` may be literals or columns of a joined slot."""
    dn = F.lit(dow_name) if isinstance(dow_name, str) else dow_name
    hr = F.lit(hour) if isinstance(hour, int) else hour
    cls = speed_class(METRIC)
    return (
        view.where((F.col("dow_name") == dn) & (F.col("hour_rome") == hr))
        .withColumn("speed_class", cls)
        .withColumn("colour", class_colour(F.col("speed_class")))
        .withColumn("swatch", css_rgb(F.col("colour")))
        .withColumn("moving_pct", moving_pct("moving_share"))
        .orderBy(F.col(METRIC).desc())
    )


def nearest_slot(street_speed: DataFrame, now_local: dt.datetime) -> DataFrame:
    """The non-empty weekly slot nearest to ``now_local`` on the 168-hour
    circle; an equally distant past slot beats a future one (SV3, SO3).
    One row (dow, hour_rome); a global partial aggregate, no sort."""
    here = now_local.weekday() * 24 + now_local.hour
    slot = F.col("dow") * 24 + F.col("hour_rome")
    ahead = F.pmod(slot - F.lit(here), F.lit(WEEK_HOURS))
    behind = F.lit(WEEK_HOURS) - ahead
    best = street_speed.select(slot.alias("slot"), ahead.alias("ahead"), behind.alias("behind")).agg(
        F.min(F.struct(F.least("ahead", "behind").alias("d"), (F.col("ahead") < F.col("behind")).alias("future"),
                       F.col("slot"))).alias("best")
    )
    s = F.col("best.slot")
    return best.where(s.isNotNull()).select((s / 24).cast("int").alias("dow"), (s % 24).cast("int").alias("hour_rome"))


def legend_totals(view: DataFrame) -> DataFrame:
    """Measurements and the most days behind a slot (SV4, AG15); no row for an empty view."""
    return view.agg(
        F.sum("segments").alias("segments"), F.max("days").alias("days"), F.count(F.lit(1)).alias("streets")
    ).where(F.col("streets") > 0)


def street_table(view: DataFrame) -> DataFrame:
    """The street table, slowest median first (SV5, PRJ3)."""
    return view.select("street", METRIC, "avg_speed_kmh", "moving_share", "routes", "vehicles", "segments").orderBy(METRIC)
