"""Street ways -> selected ways -> edges (SRC11, SRC12, SC16, GN5, AG6, DQ5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetflow.config import DEFAULT, Config
from streetflow.functions.geo import crosses_box, haversine_m, in_box


def _tag(name: str):
    # map lookup: a missing key is NULL (SC16)
    return F.col("tags").getItem(name)


def _in_box(geometry, cfg: Config):
    """Whether a way has a vertex, or by ``ways_in_box`` any spot, in the box."""
    vertex = F.exists(geometry, lambda p: in_box(p["lat"], p["lon"], cfg))
    if cfg.ways_in_box == "vertex":
        return vertex
    n = F.size(geometry)
    pieces = F.zip_with(F.slice(geometry, 1, n - 1), F.slice(geometry, 2, n - 1),
                        lambda a, b: crosses_box(a["lat"], a["lon"], b["lat"], b["lon"], cfg))
    return F.when(n >= 2, F.exists(pieces, lambda x: x)).otherwise(vertex)


def select_ways(ways: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Ways of the wanted classes in the box (SRC11, SRC12): those that have a spot in
    it, or with ``cfg.ways_in_box = "vertex"`` only those with a vertex in it.

    ``service`` roads count only when open to buses (``bus`` or ``psv`` is yes or
    designated). A way listed twice is kept once.
    """
    hw = _tag("highway")
    bus_ok = _tag("bus").isin(*cfg.service_access) | _tag("psv").isin(*cfg.service_access)
    wanted = hw.isin(*cfg.highway_classes) | ((hw == "service") & F.coalesce(bus_ok, F.lit(False)))
    return (
        ways.where(F.col("geometry").isNotNull() & (F.size("geometry") > 0))
        .where(wanted & _in_box(F.col("geometry"), cfg))
        .dropDuplicates(["way_id"])
    )


def edges(ways: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Split every way into consecutive vertex pairs, numbered from 0 (GN5).

    A single-vertex way gives no edge. Street name and class come from the tags.
    """
    g = F.col("geometry")
    n = F.size(g)
    pairs = F.when(
        n >= 2,
        F.zip_with(F.slice(g, 1, n - 1), F.slice(g, 2, n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
    ).otherwise(F.array().cast("array<struct<a:struct<lat:double,lon:double>,b:struct<lat:double,lon:double>>>"))
    out = ways.select(
        F.col("way_id").cast("long").alias("way_id"),
        _tag("name").alias("street"),
        _tag("highway").alias("highway"),
        F.posexplode(pairs).alias("seq", "pair"),
    )
    return out.select(
        "way_id",
        "street",
        "highway",
        F.col("seq").cast("long").alias("seq"),
        F.col("pair.a.lat").alias("from_lat"),
        F.col("pair.a.lon").alias("from_lon"),
        F.col("pair.b.lat").alias("to_lat"),
        F.col("pair.b.lon").alias("to_lon"),
    ).withColumn("length_m", haversine_m("from_lat", "from_lon", "to_lat", "to_lon", cfg.earth_radius_m))


def street_length(edges_df: DataFrame) -> DataFrame:
    """Total length per way (AG6)."""
    return edges_df.groupBy("way_id").agg(F.sum("length_m").alias("street_m"))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise before anything is overwritten when a source came back empty (DQ5)."""
    if df.isEmpty():
        raise RuntimeError(f"{what}: source is empty, table left untouched")
    return df
