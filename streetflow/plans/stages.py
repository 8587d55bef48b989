"""The pipeline's stages as DataFrame -> DataFrame builders (no I/O).

bronze positions -> vehicle_segments                     (segments_stage)
street ways      -> street_edges                         (edges_stage)
schedule         -> shape_streets, trip_shape            (lines_stage)
segments + above -> segment_streets                      (segment_streets_stage)
segment_streets  -> street_speed (gold)                  (speed.street_speed)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetflow.config import DEFAULT, Config
from streetflow.operators import grid as G
from streetflow.operators import match as M
from streetflow.operators import schedule as SCH
from streetflow.operators import streets as ST


def edges_stage(ways: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return ST.edges(ST.select_ways(ways, cfg), cfg)


@dataclass
class Lines:
    hashes: DataFrame        # (static_date, shape_id, shape_hash) of used lines
    new_shapes: DataFrame    # (shape_hash, static_date, shape_id): representative of each new geometry
    search: DataFrame        # edges by the tiles that new geometries pass
    samples: DataFrame       # resampled points of new geometries
    matched: DataFrame       # nearest way per sample
    shape_streets: DataFrame
    trip_shape: DataFrame


def lines_stage(points: DataFrame, trips: DataFrame, edges: DataFrame, known_trip_shape: DataFrame | None = None,
                cfg: Config = DEFAULT, persist: bool = False) -> Lines:
    """Hash every used line, match only geometries not matched before (INC6).

    ``persist`` keeps the hashes (one row per release and line), which both
    outputs read, instead of computing them twice, and the edges near the lines, which
    are counted first."""
    trips = SCH.trips_with_shape(trips)
    hashes = SCH.shape_hashes(SCH.used_points(points, trips))
    if persist:
        hashes = hashes.persist()
    new_shapes = SCH.representatives(hashes)
    if known_trip_shape is not None:
        new_shapes = SCH.unmatched(new_shapes, known_trip_shape)
    lines = M.line_points(points, new_shapes)
    samples = M.resample(lines, cfg)
    search = M.line_search(lines, edges, cfg)
    if persist:
        search = search.persist()
    matched = M.line_nearest_way(samples, edges, cfg, G.small(search) if persist else search)
    shape_streets = M.shape_streets(matched, ST.street_length(edges), cfg)
    return Lines(hashes, new_shapes, search, samples, matched, shape_streets, SCH.trip_shape(trips, hashes))


def segment_streets_stage(segs: DataFrame, trip_shape: DataFrame, shape_streets: DataFrame, edges: DataFrame,
                          cfg: Config = DEFAULT) -> DataFrame:
    """Version lookup + route-restricted snap for segments with local time."""
    days = segs.select("date_rome").distinct()
    releases = trip_shape.select("static_date").distinct()
    versions = M.day_versions(days, releases)
    trip_hashes = M.trip_lookup(versions, trip_shape)
    # lines of the releases in play; the lookup itself is planned once
    needed = trip_shape.join(F.broadcast(versions.select("static_date").distinct()), "static_date", "left_semi")
    redges = M.route_edges(shape_streets, needed, edges)
    return M.segment_streets(segs, trip_hashes, redges, edges, cfg)
