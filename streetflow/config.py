"""Run parameters with the reference's defaults."""

from __future__ import annotations

import math
from dataclasses import dataclass

# Fixed values that must equal the reference's for identical results.
ZONE = "Europe/Rome"
LAT_MIN, LAT_MAX = 41.68, 42.10
LON_MIN, LON_MAX = 12.20, 12.75
EARTH_RADIUS_M = 6371000.0
M_PER_LAT = 111320.0
M_PER_LON = 82800.0
HIGHWAY_CLASSES = (
    "motorway", "trunk", "primary", "secondary", "tertiary", "unclassified",
    "residential", "living_street", "motorway_link", "trunk_link",
    "primary_link", "secondary_link", "tertiary_link", "busway",
)
SERVICE_ACCESS = ("yes", "designated")
SPEED_CLASS_EDGES = (5, 10, 15, 20, 30)
DOW_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
PALETTE = (
    (252, 206, 37), (252, 166, 54), (242, 132, 75), (225, 100, 98),
    (204, 71, 120), (177, 42, 144), (143, 13, 164),
)
WEEK_HOURS = 7 * 24


@dataclass(frozen=True)
class Config:
    """All tunables of the pipeline; defaults are the reference's values."""

    zone: str = ZONE
    history_days: int = 90
    freshness_max_lag_s: int = 60 * 60
    max_staleness_s: int = 120
    min_gap_s: int = 5
    max_gap_s: int = 90
    max_speed_kmh: float = 100.0
    lat_min: float = LAT_MIN
    lat_max: float = LAT_MAX
    lon_min: float = LON_MIN
    lon_max: float = LON_MAX
    earth_radius_m: float = EARTH_RADIUS_M
    m_per_lat: float = M_PER_LAT
    m_per_lon: float = M_PER_LON
    max_snap_m: float = 25.0
    min_span_m: float = 30.0
    grid_deg: float = 0.00025
    cell_step_m: float = 10.0
    line_step_m: float = 5.0
    # neighbour ring of the grid join: 1 = the reference's 3x3 search
    grid_ring: int = 1
    # True: the cells that an edge clips and a ring as wide as max_snap_m, so that
    # the nearest edge within max_snap_m is always found
    exact_radius: bool = False
    min_release_share: float = 0.8
    min_segments: int = 20
    min_day_share: float = 0.5
    baseline_days: int = 7
    min_street_share: float = 0.9
    highway_classes: tuple[str, ...] = HIGHWAY_CLASSES
    service_access: tuple[str, ...] = SERVICE_ACCESS
    # "crossing": ways with a spot in the box, as a map service's box query gives
    # them; "vertex": only ways with a vertex in it
    ways_in_box: str = "crossing"
    speed_class_edges: tuple[int, ...] = SPEED_CLASS_EDGES
    # Width of the time buckets that split one vehicle's track across tasks.
    # Must be at least max_gap_s so a segment never spans two non-adjacent buckets.
    track_bucket_s: int = 3600

    def __post_init__(self):
        if self.track_bucket_s < self.max_gap_s:
            raise ValueError("track_bucket_s must be >= max_gap_s")
        if self.ways_in_box not in ("crossing", "vertex"):
            raise ValueError("ways_in_box must be 'crossing' or 'vertex'")

    @property
    def ring(self) -> tuple[int, int]:
        """Cells that the grid join searches north and south, and east and west."""
        if not self.exact_radius:
            return self.grid_ring, self.grid_ring
        return (math.ceil(self.max_snap_m / (self.grid_deg * self.m_per_lat)),
                math.ceil(self.max_snap_m / (self.grid_deg * self.m_per_lon)))


DEFAULT = Config()
