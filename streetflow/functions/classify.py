"""Serving-side scalar functions: speed class, colours, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from streetflow.config import DOW_NAMES, PALETTE, SPEED_CLASS_EDGES


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def speed_class(value, edges=SPEED_CLASS_EDGES) -> Column:
    """0 for a value <= 0, NULL or NaN; else 1 + the number of edges strictly
    below the value, i.e. right-closed bins (0,5], (5,10], ... (SC17)."""
    v = _c(value)
    below = sum((F.when(v > F.lit(float(e)), 1).otherwise(0) for e in edges), F.lit(0))
    return F.when(v.isNull() | F.isnan(v) | (v <= 0), F.lit(0)).otherwise(below + 1).cast("int")


def moving_pct(share) -> Column:
    """Share as a whole percent, rounded half to even (SC18)."""
    return F.bround(_c(share) * 100).cast("int")


def weekday_name(dow) -> Column:
    """0..6 -> Monday..Sunday (SC19)."""
    return F.element_at(F.array(*[F.lit(n) for n in DOW_NAMES]), _c(dow) + 1)


def class_colour(cls) -> Column:
    """Palette entry of a speed class as array<int> (SC20)."""
    palette = F.array(*[F.array(*[F.lit(x) for x in rgb]) for rgb in PALETTE])
    return F.element_at(palette, _c(cls) + 1)


def css_rgb(colour) -> Column:
    """'rgb(r,g,b)' text of a colour (SC20)."""
    c = _c(colour)
    return F.format_string("rgb(%d,%d,%d)", c[0], c[1], c[2])
