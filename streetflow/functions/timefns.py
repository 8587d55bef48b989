"""Time helpers: epoch seconds, local date/hour, weekday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from streetflow.config import DEFAULT


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_s(ts) -> Column:
    """Whole epoch seconds of a timestamp (SC8)."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def local_date(ts, zone: str = DEFAULT.zone) -> Column:
    """Calendar date in ``zone`` of a UTC instant, DST-aware (SC9). Needs a UTC session."""
    return F.to_date(F.from_utc_timestamp(_c(ts), zone))


def local_hour(ts, zone: str = DEFAULT.zone) -> Column:
    """Hour of day in ``zone`` of a UTC instant (SC9). Needs a UTC session."""
    return F.hour(F.from_utc_timestamp(_c(ts), zone))


def weekday(d) -> Column:
    """0 = Monday ... 6 = Sunday (SC11)."""
    return F.weekday(_c(d))
