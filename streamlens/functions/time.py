"""Time conversions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UTC_EPOCH = "TIMESTAMP '1970-01-01 00:00:00Z'"
_LOCAL_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def utc_instant(ts: Column) -> Column:
    """A zone-less timestamp read as UTC (watermarks need an instant)."""
    return F.expr(_UTC_EPOCH) + (ts - F.expr(_LOCAL_EPOCH))


def utc_wall_clock(instant: Column) -> Column:
    """The UTC wall clock of an instant, as a zone-less timestamp."""
    return F.expr(_LOCAL_EPOCH) + (instant - F.expr(_UTC_EPOCH))


def epoch_day(ts: Column) -> Column:
    """Days since 1970-01-01 as a bigint."""
    return F.unix_date(F.to_date(ts)).cast("long")
