"""Time grains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sunday_start(ts: Column) -> Column:
    return F.date_sub(F.to_date(ts), F.dayofweek(ts) - 1).cast("timestamp_ntz")


def _saturday_end(ts: Column) -> Column:
    return F.date_add(F.to_date(ts), 7 - F.dayofweek(ts)).cast("timestamp_ntz")


def _truncated(unit: str):
    return lambda ts: F.date_trunc(unit, ts).cast("timestamp_ntz")


GRAINS = {
    "second": _truncated("second"),
    "minute": _truncated("minute"),
    "hour": _truncated("hour"),
    "day": _truncated("day"),
    "week": _truncated("week"),
    "month": _truncated("month"),
    "quarter": _truncated("quarter"),
    "year": _truncated("year"),
    "week_ending_saturday": _saturday_end,
    "week_starting_sunday": _sunday_start,
}


def time_grain(ts: Column, grain: str | None) -> Column:
    """Start of the period that holds ``ts`` (its end for weeks that end on Saturday)."""
    if grain is None:
        return ts
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}; one of {', '.join(GRAINS)}")
    return GRAINS[grain](ts)
