"""Days and timestamps, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def utc_date(instant: Column | str) -> Column:
    """UTC calendar day of a TIMESTAMP (an instant)."""
    instant = F.col(instant) if isinstance(instant, str) else instant
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86_400).cast("int"))


def day_of(wall_clock: Column | str) -> Column:
    """Calendar day of a TIMESTAMP_NTZ (wall-clock time)."""
    wall_clock = F.col(wall_clock) if isinstance(wall_clock, str) else wall_clock
    return wall_clock.cast("date")


def day_bucket(wall_clock: Column | str) -> Column:
    """Wall-clock time cut down to midnight of its day."""
    return day_of(wall_clock).cast("timestamp_ntz")
