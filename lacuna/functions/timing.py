"""Column expressions on elapsed time and time bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def elapsed_micros(start: Column, end: Column) -> Column:
    """``end - start`` in microseconds.

    Built from interval fields, so zone-less timestamps never pass through the
    session time zone.
    """
    gap = end - start

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), gap)

    return (
        part("DAY").cast("bigint") * 86_400_000_000
        + part("HOUR").cast("bigint") * 3_600_000_000
        + part("MINUTE").cast("bigint") * 60_000_000
        + (part("SECOND") * 1_000_000).cast("bigint")
    )


def hours_before(end: Column, at: Column) -> Column:
    """Hours from ``at`` to ``end`` as double; negative when ``at`` is later."""
    return elapsed_micros(at, end) / F.lit(3.6e9)


def time_bin(hours: Column, width: Column | int) -> Column:
    """Index of the bin counted backwards from the end point."""
    width = width if isinstance(width, Column) else F.lit(width)
    return F.floor(hours / width).cast("int")


def bin_start(hours: Column, width: int) -> Column:
    """Start of the bin in hours before the end point, as double."""
    return F.floor(hours / width).cast("double") * width


def capped_bin(hours: Column, width: int = 6, cap: int = 27) -> Column:
    """1-based bin, everything beyond ``cap`` counted in ``cap``."""
    return F.least(F.floor(hours / width).cast("int") + 1, F.lit(cap))


def whole_units(start: Column, end: Column, unit_seconds: int) -> Column:
    """Whole units between two times, rounded down (also when negative)."""
    return F.floor(elapsed_micros(start, end) / F.lit(unit_seconds * 1_000_000)).cast("int")


def days_truncated(start: Column, end: Column) -> Column:
    """Days between two times, rounded toward zero."""
    return (elapsed_micros(start, end) / F.lit(86_400_000_000)).cast("int")


def days_earlier(end: Column, days: int) -> Column:
    return end - F.make_dt_interval(days=F.lit(days))


def look_back(end: Column, at: Column, days: int) -> Column:
    """True when ``at`` lies in the ``days`` before ``end``, both ends included."""
    return at.between(days_earlier(end, days), end)
