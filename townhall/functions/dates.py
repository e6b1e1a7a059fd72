"""Timestamps, elapsed time and month keys (session time zone: UTC)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_HOUR = 3_600_000_000

# The years a nanosecond clock can hold in full.
FIRST_YEAR, LAST_YEAR = 1678, 2261


def parse_timestamp(c: Column) -> Column:
    """ISO-8601 text -> timestamp; unreadable or out-of-range -> null."""
    parsed = F.try_to_timestamp(c.cast("string"))
    return F.when(F.year(parsed).between(FIRST_YEAR, LAST_YEAR), parsed)


def not_before(c: Column, year: int = 2000) -> Column:
    """Drop sentinel dates from before ``year``."""
    return F.when(F.year(c) >= year, c)


def elapsed_micros(start: Column, end: Column) -> Column:
    return F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))


def micros_to_hours(c: Column) -> Column:
    return c / F.lit(float(MICROS_PER_HOUR))


def month_key(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")
