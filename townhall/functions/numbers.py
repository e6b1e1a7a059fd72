"""Tolerant numeric coercion and the rounding rules of the report."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_DECIMAL = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_count(c: Column) -> Column:
    """Text or number -> bigint, toward zero; anything unreadable -> 0."""
    text = c.cast("string")
    whole = F.when(text.rlike(_INTEGER), F.trim(text).try_cast("bigint"))
    real = F.when(text.rlike(_DECIMAL), F.trim(text).try_cast("double").try_cast("bigint"))
    return F.coalesce(whole, real, F.lit(0).cast("bigint"))


def at_least_one(c: Column) -> Column:
    """Denominator floor: max(n, 1)."""
    return F.greatest(c, F.lit(1))


def zero_to_one(c: Column) -> Column:
    """Denominator guard that leaves every other value alone."""
    return F.when(c == 0, F.lit(1)).otherwise(c)


def percent_floor(part: Column, whole: Column) -> Column:
    """Percent cut to an integer; divides before it multiplies."""
    return (part / at_least_one(whole) * 100).cast("int")


def percent_even(part: Column, whole: Column) -> Column:
    """Percent rounded half-even to an integer."""
    return F.bround(part / zero_to_one(whole) * 100, 0).cast("int")


def round_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def complement(percent: Column) -> Column:
    return F.lit(100) - percent
