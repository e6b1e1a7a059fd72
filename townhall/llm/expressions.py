"""Column helpers for expressions that stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, and only where the whole is needed."""
    return F.element_at(F.transform(F.array(value), body), 1)


def up_to(n: Column) -> Column:
    """0 to n - 1; empty for n below 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
