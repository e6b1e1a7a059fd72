"""Mergeable sketches of who is there: distinct text keys by channel and month, for any range of them.

A sketch has a fixed size whatever it has seen; sketches of parts are united without the posts. Up to a few
thousand keys the estimate is nearly exact, beyond that its relative standard error is 1.04 / sqrt(2^k).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

LOG_CELLS = 14
STANDARD_ERROR = 1.04 / 2 ** (LOG_CELLS / 2)  # 0.8 %


def member_sketches(posts: DataFrame, key: str = "author", by: Sequence[str] = ("channel", "month")) -> DataFrame:
    """One row (by, sketch) to store; built in every task first, so a hot group is a few sketches when it moves."""
    return posts.where(F.col(key).isNotNull()).groupBy(*by).agg(F.hll_sketch_agg(key, LOG_CELLS).alias("sketch"))


def united(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stored sketches as one for each ``by``."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def members_about(sketches: DataFrame, by: Sequence[str] = (), name: str = "members_about") -> DataFrame:
    """About how many different keys the stored parts hold; 0 without a part."""
    return united(sketches, by).select(*by, F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias(name))


def agrees(about: Column, exact: Column, errors: float = 4.0) -> Column:
    """Whether an estimate lies within ``errors`` standard errors of the exact count."""
    return F.abs(about - exact) <= F.ceil(exact * errors * STANDARD_ERROR)
