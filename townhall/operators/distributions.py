"""Histograms and paired measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _range(df: DataFrame, value: Column) -> DataFrame:
    return df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over the observed range; the last bin includes its right edge.

    Every bin is listed, empty ones with 0. One value only: the range is widened
    by a half on both sides. No values: no rows.
    """
    v = F.col(value)
    df = df.where(v.isNotNull())
    flat = F.col("lo") == F.col("hi")
    limits = _range(df, v).where(F.col("lo").isNotNull()).select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    limit = limits.select(F.struct("lo", "hi")).scalar()
    return _count_bins(df, v, limits, limit["lo"], limit["hi"], bins)


def _count_bins(df: DataFrame, v: Column, limits: DataFrame, lo: Column, hi: Column, bins: int) -> DataFrame:
    def edge(low: Column, high: Column, i) -> Column:
        return low + i * ((high - low) / bins)

    # comparing with each inner edge places values the way the edges are printed
    place = F.lit(1)
    for i in range(1, bins):
        place = place + (F.col("_v") >= edge(F.col("_lo"), F.col("_hi"), i)).cast("int")
    counts = (
        df.select(v.alias("_v"), lo.alias("_lo"), hi.alias("_hi"))
        .groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = limits.select("lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return frame.join(F.broadcast(counts), "bin", "left").select(  # at most one row per bin
        "bin",
        edge(F.col("lo"), F.col("hi"), F.col("bin") - 1).alias("left_edge"),
        F.when(F.col("bin") == bins, F.col("hi"))
        .otherwise(edge(F.col("lo"), F.col("hi"), F.col("bin"))).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _nice_step(width: Column) -> Column:
    """Smallest of 1, 2, 5 and 10 times a power of ten that is no less than ``width``."""
    power = F.pow(F.lit(10.0), F.floor(F.log10(width)))
    ratio = width / power
    return power * F.when(ratio <= 1, 1).when(ratio <= 2, 2).when(ratio <= 5, 5).otherwise(10)


def rounded_histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Bins of a round width (1, 2 or 5 times a power of ten) starting at a multiple of it.

    The width is the smallest round one of which ``bins`` span the observed range;
    as the first bin starts at a multiple there can be one bin more. Empty bins inside
    the range are listed.
    """
    v = F.col(value).cast("double")
    df = df.where(v.isNotNull())
    limits = _range(df, v).where(F.col("lo").isNotNull()).select(
        "lo", "hi",
        F.when(F.col("hi") > F.col("lo"), _nice_step((F.col("hi") - F.col("lo")) / bins))
        .otherwise(F.lit(1.0)).alias("step"),
    )
    limits = limits.select(
        "step",
        F.floor(F.col("lo") / F.col("step")).alias("first"),
        F.floor(F.col("hi") / F.col("step")).alias("last"),
    )
    step = limits.select("step").scalar()
    counts = (
        df.select(v.alias("_v"), step.alias("_step"))
        .groupBy(F.floor(F.col("_v") / F.col("_step")).alias("_k"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = limits.select("step", F.explode(F.sequence("first", "last")).alias("_k"))
    return frame.join(F.broadcast(counts), "_k", "left").select(  # at most bins + 1 rows
        (F.col("_k") * F.col("step")).alias("left_edge"),
        ((F.col("_k") + 1) * F.col("step")).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def views_vs_responses(posts: DataFrame, width: int = 25) -> DataFrame:
    """The paired measures of every post with a short label."""
    return posts.select(
        "id", "response_count", "view_count", "reaction_count", F.substring("title", 1, width).alias("label"))


def views_by_response_count(posts: DataFrame) -> DataFrame:
    return posts.groupBy("response_count").agg(
        F.count(F.lit(1)).alias("posts"), F.avg("view_count").alias("mean_views"))


def views_response_correlation(posts: DataFrame) -> DataFrame:
    return posts.agg(F.corr("response_count", "view_count").alias("correlation"))
