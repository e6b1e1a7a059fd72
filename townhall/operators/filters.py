"""Report filters and the option lists behind them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from townhall.functions.labels import QUESTION, SHARE


@dataclass(frozen=True)
class PostFilter:
    """Channel, type label and months; an unset part filters nothing."""

    channel: str | None = None
    type_label: str | None = None
    months: tuple[str, ...] = field(default_factory=tuple)

    def apply(self, posts: DataFrame) -> DataFrame:
        if self.channel is not None:
            posts = posts.where(F.col("channel") == self.channel)
        if self.type_label is not None:
            posts = posts.where(F.col("type_label") == self.type_label)
        if self.months:
            posts = posts.where(F.col("month").isin(*self.months))
        return posts


def of_type(posts: DataFrame, label: str) -> DataFrame:
    return posts.where(F.col("type_label") == label)


def questions(posts: DataFrame) -> DataFrame:
    return of_type(posts, QUESTION)


def shares(posts: DataFrame) -> DataFrame:
    return of_type(posts, SHARE)


def unanswered(posts: DataFrame) -> DataFrame:
    return posts.where(~F.col("has_responses"))


def having(posts: DataFrame, *columns: str) -> DataFrame:
    """Rows with none of ``columns`` null."""
    return posts.dropna(subset=list(columns))


def options(posts: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values offered for a filter."""
    return having(posts, column).select(F.col(column).alias("option")).distinct().orderBy("option")


def filter_options(posts: DataFrame, columns=("channel", "type_label", "month")) -> DataFrame:
    """Every filter's options in one pass over the posts."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("filter"), F.col(c).alias("option")) for c in columns])
    )
    return (
        posts.select(pairs.alias("o"))
        .select("o.*")
        .where(F.col("option").isNotNull())
        .distinct()
    )
