"""The batch report: every section as one lazy frame over the same typed posts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from townhall.functions import text as tx
from townhall.operators import distributions, metrics, ranking, terms
from townhall.operators.filters import having

# The columns of the full table, in order.
FULL_TABLE = [
    "title", "author", "view_count", "response_count", "reaction_count", "has_answer", "channel", "created_date",
]


def post_text() -> Column:
    return tx.joined(F.col("title"), F.col("body"))


def full_table(posts: DataFrame) -> DataFrame:
    return posts.orderBy(F.desc("view_count"), F.asc("id")).select("id", *FULL_TABLE)


def listing(posts: DataFrame, k: int = 10) -> DataFrame:
    """The top posts as printed lines: padded views, cut title."""
    return ranking.top_posts(posts, k).select(
        "id",
        F.concat(
            tx.pad_left(tx.thousands(F.col("view_count")), 5), F.lit("  "), tx.prefix(F.col("title"), 50)
        ).alias("line"),
    )


def sections(posts: DataFrame, stopwords=terms.ENGLISH_STOPWORDS) -> dict[str, Callable[[], DataFrame]]:
    """Sections of the single-community report, each planned when it is called for."""
    texts = posts.select(post_text().alias("text"))
    return {
        "overview": lambda: metrics.overview(posts),
        "top_posts": lambda: ranking.top_posts(posts),
        "views_vs_responses": lambda: distributions.views_vs_responses(posts),
        "response_times": lambda: distributions.histogram(
            having(posts, "latest_response_hours"), "latest_response_hours"),
        "response_lines": lambda: metrics.response_lines(posts),
        "monthly_posts": lambda: metrics.monthly_posts(posts).orderBy("month"),
        "terms": lambda: terms.most_frequent(terms.cloud_counts(texts, "text", stopwords), terms.OVERVIEW_TERMS),
        "author_activity": lambda: metrics.author_activity(posts).orderBy(F.desc("total_views"), F.asc("author")),
        "full_table": lambda: full_table(posts),
    }


def report(posts: DataFrame, stopwords=terms.ENGLISH_STOPWORDS) -> dict[str, DataFrame]:
    """All sections as lazy frames. Keep ``posts`` in memory or as a table when using several."""
    return {name: section() for name, section in sections(posts, stopwords).items()}
