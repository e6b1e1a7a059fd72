"""Top-k lists. Ties go to the smaller key, so results do not depend on row order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from townhall.functions import text as tx
from townhall.operators.filters import questions, shares, unanswered
from townhall.operators.metrics import author_rollup


def top(df: DataFrame, k: int, by: str, tie: str = "id") -> DataFrame:
    """The k largest by ``by``; each task keeps k rows and only those are merged."""
    return df.orderBy(F.desc(by), F.asc(tie)).limit(k)


def ascending(df: DataFrame, by: str, tie: str = "id") -> DataFrame:
    """A short list turned round for display."""
    return df.orderBy(F.asc(by), F.asc(tie))


def top_posts(posts: DataFrame, k: int = 10) -> DataFrame:
    return top(posts, k, "view_count")


def top_unanswered(posts: DataFrame, k: int = 10) -> DataFrame:
    return top(unanswered(questions(posts)), k, "view_count")


def top_questions(posts: DataFrame, k: int = 12) -> DataFrame:
    return top(questions(posts), k, "view_count")


def top_shares(posts: DataFrame, k: int = 5) -> DataFrame:
    return top(shares(posts), k, "reaction_count")


def hardest_question(posts: DataFrame, width: int = 55) -> DataFrame:
    """Title and views of the most viewed unanswered question, always one row."""
    rank = F.struct(F.col("view_count"), -F.col("id"))
    best = unanswered(questions(posts)).agg(
        F.max_by(F.struct("title", "view_count"), rank).alias("best"))
    return best.select(
        F.coalesce(tx.prefix(F.col("best.title"), width), F.lit("—")).alias("title"),
        F.coalesce(F.col("best.view_count"), F.lit(0)).alias("view_count"),
    )


def numbered(df: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """1-based positions. Only for short lists: it sorts in one task."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("int"))


def top_authors(posts: DataFrame, k: int = 15) -> DataFrame:
    listed = top(author_rollup(posts), k, "posts", "author")
    return numbered(listed, [F.desc("posts"), F.asc("author")])


def top_authors_by_views(posts: DataFrame, k: int = 12, among: int = 15) -> DataFrame:
    """Largest by views among the authors with the most posts."""
    return top(top(author_rollup(posts), among, "posts", "author"), k, "views", "author")
