"""One cube for every choice of the report's filters.

Posts are added up once to a row for each author within channel, type and month, which is written. Every slice of
an author is added up where the author's rows are, so these are moved once and not once a slice. "All" is the slice
in which a column is rolled up; a slice is told apart by its id, as ``grouping_id`` gives it, so a missing channel is
a value like any other and not "All". Figures of several months are sums over slices. Who posts cannot be summed:
``members`` keeps the authors of the slices of one month, and authors of several months are counted from those, still
without reading a post.

Medians are not in the cube, as they do not add up.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from townhall.functions import numbers, text as tx
from townhall.functions.labels import QUESTION
from townhall.operators.filters import PostFilter
from townhall.operators.medians import attach
from townhall.session import settle

COLUMNS = ("channel", "type_label", "month")
SUMS = ("posts", "ids", "total_views", "questions", "responded", "unanswered", "asked_open", "anonymous")
AUTHORS = ("authors", "one_time", "repeat")
AUTHOR_ROWS = 1 << 16  # rows of authors whose slices one task adds up, about; it holds each of them once a slice


def slice_id(*kept: str) -> int:
    """``grouping_id`` of the slice that tells ``kept`` apart: a bit is set for what is rolled up."""
    return sum(2 ** (len(COLUMNS) - 1 - i) for i, c in enumerate(COLUMNS) if c not in kept)


@dataclass(frozen=True)
class Cube:
    """``slices``: (slice, channel, type_label, month, sums, authors). ``members``: the authors of slices with a month."""

    slices: DataFrame
    members: DataFrame

    def write(self, path: str) -> None:
        self.slices.write.partitionBy("slice").parquet(f"{path}/slices")
        self.members.write.partitionBy("slice").parquet(f"{path}/members")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Cube:
        return cls(spark.read.parquet(f"{path}/slices"), spark.read.parquet(f"{path}/members"))


def _sums() -> list[Column]:
    asked = F.coalesce(F.col("type_label") == QUESTION, F.lit(False))
    answered = F.col("has_responses")
    return [
        F.count(F.lit(1)).alias("posts"), F.count("id").alias("ids"),
        F.coalesce(F.sum("view_count"), F.lit(0)).alias("total_views"),
        F.count_if(asked).alias("questions"), F.count_if(asked & answered).alias("responded"),
        F.count_if(~answered).alias("unanswered"), F.count_if(asked & ~answered).alias("asked_open"),
        F.count_if("is_anonymous").alias("anonymous"),
    ]


def _dealt(posts: DataFrame) -> DataFrame:
    """Figures of each author within channel, type and month, all rows of an author in one part."""
    # an author has at most a row for each option of the filters, however many posts
    fine = settle(posts.groupBy(*COLUMNS, "author").agg(*_sums()), "authors")
    return fine.repartition(max(1, -(-fine.count() // AUTHOR_ROWS)), "author")


def build(posts: DataFrame) -> Cube:
    """Both tables of the cube."""
    sets = [kept for n in range(len(COLUMNS) + 1) for kept in combinations(COLUMNS, n)]
    fine = _dealt(posts)
    each = F.explode(F.array(*[
        F.struct(F.lit(slice_id(*kept)).alias("slice"), *[
            (F.col(c) if c in kept else F.lit(None).cast(fine.schema[c].dataType)).alias(c) for c in COLUMNS])
        for kept in sets])).alias("at")
    by_author = fine.select("author", *SUMS, each).select("at.*", "author", *SUMS).groupBy("slice", *COLUMNS, "author").agg(
        *[F.sum(c).alias(c) for c in SUMS])
    named = F.col("author").isNotNull()
    slices = by_author.groupBy("slice", *COLUMNS).agg(
        *[F.sum(c).alias(c) for c in SUMS],
        F.count("author").alias("authors"),
        F.count_if(named & (F.col("posts") == 1)).alias("one_time"),
        F.count_if(named & (F.col("posts") > 1)).alias("repeat"),
    )
    with_month = F.col("slice").bitwiseAND(F.lit(slice_id("channel", "type_label"))) == 0
    members = by_author.where(with_month & named).select("slice", *COLUMNS, "author", "posts")
    return Cube(slices, members)


def _chosen(rows: DataFrame, chosen: PostFilter, by: tuple[str, ...]) -> DataFrame:
    """Rows of the slice that answers a choice, told apart by ``by`` as well; months lie one below the other."""
    kept = set(by)
    kept |= {"channel"} if chosen.channel is not None else set()
    kept |= {"type_label"} if chosen.type_label is not None else set()
    kept |= {"month"} if chosen.months else set()
    return chosen.apply(rows.where(F.col("slice") == slice_id(*kept)))


def figures(cube: Cube, chosen: PostFilter | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Sums and authors of a choice, one row for each ``by`` (channel, type_label or month; null ones too)."""
    chosen = chosen or PostFilter()
    sums = _chosen(cube.slices, chosen, by).groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS])
    if len(chosen.months) > 1 and "month" not in by:
        each = _chosen(cube.members, chosen, by).groupBy(*by, "author").agg(F.sum("posts").alias("posts"))
        people = each.groupBy(*by).agg(
            F.count(F.lit(1)).alias("authors"), F.count_if(F.col("posts") == 1).alias("one_time"),
            F.count_if(F.col("posts") > 1).alias("repeat"))
    else:
        people = _chosen(cube.slices, chosen, by).groupBy(*by).agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in AUTHORS])
    if not by:
        return attach(sums, people, list(AUTHORS))
    # both sides are as long as the filter's options; a group of posts without any author has no members
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"p.{c}")) for c in by]
    joined = sums.alias("s").join(people.alias("p"), same, "left")
    return joined.select("s.*", *[F.coalesce(f"p.{c}", F.lit(0)).alias(c) for c in AUTHORS])


def support_figures(cube: Cube, chosen: PostFilter | None = None) -> DataFrame:
    """The headline row without its median."""
    channels = figures(cube, chosen, ("channel",)).agg(F.count("channel").alias("channels"))
    row = figures(cube, chosen).withColumn("channels", channels.scalar())
    rate = numbers.percent_floor(F.col("responded"), F.col("questions"))
    return row.select(
        "posts", "total_views", "questions", "responded", "channels", rate.alias("response_rate"),
        numbers.complement(rate).alias("unanswered_rate"))


def channel_summary(cube: Cube, chosen: PostFilter | None = None) -> DataFrame:
    asked, open_posts = F.col("questions"), F.col("unanswered")
    return figures(cube, chosen, ("channel",)).where(F.col("channel").isNotNull()).select(
        "channel", F.col("ids").alias("posts"), "total_views", "questions", "unanswered", "authors",
        tx.percent_text(numbers.percent_even(asked - open_posts, asked)).alias("response_rate"),
        numbers.percent_floor(F.col("responded"), asked).alias("question_response_rate"))


def answered_by_channel(cube: Cube, chosen: PostFilter | None = None) -> DataFrame:
    rows = figures(cube, chosen, ("channel",)).where(F.col("channel").isNotNull() & (F.col("questions") > 0))
    return rows.select("channel", "questions", F.col("asked_open").alias("unanswered"),
                       (F.col("questions") - F.col("asked_open")).alias("answered"))


def poster_frequency(cube: Cube, chosen: PostFilter | None = None) -> DataFrame:
    return figures(cube, chosen).select(*AUTHORS)


def choices(cube: Cube) -> DataFrame:
    """Every choice of channel and type with its figures; "All" stands for a filter that is not set."""
    rows = cube.slices.where(F.col("slice").bitwiseAND(F.lit(1)) == 1)
    bit = {c: F.col("slice").bitwiseAND(F.lit(2 ** (len(COLUMNS) - 1 - i))) > 0 for i, c in enumerate(COLUMNS)}
    offered = [bit[c] | F.col(c).isNotNull() for c in COLUMNS[:2]]
    return rows.where(offered[0] & offered[1]).select(
        *[F.when(bit[c], "All").otherwise(F.col(c)).alias(c) for c in COLUMNS[:2]],
        "posts", "total_views", "questions", "responded", "unanswered", *AUTHORS)
