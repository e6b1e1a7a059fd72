"""Engagement measures: headline figures, rollups and shares.

Null group keys are dropped before grouping, and every grouping keeps at most
one exact distinct count so no aggregate multiplies its input rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from townhall.functions import dates, numbers, text as tx
from townhall.functions.labels import QUESTION
from townhall.operators.filters import having, questions
from townhall.operators.medians import attach, bracketed_medians, exact_medians


def _rows() -> Column:
    return F.count(F.lit(1))


def _is_question() -> Column:
    return F.coalesce(F.col("type_label") == QUESTION, F.lit(False))


def _positive_micros() -> Column:
    return F.when(F.col("latest_response_micros") > 0, F.col("latest_response_micros"))


def _mean_hours(micros: Column) -> Column:
    """Mean in hours. The sum is a wide decimal: microseconds of a large table pass 64 bits."""
    total = F.sum(micros.cast("decimal(20,0)")).cast("double")
    return dates.micros_to_hours(total / F.count(micros))


# -- headline figures --------------------------------------------------------


def overview(posts: DataFrame) -> DataFrame:
    """Counts, views, answers, authors and mean response time of all posts."""
    base = posts.agg(
        _rows().alias("posts"),
        F.coalesce(F.sum("view_count"), F.lit(0)).alias("total_views"),
        F.avg("view_count").alias("mean_views"),
        F.coalesce(F.sum("response_count"), F.lit(0)).alias("total_responses"),
        F.count_if("has_answer").alias("answered"),
        F.count_distinct("author").alias("authors"),
        _mean_hours(F.col("latest_response_micros")).alias("mean_response_hours"),
    )
    medians = exact_medians(posts, {"median_views": F.col("view_count")})
    return attach(base, medians, ["median_views"])


def overview_text(figures: DataFrame) -> DataFrame:
    """The headline figures as they are displayed."""
    c = F.col
    return figures.select(
        tx.thousands(c("total_views")).alias("total_views"),
        tx.fixed(c("mean_views"), 0).alias("mean_views"),
        tx.fixed(c("median_views"), 0).alias("median_views"),
        tx.ratio_text(c("answered"), c("posts"), " / ").alias("answered"),
        tx.ratio_text(c("answered"), c("posts")).alias("answered_short"),
        F.concat(tx.fixed(c("mean_response_hours"), 1), F.lit(" hours")).alias("mean_response_time"),
    )


def support_figures(posts: DataFrame) -> DataFrame:
    """Posts, views, questions, response rate, median positive response time, channels."""
    is_question = _is_question()
    base = posts.agg(
        _rows().alias("posts"),
        F.coalesce(F.sum("view_count"), F.lit(0)).alias("total_views"),
        F.count_if(is_question).alias("questions"),
        F.count_if(is_question & F.col("has_responses")).alias("responded"),
        F.count_distinct("channel").alias("channels"),
    )
    base = base.withColumn("response_rate", numbers.percent_floor(F.col("responded"), F.col("questions")))
    base = base.withColumn("unanswered_rate", numbers.complement(F.col("response_rate")))
    medians = exact_medians(posts, {"_median": _positive_micros()})
    return (
        attach(base, medians, ["_median"])
        .withColumn("median_response_hours",
                    F.coalesce(dates.micros_to_hours(F.col("_median")), F.lit(0.0)))
        .drop("_median")
    )


def support_text(figures: DataFrame, channels_in_all: Column) -> DataFrame:
    """The support figures as they are displayed; channels out of all there are without a filter."""
    c = F.col
    return figures.select(
        tx.thousands(c("posts")).alias("posts"),
        tx.thousands(c("total_views")).alias("total_views"),
        tx.thousands(c("questions")).alias("questions"),
        tx.percent_text(c("response_rate")).alias("response_rate"),
        F.concat(tx.fixed(c("median_response_hours"), 0), F.lit(" hrs")).alias("median_response_time"),
        tx.ratio_text(c("channels"), channels_in_all, " / ").alias("channels"),
    )


def response_lines(posts: DataFrame, positive_only: bool = False) -> DataFrame:
    """Mean and median response time, the reference lines of the distribution."""
    micros = _positive_micros() if positive_only else F.col("latest_response_micros")
    base = posts.agg(_mean_hours(micros).alias("mean_hours"))
    medians = exact_medians(posts, {"_median": micros})
    return attach(base, medians, ["_median"]).select(
        "mean_hours", dates.micros_to_hours(F.col("_median")).alias("median_hours"))


# -- rollups -----------------------------------------------------------------


def group_sizes(posts: DataFrame, *by: str, name: str = "posts") -> DataFrame:
    return having(posts, *by).groupBy(*by).agg(_rows().alias(name))


def monthly_posts(posts: DataFrame) -> DataFrame:
    return group_sizes(posts, "month")


def monthly_by_type(posts: DataFrame) -> DataFrame:
    return group_sizes(posts, "month", "type_label")


def monthly_pivot(posts: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Month rows, one column per label; ``labels`` maps a label to its column name."""
    return having(posts, "month").groupBy("month").agg(
        *[F.count_if(F.col("type_label") == label).alias(name) for label, name in labels.items()])


def share_of_total(sizes: DataFrame, size: str = "posts") -> DataFrame:
    """Each group's percentage of all rows, over an already grouped frame."""
    total = sizes.agg(F.sum(size).alias("t")).scalar()
    return sizes.withColumn("share", F.col(size) / total * 100)


def type_share(posts: DataFrame) -> DataFrame:
    return share_of_total(group_sizes(posts, "type_label"))


def author_activity(posts: DataFrame) -> DataFrame:
    return having(posts, "author").groupBy("author").agg(
        F.count("title").alias("posts"),
        F.sum("view_count").alias("total_views"),
        F.sum("response_count").alias("total_responses"),
    )


def author_rollup(posts: DataFrame) -> DataFrame:
    return having(posts, "author").groupBy("author").agg(
        F.count("id").alias("posts"),
        F.sum("view_count").alias("views"),
        F.sum("reaction_count").alias("reactions"),
        F.count_distinct("channel").alias("channels"),
    )


def channel_summary(posts: DataFrame) -> DataFrame:
    """Per channel. ``response_rate`` sets questions against unanswered posts of *any*
    type, so it can be negative; ``question_response_rate`` stays within questions."""
    is_question = _is_question()
    rows = having(posts, "channel").groupBy("channel").agg(
        F.count("id").alias("posts"),
        F.sum("view_count").alias("total_views"),
        F.count_if(is_question).alias("questions"),
        F.count_if(~F.col("has_responses")).alias("unanswered"),
        F.count_if(is_question & F.col("has_responses")).alias("_responded"),
        F.count_distinct("author").alias("authors"),
    )
    asked, open_posts = F.col("questions"), F.col("unanswered")
    return rows.withColumns(
        {
            "response_rate": tx.percent_text(numbers.percent_even(asked - open_posts, asked)),
            "question_response_rate": numbers.percent_floor(F.col("_responded"), asked),
        }
    ).drop("_responded")


def answered_by_channel(posts: DataFrame) -> DataFrame:
    rows = having(questions(posts), "channel").groupBy("channel").agg(
        F.count("id").alias("questions"),
        F.count_if(~F.col("has_responses")).alias("unanswered"),
    )
    return rows.withColumn("answered", F.col("questions") - F.col("unanswered"))


def median_response_by(posts: DataFrame, by: str = "channel") -> DataFrame:
    """Median of the positive response times per group, one decimal, half-even."""
    slow = having(posts.where(F.col("latest_response_micros") > 0), by)
    medians = exact_medians(slow, {"_median": F.col("latest_response_micros")}, [by])
    hours = numbers.round_even(dates.micros_to_hours(F.col("_median")), 1)
    return medians.select(by, hours.alias("median_hours"))


def bracketed_median_response_by(posts: DataFrame, by: str = "channel") -> DataFrame:
    """The same as ``median_response_by``, for posts whose response times are too many to be shuffled."""
    slow = having(posts.where(F.col("latest_response_micros") > 0), by)
    medians = bracketed_medians(slow, F.col("latest_response_micros"), [by], "_median")
    hours = numbers.round_even(dates.micros_to_hours(F.col("_median")), 1)
    return medians.select(by, hours.alias("median_hours"))


def poster_frequency(posts: DataFrame) -> DataFrame:
    """One-time and repeat authors, from one count per author."""
    return group_sizes(posts, "author").agg(
        _rows().alias("authors"),
        F.count_if(F.col("posts") == 1).alias("one_time"),
        F.count_if(F.col("posts") > 1).alias("repeat"),
    )


def anonymous_posts(posts: DataFrame) -> DataFrame:
    return posts.agg(F.count_if("is_anonymous").alias("anonymous"))
