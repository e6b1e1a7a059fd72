"""From a raw post table to the typed frame every report starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from townhall.functions import dates, labels, numbers, text as tx

COUNTS = ("view_count", "response_count", "reply_count", "reaction_count")
TEXTS = ("title", "body", "author", "channel", "last_responder")
FIRST_REAL_YEAR = 2000


def with_response_time(df: DataFrame) -> DataFrame:
    """Time from the post to its *latest* response, in exact microseconds and in hours."""
    micros = dates.elapsed_micros(F.col("created_date"), F.col("last_response"))
    return df.withColumn("latest_response_micros", micros).withColumn(
        "latest_response_hours", dates.micros_to_hours(F.col("latest_response_micros"))
    )


def typed_posts(
    df: DataFrame, clean_texts: bool = False, drop_sentinels: bool = False, title_width: int = 50
) -> DataFrame:
    """Coerce counts, dates and flags, then add the derived columns.

    ``clean_texts`` and ``drop_sentinels`` are what the multi-channel report
    does on top (with ``title_width=55``).
    """
    present = set(df.columns)
    if clean_texts:
        df = tx.clean_columns(df, [c for c in TEXTS if c in present])
    created = dates.parse_timestamp(F.col("created_date"))
    last = dates.parse_timestamp(F.col("last_response"))
    if drop_sentinels:
        last = dates.not_before(last, FIRST_REAL_YEAR)
    df = df.withColumns(
        {
            **{c: numbers.to_count(F.col(c)) for c in COUNTS if c in present},
            **{c: labels.truthy_text(F.col(c)) for c in ("is_anonymous", "has_answer") if c in present},
            "created_date": created,
            "last_response": last,
        }
    )
    return with_derived(with_response_time(df), title_width)


def with_derived(df: DataFrame, title_width: int) -> DataFrame:
    return df.withColumns(
        {
            "month": dates.month_key(F.col("created_date")),
            "type_label": labels.mapped(F.col("type"), labels.TYPE_LABELS),
            "short_title": tx.ellipsize(F.col("title"), title_width),
            "has_responses": F.col("response_count") > 0,
        }
    )


def single_community_posts(df: DataFrame) -> DataFrame:
    return typed_posts(df, title_width=50)


def multi_channel_posts(df: DataFrame) -> DataFrame:
    return typed_posts(df, clean_texts=True, drop_sentinels=True, title_width=55)
