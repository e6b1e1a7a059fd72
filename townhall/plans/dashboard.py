"""The interactive report: filters first, then the frames behind every view."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from townhall.operators import metrics, ranking, terms
from townhall.operators.filters import PostFilter, questions
from townhall.plans.report import post_text


def sections(posts: DataFrame, chosen: PostFilter | None = None) -> dict[str, Callable[[], DataFrame]]:
    """Views of the multi-channel report for one choice of filters, each planned when it is called for."""
    shown = (chosen or PostFilter()).apply(posts)
    asked = questions(shown).select(post_text().alias("text"))
    every_channel = posts.agg(F.count_distinct("channel").alias("n"))
    return {
        "support_figures": lambda: metrics.support_figures(shown),
        "support_text": lambda: metrics.support_text(metrics.support_figures(shown), every_channel.scalar()),
        "hardest_question": lambda: ranking.hardest_question(shown),
        "answered_by_channel": lambda: metrics.answered_by_channel(shown).orderBy("questions", "channel"),
        "top_unanswered": lambda: ranking.ascending(ranking.top_unanswered(shown), "view_count"),
        "median_response": lambda: metrics.median_response_by(shown).orderBy("median_hours", "channel"),
        "top_questions": lambda: ranking.ascending(ranking.top_questions(shown), "view_count"),
        "type_share": lambda: metrics.type_share(shown),
        "top_shares": lambda: ranking.top_shares(shown),
        "terms": lambda: terms.most_frequent(
            terms.cloud_counts(asked, "text", terms.REPORT_STOPWORDS), terms.REPORT_TERMS),
        "channel_sizes": lambda: metrics.group_sizes(shown, "channel").orderBy("posts", "channel"),
        "monthly_by_type": lambda: metrics.monthly_by_type(shown),
        "channel_summary": lambda: metrics.channel_summary(shown).orderBy(F.desc("posts"), F.asc("channel")),
        "poster_frequency": lambda: metrics.poster_frequency(shown),
        "anonymous_posts": lambda: metrics.anonymous_posts(shown),
        "top_authors": lambda: ranking.top_authors(shown),
        "top_authors_by_views": lambda: ranking.top_authors_by_views(shown),
    }


def dashboard(posts: DataFrame, chosen: PostFilter | None = None) -> dict[str, DataFrame]:
    """All views as lazy frames. Keep ``posts`` in memory or as a table when using several."""
    return {name: view() for name, view in sections(posts, chosen).items()}
