"""Value maps, flags and fills."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# Stored post types and the labels shown for them.
TYPE_LABELS = {
    "helpQuestion": "Help / Question",
    "sharePost": "Share / Resource",
    "liveSession": "Live Session",
}
QUESTION = TYPE_LABELS["helpQuestion"]
SHARE = TYPE_LABELS["sharePost"]

# Texts that mean true.
TRUE_TEXTS = ("true", "1", "yes")


def mapped(c: Column, mapping: dict[str, str]) -> Column:
    """Mapped value, or the original when the map has none."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(table, c), c)


def truthy_text(c: Column) -> Column:
    return F.coalesce(F.lower(c.cast("string")).isin(*TRUE_TEXTS), F.lit(False))


def filled(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))
