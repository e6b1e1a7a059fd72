"""String functions. Every one is a plain expression: no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from townhall.functions.entities import decode_entities

_TAG = "<[^>]+>"
# Unicode white space plus the four separators Java leaves out.
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def strip_tags(c: Column) -> Column:
    """Remove tags, leaving nothing in their place; entities stay as they are."""
    return F.regexp_replace(c, _TAG, "")


def space_tags(c: Column) -> Column:
    """Replace each tag by one space."""
    return F.regexp_replace(c, _TAG, " ")


def collapse_space(c: Column) -> Column:
    return F.regexp_replace(c, _SPACE_RUN, " ")


def tidy(c: Column) -> Column:
    """Tags to spaces, white space collapsed, ends trimmed (no entity decoding)."""
    return F.trim(collapse_space(space_tags(c)))


def clean(c: Column) -> Column:
    """Decode entities first, then tidy: an encoded tag is removed as well. Null -> ''."""
    return F.coalesce(tidy(decode_entities(c)), F.lit(""))


def clean_columns(df, names):
    return df.withColumns({name: clean(F.col(name)) for name in names})


def ellipsize(c: Column, width: int) -> Column:
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("…"))).otherwise(c)


def prefix(c: Column, width: int) -> Column:
    return F.substring(c, 1, width)


def joined(*columns: Column) -> Column:
    """Texts with one space between them; a null counts as ''."""
    return F.array_join(F.array(*[F.coalesce(c, F.lit("")) for c in columns]), " ")


def one_of(c: Column, values) -> Column:
    """Case-blind membership; null -> false."""
    return F.coalesce(F.lower(c).isin([v.lower() for v in values]), F.lit(False))


def not_blank(c: Column) -> Column:
    return F.coalesce(F.trim(collapse_space(c)) != "", F.lit(False))


def or_else(c: Column, fallback) -> Column:
    """``c`` unless it is null or empty."""
    fallback = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.coalesce(F.nullif(c, F.lit("")), fallback)


# -- numbers as text ---------------------------------------------------------


def thousands(c: Column) -> Column:
    """12345 -> 12,345"""
    return F.format_number(c, 0)


def fixed(c: Column, digits: int) -> Column:
    """Fixed decimals, half-even, no grouping."""
    return F.replace(F.format_number(c, digits), F.lit(","), F.lit(""))


def percent_text(c: Column) -> Column:
    return F.concat(c.cast("string"), F.lit("%"))


def ratio_text(a: Column, b: Column, sep: str = "/") -> Column:
    return F.concat(a.cast("string"), F.lit(sep), b.cast("string"))


def pad_left(c: Column, width: int) -> Column:
    """Right-align; longer text is kept whole."""
    text = c.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, " ")).otherwise(text)


def pad_right(c: Column, width: int) -> Column:
    text = c.cast("string")
    return F.when(F.length(text) < width, F.rpad(text, width, " ")).otherwise(text)


# -- URLs and short labels ---------------------------------------------------


def url_slug(url: Column, section: str = "channels") -> Column:
    """The path part after ``/section/``; null when there is none."""
    return F.nullif(F.regexp_extract(url, rf"/{section}/([^/?#\s]+)", 1), F.lit(""))


def without_batch_number(url: Column) -> Column:
    return F.regexp_replace(url, "&batchNumber=[0-9]+", "")


def with_batch_number(url: Column, batch: Column) -> Column:
    return F.concat(url, F.lit("&batchNumber="), batch.cast("string"))


def channel_url(href: Column, base: str, slug: Column) -> Column:
    """The link itself, or the address built from its parts when there is no link.

    A slug comes out of an address, so it goes into the new one as it is.
    """
    built = F.concat_ws("/", F.lit(base), slug, F.lit("all-content"))
    return or_else(href, built)


def with_query(base: str, **parts) -> Column:
    """An address with a query string of the given parts in order; values go in as they are."""
    pairs = [F.concat(F.lit(f"{name}="), p.cast("string") if isinstance(p, Column) else F.lit(str(p)))
             for name, p in parts.items()]
    return F.concat(F.lit(f"{base}?"), F.concat_ws("&", *pairs))


def batch_number(url: Column) -> Column:
    return F.regexp_extract(url, "[?&]batchNumber=([0-9]+)", 1).try_cast("int")


def label_length_ok(c: Column, limit: int = 60) -> Column:
    """Non-empty after trimming and shorter than ``limit``."""
    return F.length(F.trim(collapse_space(c))).between(1, limit - 1)
