"""Links found in raw pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from townhall.functions import text as tx
from townhall.functions.entities import decode_entities

_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""
_ANCHOR = rf"""(?is)<a(?=[\s>/])((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>(.*?)</a\s*>"""
# attributes before href are passed over whole, so a name or value that merely ends in href is none
_HREF = (
    rf"""(?is)^<a(?:[\s/]++(?!href[\s=])[^\s=>"'/]++(?:\s*+=\s*+{_VALUE})?+)*+"""
    r"""[\s/]++href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
)


def resolved(href: Column, base: Column) -> Column:
    """An address as a browser shows it: relative ones are completed from that of the page."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.when(page == origin, F.concat(origin, F.lit("/"))).otherwise(F.regexp_replace(page, r"[^/]*$", ""))
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .when(href == "", base)
        .otherwise(F.concat(folder, href))
    )


def page_links(
    pages: DataFrame, keep: list[str], html: str = "html", width: int = 60, base: str | None = None
) -> DataFrame:
    """Every anchor with an address of every page: its target and the first ``width`` characters of its text.

    The page is searched once; the rest looks at single anchors. Addresses may be in double,
    single or no quotes; references in them are decoded. ``base`` names the column with the
    page's own address and adds the completed target as ``address``.
    """
    anchors = F.regexp_extract_all(F.col(html), F.lit(_ANCHOR), F.lit(0))
    anchors = F.filter(anchors, lambda a: a.rlike(_HREF))
    rows = pages.select(*keep, *([F.col(base).alias("_base")] if base else []), F.posexplode(anchors).alias("pos", "_a"))
    parts = [F.nullif(F.regexp_extract("_a", _HREF, i), F.lit("")) for i in (1, 2, 3)]
    href = decode_entities(F.coalesce(*parts, F.lit("")))
    rows = rows.withColumn("href", href)
    shown = tx.prefix(tx.clean(F.regexp_extract("_a", _ANCHOR, 2)), width).alias("text")
    extra = [resolved(F.col("href"), F.col("_base")).alias("address")] if base else []
    return rows.select(*keep, "pos", "href", *extra, shown)
