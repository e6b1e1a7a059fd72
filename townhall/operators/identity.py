"""Who is who: first-wins dedupe, incremental loads and the channel dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from townhall.functions import payloads, text as tx

# Payload keys that may hold a channel list.
CHANNEL_LIST_KEYS = ("channels", "myChannels", "enrolledChannels", "communityChannels")


def keep_first(df: DataFrame, keys: list, order: list) -> DataFrame:
    """One row per key: the first in ``order``.

    Spark cuts every map task's rows to one per key before the shuffle
    (WindowGroupLimit), so a key held by a third of the rows costs no more
    than one row per task.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = df.withColumns({n: k if isinstance(k, Column) else F.col(k) for n, k in zip(names, keys)})
    window = Window.partitionBy(*names).orderBy(*order)
    return keyed.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn", *names)


def text_digest(c: Column) -> Column:
    """Short stand-in for a whole text as a key."""
    return F.sha2(F.coalesce(c, F.lit("")), 256)


def new_rows(batch: DataFrame, seen: DataFrame, key: str = "id", spread: int = 16) -> DataFrame:
    """Rows of ``batch`` whose key was never seen; all copies of a new key are kept.

    Copies of one key are dealt out over ``spread`` tasks, each of which gets the seen keys,
    so a key held by a third of the batch does not meet in one task.
    """
    known = seen.select(key).distinct()
    if spread == 1:
        return batch.join(known, key, "left_anti")
    known = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    salted = batch.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in batch.columns]), F.lit(spread)).cast("int"))
    return salted.join(known, [key, "_salt"], "left_anti").select(*batch.columns)


def append_new(seen: DataFrame, batch: DataFrame, order: list, key: str = "id") -> DataFrame:
    """``seen`` plus the first copy of every new key in ``batch``.

    The batch is cut to one row per key before the anti join, so neither side
    of the join has a hot key.
    """
    fresh = new_rows(keep_first(batch, [key], order), seen, key, spread=1)
    return seen.unionByName(fresh, allowMissingColumns=True)


# -- channels ----------------------------------------------------------------


def channels_from_links(links: DataFrame, section: str = "channels") -> DataFrame:
    """Links (href, text, ord) that point into a channel -> slug, name, href, ord."""
    slug = tx.url_slug(F.col("href"), section)
    return links.select(
        slug.alias("slug"),
        tx.or_else(F.trim(tx.collapse_space(F.col("text"))), slug).alias("name"),
        "href",
        "ord",
    ).where(F.col("slug").isNotNull())


def channels_from_payloads(captures: DataFrame, order: str = "capture_ord") -> DataFrame:
    """Channel lists under any of the known keys, all of them, in key order."""
    data = F.col("data")
    lists = F.concat(*[payloads.list_or_empty(data, k) for k in CHANNEL_LIST_KEYS])
    rows = captures.select(F.col(order), F.posexplode(lists).alias("pos", "item"))
    item = F.col("item")
    slug = tx.or_else(payloads.field(item, "slugName"), payloads.field(item, "slug"))
    return (
        rows.where(payloads.is_object(item))
        .select(
            slug.alias("slug"),
            F.coalesce(payloads.field(item, "name"), slug).alias("name"),
            F.lit("").alias("href"),
            F.struct(order, "pos").alias("ord"),
        )
        .where(F.coalesce(F.col("slug"), F.lit("")) != "")
    )


def channel_dimension(links: DataFrame, listed: DataFrame) -> DataFrame:
    """Both sources, one row per slug; a link beats a listed channel.

    Each source is cut to one row per slug first, so the union that decides
    between them is only as long as the dimension itself.
    """
    first = keep_first(links, ["slug"], ["ord", "href"]).select(
        "slug", "name", "href", F.lit(0).alias("_priority"))
    second = keep_first(listed, ["slug"], ["ord", "name"]).select(
        "slug", "name", "href", F.lit(1).alias("_priority"))
    return keep_first(first.unionByName(second), ["slug"], ["_priority"]).drop("_priority")
