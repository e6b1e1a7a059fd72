"""Exact sets of ids as bitmaps, one row per range of 32,768 ids.

A set is a frame (range, bits) or, kept apart by groups, (group columns, range, bits). It is some
thousandth of the rows it stands for: a load asks it which ids are new without reading what
was loaded before, and distinct counts of parts add up exactly, as bitmaps are united and not counted
twice. Ids are whole numbers of 64 bits, negative ones too; null is in no set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from townhall.operators.identity import keep_first


def _place(id_: Column) -> tuple[Column, Column]:
    whole = id_.cast("bigint")
    return F.bitmap_bucket_number(whole), F.bitmap_bit_position(whole)


def id_set(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """The ids of ``key``. Bits are set within every task first, so copies of an id cost nothing."""
    bucket, position = _place(F.col(key))
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(*by, bucket.alias("range"))
        .agg(F.bitmap_construct_agg(position).alias("bits"))
    )


def united(sets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sets of the same shape, one below the other, or groups of one, as one set for each ``by``."""
    return sets.groupBy(*by, "range").agg(F.bitmap_or_agg("bits").alias("bits"))


def size(sets: DataFrame, by: Sequence[str] = (), name: str = "ids") -> DataFrame:
    """How many different ids there are for each ``by``, over all parts they were kept in."""
    return united(sets, by).groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))


def _holds(bits: Column, position: Column) -> Column:
    """Whether a bit is set; bytes run upwards, bits within a byte from the least."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, F.pmod(position, F.lit(8)).cast("int")) == 1


def unseen(batch: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose id is not in the set, all copies of them; rows without an id too.

    ``seen`` may hold the sets of several loads, one below the other. United it has one row per range, so a range
    or an id with a third of the batch is split by its size when the job runs.
    """
    bucket, position = _place(F.col(key))
    known = united(seen).select(F.col("range").alias("_range"), F.col("bits").alias("_bits"))
    held = batch.withColumns({"_in": bucket, "_at": position}).join(known, F.col("_in") == F.col("_range"), "left")
    return held.where(~F.coalesce(_holds(F.col("_bits"), F.col("_at")), F.lit(False))).select(*batch.columns)


def load(batch: DataFrame, seen: DataFrame, key: str, order: list) -> tuple[DataFrame, DataFrame]:
    """First copies of the ids that are new, and the set of those alone, to be stored beside ``seen``."""
    fresh = unseen(keep_first(batch.where(F.col(key).isNotNull()), [key], order), seen, key)
    return fresh, id_set(fresh, key)
