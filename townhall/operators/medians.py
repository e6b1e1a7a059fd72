"""Exact medians without gathering a large group in one place.

Values are first added up to (group, value, count). The two middle values are then found
digit by digit: each pass counts values by their leading bits, keeps the one or two prefixes the
middle falls in, and the next pass looks only inside those. No group has more than 2**22 counts
in a pass, whatever its size, and all passes read the one shuffled table of counts. Nothing
runs before the result is asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# How many low bits are still unread after each pass over a 64-bit integer.
_UNREAD = (42, 21, 0)


def _middle(position: Column, low: Column, high: Column, name: str) -> Column:
    """Mean of the two middle values of the measure at ``position``; null when it has none."""
    mine = F.col("_m") == position
    return ((F.min(F.when(mine, low)) + F.max(F.when(mine, high))) / 2).alias(name)


def exact_medians(df: DataFrame, values: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """Medians of whole-number columns, nulls skipped: one row per group.

    ``values`` names each result. All of them share the passes. Groups in which
    every value is null are absent; without ``by`` there is always one row.
    """
    by = list(by or [])
    pairs = F.explode(
        F.array(*[
            F.struct(F.lit(i).alias("_m"), c.cast("bigint").alias("_v")) for i, c in enumerate(values.values())
        ])
    )
    group = [*by, "_m"]
    data = df.select(*by, pairs.alias("_x")).select(*by, "_x.*").where(F.col("_v").isNotNull())
    counts = data.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_n"))
    found = _select_middle(counts, group)
    return found.groupBy(*by).agg(
        *[_middle(F.lit(i), F.col("_low"), F.col("_high"), name) for i, name in enumerate(values)]
    )


def _select_middle(data: DataFrame, group: list[str]) -> DataFrame:
    """The two middle values of ``_v``, counted by ``_n``, in each group."""

    def counted(rows: DataFrame, carried: list[str], unread: int) -> DataFrame:
        return rows.groupBy(*group, *carried, F.shiftright("_v", unread).alias("_p")).agg(
            F.sum("_n").alias("_n"))

    # positions (0-based) of the two middle values among _total sorted ones
    low = F.floor((F.col("_total") - 1) / 2)
    high = F.floor(F.col("_total") / 2)

    def holding_middle(rows: DataFrame) -> DataFrame:
        before = F.col("_upto") - F.col("_n")
        return rows.where((before <= high) & (F.col("_upto") > low)).select(
            *group, "_p", before.alias("_before"), "_total")

    in_group = Window.partitionBy(*group)
    running = in_group.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = counted(data, [], _UNREAD[0])
    first = first.withColumns({
        "_upto": F.sum("_n").over(running),
        "_total": F.sum("_n").over(in_group),
    })
    wanted = holding_middle(first)

    for previous, unread in zip(_UNREAD, _UNREAD[1:]):
        # one or two rows per group: the engine sends them to the counts, or splits a large group
        inside = data.withColumn("_q", F.shiftright("_v", previous)).join(
            wanted.withColumnRenamed("_p", "_q"), [*group, "_q"])
        counts = counted(inside, ["_q", "_before", "_total"], unread)
        window = Window.partitionBy(*group, "_q").orderBy("_p").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        wanted = holding_middle(counts.withColumn("_upto", F.col("_before") + F.sum("_n").over(window)))

    # what is left: the one or two values in the middle
    return wanted.groupBy(*group).agg(
        F.min("_p").cast("double").alias("_low"), F.max("_p").cast("double").alias("_high"))


def attach(row: DataFrame, extra: DataFrame, names: list[str]) -> DataFrame:
    """Add the columns of one one-row frame to another."""
    return reduce(lambda acc, n: acc.withColumn(n, extra.select(n).scalar()), names, row)


# -- medians inside a sketched bracket ---------------------------------------

SKETCH_ACCURACY = 10_000  # a sketched quantile is off by at most a rank in so many


def bracketed_medians(
    df: DataFrame, value: Column, by: list[str], name: str = "median", accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Exact medians of a whole-number column, of each group with a value, by two reads of ``df`` and no shuffle of it.

    The first read sketches each group's quantiles on both sides of the middle: a bracket of values that
    holds about a few ranks in ``accuracy`` of the group. The second counts the values below the bracket and
    adds up those inside it by value; only these move. Counts prove the result: the middle ranks lie between
    the number below and that plus the number inside. A group where they do not is counted anew by digits.
    Rows without a value or a group are left out.
    """
    rows = df.select(*by, value.cast("bigint").alias("_v")).dropna(subset=[*by, "_v"])
    margin = 2.0 / accuracy
    sketched = rows.groupBy(*by).agg(
        F.percentile_approx("_v", [0.5 - margin, 0.5 + margin], accuracy).alias("_q"), F.count(F.lit(1)).alias("_total"))
    bracket = sketched.select(*by, F.col("_q")[0].alias("_from"), F.col("_q")[1].alias("_to"), "_total")
    held = rows.join(bracket, by).where(F.col("_v") <= F.col("_to"))
    spot = F.when(F.col("_v") >= F.col("_from"), F.col("_v"))  # null: below the bracket
    counted = held.groupBy(*by, "_total", spot.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(*by).orderBy(F.asc_nulls_first("_v"))
    placed = counted.withColumn("_upto", F.sum("_n").over(running))
    low, high = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    before = F.col("_upto") - F.col("_n")
    inside = F.col("_v").isNotNull()
    found = placed.groupBy(*by).agg(
        F.max(F.when(inside & (before <= low) & (F.col("_upto") > low), F.col("_v"))).alias("_low"),
        F.max(F.when(inside & (before <= high) & (F.col("_upto") > high), F.col("_v"))).alias("_high"))
    proven = F.col("_low").isNotNull() & F.col("_high").isNotNull()
    sure = found.where(proven).select(*by, ((F.col("_low") + F.col("_high")) / 2).alias(name))
    rest = rows.join(found.where(~proven).select(*by), by, "left_semi")
    return sure.unionByName(exact_medians(rest, {name: F.col("_v")}, by))
