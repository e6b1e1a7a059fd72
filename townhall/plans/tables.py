"""Post-, capture- and link-shaped views over the driver tables.

Nothing here is made up: every row of a view comes from a row of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from townhall.functions import payloads
from townhall.operators.typed import with_derived, with_response_time
from townhall.sources.links import page_links

# order status and the post type it plays
STATUS_TYPES = {"F": "helpQuestion", "O": "sharePost", "P": "liveSession"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _post_type() -> Column:
    kinds = F.create_map(*[F.lit(x) for pair in STATUS_TYPES.items() for x in pair])
    return F.try_element_at(kinds, F.col("o_orderstatus"))


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as posts; their line items are the responses."""
    responses = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("response_count"),
            F.max("l_shipdate").alias("last_response"),
            F.count_if(F.col("l_returnflag") == "R").alias("reaction_count"),
            F.count_if(F.col("l_linestatus") == "F").alias("answers"),
        )
    )
    orders = table(spark, sf_dir, "orders")
    return orders.join(responses, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Post "), F.col("o_orderkey"), F.lit(" by customer "), F.col("o_custkey"),
                 F.lit(" with priority "), F.col("o_orderpriority"), F.lit(" on the community board")).alias("title"),
        F.concat(F.lit("Handled by clerk of customer "), F.col("o_custkey"), F.lit(" in status "),
                 F.col("o_orderstatus")).alias("body"),
        F.concat(F.lit("Customer "), F.col("o_custkey")).alias("author"),
        _post_type().alias("type"),
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderdate").cast("timestamp").alias("created_date"),
        F.col("last_response").cast("timestamp").alias("last_response"),
        F.floor("o_totalprice").cast("bigint").alias("view_count"),
        F.coalesce("response_count", F.lit(0)).alias("response_count"),
        F.coalesce("reaction_count", F.lit(0)).alias("reaction_count"),
        F.coalesce(F.col("answers") > 0, F.lit(False)).alias("has_answer"),
        (F.pmod("o_custkey", F.lit(10)) == 0).alias("is_anonymous"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed frame the reports start from."""
    return with_derived(with_response_time(raw_posts(spark, sf_dir)), title_width=55)


def _resource(ident: Column, views: Column) -> Column:
    """A nested post as the site would send it, built from one order."""
    key = F.col("o_orderkey")
    return F.struct(
        ident.alias("id"),
        F.concat(F.lit("Post &amp; "), ident).alias("title"),
        F.concat(F.lit("<p>Priority <b>"), F.col("o_orderpriority"), F.lit("</b></p>")).alias("bodyHTML"),
        F.concat(F.lit("Customer "), F.col("o_custkey")).alias("authorName"),
        _post_type().alias("conversationType"),
        F.when(F.pmod(key, F.lit(4)) != 0, F.struct(F.col("o_orderpriority").alias("name"))).alias("channel"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("createdDate"),
        views.alias("viewCount"),
        F.pmod(key, F.lit(7)).alias("responseCount"),
        F.when(F.pmod(key, F.lit(3)) != 0, F.struct(F.pmod(key, F.lit(5)).alias("reactionCount")))
        .alias("reactionSummary"),
        (F.col("o_orderstatus") == "F").alias("hasModeratorOrEndorsedResponse"),
    )


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One intercepted response per order: the order and, shown again, the order
    with half its key. Six payload shapes take turns; JSON nulls are kept."""
    key = F.col("o_orderkey")
    views = F.floor("o_totalprice").cast("bigint")
    pair = F.array(_resource(key, views), _resource(F.floor(key / 2).cast("bigint"), views + 1))
    shape = F.pmod(key, F.lit(6))

    def text(column: Column) -> Column:
        return F.to_json(column, {"ignoreNullFields": "false"})

    none = F.array().cast("array<string>")
    payload = (
        F.when(shape == 0, text(F.struct(pair.alias("enrichedContentResources"))))
        .when(shape == 1, text(pair))
        .when(shape == 2, text(F.struct(none.alias("data"), pair.alias("items"))))
        .when(shape == 3, text(F.struct(
            F.struct(pair.alias("results")).alias("page"), F.lit(2).alias("total"),
            *[F.lit(i).alias(f"extra{i:02}") for i in range(1, 13)])))
        .when(shape == 4, F.lit('"no content"'))
        .otherwise(text(F.struct(pair.alias("enrichedContentResources"), F.lit("none").alias("items"))))
    )
    url = F.concat(
        F.lit("https://community.example.org/"),
        F.when(shape == 1, "search/data").otherwise("views/mainLayout/data"),
        F.lit("?channelSlugName="), F.lower(F.substring("o_orderpriority", 1, 3)),
        F.lit("&contentId=0&batchNumber="), F.pmod(F.floor(key / 6), F.lit(3)) + 1,
        F.lit("&tz=UTC"),
    )
    kind = (
        F.when(shape == 4, "text/html; charset=utf-8")
        .when(shape == 1, "application/javascript")
        .otherwise("application/json; charset=utf-8")
    )
    return table(spark, sf_dir, "orders").select(
        key.alias("capture_ord"),
        F.col("o_orderpriority").alias("channel_name"),
        url.alias("url"),
        kind.alias("ct"),
        F.parse_json(payload).alias("data"),
    )


def id_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payload items whose id is, in turn, good or one of the unusable kinds."""
    key = F.col("o_orderkey")
    case = F.pmod(key, F.lit(8))
    ident = (
        F.when(case == 0, "0").when(case == 1, '"0"').when(case == 2, '""').when(case == 3, "null")
        .when(case == 4, "false").when(case == 5, F.concat(F.lit('"k'), key, F.lit('"')))
        .otherwise(key.cast("string"))
    )
    text = F.when(case == 6, F.concat(F.lit('{"key": '), key, F.lit("}"))).otherwise(
        F.concat(F.lit('{"id": '), ident, F.lit("}")))
    text = F.when(F.pmod(key, F.lit(16)) == 15, F.lit('["id"]')).otherwise(text)
    return table(spark, sf_dir, "orders").select(key.alias("ord"), F.parse_json(text).alias("item"))


def channel_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as responses that carry channel lists under several keys."""
    key = F.col("c_custkey")
    text = F.to_json(
        F.struct(
            F.array(F.struct(
                F.lower("c_mktsegment").alias("slugName"),
                F.when(F.pmod(key, F.lit(2)) == 0, F.initcap("c_mktsegment")).alias("name"),
            )).alias("channels"),
            F.array(F.struct(F.lit("").alias("slugName"), F.lit("de").alias("slug"),
                             F.lit("never shown").alias("name"))).alias("myChannels"),
            F.array(F.lit("not an object")).alias("enrolledChannels"),
            F.lit("not a list").alias("communityChannels"),
        ),
        {"ignoreNullFields": "true"},
    )
    return table(spark, sf_dir, "customer").select(key.alias("capture_ord"), F.parse_json(text).alias("data"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(table(spark, sf_dir, "pages"), ["page_id"], base="url")


def channel_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page links as links into channels."""
    return links(spark, sf_dir).select(
        F.concat(F.lit("https://community.example.org/channels"), F.col("href"), F.lit("?tab=all")).alias("href"),
        "text",
        F.struct("page_id", "pos").alias("ord"),
    )


def props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.parse_json("props").alias("props"))


def event_keys(events: DataFrame) -> DataFrame:
    return events.withColumn("k", payloads.field(F.col("props"), "k", "bigint"))
