"""Projections, tables and identity shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """The two columns every operator needs, under fixed names; a null text is empty.

    Whatever else the table holds stays outside, so extra columns cannot clash.
    """
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def beside_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, text and ``row``: all other columns and whether there is a text, so that the text moves once."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    row = F.struct(rest.alias("rest"), F.col(f"`{text_col}`").isNotNull().alias("there"))
    return docs.select(row.alias("row"), F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))


def with_text(done: DataFrame, columns: list[str], text_col: str, new: str) -> DataFrame:
    """The columns that ``beside_text`` put into ``row``, with a new text; a null text stays null."""
    text = F.when(F.col("row.there"), F.col(new))
    return done.select(*[(text if c == text_col else F.col(f"row.rest.`{c}`")).alias(c) for c in columns])


def row_key(*cols: str) -> Column:
    """128 bits that name a row by its values; repeated rows have the same key."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in cols]
    return F.coalesce(F.unhex(F.md5(F.concat_ws("\1", *parts))), F.lit(b""))
