"""From raw documents to packed training sequences, in stages that are written between."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from townhall.llm.frames import table
from townhall.llm.packing import packed_documents
from townhall.llm.quality import keep_good
from townhall.llm.repeats import drop_repeats
from townhall.llm.shipping import ship
from townhall.llm.skip_chain import mask_personal_data
from townhall.llm.superminhash import drop_near_duplicates
from townhall.session import settle

PASSAGE_BYTES = 256  # as good as all runs of 51 words are that long; few shorter runs are (README)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    ship(spark)
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest id."""
    ship(spark)
    return drop_near_duplicates(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``PASSAGE_BYTES`` or more that occur again go from every text."""
    ship(spark)
    return drop_repeats(docs, length=PASSAGE_BYTES)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind."""
    ship(spark)
    return mask_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenized, cut and packed into sequences."""
    ship(spark)
    return packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("pii", pii),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
