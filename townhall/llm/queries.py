"""The queries of this subpackage: (spark, folder) -> DataFrame over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from townhall.llm import (
    ball_search, byte_network, language_crf, merkle, packing, quality, repeats, skip_chain, superminhash, syncmers, tree_bpe, warc,
    wrappers,
)
from townhall.llm.frames import table
from townhall.llm.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_skip_chain_pii(spark, sf):
    return skip_chain.span_digest(table(spark, sf, "documents"))


@query
def op2_warc_source(spark, sf):
    return warc.archive_round_trip(table(spark, sf, "pages"))


@query
def op3_best_fit_packing(spark, sf):
    return packing.packed_documents(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op4_quality_cascade(spark, sf):
    return quality.judged(table(spark, sf, "documents")).drop("rejected_by")


@query
def op5_page_wrappers(spark, sf):
    return wrappers.main_text(table(spark, sf, "pages"))


@query
def op6_superminhash(spark, sf):
    return superminhash.near_duplicates(table(spark, sf, "documents"))


@query
def op7_closed_syncmers(spark, sf):
    return syncmers.edit_check(table(spark, sf, "documents"))


@query
def op8_suffix_dedup(spark, sf):
    return repeats.repeat_digest(table(spark, sf, "documents"))


@query
def op9_language_crf(spark, sf):
    return language_crf.languages(table(spark, sf, "documents"))


@query
def op10_tree_bpe(spark, sf):
    return tree_bpe.encode_digest(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op11_byte_network(spark, sf):
    return byte_network.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op12_merkle_manifest(spark, sf):
    return merkle.proofs(table(spark, sf, "documents"))


@query
def op13_ball_search(spark, sf):
    return ball_search.ranked_search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
