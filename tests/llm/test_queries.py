"""The registered queries and the pipeline on the smallest tables."""

import collections

import pytest

import __spark_entry__ as contract
import brute
import corpus_pipeline
from compare import connect, difference
from townhall.llm.oracle import ORACLE
from townhall.llm.queries import QUERIES

COLUMNS = {
    1: ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    2: ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    3: ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    4: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    5: ["page_id", "url", "text", "n_chars"],
    6: ["doc_id", "n_shingles", "component_id", "kept"],
    7: ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    8: ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    9: ["doc_id", "held_out", "lang_pred", "score"],
    10: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    11: ["doc_id", "held_out", "score", "predicted"],
    12: ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    13: ["item_id", "rank", "doc_id", "score"],
}


def test_all_are_registered():
    found = contract.queries()
    assert set(QUERIES) | {"pipeline"} <= set(found) and set(ORACLE) <= set(contract.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(name, spark, small):
    out = QUERIES[name](spark, small)
    number = int(name[2:].split("_")[0])
    assert set(COLUMNS[number]) <= set(out.columns)
    source = "pages" if number in (2, 5) else "documents"
    n = spark.read.parquet(f"{small}/{source}.parquet").count()
    if number == 13:
        source, n = "benchmark", 10 * spark.read.parquet(f"{small}/benchmark.parquet").count()
    assert out.count() == n if number != 3 else out.select("doc_id").distinct().count() == n


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(name, spark, small):
    assert difference(QUERIES[name](spark, small), connect(small), ORACLE[name]) is None


def test_native_operators_run_no_python(spark, small):
    for name in ("op4_quality_cascade", "op7_closed_syncmers"):
        text = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_pipeline(spark, small):
    """Each stage against its brute-force version, on what the stage before has written."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "suffix_dedup", "pii", "packing"]
    stage = dict(corpus_pipeline.STAGES)

    def step(name, df):
        out = stage[name](spark, df, small)
        assert out.columns == docs.columns
        rows = out.collect()
        return spark.createDataFrame(rows, docs.schema), {r.doc_id: r.text for r in rows}

    good, left = step("quality_rules", docs)
    kept = {r.doc_id for r in QUERIES["op4_quality_cascade"](spark, small).where("kept").collect()}
    assert set(left) == kept
    single, texts = step("near_dedup", good)
    assert set(texts) == {c for _, _, c in brute.near_groups(sorted(left.items()))}
    cut, rest = step("suffix_dedup", single)
    gone = {d: n for d, _, n, _, _ in brute.repeats(sorted(texts.items()), corpus_pipeline.PASSAGE_BYTES)}
    assert {d: len(t.encode()) for d, t in rest.items()} == {d: len(t.encode()) - gone[d] for d, t in texts.items()}
    masked, clean = step("pii", cut)
    assert all(not brute.personal(t) for t in clean.values())
    assert all(clean[d] == t for d, t in rest.items() if not any(c.isdigit() or c == "@" for c in t))
    packed = stage["packing"](spark, masked, small).collect()
    assert {r.doc_id for r in packed} == set(clean)
    full = collections.Counter()
    for r in packed:
        full[r.sequence_id] += r.length
    assert max(full.values()) <= 2048
    total = sum(full.values())
    assert len(full) <= -(-total // 2048) + 2
    whole = corpus_pipeline.run(spark, small).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in whole) == sorted(
        (r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed)
