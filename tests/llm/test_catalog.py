"""The registered queries and the pipeline on the smallest tables."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from planmart.llm import catalog, simhash
from planmart.llm.common import written
from tools.compare import compare, duck


def test_every_operator_is_registered_once():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in catalog.QUERIES) == list(range(1, 14))
    assert {*catalog.QUERIES, "pipeline"} <= set(E.queries())
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_queries_match_their_sql(session, small_dir, name):
    ok, detail = compare(catalog.QUERIES[name](session, small_dir), duck(small_dir), catalog.ORACLE[name])
    assert ok, detail


CONTRACT = {
    "op3_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op6_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op8_quality": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
                    "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op9_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
                    "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op10_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op2_topk": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op13_filter_audit": {"part": "string", "filter_order": "string", "step": "int", "kept": "bigint", "removed": "bigint",
                          "redundant": "bigint", "unique_fails": "bigint", "good_lost": "bigint", "toxic_lost": "bigint", "shapley": "bigint"},
    "op11_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op12_sentencepiece": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op1_toxicity": {"doc_id": "bigint", "expected_severity": "double", "toxic": "boolean"},
    "op7_mixing": {"doc_id": "bigint", "rate": "double", "copies": "int"}}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_of_the_contract(session, small_dir, name):
    df = catalog.QUERIES[name](session, small_dir)
    assert CONTRACT[name].items() <= dict(df.dtypes).items()
    if name not in ("op2_topk", "op9_packing", "op11_search", "op13_filter_audit"):
        assert df.count() == session.read.parquet(f"{small_dir}/documents.parquet").count()


def test_pipeline_stages_take_effect(session, small_dir):
    docs = session.read.parquet(f"{small_dir}/documents.parquet")
    odd = session.createDataFrame([(70001, None, None, "src1", None), (70002, "123", "en", "src1", 3), (None, "the and of is", None, None, 1)],
                                  docs.schema)
    columns = docs.columns
    docs = docs.unionByName(odd)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(session, docs, small_dir))
        kept[name] = docs
        if name != "sequences":
            assert docs.columns == columns
            assert docs.dtypes == before.dtypes
    ids = {n: [r.doc_id for r in df.select("doc_id").collect()] for n, df in kept.items()}
    assert not {70001, 70002} & set(ids["language"]) and len(ids["language"]) >= docs.sparkSession.read.parquet(
        f"{small_dir}/documents.parquet").count()
    assert len(ids["lines"]) == len(ids["language"])
    assert kept["lines"].where("length(text) <> n_chars").count() == 0
    prints = {simhash.text_fingerprint(r.text, 3) for r in kept["near_copies"].collect()}
    assert len(prints) == len(ids["near_copies"]) <= len(ids["lines"])
    assert set(ids["mixture"]) <= set(ids["near_copies"])
    assert set(ids["sequences"]) == set(ids["mixture"])


def test_run_gives_sequences(session, small_dir):
    got = corpus_pipeline.run(session, small_dir)
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
