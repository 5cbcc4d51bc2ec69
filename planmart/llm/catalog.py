"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planmart.llm import (bitsliced, interactions, langid, lexical, linefreq, mixing, packing, robust, sentencepieces, simhash, tokens,
                          toolcalls, toxicity)
from planmart.llm.common import importable, read_table, written

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labelled = toxicity.graded(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.rate(docs.select("doc_id", "text"), labelled).drop("text")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.dedup(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op4_toolcalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    return toolcalls.link(toolcalls.conversation_calls(turns), toolcalls.conversation_results(turns),
                          toolcalls.schema_table(spark))


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linefreq.drop_boilerplate(written(linefreq.page_lines(read_table(spark, sf_dir, "pages"))), "host", "text")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id")))
    return langid.identify(docs, docs.where("NOT held_out"), "doc_id", "held_out")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust.quality(read_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return sentencepieces.digests(sentencepieces.encode(docs, public_tokenizers.path(PIECES)))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return interactions.audit(interactions.document_masks(docs, labels))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: importable(f) for f in (op1_toxicity, op2_topk, op3_simhash, op4_toolcalls, op5_line_frequency, op6_language,
                            op7_mixing, op8_quality, op9_packing, op10_token_counts, op11_search,
                            op12_sentencepiece, op13_filter_audit)}

ORACLE: dict[str, str] = {"op2_topk": bitsliced.ORACLE_SQL, "op4_toolcalls": toolcalls.ORACLE_SQL,
                          "op5_line_frequency": linefreq.ORACLE_SQL, "op11_search": lexical.ORACLE_SQL, "op13_filter_audit": interactions.ORACLE_SQL}
