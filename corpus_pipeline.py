"""Documents to training sequences: language, boilerplate lines, near copies, mixing, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written and read again as the next one's docs.
All but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planmart.llm import langid, linefreq, mixing, packing, simhash
from planmart.llm.common import arrow_batches, importable, read_table, written


@importable
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; learned from their own labels.  Written here, so that texts
    go to the workers a few at a time."""
    with arrow_batches(spark, langid.RUN_CHARS):
        return written(langid.keep_known(docs, docs.select("text", "lang")))


@importable
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines that stand in too many documents of their source; n_chars follows the text."""
    kept = linefreq.drop_boilerplate(docs, "source", "text").drop("n_lines", "n_dropped")
    return kept.withColumn("n_chars", F.length("text").cast("long"))


@importable
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


@importable
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate says, so that domain totals meet the targets."""
    return mixing.take(docs, read_table(spark, sf_dir, "labels"))


@importable
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens; executors still hold memory of the stages
    before, so few texts at a time."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), run_chars=1 << 20)


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies),
          ("mixture", mixture), ("sequences", sequences)]

#: Trained models, fingerprints and a tokenizer take part, which SQL can't express.
ORACLE_SQL = None


@importable
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        docs = docs if name == "language" else written(docs)        # the first stage wrote its rows itself
    return STAGES[-1][1](spark, docs, sf_dir)
