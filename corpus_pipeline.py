"""Corpus pipeline: raw documents to token ids, one operator a stage.

Each stage takes (spark, docs, sf_dir), sees all that the stage before it
kept, and returns a DataFrame that is written as Parquet and read again as the
next one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martforge.llm import bpe, decontaminate, language_id, signature_join, suffix_dedup
from martforge.llm.common import Scratch, read


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter or far from every language profile."""
    return language_id.keep_known(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of every group of near copies."""
    return signature_join.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out bytes of strings that stand earlier; no document is dropped, n_chars follows the text."""
    cut = suffix_dedup.cut_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, lossless): token ids, and whether they decode to the text."""
    back = bpe.round_trip(docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text")))
    return back.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       (F.col("decoded") == F.col("text")).alias("lossless"))


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard_join", one_of_near_copies),
    ("suffix_array_dedup", without_repeats),
    ("benchmark_decontamination", without_benchmarks),
    ("bpe", token_ids),
]

#: SQL cannot say the language profiles or the merges; the pipeline is tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, before = scratch.save(stage(spark, docs, sf_dir), name), docs
        scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
