"""A training corpus from ``documents``: language ID, quality rules, line dedup,
SimHash near-dedup and best-fit packing.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.llm import langid, line_dedup, packing, quality, simhash
from marginflow.llm.registry import table, tokenizer_json
from marginflow.session import scratch_path

#: Share of a text's n-grams that the best language must explain.
MIN_LANGUAGE_SCORE = 0.2
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; the model is learned from their labels."""
    return langid.keep_identified(docs, langid.fit(docs), MIN_LANGUAGE_SCORE)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the trees learned from ``labels``."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; ``n_chars`` is counted anew."""
    cleaned = line_dedup.clean_lines(docs)
    changed = F.col("n_dropped") > 0
    return cleaned.withColumn(
        "n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return simhash.drop_near_duplicates(docs, shingle=4, bits=4)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 2048: one row per piece, with its ids."""
    return packing.pack_documents(docs, tokenizer_json(), keep_ids=True)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("simhash_near_dedup", near_deduplication),
    ("best_fit_packing", best_fit_packing),
]

#: Trained models and token ids are beyond SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    base = scratch_path(spark, "pipeline", uuid.uuid4().hex[:12])
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
