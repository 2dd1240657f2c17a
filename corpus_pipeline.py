"""Corpus pipeline over ``documents``: each stage calls one operator of ``tidemark.llm``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame. ``run`` applies them in order, writing every stage as Parquet to the shared
checkpoint folder and rereading it, so a stage never recomputes its predecessors. All
stages but the last return the columns of ``documents``; the last returns one row for each
placed piece of a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, language, near_dedup, packing, quality
from tidemark.llm.common import read, remainder, stored

#: A document leaves if its language is this unsure; clear texts score close to 1.
LANGUAGE_SCORE = 0.5


def _where(docs: DataFrame, value: Column, condition: Column) -> DataFrame:
    """The rows of ``docs`` whose ``value`` (made once, as ``_tm_value``) meets ``condition``."""
    return docs.withColumn("_tm_value", value).where(condition).select(*docs.columns)


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold of the classifier stay."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return _where(docs, quality.scorer(spark, model)("text"), F.col("_tm_value") >= quality.THRESHOLD)


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language stay; texts without letters, or without a clear language, go."""
    model = language.fit(docs, remainder("doc_id", 5) != 0)
    return _where(docs, language.predictor(spark, model)("text"),
                  (F.col("_tm_value.lang_pred") != language.UNKNOWN) & (F.col("_tm_value.score") >= LANGUAGE_SCORE))


def stage_exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each set of equal texts stays: the one with the largest doc_id."""
    return exact_dedup.keep_latest(docs)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays: the one with the smallest doc_id."""
    return near_dedup.keep_one(docs)


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document, placed in bins of several capacities."""
    lengths = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                          packing.length_in_words(F.col("text")).alias("length"))
    return packing.pack(lengths)


STAGES = [
    ("quality", stage_quality),
    ("language", stage_language),
    ("exact_dedup", stage_exact_dedup),
    ("near_dedup", stage_near_dedup),
    ("packing", stage_packing),
]

#: No SQL: the learned stages and the packing have no SQL form (tests use brute force).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
