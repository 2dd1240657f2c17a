"""Diagnosis codes: version-dispatched crosswalk to a category, titles, mapping statistics.

Crosswalks and titles are dimension tables (bounded by the code vocabulary, not by the
data). They are joined with ordinary equi-joins; Catalyst broadcasts them when their size
estimate is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks with runtime
sizes, so an unexpectedly large crosswalk falls back to a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import INVALID_CODE
from tidemark.functions.exprs import not_equal_null_safe


def _one_target_per_source(xwalk: DataFrame, src: str, dst: str, alias: str) -> DataFrame:
    """A code maps to one target: the smallest, so a duplicated crosswalk row cannot fan
    out the diagnoses."""
    return xwalk.where(F.col(src).isNotNull()).groupBy(F.col(src).alias(f"_{alias}_key")) \
        .agg(F.min(dst).alias(f"_{alias}_val"))


def map_codes(diagnoses: DataFrame, icd9_to_icd10: DataFrame, icd10_to_ccsr: DataFrame,
              code: str = "icd_code", version: str = "icd_version",
              out: str = "ccsr_code") -> DataFrame:
    """Add ``out``: version 9 maps code -> icd10 -> category, version 10 maps code ->
    category, any other (or null) version gives 'Invalid'. An unmapped code gives null."""
    x9 = _one_target_per_source(icd9_to_icd10, "icd9", "icd10", "x9")
    x10 = _one_target_per_source(icd10_to_ccsr, "icd10", "ccsr", "x10")
    v = F.col(version)
    step1 = diagnoses.join(x9, (F.col(code) == F.col("_x9_key")) & (v == F.lit(9)), "left")
    icd10 = F.when(v == F.lit(9), F.col("_x9_val")).when(v == F.lit(10), F.col(code))
    step2 = step1.withColumn("_icd10", icd10).join(x10, F.col("_icd10") == F.col("_x10_key"), "left")
    category = F.when(v.isNull() | ~v.isin(9, 10), F.lit(INVALID_CODE)).otherwise(F.col("_x10_val"))
    return step2.withColumn(out, category).drop("_x9_key", "_x9_val", "_icd10", "_x10_key", "_x10_val")


def add_titles(diagnoses: DataFrame, d_icd: DataFrame, on_version: bool = False) -> DataFrame:
    """Left join of code titles. On the code alone (default) a code listed under both
    versions duplicates the diagnosis row, as the pandas merge does."""
    keys = ["icd_code", "icd_version"] if on_version else ["icd_code"]
    titles = d_icd.select(*keys, "long_title")
    return diagnoses.join(titles, keys, "left")


def mapped_diagnoses(diagnoses: DataFrame, d_icd: DataFrame, icd9_to_icd10: DataFrame,
                     icd10_to_ccsr: DataFrame, on_version: bool = False) -> DataFrame:
    """Crosswalk then titles: one row per (diagnosis, matching title)."""
    return add_titles(map_codes(diagnoses, icd9_to_icd10, icd10_to_ccsr), d_icd, on_version)


def mapping_counts(col: str = "ccsr_code") -> list[F.Column]:
    """Aggregates: total, valid (not 'Invalid', null counts as valid), failed."""
    valid = not_equal_null_safe(col, INVALID_CODE)
    return [F.count(F.lit(1)).alias("total_codes"), F.count_if(valid).alias("valid_mappings"),
            F.count_if(~valid).alias("failed_mappings")]


def mapping_stats(mapped: DataFrame, col: str = "ccsr_code") -> DataFrame:
    return mapped.agg(*mapping_counts(col))
