"""Per-visit facts: diagnosis titles, abnormal labs, target flag, length of stay.

Every output here has one row per visit id, so the joins that combine them are on a
unique key and cannot skew. Lists are built in two steps (distinct (visit, item) with a
count, then one list per visit), so a visit with very many rows only ships its distinct
items through the second shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import any_equal, fractional_days
from tidemark.operators.membership import Members


def visit_diagnoses(mapped: DataFrame, title: str = "long_title") -> DataFrame:
    """hadm_id, diagnoses: all titles of the visit, duplicates kept, sorted; null titles
    are skipped, and a visit without any title has no row. Aggregated as (title, count), so a
    visit ships each title once; the list itself is as long as the visit's coded rows."""
    counted = (mapped.where(F.col(title).isNotNull())
               .groupBy("hadm_id", F.col(title).alias("_t")).agg(F.count(F.lit(1)).alias("_n")))
    per_visit = counted.groupBy("hadm_id").agg(
        F.array_sort(F.collect_list(F.struct("_t", "_n"))).alias("_tn"))
    expanded = F.flatten(F.transform("_tn", lambda x: F.array_repeat(x["_t"], x["_n"].cast("int"))))
    return per_visit.select("hadm_id", expanded.alias("diagnoses"))


def visit_abnormal_labs(labs: DataFrame) -> DataFrame:
    """hadm_id, abnormal_labs: distinct labels of abnormal results, sorted."""
    return (labs.where((F.col("abnormal") == 1) & F.col("hadm_id").isNotNull())
            .groupBy("hadm_id").agg(F.array_sort(F.collect_set("label")).alias("abnormal_labs")))


def lists_of(wanted: Members, mapped: DataFrame, labs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``visit_diagnoses`` and ``visit_abnormal_labs`` of the wanted visits (and of the few others
    that the filter lets pass): rows of other visits leave during the scan, before the lists'
    shuffles. The lists themselves are exact."""
    return (visit_diagnoses(wanted.keep(mapped, "hadm_id")), visit_abnormal_labs(wanted.keep(labs, "hadm_id")))


def visit_target_flag(mapped: DataFrame, target: str, code: str = "ccsr_code") -> DataFrame:
    """hadm_id, has_target: 1 when any diagnosis of the visit maps to ``target``."""
    return mapped.groupBy("hadm_id").agg(any_equal(code, target).alias("has_target"))


def with_length_of_stay(admissions: DataFrame) -> DataFrame:
    return admissions.withColumn("length_of_stay", fractional_days("admittime", "dischtime"))


def visit_flags(admissions: DataFrame, codes_per_visit: DataFrame) -> DataFrame:
    """The narrow visit table that drives ordering: subject_id, hadm_id, admittime,
    length_of_stay, has_target (0 for a visit without diagnoses). The length of stay is
    one number per visit, so it rides along here rather than costing another scan and
    shuffle of the admissions when the history is assembled."""
    return (with_length_of_stay(admissions).select("subject_id", "hadm_id", "admittime", "length_of_stay")
            .join(codes_per_visit.select("hadm_id", "has_target"), "hadm_id", "left")
            .withColumn("has_target", F.coalesce("has_target", F.lit(0))))
