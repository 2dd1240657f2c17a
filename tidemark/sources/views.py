"""Role views: the driver's star-schema tables shaped into the clinical input roles.

Each view is a projection (plus one filter) over a parquet scan, so column pruning and
filter pushdown reach the files. The same view text exists for DuckDB in
``tidemark.plans.oracle`` so both engines see identical inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@dataclass
class ClinicalInputs:
    admissions: DataFrame
    patients: DataFrame
    diagnoses_icd: DataFrame
    d_icd_diagnoses: DataFrame
    d_labitems: DataFrame
    labevents: DataFrame
    icd9_to_icd10: DataFrame
    icd10_to_ccsr: DataFrame


def star_schema_inputs(spark: SparkSession, sf_dir: str) -> ClinicalInputs:
    """customer -> patients, orders -> admissions, lineitem -> diagnoses and lab events,
    part -> code titles, lab items and both crosswalks."""
    customer = read_driver(spark, sf_dir, "customer")
    orders = read_driver(spark, sf_dir, "orders")
    lineitem = read_driver(spark, sf_dir, "lineitem")
    part = read_driver(spark, sf_dir, "part")

    patients = customer.select(
        F.col("c_custkey").alias("subject_id"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
        (F.lit(18) + F.col("c_custkey") % 70).cast("int").alias("anchor_age"),
    )
    admissions = orders.select(
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderdate").alias("admittime"),
        F.timestamp_add("HOUR", ((F.col("o_orderkey") * 7) % 480 + 1).cast("int"),
                        F.col("o_orderdate")).alias("dischtime"),
    )
    diagnoses = lineitem.select(
        F.col("l_orderkey").alias("hadm_id"),
        F.col("l_partkey").cast("string").alias("icd_code"),
        F.when(F.col("l_linestatus") == "F", F.lit(9)).otherwise(F.lit(10)).alias("icd_version"),
    )
    icd9_to_icd10 = part.select(
        F.col("p_partkey").cast("string").alias("icd9"),
        (F.col("p_partkey") + F.col("p_size")).cast("string").alias("icd10"),
    )
    icd10_to_ccsr = part.where(F.col("p_size") <= 48).select(
        F.col("p_partkey").cast("string").alias("icd10"), F.col("p_brand").alias("ccsr"))
    d_icd = part.where(F.col("p_size") <= 45).select(
        F.col("p_partkey").cast("string").alias("icd_code"), F.col("p_name").alias("long_title"))
    d_labitems = part.select(F.col("p_partkey").alias("itemid"), F.col("p_type").alias("label"))
    labevents = lineitem.select(
        F.col("l_orderkey").alias("hadm_id"),
        F.col("l_partkey").alias("itemid"),
        F.col("l_shipdate").alias("charttime"),
        F.when(F.col("l_returnflag") == "R", F.lit("high"))
         .when(F.col("l_returnflag") == "A", F.lit("abnormal")).alias("flag"),
    )
    return ClinicalInputs(admissions, patients, diagnoses, d_icd, d_labitems, labevents,
                          icd9_to_icd10, icd10_to_ccsr)


def event_inputs(spark: SparkSession, sf_dir: str, target_type: str = "purchase"):
    """Click-stream roles: user -> entity, event -> episode, ts -> time, and the event
    type as the episode's single code (target: ``purchase``)."""
    events = read_driver(spark, sf_dir, "events")
    admissions = events.select(
        F.col("user_id").alias("subject_id"), F.col("event_id").alias("hadm_id"),
        F.col("ts").alias("admittime"), F.col("ts").alias("dischtime"))
    codes = events.select(F.col("event_id").alias("hadm_id"),
                          F.col("event_type").alias("ccsr_code"))
    return admissions, codes
