"""Structured Streaming use of the stateless operators.

Lab flagging and the code crosswalk are projections plus joins against dimension tables,
so the same functions accept a streaming DataFrame: the stream stays on the left of
stream-static joins (inner for lab items, left outer for the crosswalks). No state is
kept. The per-entity sequence operators need the entity's whole history and remain batch.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import ABNORMAL_FLAGS
from tidemark.operators.codes import map_codes
from tidemark.operators.labs import relevant_labs


def lab_event_stream(spark: SparkSession, lineitem_dir: str, schema) -> DataFrame:
    """The lab-event role over a folder of lineitem-shaped parquet files, as a stream."""
    raw = spark.readStream.schema(schema).parquet(lineitem_dir)
    return raw.select(
        F.col("l_orderkey").alias("hadm_id"), F.col("l_partkey").alias("itemid"),
        F.col("l_shipdate").alias("charttime"),
        F.when(F.col("l_returnflag") == "R", F.lit("high"))
         .when(F.col("l_returnflag") == "A", F.lit("abnormal")).alias("flag"))


def flagged_labs(lab_stream: DataFrame, d_labitems: DataFrame, labels: Iterable[str],
                 abnormal_flags: Iterable[str] = ABNORMAL_FLAGS) -> DataFrame:
    """Relevant lab results with the abnormal flag, row by row as they arrive."""
    return relevant_labs(lab_stream, d_labitems, labels, abnormal_flags)


def mapped_codes(dx_stream: DataFrame, icd9_to_icd10: DataFrame, icd10_to_ccsr: DataFrame) -> DataFrame:
    """Diagnoses mapped to categories as they arrive."""
    return map_codes(dx_stream, icd9_to_icd10, icd10_to_ccsr)


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """Append the stream to a parquet folder. Both ``path`` and ``checkpoint`` belong on
    the shared storage the cluster names (the checkpoint holds the source offsets and the
    sink's commit log, so a restarted query resumes exactly once). With ``trigger_once``
    it processes what is available and stops."""
    w = (df.writeStream.outputMode("append").format("parquet")
         .option("path", path).option("checkpointLocation", checkpoint))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
