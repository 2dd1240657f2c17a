"""Lab results: label lookup, relevant-label filter, abnormal flag."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import ABNORMAL_FLAGS
from tidemark.functions.exprs import upper_in


def relevant_labs(labevents: DataFrame, d_labitems: DataFrame, labels: Iterable[str],
                  abnormal_flags: Iterable[str] = ABNORMAL_FLAGS) -> DataFrame:
    """labevents inner-join lab items on itemid, keep exact label matches, add ``abnormal``.

    The label filter is on the lab-item side, so Catalyst applies it before the join (and
    pushes it into the lab-item scan when that is a file).
    """
    items = d_labitems.select("itemid", "label").where(F.col("label").isin(*list(labels)))
    return labevents.join(items, "itemid").withColumn("abnormal", upper_in("flag", abnormal_flags))


def lab_counts() -> list[F.Column]:
    return [F.count(F.lit(1)).alias("relevant_labs"), F.sum("abnormal").cast("bigint").alias("abnormal_labs")]


def lab_stats(labs: DataFrame) -> DataFrame:
    return labs.agg(*lab_counts())
