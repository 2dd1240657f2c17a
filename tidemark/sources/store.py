"""Split-partitioned parquet datasets written between the jobs.

One folder per dataset, ``split=train|val|test`` sub-folders; a reader that filters on
``split`` only lists and opens the matching folder (partition pruning).
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_by_split(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write ``df`` as parquet partitioned by ``split``; ``mode`` is explicit
    ('overwrite' | 'errorifexists' | 'append'). The writer creates missing folders."""
    df.write.mode(mode).partitionBy("split").parquet(path)
    return path


def read_dataset(spark: SparkSession, path: str, split: str | list[str] | None = None) -> DataFrame:
    """Read a split-partitioned dataset, optionally only some splits."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"dataset not found at {path}") from e
        raise
    if split is None:
        return df
    wanted = [split] if isinstance(split, str) else list(split)
    return df.where(F.col("split").isin(*wanted))


def write_small_json(spark: SparkSession, rows: DataFrame, path: str) -> str:
    """Write a small result table (statistics, metrics) as one JSON file folder."""
    rows.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_text_report(spark: SparkSession, lines: list[str], path: str) -> str:
    """A human-readable report next to the data: a text folder with one part file, written
    by Spark, so it lands on the job's (shared) output storage and not on the driver's
    disk. ``lines`` is a few report lines; their order is kept (one partition)."""
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, value string")
    df.coalesce(1).sortWithinPartitions("i").select("value").write.mode("overwrite").text(path)
    return path


def read_text_report(spark: SparkSession, path: str) -> str:
    """The report written by ``write_text_report``, as one string."""
    return "\n".join(r["value"] for r in spark.read.text(path).collect()) + "\n"


def to_json_line(d: dict) -> str:
    return json.dumps(d, default=str, sort_keys=True)
