"""Typed readers for the six clinical input tables (CSV or parquet).

Schemas are explicit: codes stay strings (an all-digit code keeps its leading zeros) and
times are ``timestamp_ntz``. A missing input raises ``FileNotFoundError`` naming the table.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import csv_ranges

SCHEMAS: dict[str, T.StructType] = {
    "admissions": T.StructType([
        T.StructField("subject_id", T.LongType()),
        T.StructField("hadm_id", T.LongType()),
        T.StructField("admittime", T.TimestampNTZType()),
        T.StructField("dischtime", T.TimestampNTZType()),
    ]),
    "patients": T.StructType([
        T.StructField("subject_id", T.LongType()),
        T.StructField("gender", T.StringType()),
        T.StructField("anchor_age", T.IntegerType()),
    ]),
    "diagnoses_icd": T.StructType([
        T.StructField("hadm_id", T.LongType()),
        T.StructField("icd_code", T.StringType()),
        T.StructField("icd_version", T.IntegerType()),
    ]),
    "d_icd_diagnoses": T.StructType([
        T.StructField("icd_code", T.StringType()),
        T.StructField("icd_version", T.IntegerType()),
        T.StructField("long_title", T.StringType()),
    ]),
    "d_labitems": T.StructType([
        T.StructField("itemid", T.LongType()),
        T.StructField("label", T.StringType()),
    ]),
    "labevents": T.StructType([
        T.StructField("hadm_id", T.LongType()),
        T.StructField("itemid", T.LongType()),
        T.StructField("charttime", T.TimestampNTZType()),
        T.StructField("flag", T.StringType()),
    ]),
    "icd9_to_icd10": T.StructType([
        T.StructField("icd9", T.StringType()),
        T.StructField("icd10", T.StringType()),
    ]),
    "icd10_to_ccsr": T.StructType([
        T.StructField("icd10", T.StringType()),
        T.StructField("ccsr", T.StringType()),
    ]),
}

CLINICAL_TABLES = tuple(n for n in SCHEMAS if n not in ("icd9_to_icd10", "icd10_to_ccsr"))


OPTIONAL = {"d_icd_diagnoses": ("icd_version",)}


def _check_header(name: str, path: str, found: list[str]) -> None:
    missing = [f.name for f in SCHEMAS[name].fields if f.name not in found and f.name not in OPTIONAL.get(name, ())]
    if missing:
        raise ValueError(f"input table {name!r} at {path} lacks the columns {missing}; it has {found}")


def _csv_path(root: str, name: str) -> str:
    return os.path.join(root, f"{name}.csv")


# How fields are written: quotes are doubled inside quoted fields, an empty field is null.
CSV = {"nullValue": "", "quote": '"', "escape": '"', "mode": "FAILFAST"}


def _read_csv(spark: SparkSession, path: str, line_breaks: bool | None) -> DataFrame:
    """All columns of the CSV files at ``path``, as text."""
    plain = spark.read.options(header=True, **CSV)
    raw = plain.csv(path)
    if line_breaks is None:
        line_breaks = csv_ranges.has_broken_lines(spark, path)
    if not line_breaks:
        return raw
    header = spark.read.option("lineSep", "\n").text(path).first()["value"].removeprefix("\ufeff").removesuffix("\r")
    rows = csv_ranges.records(spark, path, header)
    if rows is None:  # more crossings than a broadcast holds: one task a file
        return plain.option("multiLine", True).csv(path)
    kind = ", ".join(f"`{c}` string" for c in raw.columns)
    return rows.select(F.from_csv("text", kind, {**CSV, "maxCharsPerColumn": "-1"}).alias("r")).select("r.*")


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "csv",
               null_tokens: tuple[str, ...] = (), line_breaks: bool | None = None) -> DataFrame:
    """Read one input table with its fixed schema.

    CSV files carry a header; extra columns in the file are ignored (only the schema's
    columns are selected, so the scan prunes them), and a missing one is an error that names
    it (``OPTIONAL`` columns read as null). Quotes inside quoted fields are doubled. Quoted
    fields may hold line breaks, in every table: files are read in byte ranges all the same
    (``csv_ranges``). A pass over the lines looks whether there are any; ``line_breaks`` says
    so beforehand. ``null_tokens`` lists extra texts such as ``NA`` that should read as null in
    string columns.
    """
    schema = SCHEMAS[name]
    path = _csv_path(root, name) if fmt == "csv" else os.path.join(root, f"{name}.{fmt}")
    try:
        if fmt == "csv":
            # Read every column as text, then cast: the header decides column positions,
            # and ANSI casts fail loudly on malformed numbers or times.
            raw = _read_csv(spark, path, line_breaks)
            _check_header(name, path, raw.columns)
            cols = []
            for f in schema.fields:
                c = F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None)
                if null_tokens:
                    c = F.when(c.isin(*null_tokens), F.lit(None)).otherwise(c)
                cols.append(c.cast(f.dataType).alias(f.name))
            df = raw.select(*cols)
        else:
            raw = spark.read.format(fmt).load(path)
            _check_header(name, path, raw.columns)
            df = raw.select(*[F.col(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name)
                              for f in schema.fields])
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"input table {name!r} not found at {path}") from e
        raise
    return df


def read_clinical(spark: SparkSession, root: str, fmt: str = "csv",
                  null_tokens: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The six clinical tables and the two crosswalk tables that map their codes; an absent one
    is a ``FileNotFoundError`` that names it."""
    return {name: read_table(spark, root, name, fmt, null_tokens) for name in SCHEMAS}
