"""Manifests of the jobs' folders: which run wrote which table, and whether it finished.

A job writes several tables without a common commit, so a folder may hold tables of a run that
broke off, or of two runs. Each job therefore keeps, under ``<folder>/manifest``:

* one record for each table, written behind the table: the run's identity, rows, and the table's
  files (number, bytes, digest of names and lengths);
* one record of the job: ``started`` before its first write, ``complete`` with its result last.

The identity is the job, its settings and its source: for a folder of files the digest of their
names, lengths and times, for a job's folder the digest of that job's own record, so a change at
the beginning reaches every later job. The listings are Spark jobs on file names alone; contents
are not read, and row counts come from Parquet footers.

Rules: a job reads only a folder whose manifest is complete and whose tables still consist of the
recorded files (``require``). A rerun with the same identity keeps every table that is recorded
and whole up to the first that is not, and writes the others anew; if nothing is to do, it returns
the recorded result. A run with another identity writes everything. Sources without an identity
(DataFrames handed in) are never taken for the same. An unreadable record counts as none.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import store

FOLDER = "manifest"
JOB = "job"


class IncompleteFolder(RuntimeError):
    """A folder that no finished run wrote as it is now."""


def files_of(spark: SparkSession, path: str, with_times: bool = False) -> dict:
    """Number, bytes and digest of the files below ``path``; none if it is absent."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return {"files": 0, "bytes": 0, "digest": "0"}
    what = [F.substring_index("path", "/", -2), F.col("length"), *[F.col("modificationTime")] * with_times]
    # a sum of decimals: in any order the same, and repeated files do not cancel
    digest = F.coalesce(F.sum(F.xxhash64(*what).cast("decimal(20,0)")), F.lit(0)).cast("string")
    return found.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
                     digest.alias("digest")).first().asDict()


def read_record(spark: SparkSession, folder: str, name: str) -> dict | None:
    try:
        return json.loads(store.read_text_report(spark, os.path.join(folder, FOLDER, name)))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    except ValueError:  # broken off while it was written
        pass
    return None


def write_record(spark: SparkSession, folder: str, name: str, record: dict) -> None:
    store.write_text_report(spark, [store.to_json_line(record)], os.path.join(folder, FOLDER, name))


def identity(job: str, settings: dict, source: str | None) -> str | None:
    """Digest of what decides a run's results; None if the source cannot be told."""
    if source is None:
        return None
    return hashlib.sha256(store.to_json_line({"job": job, "settings": settings, "source": source}).encode()).hexdigest()


def source_digest(spark: SparkSession, path: str) -> str:
    return store.to_json_line(files_of(spark, path, with_times=True))


def require(spark: SparkSession, folder: str, job: str, tables: list[str]) -> str:
    """Digest of the record of the finished ``job`` in ``folder``, whose ``tables`` are as it left them."""
    record = read_record(spark, folder, JOB)
    if record is None or record.get("job") != job:
        raise IncompleteFolder(f"{folder} has no manifest of a {job!r} job: run it first")
    if record["state"] != "complete":
        raise IncompleteFolder(f"the {job!r} job in {folder} did not finish: run it again, it goes on where it stopped")
    for name in tables:
        if name not in record["tables"]:
            raise IncompleteFolder(f"the {job!r} job in {folder} wrote no table {name!r}")
        if files_of(spark, os.path.join(folder, name)) != record["tables"][name]["held"]:
            raise IncompleteFolder(f"table {name!r} in {folder} is not the one that the {job!r} job wrote: run it again")
    return hashlib.sha256(store.to_json_line(record).encode()).hexdigest()


class Run:
    """One run of a job that writes tables into ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, job: str, settings: dict, source: str | None):
        self.spark, self.folder, self.job = spark, folder, job
        self.identity = identity(job, settings, source)
        self.tables: dict[str, dict] = {}
        self.written: list[str] = []
        self._begun = False

    def _whole(self, name: str) -> dict | None:
        record = read_record(self.spark, self.folder, name)
        if self.identity is None or record is None or record.get("identity") != self.identity:
            return None
        return record if files_of(self.spark, os.path.join(self.folder, name)) == record["held"] else None

    def result(self, tables: list[str]) -> dict | None:
        """The recorded result, if this run was finished before and left ``tables``, still whole."""
        record = read_record(self.spark, self.folder, JOB)
        if self.identity is None or record is None or record.get("identity") != self.identity or record["state"] != "complete":
            return None
        return record["result"] if all(self._whole(name) for name in tables) else None

    def begin(self) -> None:
        """From here on the folder counts as unfinished."""
        if not self._begun:
            write_record(self.spark, self.folder, JOB, {"job": self.job, "state": "started", "identity": self.identity})
            self._begun = True

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The split-partitioned table ``name``: kept if it is whole and nothing before it was
        written anew, else made and written, then recorded."""
        self.begin()
        record = None if self.written else self._whole(name)
        path = os.path.join(self.folder, name)
        if record is None:
            write_record(self.spark, self.folder, name, {"state": "writing"})
            store.write_by_split(make(), path)
            self.written.append(name)
            record = {"identity": self.identity, "held": files_of(self.spark, path),
                      "rows": store.read_dataset(self.spark, path).count()}
            write_record(self.spark, self.folder, name, record)
        self.tables[name] = record
        return store.read_dataset(self.spark, path)

    def finish(self, result: dict) -> dict:
        """Record the job as complete; returns ``result`` as a later ``result()`` will."""
        result = json.loads(store.to_json_line(result))
        self.begin()
        write_record(self.spark, self.folder, JOB, {"job": self.job, "state": "complete", "identity": self.identity,
                                              "tables": self.tables, "result": result})
        return result
