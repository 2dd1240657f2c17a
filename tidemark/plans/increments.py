"""Prepared tables that follow their sources: only entities whose rows changed are built again.

The folder holds ``timeline``, ``history``, ``samples`` and ``patients``, as the jobs would build
them from the same sources, dealt to ``buckets`` folders by a hash of the entity id, and ``prints``:
one fingerprint for each entity, of its admissions, their coded and relevant laboratory rows and its
demographics (sums of 64-bit row hashes, so a change passes unseen with a chance of 2**-64).

A run computes the fingerprints anew (partial sums by visit, then by entity; no list, no order) and
compares them with the written ones in one full outer join. New, changed and vanished entities are
told by that; for them alone the visits are ordered and the lists built, and a membership filter
drops other visits' facts during the scan. The folders of their buckets are replaced (dynamic
overwrite) by the other entities' rows as they were and the rebuilt ones. Other folders' files are
not touched. Other settings, or other code, title or laboratory tables, rebuild everything.

Fingerprints are replaced last, and the buckets in flight are recorded before the first write. If a
run breaks off, the next one builds every entity of those buckets from the sources, so folders that
were lost or half replaced come back. One run of a folder at a time.

Each replaced folder also gets a row whose key is null, so that a bucket without entities is
replaced too; ``read`` drops those. An entity or visit without an id has no place here, as in the
jobs. Repeated rows change a fingerprint. Empty sources give tables without rows.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import CohortConfig
from tidemark.operators import aggregate, codes, labs, membership, samples, splits, visits
from tidemark.plans import manifest
from tidemark.plans.jobs import HISTORY_COLS
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import store
from tidemark.sources.tables import SCHEMAS

JOB = "increment"
BUCKETS = 256
#: The tables and their entity column, in the order in which they are replaced.
KEYS = {"timeline": "subject_id", "history": "subject_id", "samples": "patient_id", "patients": "patient_id",
        "prints": "subject_id"}
DIMENSIONS = ("d_icd_diagnoses", "d_labitems", "icd9_to_icd10", "icd10_to_ccsr")


def _sum_of_hashes(*cols: str | Column) -> Column:
    """The same in any order of the rows; repeated rows do not cancel."""
    return F.coalesce(F.sum(F.xxhash64(*cols).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))


def fingerprints(t: dict[str, DataFrame], lab: DataFrame) -> DataFrame:
    """subject_id, n_visits, print: one row for each entity that has an admission."""
    dx = t["diagnoses_icd"].select("hadm_id", F.xxhash64(F.lit("dx"), "icd_code", "icd_version").alias("_h"))
    facts = dx.unionByName(lab.select("hadm_id", F.xxhash64(F.lit("lab"), "label", "abnormal").alias("_h")))
    per_visit = (facts.where(F.col("hadm_id").isNotNull()).groupBy("hadm_id")
                 .agg(_sum_of_hashes("_h").alias("_facts"), F.count(F.lit(1)).alias("_n")))
    admissions = (t["admissions"].where(F.col("subject_id").isNotNull())
                  .select("subject_id", "hadm_id", "admittime", "dischtime").join(per_visit, "hadm_id", "left"))
    per_entity = admissions.groupBy("subject_id").agg(
        F.count(F.lit(1)).alias("n_visits"),
        _sum_of_hashes("hadm_id", "admittime", "dischtime", "_facts", "_n").alias("_visits"))
    who = samples.demographics(t["patients"]).select("subject_id", F.xxhash64("age", "gender").alias("_who"))
    return (per_entity.join(who, "subject_id", "left")
            .select("subject_id", "n_visits", F.concat_ws(":", "_visits", "_who").alias("print")))


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of a folder that a run finished."""
    record = manifest.read_record(spark, folder, manifest.JOB)
    if record is None or record.get("job") != JOB or record["state"] != "complete":
        raise manifest.IncompleteFolder(f"{folder} has no finished {JOB!r} run")
    return _rows(spark, folder, name).drop("bucket")


def _rows(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, name)).where(F.col(KEYS[name]).isNotNull())


def _rebuilt(spark: SparkSession, t: dict[str, DataFrame], lab: DataFrame, ids: DataFrame, cfg: CohortConfig,
             keep) -> dict[str, DataFrame]:
    """The four tables of the entities ``ids`` alone; ``keep`` writes and reads back a table."""
    admissions = keep("admissions", t["admissions"].join(ids, "subject_id", "left_semi"))
    asked = membership.members(admissions, "hadm_id")
    diagnoses = asked.keep(t["diagnoses_icd"], "hadm_id")
    flags = visits.visit_flags(admissions, visits.visit_target_flag(
        codes.map_codes(diagnoses, t["icd9_to_icd10"], t["icd10_to_ccsr"]), cfg.target_code))
    tl = keep("timeline", splits.hash_split(
        samples.timeline(flags, t["patients"].join(ids, "subject_id", "left_semi")).drop("first_time", "next_time", "is_sample"),
        "subject_id", cfg.seed, cfg.train_pct, cfg.train_val_pct))
    mapped = codes.mapped_diagnoses(t["diagnoses_icd"], t["d_icd_diagnoses"], t["icd9_to_icd10"], t["icd10_to_ccsr"],
                                    cfg.title_join_on_version)
    dx_lists, lab_lists = visits.lists_of(membership.members(tl.where("in_history"), "hadm_id"), mapped, lab)
    history = keep("history", samples.attach_details(tl, dx_lists, lab_lists).select(*HISTORY_COLS, "split"))
    kept = tl.where("kept").select("hadm_id", "split")
    return {"timeline": tl, "history": history,
            "samples": samples.samples(tl).join(kept, "hadm_id"),
            "patients": aggregate.with_text(aggregate.patient_rows(history))}


def increment(spark: SparkSession, tables: dict[str, DataFrame], folder: str, cfg: CohortConfig = CohortConfig(),
              buckets: int = BUCKETS) -> dict:
    """Bring ``folder`` up to the sources ``tables`` (names as in ``SCHEMAS``).

    Returns how many entities were built or removed, the buckets replaced, and whether all
    were built because nothing (or something else) was there before.
    """
    for name in SCHEMAS:
        if name not in tables:
            raise FileNotFoundError(f"input table {name!r} is missing")
    scratch = f"{ensure_checkpoint_dir(spark)}/increment-{uuid.uuid4().hex}"

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    dims = {n: tables[n].agg(_sum_of_hashes(*tables[n].columns)).first()[0] for n in DIMENSIONS}
    identity = manifest.identity(JOB, {**asdict(cfg), "buckets": buckets}, store.to_json_line(dims))
    record = manifest.read_record(spark, folder, manifest.JOB)
    fresh = record is None or record.get("job") != JOB or record.get("identity") != identity
    in_flight = [] if fresh or record["state"] == "complete" else record["buckets"]

    lab = labs.relevant_labs(tables["labevents"], tables["d_labitems"], cfg.relevant_labs, cfg.abnormal_flags)
    prints = keep("prints", fingerprints(tables, lab).withColumn("bucket", bucket_of("subject_id", buckets)))
    if fresh:
        changed = prints.select("subject_id", "bucket")
    else:
        before = _rows(spark, folder, "prints").select("subject_id", "bucket", F.col("print").alias("_was"))
        both = prints.select("subject_id", "bucket", "print").join(before, ["subject_id", "bucket"], "full_outer")
        differs = ~F.col("print").eqNullSafe(F.col("_was"))
        changed = both.where(differs | F.col("bucket").isin(in_flight)).select("subject_id", "bucket")
    changed = keep("changed", changed)
    n = changed.count()
    told = sorted({r["bucket"] for r in changed.select("bucket").distinct().collect()} | set(in_flight))  # at most ``buckets``
    told = told or [0] * fresh
    result = {"entities": n, "buckets": told, "rebuilt_all": fresh}
    if not told:
        return result

    rebuilt = _rebuilt(spark, tables, lab, changed.select("subject_id"), cfg, keep)
    started = {"job": JOB, "state": "started", "buckets": told, "identity": None if fresh else identity}
    manifest.write_record(spark, folder, manifest.JOB, started)
    empty = spark.createDataFrame([(b,) for b in told], "bucket int")
    for name, key in KEYS.items():
        if name == "prints":
            rows = prints.where(F.col("bucket").isin(told))
        else:
            rows = rebuilt[name].withColumn("bucket", bucket_of(key, buckets))
            if not fresh:
                gone = changed.select(F.col("subject_id").alias(key))
                others = _rows(spark, folder, name).where(F.col("bucket").isin(told)).join(gone, key, "left_anti")
                rows = rows.unionByName(others.select(*rows.columns))
        (rows.unionByName(empty, allowMissingColumns=True).hint("rebalance", F.col("bucket"))
         .write.mode("overwrite").option("partitionOverwriteMode", "static" if fresh else "dynamic")
         .partitionBy("bucket").parquet(os.path.join(folder, name)))
    manifest.write_record(spark, folder, manifest.JOB, {"job": JOB, "state": "complete", "identity": identity, "result": result})
    return result
