"""An increment equals a full build, touches only the folders of changed entities, and mends broken runs."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tidemark.config import FIXTURE_CONFIG
from tidemark.operators import aggregate, samples
from tidemark.plans import increments, manifest
from tidemark.plans.catalog import Fixture

BUCKETS = 8


def _files(folder):
    return {p: os.path.getmtime(p) for p in glob.glob(os.path.join(folder, "*", "bucket=*", "*.parquet"))}


def _same(a, b):
    b = b.select(*a.columns)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def _as_the_core_builds(spark, folder, fx):
    _same(samples.samples(fx.timeline), increments.read(spark, folder, "samples"))
    _same(aggregate.patient_rows(fx.history), increments.read(spark, folder, "patients"))


def test_increment_equals_a_full_build_and_mends_a_broken_run(spark, tmp_out, monkeypatch):
    fx, folder = Fixture(spark, SF0001), os.path.join(tmp_out, "f")
    t = dict(vars(fx.inputs))
    people = [r[0] for r in fx.samples.select("patient_id").distinct().orderBy("patient_id").limit(3).collect()]
    visit = t["admissions"].where(F.col("subject_id") == people[0]).agg(F.max("hadm_id")).first()[0]
    older = {**t,
             "diagnoses_icd": t["diagnoses_icd"].where(F.col("hadm_id") != visit),  # facts of a known visit come later
             "patients": t["patients"].withColumn("anchor_age", F.when(F.col("subject_id") == people[1], 99).otherwise(F.col("anchor_age")).cast("int")),
             "admissions": t["admissions"].where(F.col("subject_id") != people[2])}  # a new entity
    assert increments.increment(spark, older, folder, FIXTURE_CONFIG, BUCKETS)["rebuilt_all"]
    before = _files(folder)
    got = increments.increment(spark, t, folder, FIXTURE_CONFIG, BUCKETS)
    assert got["entities"] == 3 and 1 <= len(got["buckets"]) <= 3 and not got["rebuilt_all"]
    after = _files(folder)
    for path, time in before.items():
        touched = int(path.split("bucket=")[1].split("/")[0]) in got["buckets"]
        assert (after.get(path) != time) == touched
    _as_the_core_builds(spark, folder, fx)
    # nothing changed: nothing is written
    assert increments.increment(spark, t, folder, FIXTURE_CONFIG, BUCKETS)["buckets"] == []
    assert _files(folder) == after

    # a run breaks off behind its second table, and a folder in flight loses its files
    rows = increments._rows

    def lost(spark_, folder_, name):
        if name == "samples":
            raise OSError("lost")
        return rows(spark_, folder_, name)

    monkeypatch.setattr(increments, "_rows", lost)
    vanished = {**t, "admissions": t["admissions"].where(F.col("subject_id") != people[0])}
    with pytest.raises(OSError, match="lost"):
        increments.increment(spark, vanished, folder, FIXTURE_CONFIG, BUCKETS)
    monkeypatch.setattr(increments, "_rows", rows)
    with pytest.raises(manifest.IncompleteFolder):
        increments.read(spark, folder, "patients")
    bucket = manifest.read_record(spark, folder, manifest.JOB)["buckets"][0]
    for path in glob.glob(os.path.join(folder, "history", f"bucket={bucket}", "*.parquet")):
        os.remove(path)
    got = increments.increment(spark, t, folder, FIXTURE_CONFIG, BUCKETS)  # the change was taken back meanwhile
    assert got["buckets"] == [bucket] and got["entities"] > 1
    _as_the_core_builds(spark, folder, fx)
