"""Jobs that break off, go on, and refuse what no finished run wrote."""

import glob
import os
from dataclasses import replace

import pytest

from tidemark.config import FIXTURE_CONFIG
from tidemark.plans import jobs, manifest
from tidemark.sources import store
from test_io_jobs import _write_clinical_csv


def _files(*parts):
    return {p: os.path.getmtime(p) for p in glob.glob(os.path.join(*parts, "**", "*.parquet"), recursive=True)}


def _same_rows(spark, a, b):
    x, y = store.read_dataset(spark, a), store.read_dataset(spark, b)
    y = y.select(*x.columns)
    assert x.count() == y.count() > 0
    assert x.exceptAll(y).count() == 0


def test_broken_job_goes_on_behind_its_last_whole_table(spark, tmp_out, monkeypatch):
    src, out, other = (os.path.join(tmp_out, n) for n in ("src", "out", "other"))
    prepared = os.path.join(out, "prepared")
    _write_clinical_csv(spark, src)
    write = store.write_by_split

    def breaks(df, path, *a):
        if path.endswith("history"):
            write(df.limit(3), path, *a)  # half of it is on disk
            raise OSError("lost")
        return write(df, path, *a)

    monkeypatch.setattr(store, "write_by_split", breaks)
    with pytest.raises(OSError, match="lost"):
        jobs.prepare(spark, src, out, FIXTURE_CONFIG)
    monkeypatch.setattr(store, "write_by_split", write)
    with pytest.raises(manifest.IncompleteFolder, match="did not finish"):
        jobs.aggregate_job(spark, prepared, out)

    timeline = _files(prepared, "timeline")
    stats = jobs.prepare(spark, src, out, FIXTURE_CONFIG)
    assert timeline and _files(prepared, "timeline") == timeline  # kept as it was
    full = jobs.prepare(spark, src, other, FIXTURE_CONFIG)
    assert stats == full
    for name in ("timeline", "history", "samples"):
        _same_rows(spark, os.path.join(prepared, name), os.path.join(other, "prepared", name))

    # nothing to do: the recorded result, no file touched
    before = _files(prepared)
    assert jobs.prepare(spark, src, out, FIXTURE_CONFIG) == stats and _files(prepared) == before
    summary = jobs.aggregate_job(spark, prepared, out)
    patients = _files(out, "aggregated")
    assert jobs.aggregate_job(spark, prepared, out) == summary and _files(out, "aggregated") == patients

    # a lost file: refused, and only this table and those behind it are written again
    os.remove(sorted(_files(prepared, "history"))[0])
    with pytest.raises(manifest.IncompleteFolder, match="'history'"):
        jobs.aggregate_job(spark, prepared, out)
    jobs.prepare(spark, src, out, FIXTURE_CONFIG)
    assert _files(prepared, "timeline") == timeline
    _same_rows(spark, os.path.join(prepared, "history"), os.path.join(other, "prepared", "history"))

    # another seed is another run: everything is written, and the next job sees another source
    jobs.prepare(spark, src, out, replace(FIXTURE_CONFIG, seed=7))
    assert not set(_files(prepared, "timeline")) & set(timeline)
    jobs.aggregate_job(spark, prepared, out)
    assert not set(_files(out, "aggregated")) & set(patients)


def test_records(spark, tmp_out):
    folder = os.path.join(tmp_out, "f")
    with pytest.raises(manifest.IncompleteFolder, match="no manifest"):
        manifest.require(spark, folder, "prepare", [])
    df = spark.createDataFrame([(1, "train"), (2, "val")], "id long, split string")
    run = manifest.Run(spark, folder, "prepare", {"seed": 1}, "files")
    run.table("t", lambda: df)
    with pytest.raises(manifest.IncompleteFolder, match="did not finish"):
        manifest.require(spark, folder, "prepare", ["t"])
    run.finish({"n": 2})
    assert len(manifest.require(spark, folder, "prepare", ["t"])) == 64
    with pytest.raises(manifest.IncompleteFolder, match="no table 'u'"):
        manifest.require(spark, folder, "prepare", ["u"])
    with pytest.raises(manifest.IncompleteFolder, match="'aggregate'"):
        manifest.require(spark, folder, "aggregate", [])
    assert manifest.Run(spark, folder, "prepare", {"seed": 1}, "files").result(["t"]) == {"n": 2}
    for settings, source in (({"seed": 2}, "files"), ({"seed": 1}, "others"), ({"seed": 1}, None)):
        assert manifest.Run(spark, folder, "prepare", settings, source).result(["t"]) is None
    record = glob.glob(os.path.join(folder, "manifest", "job", "part-*"))[0]
    os.remove(record)  # a record that was being written
    assert manifest.Run(spark, folder, "prepare", {"seed": 1}, "files").result(["t"]) is None


def test_file_digests(spark, tmp_out):
    assert manifest.files_of(spark, os.path.join(tmp_out, "none"))["files"] == 0
    a = os.path.join(tmp_out, "a")
    spark.range(10).coalesce(2).write.parquet(a)
    first = manifest.files_of(spark, a)
    assert first["files"] >= 1 and first == manifest.files_of(spark, a)
    spark.range(1).write.mode("append").parquet(a)
    assert manifest.files_of(spark, a) != first
