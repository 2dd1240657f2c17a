"""Typed CSV reads, split-partitioned round trips, the three jobs end to end, streaming."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tidemark.config import FIXTURE_CONFIG
from tidemark.operators import aggregate, classify, codes, samples, splits
from tidemark.plans import jobs
from tidemark.plans.catalog import Fixture
from tidemark.sources import store
from tidemark.sources.tables import read_clinical, read_table
from tidemark.streaming import stateless


def test_csv_keeps_leading_zeros_and_types(spark, tmp_out):
    path = os.path.join(tmp_out, "diagnoses_icd.csv")
    with open(path, "w") as fh:
        fh.write("subject_id,hadm_id,seq_num,icd_code,icd_version\n1,10,1,0010,9\n1,10,2,,\n")
    df = read_table(spark, tmp_out, "diagnoses_icd")
    rows = df.collect()
    assert df.columns == ["hadm_id", "icd_code", "icd_version"]
    assert rows[0]["icd_code"] == "0010" and rows[1]["icd_version"] is None


def test_missing_table_names_it(spark, tmp_out):
    with pytest.raises(FileNotFoundError, match="admissions"):
        read_table(spark, tmp_out, "admissions")


def test_roundtrip_prunes_partitions(spark, tmp_out):
    df = spark.range(30).select(F.col("id").alias("patient_id"),
                                F.when(F.col("id") % 3 == 0, "train").when(F.col("id") % 3 == 1, "val")
                                .otherwise("test").alias("split"))
    path = store.write_by_split(df, os.path.join(tmp_out, "ds"))
    assert {"split=test", "split=train", "split=val"} <= set(os.listdir(path))
    back = store.read_dataset(spark, path, "val")
    assert back.count() == 10
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "val" in plan


def _write_clinical_csv(spark, out, absent=()):
    fx = Fixture(spark, SF0001)
    i = fx.inputs
    tables = {"admissions": i.admissions, "patients": i.patients, "diagnoses_icd": i.diagnoses_icd,
              "d_icd_diagnoses": i.d_icd_diagnoses, "d_labitems": i.d_labitems, "labevents": i.labevents,
              "icd9_to_icd10": i.icd9_to_icd10, "icd10_to_ccsr": i.icd10_to_ccsr}
    for name, df in tables.items():
        if name in absent:
            continue
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(os.path.join(out, f"{name}.csv"))
    return tables


def test_jobs_end_to_end(spark, tmp_out):
    src = os.path.join(tmp_out, "src")
    _write_clinical_csv(spark, src)
    stats = jobs.prepare(spark, src, tmp_out, FIXTURE_CONFIG, "csv", nested=True)
    assert stats["total_codes"] == 6000 and stats["relevant_labs"] == 3087
    assert stats["all_patients"] == 150 and stats["valid_patients"] == 122
    total = [s for s in stats["splits"] if s["split"] == "total"][0]
    assert (total["samples"], total["patients"], total["positives"]) == (495, 122, 101)

    prepared = os.path.join(tmp_out, "prepared")
    nested = store.read_dataset(spark, os.path.join(prepared, "nested_samples"))
    assert nested.count() == 495
    assert nested.select(F.sum(F.size("history"))).first()[0] == 1777  # flattened rows
    # the explode definition and the prefix rewrite agree
    by_def = aggregate.patient_rows_from_nested(nested.drop("split"))
    agg = jobs.aggregate_job(spark, prepared, tmp_out)
    assert sum(r["total_patients"] for r in agg["summary"]) == 122
    rows = store.read_dataset(spark, os.path.join(tmp_out, "aggregated", "patients"))
    cols = ["patient_id", "is_ckd", "num_visits", "diagnoses", "abnormal_labs", "age", "gender"]
    assert rows.select(*cols).exceptAll(by_def.select(*cols)).count() == 0
    assert by_def.select(*cols).exceptAll(rows.select(*cols)).count() == 0

    res = jobs.train_job(spark, os.path.join(tmp_out, "aggregated"), tmp_out, FIXTURE_CONFIG,
                         classify.ClassifierParams(num_features=1 << 12, max_iter=10))
    report = store.read_text_report(spark, os.path.join(tmp_out, "model", "training_results"))
    assert report.splitlines()[0] == "=== CROSS-VALIDATION RESULTS ==="
    assert "=== TEST RESULTS ===" in report and "avg_roc_auc:" in report
    model = classify.load_model(os.path.join(tmp_out, "model", "best_model"))
    assert len(model.stages) == 4 and 0 <= res["best_fold"] < 3


def test_stream_matches_batch(spark, tmp_out):
    fx = Fixture(spark, SF0001)
    schema = spark.read.parquet(f"{SF0001}/lineitem.parquet").schema
    src = os.path.join(tmp_out, "lineitem_stream")
    os.makedirs(src)
    spark.read.parquet(f"{SF0001}/lineitem.parquet").write.mode("overwrite").parquet(os.path.join(src, "batch0"))
    stream = stateless.flagged_labs(stateless.lab_event_stream(spark, os.path.join(src, "batch0"), schema),
                                    fx.inputs.d_labitems, FIXTURE_CONFIG.relevant_labs)
    sink = os.path.join(tmp_out, "flagged")
    q = stateless.run_to_parquet(stream, sink, os.path.join(tmp_out, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    assert got.count() == fx.labs.count() == 3087
    assert got.agg(F.sum("abnormal")).first()[0] == 2050


def test_nested_history_matches_prefix(spark):
    fx = Fixture(spark, SF0001)
    nested = samples.nested_samples(fx.history)
    assert nested.count() == 495
    assert nested.select(F.max(F.size("history"))).first()[0] == 13


def test_flattened_rows_are_the_exploded_records(spark):
    fx = Fixture(spark, SF0001)
    flat = samples.flattened(fx.history)
    by_def = aggregate.flatten_history(samples.nested_samples(fx.history))
    cols = ["patient_id", "age", "gender", "next_ckd", "length_of_stay", "days_since_first", "diagnoses", "abnormal_labs"]
    assert flat.count() == 1777
    assert flat.select(*cols).exceptAll(by_def.select(*cols)).count() == 0
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode(sequence" in plan


def test_seed_reaches_every_stage(spark, tmp_out):
    """With a seed of its own each patient has one split in all written tables."""
    src = os.path.join(tmp_out, "src")
    _write_clinical_csv(spark, src)
    cfg = replace(FIXTURE_CONFIG, seed=7)
    jobs.prepare(spark, src, tmp_out, cfg, "csv")
    jobs.aggregate_job(spark, os.path.join(tmp_out, "prepared"), tmp_out)
    jobs.train_job(spark, os.path.join(tmp_out, "aggregated"), tmp_out, cfg,
                   classify.ClassifierParams(num_features=1 << 10, max_iter=3))
    timeline = store.read_dataset(spark, os.path.join(tmp_out, "prepared", "timeline"))
    rows = store.read_dataset(spark, os.path.join(tmp_out, "aggregated", "patients"))
    splits_of = {r.subject_id: r.split for r in timeline.select("subject_id", "split").distinct().collect()}
    got = {r.patient_id: r.split for r in rows.select("patient_id", "split").collect()}
    assert len(got) == 122 and all(splits_of[i] == s for i, s in got.items())
    default = splits.hash_split(rows.select("patient_id"), "patient_id").collect()
    assert any(got[r.patient_id] != r.split for r in default)  # the seed matters


def test_csv_quotes_line_breaks_and_headers(spark, tmp_out):
    titles = os.path.join(tmp_out, "d_icd_diagnoses.csv")
    with open(titles, "w", encoding="utf-8") as f:
        f.write('icd_code,icd_version,long_title,extra\n0010,9,"Foo ""bar"", baz",x\n0011,9,"multi\nline",y\n0012,10,,z\n')
    rows = [tuple(r) for r in read_table(spark, tmp_out, "d_icd_diagnoses").orderBy("icd_code").collect()]
    assert rows == [("0010", 9, 'Foo "bar", baz'), ("0011", 9, "multi\nline"), ("0012", 10, None)]
    joined = codes.add_titles(spark.createDataFrame([("0010", 9), ("0010", 10)], "icd_code string, icd_version int"),
                              read_table(spark, tmp_out, "d_icd_diagnoses"), on_version=True)
    assert sorted((r.icd_version, r.long_title) for r in joined.collect()) == [(9, 'Foo "bar", baz'), (10, None)]
    with open(os.path.join(tmp_out, "d_labitems.csv"), "w", encoding="utf-8") as f:
        f.write("item,label\n1,a\n")
    with pytest.raises(ValueError, match="itemid"):
        read_table(spark, tmp_out, "d_labitems")


def test_absent_crosswalk_is_named(spark, tmp_out):
    src = os.path.join(tmp_out, "src")
    tables = _write_clinical_csv(spark, src, absent=("icd9_to_icd10", "icd10_to_ccsr"))
    with pytest.raises(FileNotFoundError, match="icd9_to_icd10"):
        read_clinical(spark, src)
    with pytest.raises(FileNotFoundError, match="icd10_to_ccsr"):
        jobs.prepare(spark, src, tmp_out, FIXTURE_CONFIG, tables={k: v for k, v in tables.items() if k != "icd10_to_ccsr"})
