"""The three batch jobs: prepare, aggregate, train (spark-submit entry points).

prepare   clinical tables -> timeline (visits in history, with sample and label columns)
          and samples, both partitioned by split; statistics as JSON
aggregate timeline -> one row per patient with both text renderings, by split; summary
train     patient rows -> sentences -> k-fold classifier -> best model -> test metrics;
          metric tables and the text report

Stages meet through parquet folders, so each job starts from a written table (no lineage
crosses a job boundary). Each folder has a manifest (``manifest.py``): a job refuses a folder that
is half-written or changed, and a rerun goes on behind the last whole table.

    spark-submit -m tidemark.plans.jobs prepare  <src> <out> [--format csv|parquet]
    spark-submit -m tidemark.plans.jobs aggregate <out>/prepared <out>
    spark-submit -m tidemark.plans.jobs train    <out>/aggregated <out>
"""

from __future__ import annotations

import argparse
import os
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import CohortConfig
from tidemark.operators import aggregate, classify, codes, labs, membership, samples, splits, text, visits
from tidemark.operators.metrics import metrics_report
from tidemark.plans import manifest
from tidemark.sources import store
from tidemark.sources.tables import SCHEMAS, read_clinical

HISTORY_COLS = ("subject_id", "hadm_id", "visit_index", "diagnoses", "abnormal_labs",
                "length_of_stay", "days_since_first", "next_hadm_id", "next_ckd", "kept", "in_history",
                "n_kept", "positive_index", "age", "gender")


def prepare(spark: SparkSession, src: str, out: str, cfg: CohortConfig = CohortConfig(),
            fmt: str = "csv", tables: dict[str, DataFrame] | None = None, nested: bool = False) -> dict:
    """Build the history samples and write them by split.

    ``tables`` may supply the input DataFrames directly (same names as the files). Writes,
    under ``out/prepared``: ``timeline`` (every visit of every cohort entity, narrow, with
    the sample and censoring columns), ``history`` (the visits inside a kept sample's
    history, with their lists), ``samples`` and, with ``nested``, ``nested_samples`` (one
    history array per sample). Returns the logged statistics. Tables of an earlier run on the
    same files and settings are kept as far as they are whole; with ``tables`` all are written.
    """
    t = tables or read_clinical(spark, src, fmt)
    for name in SCHEMAS:
        if name not in t:
            raise FileNotFoundError(f"input table {name!r} is missing: codes are mapped by the crosswalk tables "
                                    f"icd9_to_icd10 and icd10_to_ccsr, next to the six clinical tables")
    mapped = codes.mapped_diagnoses(t["diagnoses_icd"], t["d_icd_diagnoses"], t["icd9_to_icd10"],
                                    t["icd10_to_ccsr"], cfg.title_join_on_version)
    lab = labs.relevant_labs(t["labevents"], t["d_labitems"], cfg.relevant_labs, cfg.abnormal_flags)
    # the flag needs the crosswalk only; the title lists feed the history details
    crosswalked = codes.map_codes(t["diagnoses_icd"], t["icd9_to_icd10"], t["icd10_to_ccsr"])
    flags = visits.visit_flags(t["admissions"], visits.visit_target_flag(crosswalked, cfg.target_code))

    def by_split(df: DataFrame, col: str) -> DataFrame:
        return splits.hash_split(df, col, cfg.seed, cfg.train_pct, cfg.train_val_pct)

    base = os.path.join(out, "prepared")
    run = manifest.Run(spark, base, "prepare", {**asdict(cfg), "format": fmt},
                       None if tables else manifest.source_digest(spark, src))
    names = ["timeline", "history", "samples", *["nested_samples"] * nested]
    if (known := run.result(names)) is not None:
        return known
    # 1. the ordered timeline, written once; everything below reads the written table
    tl = run.table("timeline", lambda: by_split(
        samples.timeline(flags, t["patients"]).drop("first_time", "next_time", "is_sample"), "subject_id"))

    # 2. history visits with their lists: facts of other visits leave before the lists' shuffles
    def history() -> DataFrame:
        wanted = membership.members(tl.where("in_history"), "hadm_id")
        dx_lists, lab_lists = visits.lists_of(wanted, mapped, lab)
        hist = samples.attach_details(tl.drop("split"), dx_lists, lab_lists).select(*HISTORY_COLS)
        return by_split(hist, "subject_id")

    written = run.table("history", history)
    # 3. samples
    run.table("samples", lambda: tl.where("kept").select(
        F.col("subject_id").alias("patient_id"), "hadm_id", "visit_index",
        (F.col("visit_index") + 1).alias("history_len"), "age", "gender", "next_hadm_id", "next_ckd", "split"))
    if nested:
        run.table("nested_samples", lambda: by_split(samples.nested_samples(written.drop("split")), "patient_id"))

    # A scan of their own: an Observation in the session would be free, but model fits that
    # follow in the same session then fail, as its manager cannot be shipped to tasks.
    stats = {**codes.mapping_stats(mapped).first().asDict(), **labs.lab_stats(lab).first().asDict()}
    ids = t["patients"].where(F.col("subject_id").isNotNull()).select("subject_id").distinct()
    stats["all_patients"] = ids.count()
    stats["valid_patients"] = tl.select("subject_id").distinct().count()
    split_rows = splits.split_stats(store.read_dataset(spark, os.path.join(base, "samples")))
    stats["splits"] = [r.asDict() for r in split_rows.collect()]  # four rows
    store.write_small_json(spark, split_rows, os.path.join(base, "split_stats"))
    return run.finish(stats)


def aggregate_job(spark: SparkSession, prepared: str, out: str) -> dict:
    """One row per patient and split, with text renderings; summary per split."""
    source = manifest.require(spark, prepared, "prepare", ["history"])
    dest = os.path.join(out, "aggregated")
    run = manifest.Run(spark, dest, "aggregate", {}, source)
    if (known := run.result(["patients"])) is not None:
        return known
    # the written split rides along: seed and shares are decided once, by ``prepare``
    written = run.table("patients", lambda: aggregate.with_text(
        aggregate.patient_rows(store.read_dataset(spark, os.path.join(prepared, "history")))))
    summary = aggregate.aggregate_summary(written)
    store.write_small_json(spark, summary, os.path.join(dest, "summary"))
    return run.finish({"summary": [r.asDict() for r in summary.collect()]})  # one row per split


def train_job(spark: SparkSession, aggregated: str, out: str, cfg: CohortConfig = CohortConfig(),
              params: classify.ClassifierParams = classify.ClassifierParams()) -> dict:
    """k-fold cross-validation on train+val, best fold saved, test evaluated, report written."""
    source = manifest.require(spark, aggregated, "aggregate", ["patients"])
    dest = os.path.join(out, "model")
    run = manifest.Run(spark, dest, "train", {"cohort": asdict(cfg), "classifier": asdict(params)}, source)
    if (known := run.result([])) is not None:
        return known
    run.begin()
    rows = aggregate.with_sentence(store.read_dataset(spark, os.path.join(aggregated, "patients")))
    tr = text.training_rows(rows)
    pool, test = tr.where(F.col("scope") == "cv"), tr.where(F.col("scope") == "test")
    folds = splits.kfold(pool.select("patient_id"), cfg.k_folds, "patient_id", cfg.seed)
    model_dir = os.path.join(dest, "best_model")
    fm, summary, best, tm = classify.train_and_evaluate(pool, folds, test, "patient_id", model_dir, params)
    store.write_small_json(spark, fm, os.path.join(dest, "fold_metrics"))
    store.write_small_json(spark, tm, os.path.join(dest, "test_metrics"))
    cv_lines = (summary.select(F.concat(F.lit("avg_"), "metric").alias("metric"), F.col("mean").alias("value"))
                .unionByName(summary.select(F.concat(F.lit("std_"), "metric").alias("metric"),
                                            F.col("std").alias("value"))))
    cv_text = [r["text"] for r in metrics_report(cv_lines).orderBy("metric").collect()]  # 12 lines
    test_text = [r["text"] for r in metrics_report(tm).orderBy("metric").collect()]     # 6 lines
    # fixed headings of the report
    report = (["=== CROSS-VALIDATION RESULTS ==="] + cv_text
              + ["", f"Best ROC AUC: {best['value']:.4f}", f"Best model path: {model_dir}", "",
                 "=== TEST RESULTS ==="] + test_text)
    store.write_text_report(spark, report, os.path.join(dest, "training_results"))
    return run.finish({"best_fold": int(best["fold"]), "best_roc_auc": float(best["value"]), "report": report})


def main(argv: list[str] | None = None) -> None:
    from tidemark.session import ensure_checkpoint_dir
    p = argparse.ArgumentParser(prog="tidemark.plans.jobs")
    p.add_argument("job", choices=["prepare", "aggregate", "train"])
    p.add_argument("src")
    p.add_argument("out")
    p.add_argument("--format", default="csv")
    p.add_argument("--k-folds", type=int, default=3)
    p.add_argument("--seed", type=int, default=42)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"tidemark-{a.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    cfg = CohortConfig(seed=a.seed, k_folds=a.k_folds)
    if a.job == "prepare":
        print(store.to_json_line(prepare(spark, a.src, a.out, cfg, a.format)))
    elif a.job == "aggregate":
        print(store.to_json_line(aggregate_job(spark, a.src, a.out)))
    else:
        print(store.to_json_line(train_job(spark, a.src, a.out, cfg)))


if __name__ == "__main__":
    main()
