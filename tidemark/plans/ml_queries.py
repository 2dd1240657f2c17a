"""Model-fitting queries (rows-only check: an optimiser's output has no SQL twin)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import classify, metrics, splits
from tidemark.plans.catalog import Fixture
from tidemark.sources.views import read_driver


def q_train_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the whole cross-validation pool, score the test patients."""
    rows = Fixture(spark, sf_dir).stored_training
    model = classify.fit(classify.sized_for_passes(rows.where(F.col("scope") == "cv")))
    return classify.score(model, rows.where(F.col("scope") == "test"), keep=("patient_id", "labels")).select(
        "patient_id", "labels", "prediction", F.element_at("scores", 2).alias("score"))


def q_cross_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-fold metrics of the patient classifier (k = 3, seed 42)."""
    fx = Fixture(spark, sf_dir)
    fm, _ = classify.cross_validate(fx.cv_rows_folded, None, "patient_id", text="formatted_history")
    return fm


def q_evaluate_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best fold's model saved, reloaded and scored on the test split: six metrics, plus the
    cross-validation averages and spreads, as report lines."""
    fx = Fixture(spark, sf_dir)
    test = fx.stored_training.where(F.col("scope") == "test").withColumnRenamed("text", "formatted_history")
    path = classify.model_path(spark)
    fm, summary, best, tm = classify.train_and_evaluate(fx.cv_rows_folded, None, test, "patient_id", path,
                                                        text="formatted_history")
    lines = (summary.select(F.concat(F.lit("avg_"), "metric").alias("metric"), F.col("mean").alias("value"))
             .unionByName(summary.select(F.concat(F.lit("std_"), "metric").alias("metric"),
                                         F.col("std").alias("value")))
             .withColumn("scope", F.lit("cv"))
             .unionByName(tm.withColumn("scope", F.lit("test"))))
    return metrics.metrics_report(lines).withColumn("best_fold", F.lit(int(best["fold"])))


def q_doc_cross_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality classifier on document texts: per-fold metrics over the labelled documents."""
    docs = read_driver(spark, sf_dir, "documents").select("doc_id", "text")
    lab = read_driver(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("labels"))
    pool = docs.join(lab, "doc_id")
    folds = splits.kfold(pool.select("doc_id"), 3, "doc_id", 42)
    fm, _ = classify.cross_validate(pool, folds, "doc_id")
    return fm


QUERIES = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}
