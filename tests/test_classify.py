"""Cross-validation: one joint fit, concurrent fits and one fold at a time agree."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tidemark.operators import aggregate, classify, fold_fit
from tidemark.plans import ml_queries
from tidemark.plans.catalog import Fixture

TIGHT = classify.ClassifierParams(num_features=1 << 10, max_iter=500, tol=1e-12)


def _metrics(fm):
    return {(r["fold"], r["metric"]): r["value"] for r in fm.collect()}


def _texts(spark, n=240, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.4)
        words = [rng.choice(["a", "b", "c", "d", f"w{rng.randrange(30)}", "pos" if y and rng.random() < .5 else "neg"]) for _ in range(12)]
        rows.append((i, " ".join(words), y, rng.choice([0, 0, 1, 2])))  # folds of unequal size
    return spark.createDataFrame(rows, "id long, text string, labels int, fold int")


def test_concurrent_folds_equal_sequential(spark, monkeypatch):
    pool = Fixture(spark, SF0001).cv_rows_folded
    params = classify.ClassifierParams(num_features=1 << 12, max_iter=10)
    got = {}
    for workers in (1, 3):
        monkeypatch.setattr(classify, "fold_parallelism", lambda *_a, w=workers: w)
        fm, models = classify.cross_validate(pool, None, "patient_id", params, text="formatted_history", jointly=False)
        got[workers] = sorted((r["fold"], r["metric"], round(r["value"], 9)) for r in fm.collect())
        assert sorted(models) == [0, 1, 2]
    assert got[1] == got[3] and len(got[1]) == 18


@pytest.mark.parametrize("weighted", [False, True])
def test_joint_fit_equals_separate_fits(spark, weighted):
    params = classify.ClassifierParams(**{**TIGHT.__dict__, "use_class_weights": weighted})
    data = _texts(spark).checkpoint(eager=True)
    joint, models = classify.cross_validate(data, None, "id", params, jointly=True)
    apart, known = classify.cross_validate(data, None, "id", params, jointly=False)
    a, b = _metrics(joint), _metrics(apart)
    assert a.keys() == b.keys() and len(a) == 18
    assert all(a[key] == pytest.approx(b[key], abs=1e-6) for key in a)
    assert sorted(models) == sorted(known) == [0, 1, 2] and not models.known


def test_joint_margins_equal_separate_margins(spark):
    data = _texts(spark, 200, 8).checkpoint(eager=True)
    joint = fold_fit.scored_folds(data.withColumn("labels", F.col("labels")), 3, TIGHT, "text", "labels")
    got = sorted((r.fold, r.labels, round(r.scores[1], 3)) for r in joint.collect())
    want = []
    for f in range(3):
        model = classify.fit(data.where(F.col("fold") != f), TIGHT)
        want += [(r.fold, r.labels, round(r.scores[1], 3)) for r in
                 classify.score(model, data.where(F.col("fold") == f), keep=("fold", "labels")).collect()]
    assert len(got) == len(want) == 200
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=5e-3)


def test_best_fold_is_fitted_saved_and_reloaded(spark, tmp_out):
    data = _texts(spark)
    test = _texts(spark, 60, 9).drop("fold")
    fm, summary, best, tm = classify.train_and_evaluate(data, None, test, "id", f"{tmp_out}/model",
                                                        classify.ClassifierParams(num_features=1 << 10))
    assert summary.count() == 6 and {r.metric for r in tm.collect()} == {r.metric for r in fm.collect()}
    assert best["value"] == max(r["value"] for r in fm.where("metric = 'roc_auc'").collect())


def test_too_many_weights_are_fitted_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(fold_fit, "MAX_WEIGHTS", 100)
    _, models = classify.cross_validate(_texts(spark, 80), None, "id", classify.ClassifierParams(num_features=256, max_iter=5), jointly=True)
    assert sorted(models.known) == [0, 1, 2]


def test_tables_that_fill_the_cluster_are_fitted_jointly(spark, monkeypatch):
    params = classify.ClassifierParams(num_features=256, max_iter=3)
    for workers, joint in ((1, True), (3, False)):
        monkeypatch.setattr(classify, "fold_parallelism", lambda *_a, w=workers: w)
        _, models = classify.cross_validate(_texts(spark, 80), None, "id", params)
        assert bool(models.known) != joint


def test_fold_parallelism_rule(spark):
    slots = spark.sparkContext.defaultParallelism
    assert classify.fold_parallelism(spark, 3, 1) == (3 if slots >= 3 else 1)
    assert classify.fold_parallelism(spark, 3, slots) == 1


def test_free_slots_are_used_for_tables_below_one_full_task(spark):
    assert [classify.tasks_for(n, 12) for n in (0, 9_000, 35_000, 150_000, 5_000_000)] == [1, 1, 4, 12, 25]
    rows = spark.range(60_000, numPartitions=6).checkpoint(eager=True)
    sized, filled = classify._sized(rows)
    assert sized.rdd.getNumPartitions() == min(6, spark.sparkContext.defaultParallelism) and filled == 1


def test_patient_rows_are_made_once_for_pool_and_test(spark, monkeypatch):
    made = []
    real = aggregate.patient_rows
    monkeypatch.setattr(aggregate, "patient_rows", lambda tl: made.append(1) or real(tl))
    scored = ml_queries.q_train_classifier(spark, SF0001)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert made == [1] and "parquet" not in plan  # the test rows come from the written table
    assert scored.count() == Fixture(spark, SF0001).training.where("scope = 'test'").count()


def test_folds_of_the_written_rows_are_those_of_the_timeline(spark):
    fx = Fixture(spark, SF0001)
    got = sorted((r.patient_id, r.fold) for r in fx.training_folded.select("patient_id", "fold").collect())
    assert got == sorted((r.patient_id, r.fold) for r in fx.folds.collect())
    assert "parquet" not in fx.training_folded._jdf.queryExecution().optimizedPlan().toString()
