"""Exact ranking metrics, threshold metrics, splits and folds."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics, splits


def _scored(spark, rows):
    return spark.createDataFrame(rows, "score double, label int")


def test_tie_on_top(spark):
    m = metrics.ranking_metrics(_scored(spark, [(0.9, 1), (0.9, 0), (0.5, 1), (0.1, 0)])).first()
    assert m["roc_auc"] == pytest.approx(0.625) and m["pr_auc"] == pytest.approx(2 / 3)


def test_edges(spark):
    tied = metrics.ranking_metrics(_scored(spark, [(0.3, 1), (0.3, 0), (0.3, 1), (0.3, 0)])).first()
    assert tied["roc_auc"] == pytest.approx(0.5)
    one = metrics.ranking_metrics(_scored(spark, [(0.3, 1), (0.4, 1)])).first()
    assert one["roc_auc"] is None
    empty = metrics.ranking_metrics(_scored(spark, [])).first()
    assert empty["roc_auc"] is None and empty["pr_auc"] is None and empty["positives"] == 0


def test_auc_invariant_under_monotone_change(spark):
    rows = [(float(i % 37), int(i % 3 == 0)) for i in range(500)]
    a = metrics.ranking_metrics(_scored(spark, rows)).first()
    b = metrics.ranking_metrics(_scored(spark, rows).withColumn("score", F.exp("score") * 3 + 1)).first()
    assert a["roc_auc"] == pytest.approx(b["roc_auc"]) and a["pr_auc"] == pytest.approx(b["pr_auc"])


def test_grouped_equals_separate(spark):
    rows = [(g, float((i * 13) % 29), int((i * 7) % 5 < 2)) for g in range(3) for i in range(60 + g)]
    df = spark.createDataFrame(rows, "g int, score double, label int")
    grouped = {r["g"]: r for r in metrics.ranking_metrics(df, by="g").collect()}
    for g in range(3):
        alone = metrics.ranking_metrics(df.where(F.col("g") == g)).first()
        assert grouped[g]["roc_auc"] == pytest.approx(alone["roc_auc"])
        assert grouped[g]["pr_auc"] == pytest.approx(alone["pr_auc"])


def test_threshold_metrics_zero_when_undefined(spark):
    df = spark.createDataFrame([(0, 0), (0, 1)], "prediction int, label int")
    m = metrics.threshold_metrics(df).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (0.5, 0.0, 0.0, 0.0)


def test_best_fold_rules(spark):
    fm = spark.createDataFrame([(0, "roc_auc", 0.7), (1, "roc_auc", 0.8), (2, "roc_auc", 0.8)],
                               "fold int, metric string, value double")
    assert metrics.best_fold(fm).first()["fold"] == 1
    none = spark.createDataFrame([(0, "roc_auc", 0.0)], "fold int, metric string, value double")
    assert metrics.best_fold(none).first() is None
    s = {r["metric"]: r for r in metrics.cv_summary(fm).collect()}
    assert s["roc_auc"]["std"] == pytest.approx(0.0471404520791, rel=1e-6)  # population std


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")
    w = {r["label"]: r["weight"] for r in metrics.class_weights(df).collect()}
    assert w == {0: pytest.approx(8 / 12), 1: pytest.approx(2.0)}


def test_folds_sizes_and_partition(spark):
    ids = spark.range(11).withColumnRenamed("id", "patient_id")
    f = splits.kfold(ids, 3)
    sizes = sorted(r["count"] for r in f.groupBy("fold").count().collect())
    assert sizes == [3, 4, 4] and f.select("patient_id").distinct().count() == 11
    assert splits.fold_sizes(11, 3) == [4, 4, 3]


def test_splits_disjoint_and_exact_sizes(spark):
    ids = spark.range(1, 1001).withColumnRenamed("id", "patient_id")
    h = splits.hash_split(ids)
    assert h.groupBy("patient_id").count().where("count > 1").count() == 0
    e = splits.exact_split(ids)
    sizes = {r["split"]: r["count"] for r in e.groupBy("split").count().collect()}
    assert (sizes["train"], sizes["val"], sizes["test"]) == splits.exact_split_sizes(1000) == (700, 150, 150)
    assert splits.exact_split_sizes(10) == (7, 1, 2)  # test = ceil(0.3 * 10) = 3, then ceil(1.5) = 2
    again = {r["patient_id"]: r["split"] for r in splits.exact_split(ids).collect()}
    assert again == {r["patient_id"]: r["split"] for r in e.collect()}


def test_hashed_position_equals_the_global_order(spark):
    from tidemark.functions.exprs import seeded_order_key
    from tidemark.operators.ranking import with_hashed_position
    ids = spark.range(5000).repartition(9).withColumn("key", seeded_order_key("id", 3))
    # equal digests meet in one range, and the tie decides
    ids = ids.unionByName(ids.where("id < 50").withColumn("id", -F.col("id") - 1))
    rows = with_hashed_position(ids, "key", "id", "pos", total="n").collect()
    want = sorted((r.key, r.id) for r in rows)
    assert [(r.key, r.id) for r in sorted(rows, key=lambda r: r.pos)] == want
    assert sorted(r.pos for r in rows) == list(range(5050)) and {r.n for r in rows} == {5050}
    assert with_hashed_position(ids.limit(0), "key", "id").count() == 0


def test_class_weights_by_group(spark):
    from tidemark.operators.metrics import class_weights
    rows = spark.createDataFrame([("a", 0), ("a", 0), ("a", 1), ("b", 1)], "g string, y int")
    got = {(r.g, r.label): (r.n_c, r.weight) for r in class_weights(rows, "y", by="g").collect()}
    assert got == {("a", 0): (2, 0.75), ("a", 1): (1, 1.5), ("b", 1): (1, 1.0)}
