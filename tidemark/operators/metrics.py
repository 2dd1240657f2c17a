"""Exact evaluation metrics over (score, label) tables.

ROC-AUC and PR-AUC are computed exactly, with tied scores grouped into one threshold:
``groupBy(score)`` gives one row per distinct score with its positives ``p`` and negatives
``n``; running totals along descending score come from ``ranking.with_prefix_sums``
(distributed, no single-partition window). Each distinct score then contributes one
trapezoid, and the areas are a plain global sum.

* ROC: sum of n_i * (TP_i + TP_{i-1}) / 2 over thresholds, divided by P * N.
* PR: points (recall, precision) at each threshold plus the start point (0, 1); area by
  the trapezoid rule in recall (each threshold adds p_i / P of recall).

Both are null when a class is missing (ROC) or there is no positive (PR).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import argmax_class, class_score
from tidemark.operators.ranking import with_prefix_sums


# Per-group offset tables (keys and four numbers a row) are broadcast up to this many groups.
MAX_BROADCAST_GROUPS = 200_000


def _keys(by):
    return [] if by is None else ([by] if isinstance(by, str) else list(by))


def score_table(df: DataFrame, score: str = "score", label: str = "label", by=None) -> DataFrame:
    """One row per (group, distinct score): p (positives), n (negatives)."""
    keys = _keys(by)
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(*keys, F.col(score).cast("double").alias("score"))
            .agg(F.sum((F.col(label) == 1).cast("long")).alias("p"),
                 F.sum((F.col(label) != 1).cast("long")).alias("n")))


def curve(df: DataFrame, score: str = "score", label: str = "label", by=None) -> DataFrame:
    """The curve of a (score, label) table, see ``curve_of``."""
    return curve_of(score_table(df, score, label, by), by)


def curve_of(table: DataFrame, by=None) -> DataFrame:
    """``table`` is a score table; further columns of it ride along. One row per (group, threshold) with thresholds the distinct scores, descending:
    tp, fp (cumulative inside the group), p, n (at this score), tp_prev, fp_prev
    (cumulative before it), tp_total, fp_total (the group's positives and negatives).

    Groups are contiguous in the (group, score desc) order, so one distributed prefix
    pass serves all groups; each group's running totals are the global ones minus the
    total reached before the group's first row.
    """
    keys = _keys(by)
    order = [F.col(k).asc() for k in keys] + [F.col("score").desc()]
    cum = with_prefix_sums(table, order, {"p": "tp", "n": "fp"}, position=None)
    if keys:
        cum = cum.drop("tp_total", "fp_total")
        base = cum.groupBy(*keys).agg(
            F.min(F.col("tp") - F.col("p")).alias("_btp"), F.min(F.col("fp") - F.col("n")).alias("_bfp"),
            F.sum("p").alias("tp_total"), F.sum("n").alias("fp_total"))
        # Few groups (folds) each own many rows, so the group key is a hot join key: the
        # one-row-per-group table is broadcast when its counted size allows it.
        n_groups = base.count()
        if n_groups <= MAX_BROADCAST_GROUPS:
            base = F.broadcast(base)
        cum = (cum.join(base, keys)
               .withColumn("tp", F.col("tp") - F.col("_btp"))
               .withColumn("fp", F.col("fp") - F.col("_bfp")).drop("_btp", "_bfp"))
    return (cum.withColumnRenamed("score", "threshold")
            .withColumn("tp_prev", F.col("tp") - F.col("p"))
            .withColumn("fp_prev", F.col("fp") - F.col("n")))


def _precision(tp, fp):
    return F.coalesce(F.try_divide(tp.cast("double"), (tp + fp).cast("double")), F.lit(0.0))


def curve_points(df: DataFrame, score: str = "score", label: str = "label", by=None) -> DataFrame:
    """threshold, precision, recall, fpr, tpr at each distinct score (per group), and the end
    point above every score (threshold null: recall 0 with precision 1, the ROC origin)."""
    c = curve(df, score, label, by)
    keys = _keys(by)
    ends = c.groupBy(*keys).agg(F.max("tp_total").alias("_p"), F.max("fp_total").alias("_n")).where("_p is not null")
    zero = lambda total: F.when(F.col(total) > 0, F.lit(0.0))
    ends = ends.select(*keys, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                       zero("_p").alias("recall"), zero("_n").alias("fpr"), zero("_p").alias("tpr"))
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    all_pos, all_neg = F.col("tp_total").cast("double"), F.col("fp_total").cast("double")
    points = c.select(*keys, "threshold", _precision(F.col("tp"), F.col("fp")).alias("precision"),
                    F.try_divide(tp, all_pos).alias("recall"), F.try_divide(fp, all_neg).alias("fpr"),
                    F.try_divide(tp, all_pos).alias("tpr"))
    return points.unionByName(ends)


def _areas() -> list[F.Column]:
    """Aggregates over a curve: unscaled areas, positives and negatives."""
    tp, fp, tpp, fpp = (F.col(x).cast("double") for x in ("tp", "fp", "tp_prev", "fp_prev"))
    prev_prec = F.when((F.col("tp_prev") + F.col("fp_prev")) == 0, F.lit(1.0)).otherwise(_precision(tpp, fpp))
    return [F.sum(F.col("n").cast("double") * (tp + tpp) / 2.0).alias("_roc"),
            F.sum(F.col("p").cast("double") * (_precision(tp, fp) + prev_prec) / 2.0).alias("_pr"),
            F.sum("p").alias("positives"), F.sum("n").alias("negatives")]


def _scaled() -> list[F.Column]:
    P, N = F.col("positives").cast("double"), F.col("negatives").cast("double")
    return [F.when((P > 0) & (N > 0), F.col("_roc") / (P * N)).alias("roc_auc"),
            F.when(P > 0, F.col("_pr") / P).alias("pr_auc")]


def ranking_metrics(df: DataFrame, score: str = "score", label: str = "label", by=None) -> DataFrame:
    """One row (per group): roc_auc, pr_auc, positives, negatives."""
    keys = _keys(by)
    parts = curve(df, score, label, by).groupBy(*keys).agg(*_areas())
    return parts.select(*keys, *_scaled(), F.coalesce("positives", F.lit(0)).cast("bigint").alias("positives"),
                        F.coalesce("negatives", F.lit(0)).cast("bigint").alias("negatives"))


def _rates(tp: F.Column, fp: F.Column, fn: F.Column, tn: F.Column) -> list[F.Column]:
    precision = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2.0 * tp, 2.0 * tp + fp + fn), F.lit(0.0))
    return [F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"), precision.alias("precision"),
            recall.alias("recall"), f1.alias("f1")]


def threshold_metrics(df: DataFrame, prediction: str = "prediction", label: str = "label",
                      by=None) -> DataFrame:
    """One row (per group): accuracy, precision, recall, f1 (binary, positive class 1;
    0 when undefined)."""
    keys = _keys(by)
    pr, lb = F.col(prediction) == 1, F.col(label) == 1
    s = df.groupBy(*keys).agg(F.count_if(pr & lb).alias("tp"), F.count_if(pr & ~lb).alias("fp"),
                              F.count_if(~pr & lb).alias("fn"), F.count_if(~pr & ~lb).alias("tn"))
    return s.select(*keys, *_rates(*(F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))))


def metric_bundle(scored: DataFrame, scores: str = "scores", label: str = "label", by=None) -> DataFrame:
    """Six metrics as rows (group..., metric, value) from a two-class score array and a
    label: prediction = argmax (ties -> class 0), ranking score = the class-1 entry.

    ``scored`` is read once: one row per group and score carries its positives, negatives
    and how many of either are predicted positive; all six metrics come from that table.
    """
    keys = _keys(by)
    hit, positive = argmax_class(scores) == 1, F.col(label) == 1
    table = (scored.select(*keys, class_score(scores, 1).cast("double").alias("score"), hit.alias("_hit"),
                           positive.alias("_pos"))
             .where(F.col("score").isNotNull() & F.col("_pos").isNotNull())
             .groupBy(*keys, "score").agg(F.count_if("_pos").alias("p"), F.count_if(~F.col("_pos")).alias("n"),
                                          F.count_if(F.col("_hit") & F.col("_pos")).alias("_tp"),
                                          F.count_if(F.col("_hit") & ~F.col("_pos")).alias("_fp")))
    per = curve_of(table, by).groupBy(*keys).agg(*_areas(), F.sum("_tp").alias("_tp"), F.sum("_fp").alias("_fp"))
    tp, fp = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("_tp", "_fp"))
    p, n = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("positives", "negatives"))
    return per.select(*keys, *_rates(tp, fp, p - tp, n - fp), *_scaled()).select(*keys, F.expr(
        "stack(6, 'accuracy', accuracy, 'f1', f1, 'precision', precision, 'recall', recall, "
        "'roc_auc', roc_auc, 'pr_auc', pr_auc) as (metric, value)"))


def balanced_weights(counts: DataFrame, by: str | None = None) -> DataFrame:
    """Adds ``weight`` = n / (n_classes * n_c) to rows (label, n_c), one for each class present,
    within each value of ``by``."""
    # one row a class (and group), so a window over all of it is tiny
    every = (Window.partitionBy(by) if by else Window).orderBy("label").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    n, k = F.sum("n_c").over(every), F.count(F.lit(1)).over(every)
    return counts.withColumn("weight", n / (k * F.col("n_c")))


def class_weights(df: DataFrame, label: str = "label", by: str | None = None) -> DataFrame:
    """Balanced weights of the classes of ``label`` (within each value of ``by``)."""
    keys = [by] if by else []
    counts = df.groupBy(*keys, F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n_c"))
    return balanced_weights(counts, by)


def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    """(fold, metric, value) -> metric, mean, std (population)."""
    return fold_metrics.groupBy("metric").agg(F.avg("value").alias("mean"),
                                              F.stddev_pop("value").alias("std"))


def best_fold(fold_metrics: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """The fold with the largest ``metric`` strictly above 0; the earlier fold wins a tie.
    Empty when no fold qualifies."""
    cand = fold_metrics.where((F.col("metric") == metric) & (F.col("value") > 0))
    return cand.agg(F.max_by("fold", F.struct(F.col("value"), -F.col("fold"))).alias("fold"),
                    F.max("value").alias("value")).where(F.col("fold").isNotNull())


def metrics_report(metrics: DataFrame, digits: int = 4) -> DataFrame:
    """(scope, metric, value) -> adds ``text`` = 'metric: value' with fixed decimals."""
    return metrics.withColumn(
        "text", F.concat(F.col("metric"), F.lit(": "), F.format_string(f"%.{digits}f", F.col("value"))))
