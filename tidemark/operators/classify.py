"""Binary text classifier, k-fold cross-validation and held-out evaluation on Spark ML.

The model is a Spark ML pipeline (whitespace tokens -> hashed term frequencies -> IDF ->
logistic regression with an L2 penalty standing in for weight decay). Every fit and every
scoring pass is distributed. Cross-validation of a table that fills the cluster fits all folds
at once (``fold_fit``). When a fold's training table is too small for that, the k fits are
submitted concurrently from driver threads (``fold_parallelism``). Scores are the raw margins (the class-1 entry of ``rawPrediction``), which is
what the metrics rank; the predicted class is their argmax.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import fold_fit, metrics
from tidemark.operators.metrics import best_fold, class_weights, cv_summary
from tidemark.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class ClassifierParams:
    num_features: int = 1 << 16
    reg_param: float = 0.01       # L2 strength (the reference's weight decay is 0.01)
    max_iter: int = 50
    tol: float = 1e-6
    use_class_weights: bool = False  # weights are computed, but off by default, as in the reference
    seed: int = 42


# Logistic regression makes dozens of passes over its input, so each pass should run few,
# well-filled tasks: training tables are cut to about ``ROWS_PER_TASK`` rows per partition. Making
# the features costs far more than a pass, so as long as the cluster has free slots a partition
# need not hold more than ``LEAST_ROWS``.
ROWS_PER_TASK = 200_000
LEAST_ROWS = 10_000


def tasks_for(n_rows: int, slots: int) -> int:
    """Into how many tasks a pass over so many rows is cut on a cluster of ``slots``."""
    return max(1, -(-n_rows // ROWS_PER_TASK), min(slots, -(-n_rows // LEAST_ROWS)))


def sized_for_passes(df: DataFrame) -> DataFrame:
    """Coalesce a materialised table (no shuffle) to ``tasks_for`` its rows; a table with fewer
    partitions keeps them."""
    return _sized(df)[0]


def _sized(df: DataFrame) -> tuple[DataFrame, int]:
    """(the coalesced table, the number of partitions of ``ROWS_PER_TASK`` rows that it fills)."""
    n_rows = df.count()
    target = tasks_for(n_rows, df.sparkSession.sparkContext.defaultParallelism)
    current = df.rdd.getNumPartitions()
    filled = min(current, max(1, -(-n_rows // ROWS_PER_TASK)))
    return (df.coalesce(target) if target < current else df), filled


def fold_parallelism(spark, k: int, partitions: int) -> int:
    """How many folds to fit at once. Each fit's passes need one task per filled partition; when
    k fits together still need no more tasks than the cluster runs at once, they are
    submitted concurrently (as Spark ML's CrossValidator does with ``parallelism``).
    A table that fills the cluster is fitted one fold at a time, so only one fold's
    training copy is ever cached."""
    slots = spark.sparkContext.defaultParallelism
    return k if partitions * k <= slots else 1


def pipeline(params: ClassifierParams = ClassifierParams(), text: str = "text", label: str = "labels",
             weight_col: str | None = None) -> Pipeline:
    tok = RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"\s+", toLowercase=True)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=params.num_features)
    idf = IDF(inputCol="_tf", outputCol="_features")
    lr = LogisticRegression(featuresCol="_features", labelCol=label, regParam=params.reg_param,
                            elasticNetParam=0.0, maxIter=params.max_iter, tol=params.tol, standardization=False)
    if weight_col:
        lr.setWeightCol(weight_col)
    return Pipeline(stages=[tok, tf, idf, lr])


def _with_weights(df: DataFrame, label: str) -> DataFrame:
    """Attach the balanced class weight of each row's label (a class-count-sized join)."""
    w = class_weights(df, label).select(F.col("label").alias(label), F.col("weight").alias("_weight"))
    return df.join(F.broadcast(w), label)  # one row per class


def fit(train: DataFrame, params: ClassifierParams = ClassifierParams(), text: str = "text",
        label: str = "labels") -> PipelineModel:
    """The fitted pipeline. The optimiser reads its features once a step, so they are made once
    and kept in memory or on disk for the fit; a lost part is made anew from ``train``."""
    weight = "_weight" if params.use_class_weights else None
    rows = _with_weights(train, label) if weight else train
    *features, lr = pipeline(params, text, label, weight).getStages()
    prepared = Pipeline(stages=features).fit(rows)
    ready = prepared.transform(rows).select("_features", label, *([weight] if weight else [])).persist()
    try:
        model = lr.fit(ready)
    finally:
        ready.unpersist()
    return PipelineModel([*prepared.stages, model])


def score(model: PipelineModel, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """keep..., scores (array of 2 raw margins), prediction (int)."""
    out = model.transform(df)
    return out.select(*keep, vector_to_array("rawPrediction").alias("scores"),
                      F.col("prediction").cast("int").alias("prediction"))


class FoldModels(Mapping):
    """fold -> the model of its complement, fitted when it is asked for."""

    def __init__(self, k: int, fit_fold, known: dict[int, PipelineModel] | None = None):
        self.k, self.fit_fold, self.known = k, fit_fold, dict(known or {})

    def __getitem__(self, fold: int) -> PipelineModel:
        if fold not in range(self.k):
            raise KeyError(fold)
        if fold not in self.known:
            self.known[fold] = self.fit_fold(fold)
        return self.known[fold]

    def __iter__(self):
        return iter(range(self.k))

    def __len__(self) -> int:
        return self.k


def cross_validate(pool: DataFrame, folds: DataFrame | None, key: str,
                   params: ClassifierParams = ClassifierParams(), text: str = "text", label: str = "labels",
                   jointly: bool | None = None):
    """Fit on each fold's complement, score the fold. ``folds`` (key, fold) is joined to
    the pool; pass None when the pool already has a ``fold`` column.

    Returns (fold_metrics (fold, metric, value), models: fold -> PipelineModel). All folds'
    scores are evaluated in one grouped metric pass. ``jointly`` fits all folds at once; a
    fold's own pipeline is then fitted when it is taken from ``models``. By default that is done
    when a single fold's passes fill the cluster: below that, fits of their own run side by side
    and none waits for another's steps. The results are the same.
    """
    # The passes of the fit read this table again and again: checkpoint it once to the shared
    # folder, so no pass recomputes the upstream plan and a lost executor does not either.
    spark = pool.sparkSession
    ensure_checkpoint_dir(spark)
    rows = (pool if folds is None else pool.join(folds, key)).select("fold", label, text)
    data, partitions = _sized(rows.checkpoint(eager=True))
    last = data.agg(F.max("fold")).first()[0]
    if last is None:
        raise ValueError("cross-validation needs at least one row with a fold")
    k = last + 1

    def fit_fold(f: int) -> PipelineModel:
        return fit(data.where(F.col("fold") != f), params, text, label)

    if jointly is None:
        jointly = fold_parallelism(spark, k, partitions) == 1
    if jointly and k > 1 and fold_fit.fits(k, params.num_features):
        weights = None
        if params.use_class_weights:
            runs = data.select("fold", label, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("run")).where("run <> fold")
            weights = class_weights(runs, label, by="run")
        scored = fold_fit.scored_folds(data, k, params, text, label, weights)
        models = FoldModels(k, fit_fold)
    else:
        with ThreadPoolExecutor(max_workers=fold_parallelism(spark, k, partitions)) as workers:
            models = FoldModels(k, fit_fold, dict(zip(range(k), workers.map(fit_fold, range(k)), strict=True)))
        scored = reduce(DataFrame.unionByName, [
            score(models[f], data.where(F.col("fold") == f), keep=("fold", label)) for f in range(k)])
    return metrics.metric_bundle(scored, "scores", label, by="fold"), models


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_path(spark, name: str = "best_model") -> str:
    """A fresh folder for a model under the session's shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "models", f"{name}-{uuid.uuid4().hex[:12]}")


def train_and_evaluate(pool: DataFrame, folds: DataFrame, test: DataFrame, key: str, out_path: str,
                       params: ClassifierParams = ClassifierParams(), text: str = "text",
                       label: str = "labels"):
    """The whole model stage: cross-validate, keep the best fold by ROC-AUC (> 0, earliest
    on ties), save it, reload it and evaluate the test rows.

    Returns (fold_metrics, summary, best (fold, value), test_metrics). Raises when no fold
    has a positive ROC-AUC (no model would be saved).
    """
    fm, models = cross_validate(pool, folds, key, params, text, label)
    fm = fm.checkpoint(eager=True)  # six rows a fold, read three times
    best = best_fold(fm).first()
    if best is None:
        raise RuntimeError("no fold reached a ROC-AUC above 0; no model saved")
    save_model(models[int(best["fold"])], out_path)
    reloaded = load_model(out_path)
    test_scored = score(reloaded, test, keep=(label,))
    tm = metrics.metric_bundle(test_scored, "scores", label)
    return fm, cv_summary(fm), best, tm
