"""All folds of a cross-validation in one fit.

Cross-validation fits k models on k overlapping training sets. Here they are one model: run f
has a block of features of its own, a training row appears once for each run it trains (k - 1
times), in that run's block, and one logistic regression over all blocks has the k models as
the blocks of its weights. Blocks share no feature, so the joint objective

    1/k * sum over f of [ 1/n_f * sum of the losses of run f  +  lambda/2 * |w_f|^2 ]

is minimal exactly where each run's own objective is: rows weigh N / (k * n_f), and the joint
penalty is lambda / k. Each optimiser step is one pass, with one tree aggregation of k
gradients, instead of k passes.

* **Document frequencies** of all runs come from one IDF pass over the blocks; with the number
  of rows of each run they give every run the IDF of its own training rows.
* **Intercepts** are the weights of one indicator feature a run, scaled by ``INTERCEPT``, so
  that the penalty on them is its inverse square: nothing, as in a model with a free intercept.
* Scoring is one pass as well: a held-out row takes the block of the run that did not see it.

Everything stays in the JVM: conditions on vector columns, ``VectorAssembler``,
``ElementwiseProduct``. What reaches the driver are vectors of k * (features + 1) numbers, a
parameter, not the data; ``MAX_WEIGHTS`` bounds it, and beyond it folds are fitted one by one.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, ElementwiseProduct, HashingTF, RegexTokenizer, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_WEIGHTS = 1 << 22
INTERCEPT = 1000.0
RUN = "_run"


def fits(k: int, num_features: int) -> bool:
    """Whether the weights of all folds together are few enough for one fit."""
    return k * (num_features + 1) <= MAX_WEIGHTS


def _blocks(rows: DataFrame, k: int, num_features: int) -> DataFrame:
    """Adds ``_blocks``: the term counts ``_tf`` in the block of the row's run, then the runs'
    indicators."""
    empty = HashingTF(inputCol="_none", outputCol="_zero", numFeatures=num_features)
    rows = empty.transform(rows.withColumn("_none", F.array().cast("array<string>"))).drop("_none")
    names = [f"_block{f}" for f in range(k)]
    rows = rows.withColumns({name: F.when(F.col(RUN) == f, F.col("_tf")).otherwise(F.col("_zero"))
                             for f, name in enumerate(names)}).drop("_zero")
    indicator = F.array(*[(F.col(RUN) == f).cast("double") for f in range(k)])
    rows = rows.withColumn("_indicator", array_to_vector(indicator))
    for name, size in [*((n, num_features) for n in names), ("_indicator", k)]:
        rows = VectorSizeHint(inputCol=name, size=size, handleInvalid="optimistic").transform(rows)
    return VectorAssembler(inputCols=[*names, "_indicator"], outputCol="_blocks").transform(rows).drop(*names, "_indicator")


def _scale(idf: np.ndarray, rows: int, k: int, num_features: int) -> tuple[np.ndarray, np.ndarray]:
    """What each block's features are multiplied by, and the number of training rows of each run,
    from the IDF values over all runs' rows."""
    frequency = np.rint((rows + 1) / np.exp(idf) - 1)
    n = frequency[k * num_features:]
    own = np.log((n[:, None] + 1) / (frequency[:k * num_features].reshape(k, num_features) + 1))
    return np.concatenate([own.reshape(-1), np.full(k, INTERCEPT)]), n


def scored_folds(data: DataFrame, k: int, params, text: str, label: str, class_weights: DataFrame | None = None) -> DataFrame:
    """fold, ``label``, scores (array of 2 raw margins) and prediction of every row of ``data``
    (columns fold, text, label), each scored by the model of the run that did not train on it.
    ``class_weights``: run, label, weight."""
    words = RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"\s+", toLowercase=True)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=params.num_features)
    base = PipelineModel([words, tf]).transform(data.select("fold", label, text)).select("fold", label, "_tf")
    runs = base.withColumn(RUN, F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    training = _blocks(runs.where(F.col(RUN) != F.col("fold")), k, params.num_features)
    idf = IDF(inputCol="_blocks", outputCol="_idf").fit(training)
    scale, n = _scale(idf.idf.toArray(), idf.numDocs, k, params.num_features)
    if not n.all():
        raise ValueError("a fold holds all rows: its run has nothing to train on")
    scaled = ElementwiseProduct(inputCol="_blocks", outputCol="_features", scalingVec=DenseVector(scale))
    share = F.element_at(F.array(*[F.lit(float(n.sum() / (k * x))) for x in n]), F.col(RUN) + 1)
    weighted = training.withColumn("_weight", share)
    if class_weights is not None:  # a row for each run and class
        per = class_weights.select(F.col("run").alias(RUN), F.col("label").alias(label), F.col("weight").alias("_class"))
        weighted = weighted.join(F.broadcast(per), [RUN, label]).withColumn("_weight", F.col("_weight") * F.col("_class"))
    lr = LogisticRegression(featuresCol="_features", labelCol=label, weightCol="_weight", regParam=params.reg_param / k,
                            elasticNetParam=0.0, maxIter=params.max_iter, tol=params.tol, standardization=False, fitIntercept=False)
    # every step reads these rows: kept in memory or on disk, and made anew from ``data`` if lost
    ready = scaled.transform(weighted).select("_features", label, "_weight").persist()
    try:
        model = lr.fit(ready)
    finally:
        ready.unpersist()
    held_out = _blocks(base.withColumn(RUN, F.col("fold")), k, params.num_features)
    return model.transform(scaled.transform(held_out)).select(
        "fold", label, vector_to_array("rawPrediction").alias("scores"), F.col("prediction").cast("int").alias("prediction"))
