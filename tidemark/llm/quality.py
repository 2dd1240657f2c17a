"""Quality classifier (operator 10) by positive-unlabelled learning.

A linear model over text statistics minimises the non-negative unbiased risk

    R(f) = pi * E_P[l(f)] + max(0, E_U[l(-f)] - pi * E_P[l(-f)])

with the logistic loss l, trusted positives P (rows labelled 1), unlabelled texts U and the
class prior pi, estimated as the share of label 1 among the training labels. Whenever the
negative part of the risk falls below zero, the step goes back up along it, as the method
prescribes. The model's output is then fitted to the training labels by a logistic curve in
one variable, so that a score is a probability.

``fit`` works on bounded samples (``POSITIVES``, ``UNLABELLED`` and ``CALIBRATION`` rows,
chosen by a hash of their id); only their statistics reach the driver. Every row is scored.

Defined cases: a null or empty text has all statistics 0 and gets the model's score for
that. Without training rows every score is the estimated prior. Repeated rows get equal
scores; only the text is used for a score.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fraction_for, hash_share, read, remainder

POSITIVES = UNLABELLED = CALIBRATION = 12_000
STEPS, RATE, DECAY = 400, 0.05, 1e-4
#: Decision threshold of the registered query.
THRESHOLD = 0.3
SYMBOLS, DIGITS, STOPS = "#$%&*@^~<>{}[]=+\\/_", "0123456789", ".,;:?"


def statistics(text: str | None) -> list[float]:
    """Statistics of a whole text; shares also in a steep form that saturates early."""
    words = (text or "").split()
    if not words:
        return [0.0] * WIDTH
    n, size = len(words), len(text)
    lines = [line for line in text.split("\n") if line]
    shares = [
        sum(map(operator.eq, words, words[1:])) / n,  # a word repeated at once
        1 - len(set(words)) / n,
        sum(map(str.isupper, words)) / n,
        sum(map(text.count, SYMBOLS)) / size,
        sum(map(text.count, DIGITS)) / size,
        text.count("!") / n,
        text.count("|") / n,
        sum(map(text.count, STOPS)) / n,
        1 - len(set(lines)) / len(lines),
        len(lines) / n,
    ]
    sizes = [math.log1p(n), math.log1p(size / n), math.log1p(max(map(len, words)))]
    return [*sizes, *shares, *(min(1.0, 5 * s) for s in shares)]


WIDTH = 23


def descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Weights (last: constant) of the non-negative unbiased risk, by Adam steps."""
    w, m, v = np.zeros(positive.shape[1]), 0.0, 0.0
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, STEPS + 1):
        p, u = positive @ w, unlabelled @ w
        loss = lambda z: np.logaddexp(0, -z).mean()
        negative = loss(-u) - prior * loss(-p)
        up_negative = (sigmoid(u)[:, None] * unlabelled).mean(0) - prior * (sigmoid(p)[:, None] * positive).mean(0)
        if negative >= 0:
            g = -prior * (sigmoid(-p)[:, None] * positive).mean(0) + up_negative
        else:
            g = -up_negative
        g = g + DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w


def logistic_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(y = 1 | x), by Newton steps; targets kept off 0 and 1."""
    ones = int(y.sum())
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
    design, w = np.c_[x, np.ones(len(x))], np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        curve = design.T @ (design * (p * (1 - p) + 1e-6)[:, None]) + 1e-6 * np.eye(2)
        w = w + np.linalg.solve(curve, design.T @ (target - p))
    return float(w[0]), float(w[1])


class Model:
    def __init__(self, mean, scale, weights, slope, offset):
        self.mean, self.scale, self.weights, self.slope, self.offset = mean, scale, weights, slope, offset

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.c_[(rows - self.mean) / self.scale, np.ones(len(rows))] @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(rows) + self.offset, -30, 30)))


def _each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([statistics(t) for t in texts])


def _rows(documents: DataFrame, chosen: DataFrame, *more: str) -> pd.DataFrame:
    """Statistics of the documents with chosen ids: a sample of stated size, so broadcast."""
    joined = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    each = F.pandas_udf(_each, "array<double>")
    return joined.select(each("text").alias("x"), *more).toPandas()


def fit(documents: DataFrame, labels: DataFrame, trainable: Column) -> Model:
    """The model of documents (doc_id, text) and their labels (doc_id, quality); labels of rows
    that do not satisfy ``trainable`` are not looked at."""
    known = labels.where(trainable & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").alias("y"))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, zeros = counts.get(1, 0), counts.get(0, 0)
    prior = (ones + 1) / (ones + zeros + 2)
    matrix = lambda pdf: np.array(pdf["x"].tolist(), float).reshape(-1, WIDTH)

    def sample(rows: DataFrame, bound: int, total: int, seed: int) -> DataFrame:
        return rows.where(hash_share(F.col("doc_id"), fraction_for(bound, total), seed))

    positive = matrix(_rows(documents, sample(known.where("y = 1"), POSITIVES, ones, 2).select("doc_id")))
    some = sample(documents.select("doc_id"), UNLABELLED, documents.count(), 3)
    unlabelled = matrix(_rows(documents, some.join(labels.select("doc_id"), "doc_id", "left_anti")))
    if not len(unlabelled):  # every text has a label: their texts serve without it
        unlabelled = matrix(_rows(documents, sample(known, UNLABELLED, ones + zeros, 4).select("doc_id")))
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH + 1), 0.0, math.log(prior / (1 - prior)))
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    spread = lambda x: np.c_[(x - mean) / scale, np.ones(len(x))]
    model = Model(mean, scale, descend(spread(positive), spread(unlabelled), prior), 1.0, 0.0)
    if ones and zeros:
        check = _rows(documents, sample(known, CALIBRATION, ones + zeros, 5), "y")
        if check["y"].nunique() == 2:
            model.slope, model.offset = logistic_curve(model.raw(matrix(check)), check["y"].to_numpy())
    return model


def scorer(spark, model: Model):
    """A column function: text -> score."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            rows = np.array([statistics(t) for t in texts], float).reshape(-1, WIDTH)
            yield pd.Series(shared.value.score(rows))

    return run.asNondeterministic()


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every document, learned where crc32(doc_id) mod 5 is not 0."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = fit(docs, labels, remainder("doc_id", 5) != 0)
    scored = docs.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                         scorer(spark, model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


QUERIES = {"op10_quality": op10_quality}
