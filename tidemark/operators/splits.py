"""Group-wise splits and k-fold assignment keyed by a seeded hash of the entity id.

Every entity lands in exactly one split or fold, independent of partitioning and session
state: the seed is part of the hashed text. Two modes:

* ``hash_split``: bucket = md5('seed:id') mod 100 against the 70 / 85 thresholds; no
  shuffle and no count, each row decides alone (approximate 70/15/15 shares);
* ``exact_split`` / ``kfold``: entities in the order of md5('seed:id') by a radix pass over
  the digest (``ranking.with_hashed_position``), then cut into blocks of the exact sizes a shuffled two-step
  train/test split (test = ceil(0.3 n), then ceil(half) of the rest) or a shuffled k-fold
  (the first n mod k folds one larger) would produce.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import seeded_bucket, seeded_order_key
from tidemark.operators.ranking import with_hashed_position

SPLITS = ("train", "val", "test")


def hash_split(ids: DataFrame, id_col: str = "patient_id", seed: int = 42, train_pct: int = 70,
               train_val_pct: int = 85) -> DataFrame:
    """Add ``split`` to each row from its entity id alone."""
    b = seeded_bucket(id_col, seed, 100)
    split = (F.when(b < train_pct, F.lit("train")).when(b < train_val_pct, F.lit("val"))
             .otherwise(F.lit("test")))
    return ids.withColumn("split", split)


def _ordered_ids(ids: DataFrame, id_col: str, seed: int, keep_columns: bool = False) -> DataFrame:
    """Rank entities by the seeded hash: adds ``_rank`` and ``_n`` (number of entities).
    With ``keep_columns`` the input must hold one row per id and its columns ride along
    (no second pass over the input to re-attach them)."""
    base = ids.where(F.col(id_col).isNotNull())
    if not keep_columns:
        base = base.select(id_col).distinct()
    keyed = base.withColumn("_key", seeded_order_key(id_col, seed))
    return with_hashed_position(keyed, "_key", id_col, "_rank", total="_n").drop("_key")


def exact_split_sizes(n: int, test_frac: float = 0.3, second_test_frac: float = 0.5) -> tuple[int, int, int]:
    """(train, val, test) sizes of two successive shuffled splits with ceil'd test sizes."""
    n_temp = math.ceil(test_frac * n) if n else 0
    n_test = math.ceil(second_test_frac * n_temp) if n_temp else 0
    return n - n_temp, n_temp - n_test, n_test


def _out_cols(ordered: DataFrame, id_col: str, keep_columns: bool) -> list[str]:
    return [c for c in ordered.columns if c not in ("_rank", "_n")] if keep_columns else [id_col]


def exact_split(ids: DataFrame, id_col: str = "patient_id", seed: int = 42,
                keep_columns: bool = False, test_frac: float = 0.3, second_test_frac: float = 0.5) -> DataFrame:
    """One row per distinct id with ``split``; sizes follow ``exact_split_sizes``, computed
    as column arithmetic on the entity count (double products, as in ``math.ceil``)."""
    ordered = _ordered_ids(ids, id_col, seed, keep_columns)
    n = F.col("_n")
    n_temp = F.ceil(F.lit(test_frac) * n.cast("double"))
    n_test = F.ceil(F.lit(second_test_frac) * n_temp.cast("double"))
    r = F.col("_rank")
    split = (F.when(r < n - n_temp, F.lit("train")).when(r < n - n_test, F.lit("val"))
             .otherwise(F.lit("test")))
    return ordered.select(*_out_cols(ordered, id_col, keep_columns), split.alias("split"))


def fold_sizes(n: int, k: int) -> list[int]:
    q, r = divmod(n, k)
    return [q + 1 if f < r else q for f in range(k)]


def kfold(ids: DataFrame, k: int = 3, id_col: str = "patient_id", seed: int = 42,
          keep_columns: bool = False) -> DataFrame:
    """One row per distinct id with ``fold`` in [0, k): shuffled by the seeded hash, then
    cut into k contiguous blocks, the first n mod k one larger. With ``keep_columns`` the
    input (one row per id) keeps its columns."""
    ordered = _ordered_ids(ids, id_col, seed, keep_columns)
    n, r = F.col("_n"), F.col("_rank")
    q = (n / F.lit(k)).cast("long")
    rem = n - q * F.lit(k)
    big = rem * (q + 1)
    fold = F.when(r < big, (r / (q + 1)).cast("long")).otherwise(
        rem + ((r - big) / F.greatest(q, F.lit(1))).cast("long"))
    return ordered.select(*_out_cols(ordered, id_col, keep_columns), fold.cast("int").alias("fold"))


def split_stats(samples: DataFrame, id_col: str = "patient_id", label: str = "next_ckd") -> DataFrame:
    """Per split and in total (split = 'total'): samples, distinct entities, positives,
    negatives. The total row comes from ``rollup``."""
    agg = samples.rollup("split").agg(
        F.count(F.lit(1)).alias("samples"),
        F.countDistinct(id_col).alias("patients"),
        F.sum(label).cast("bigint").alias("positives"))
    return (agg.withColumn("split", F.coalesce("split", F.lit("total")))
            .withColumn("negatives", F.col("samples") - F.col("positives")))
