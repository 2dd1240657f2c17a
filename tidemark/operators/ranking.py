"""Global order without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row to one task. These helpers
give each row its 0-based position in a total order, and running sums along that order,
with work spread over ``n`` range partitions:

1. ``repartitionByRange(n, order)`` + ``sortWithinPartitions(order)``: equal order keys
   land in one partition, partitions are contiguous slices of the order. A single hot
   entity is split across several partitions, because the order key includes the row's
   own tie-breaker (for example the visit id).
2. The partition id and the row's index inside its partition are attached and the result
   is checkpointed to the session's shared checkpoint folder. Both later reads (the
   per-partition totals and the rows) then see the same partitions, even if an executor is
   lost and work is recomputed; range bounds come from sampling, so two independent
   evaluations could otherwise disagree.
3. Per-partition totals are ``n`` rows. Their exclusive prefix is computed on those ``n``
   rows and broadcast back (size bound: the partition count, not the data).

Only step 3's ``n``-row table ever sits in one partition.

``with_hashed_position`` orders by a digest instead. A digest is uniform, so its first digits
are ranges of equal size already: no sample, no range exchange, one count for each prefix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir, shuffle_partitions

# A range slice holds about this many rows at most: beyond (shuffle partitions x this), the
# number of slices follows the counted rows instead of the fixed setting.
ROWS_PER_SLICE = 2_000_000

PID = "_tm_pid"
LOC = "_tm_loc"


def _ranged(df: DataFrame, order: Sequence[Column], n_parts: int | None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = n_parts
    if n is None:  # written once: counting and sampling then read rows, not the plan above them
        df = df.checkpoint(eager=True)
        n = max(shuffle_partitions(spark), -(-df.count() // ROWS_PER_SLICE))
    # An explicit partition count keeps AQE from coalescing this exchange, so partition ids
    # are exactly the range slices.
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn(PID, F.spark_partition_id())
              .withColumn(LOC, F.monotonically_increasing_id()
                          - F.shiftleft(F.col(PID).cast("long"), 33)))
    return ranged.checkpoint(eager=True)


def _exclusive_offsets(totals: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exclusive running sums, and grand totals, over the n-row per-partition totals."""
    w = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return totals.select(PID, *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"_off_{c}") for c in cols],
                         *[F.sum(c).over(everything).alias(f"_all_{c}") for c in cols])


def with_global_position(df: DataFrame, order: Sequence[Column], name: str = "pos",
                         n_parts: int | None = None, total: str | None = None) -> DataFrame:
    """Add ``name``: the row's 0-based position in ``order`` (and, with ``total``, the
    number of rows, taken from the offsets table instead of a separate count).

    ``order`` must be a total order (end it with a unique column), or positions of tied rows
    are arbitrary but still distinct and gap-free.
    """
    ranged = _ranged(df, order, n_parts)
    totals = ranged.groupBy(PID).agg(F.count(F.lit(1)).alias("_n"))
    offsets = _exclusive_offsets(totals, ["_n"])
    out = ranged.join(F.broadcast(offsets), PID).withColumn(name, F.col("_off__n") + F.col(LOC))
    if total:
        out = out.withColumn(total, F.col("_all__n"))
    return out.drop(PID, LOC, "_off__n", "_all__n")


#: Hex digits of a digest that make a range: 65,536 ranges, so 1e10 rows are 150,000 a range.
PREFIX_DIGITS = 4


def with_hashed_position(df: DataFrame, key: str, tie: str, name: str = "pos", total: str | None = None) -> DataFrame:
    """Add ``name``: the row's 0-based position in the order of the hex digest ``key``, then
    ``tie`` (and, with ``total``, the number of rows).

    The first ``PREFIX_DIGITS`` digits are a radix pass: rows are counted by prefix (at most
    65,536 partial sums), exclusive prefix sums of those counts are broadcast, and inside a
    prefix a window numbers the rows. The input is written once, as both read it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.withColumn(PID, F.conv(F.substring(key, 1, PREFIX_DIGITS), 16, 10).cast("int")).checkpoint(eager=True)
    offsets = _exclusive_offsets(rows.groupBy(PID).agg(F.count(F.lit(1)).alias("_n")), ["_n"])
    local = F.row_number().over(Window.partitionBy(PID).orderBy(key, tie)) - 1
    out = rows.withColumn(LOC, local).join(F.broadcast(offsets), PID).withColumn(name, F.col("_off__n") + F.col(LOC))
    if total:
        out = out.withColumn(total, F.col("_all__n"))
    return out.drop(PID, LOC, "_off__n", "_all__n")


def with_prefix_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, str],
                     position: str | None = "pos", n_parts: int | None = None) -> DataFrame:
    """Running (inclusive) sums along a global order.

    ``sums`` maps an input column to the output column holding its running total up to and
    including the row; ``{output}_total`` holds the grand total. ``order`` should be unique
    per row (aggregate ties first).
    """
    ranged = _ranged(df, order, n_parts)
    # Inside a partition the running sum is an ordinary window keyed by the partition id;
    # a partition is a bounded slice, so this window is never larger than one range slice.
    w = Window.partitionBy(PID).orderBy(LOC).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(src).over(w).alias(f"_run_{src}") for src in sums])
    totals = ranged.groupBy(PID).agg(F.count(F.lit(1)).alias("_n"),
                                     *[F.sum(src).alias(f"_t_{src}") for src in sums])
    offsets = _exclusive_offsets(totals, ["_n", *[f"_t_{src}" for src in sums]])
    out = local.join(F.broadcast(offsets), PID)
    for src, dst in sums.items():
        out = (out.withColumn(dst, F.col(f"_off__t_{src}") + F.col(f"_run_{src}"))
               .withColumn(f"{dst}_total", F.col(f"_all__t_{src}")))
    if position:
        out = out.withColumn(position, F.col("_off__n") + F.col(LOC))
    drop = ([PID, LOC, "_off__n", "_all__n"] + [f"_off__t_{s}" for s in sums]
            + [f"_all__t_{s}" for s in sums] + [f"_run_{s}" for s in sums])
    return out.drop(*drop)
