"""Exact deduplication (operator 3) with counting quotient filters.

1. Every row gets a 64-bit fingerprint of its text. Each input partition builds counting
   quotient filters: the high bits of a fingerprint (the quotient) choose a block, the
   remaining bits (the remainder) are stored once, sorted, with a count.
2. The filters of one block merge without loss: their sorted remainders are interleaved
   and the counts of equal remainders added. Many copies of one text are a single entry of
   each partition's filter, so a hot text does not make a hot block.
3. Fingerprints with a count above one are *suspects*. Only their rows are compared byte by
   byte: a group-by on the whole text, partially aggregated before the shuffle. Different
   texts with one fingerprint come out as different groups.

Rows never travel with their texts except as one copy per distinct suspect text and task.

Defined cases: a null text equals the empty text. The kept row of a class is the one with
the largest ``doc_id`` (null is smallest); among rows that repeat one id and text exactly
one stays. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import read, shuffle_partitions, stored
from tidemark.operators.membership import without

#: Fingerprints that one merged block holds on average.
BLOCK_FINGERPRINTS = 1 << 18
FILTER = "block int, remainders binary, counts binary"


def quotient_bits(rows: int, parallelism: int) -> int:
    """Bits of the quotient: blocks of bounded size, and at least one for each task."""
    blocks = max(4 * parallelism, -(-rows // BLOCK_FINGERPRINTS))
    return max(1, min(30, int(blocks - 1).bit_length()))


def build_filter(keys: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block, sorted remainders, counts) of each quotient that occurs in sorted ``keys``."""
    shift = np.uint64(64 - bits)
    quotients = (keys >> shift).astype(np.int64)
    remainders = keys & ((np.uint64(1) << shift) - np.uint64(1))
    starts = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1]])
    for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
        yield int(quotients[a]), remainders[a:b], counts[a:b]


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One sorted run with the counts of equal remainders added; nothing is lost."""
    remainders = np.concatenate([r for r, _ in runs])
    counts = np.concatenate([c for _, c in runs])
    order = np.argsort(remainders, kind="stable")  # timsort: linear on runs that are sorted
    remainders, counts = remainders[order], counts[order]
    starts = np.flatnonzero(np.r_[True, remainders[1:] != remainders[:-1]])
    return remainders[starts], np.add.reduceat(counts, starts)


def partition_filters(fingerprints: DataFrame, bits: int) -> DataFrame:
    """One filter for each input partition and block, from the column ``fp``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = None  # running (fingerprints, counts) of this partition, merged batch by batch
        for batch in batches:
            if not batch.num_rows:
                continue
            fp, n = np.unique(batch.column(0).to_numpy().view(np.uint64), return_counts=True)
            seen = (fp, n) if seen is None else merge_runs([seen, (fp, n)])
        if seen is None:
            return
        blocks, remainders, counts = zip(*build_filter(*seen, bits), strict=True)
        yield pa.RecordBatch.from_arrays([
            pa.array(blocks, pa.int32()),
            pa.array([r.astype("<u8").tobytes() for r in remainders], pa.binary()),
            pa.array([c.astype("<u8").tobytes() for c in counts], pa.binary())],
            names=["block", "remainders", "counts"])

    return fingerprints.select("fp").mapInArrow(build, FILTER)


def repeated_fingerprints(filters: DataFrame, bits: int) -> DataFrame:
    """Merge the filters block by block; the fingerprints counted more than once."""

    def merge(table: pa.Table) -> pa.Table:
        runs = [(np.frombuffer(r, "<u8"), np.frombuffer(c, "<u8")) for r, c in zip(
            table.column("remainders").to_pylist(), table.column("counts").to_pylist(), strict=True)]
        remainders, counts = merge_runs(runs)
        block = np.uint64(table.column("block")[0].as_py())
        fp = ((block << np.uint64(64 - bits)) | remainders)[counts > 1]
        return pa.table({"fp": pa.array(fp.view(np.int64), pa.int64())})

    return filters.groupBy("block").applyInArrow(merge, "fp long")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row; ``_row`` tells repeated
    rows apart and is an internal number."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("fp", F.xxhash64("text"))
    rows = stored(texts.select("doc_id", "fp", F.unhex(F.sha2("text", 256)).alias("sha"),
                               F.monotonically_increasing_id().alias("_row")), "dedup-rows")
    bits = quotient_bits(rows.count(), shuffle_partitions(spark))
    suspects = stored(repeated_fingerprints(partition_filters(rows, bits), bits), "dedup-suspects")

    # byte verification: the group key is the text itself
    verified = (texts.select("fp", "text").join(suspects, "fp", "left_semi")
                .groupBy("fp", "text").agg(F.count(F.lit(1)).alias("n"))
                .where("n > 1").select("fp", F.unhex(F.sha2("text", 256)).alias("sha"), "n"))
    newest = (rows.join(suspects, "fp", "left_semi")
              .groupBy("fp", "sha").agg(F.max(F.struct("doc_id", "_row")).alias("keep")))
    groups = stored(newest.join(verified, ["fp", "sha"]).select("fp", "sha", "keep", "n"), "dedup-groups")
    out = rows.join(groups, ["fp", "sha"], "left")
    return out.select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("keep._row") == F.col("_row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Exact duplicates of the whole texts of ``documents``; the largest doc_id stays."""
    return classes(read(spark, sf_dir, "documents"))


def _row_key(doc_id: str, sha: Column) -> Column:
    """The id and text digest of a row as one value, for joins; the id may be null."""
    return F.concat_ws(":", sha, F.col(doc_id).cast("string")).alias("_tm_key")


def keep_latest(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Dropped rows leave by an anti-join on (id, text digest), for which only rows that may be
    dropped are moved. Rows that repeat an id *and*
    its text share that key, so only if such rows exist they are reduced to one as well.
    """
    decided = classes(docs.select("doc_id", "text"))
    dropped = stored(decided.where(~F.col("kept")).select(
        F.col("doc_id").alias("_tm_id"), F.col("keep_id").alias("_tm_keep"), F.col("text_sha256").alias("_tm_sha")),
        "dedup-dropped")
    twins = dropped.where(F.col("_tm_id").eqNullSafe(F.col("_tm_keep")))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    gone = dropped.where(~F.col("_tm_id").eqNullSafe(F.col("_tm_keep"))).select(_row_key("_tm_id", F.col("_tm_sha")))
    kept = without(docs.select("*", _row_key("doc_id", digest)), gone, "_tm_key").drop("_tm_key")
    if twins.isEmpty():
        return kept
    marked = kept.withColumn("_tm_sha", digest)
    return marked.dropDuplicates(["doc_id", "_tm_sha"]).drop("_tm_sha")


ORACLE = {"op3_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""}
QUERIES = {"op3_exact_dedup": op3_exact_dedup}
