"""Importance resampling towards a target distribution (operator 12) by hashed word n-grams.

The features of a text are its words and pairs of consecutive words; each falls into one of
``BUCKETS`` buckets by the crc32 of its bytes. ``raw`` and ``target`` texts are counted by
bucket, a bucket's gain is the floored thousandfold log ratio of its smoothed shares, and a
document's weight is the floored mean gain of its features. Adding Gumbel noise, made from a
hash of the document's id and a seed, and taking the highest scores draws documents without
replacement in proportion to their importance.

Features of a whole batch are found together: texts are joined with a separator that no word
holds, one regular-expression pass finds all words, ``searchsorted`` on the documents' offsets
tells whose they are, pairs that cross a document's end are masked, and ``bincount`` sums. A
pair's crc32 is put together from its words' values, since crc32 is linear: appending n bytes
is one of 32-bit-to-32-bit maps that depend only on n, tabulated for words up to ``TABLED``
bytes (longer ones are hashed as they are).

Two passes read the texts. The first sends at most ``BUCKETS`` counts a task through a sum;
only those ``BUCKETS`` sums reach the driver and go out again as gains. Ranks come from the
distributed global position of (score, id), never from one sorted task.

Defined cases: a null text has no words. Without features a weight is 0. A null doc_id hashes
as the empty string, and sorts before others in a tie of scores. Rows that repeat a doc_id are
drawn like others, with equal noise; the order of ties between them is arbitrary. Empty tables
give empty counts, and gains of empty counts are those of the smoothing alone. A text is
never cut: batches are closed after about ``BLOCK`` characters, and a longer text has a batch
of its own. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import blocks
from tidemark.llm.common import CRC_TABLE, crc32_sql, read, stored
from tidemark.operators.ranking import with_global_position

BUCKETS = 10_000
LEAST_WORDS, DRAWN, SEED = 20, 25, 7  # words of a document that takes part; per cent drawn
BLOCK = 1 << 20
TABLED = 64
#: Of lower-cased UTF-8: digits, a-z and everything beyond ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SEPARATOR = "\0"


def _appending() -> np.ndarray:
    """[n, i, b]: what byte i of a crc register, being b, becomes when n zero bytes follow."""
    each = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
    steps = each ^ each[0]  # the register's change by one byte, without the start value
    table = np.zeros((TABLED + 2, 4, 256), np.uint32)
    table[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, len(table)):
        before = table[n - 1]
        table[n] = (before >> np.uint32(8)) ^ steps[before & np.uint32(255)]
    return table


APPENDING = _appending()


def pair_crc(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of two strings put together, from their crc32 values and the second's size in
    bytes (at most ``TABLED`` + 1)."""
    out = second.copy()
    for i in range(4):
        out ^= APPENDING[size, i, (first >> np.uint32(8 * i)) & np.uint32(255)]
    return out


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch: each feature's document (its index) and bucket, and the words of each document."""
    parts = [t.encode("utf-8", "surrogatepass").lower() for t in texts]  # of bytes: A-Z only
    ends = np.cumsum([len(p) + 1 for p in parts])
    found = list(WORD.finditer(SEPARATOR.encode().join(parts)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    words = [m[0] for m in found]
    spaced = [b" " + w for w in words]
    document = np.searchsorted(ends, np.fromiter((m.start() for m in found), np.int64, len(found)), "right")
    single = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    after_space = np.fromiter(map(zlib.crc32, spaced), np.uint32, len(words))
    size = np.fromiter(map(len, spaced), np.int64, len(words))
    pair = pair_crc(single[:-1], after_space[1:], np.minimum(size[1:], TABLED + 1))
    for at in np.flatnonzero(size[1:] > TABLED + 1):
        pair[at] = zlib.crc32(spaced[at + 1], int(single[at]))
    inside = document[1:] == document[:-1]
    buckets = np.concatenate([single, pair[inside]]) % BUCKETS
    return (np.concatenate([document, document[1:][inside]]), buckets.astype(np.int64),
            np.bincount(document, minlength=len(texts)))


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket's features occur in the column ``text``, over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0).to_pylist(), BLOCK):
                total += np.bincount(features(block)[1], minlength=BUCKETS)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(run, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The floored thousandfold log ratio of target to raw shares of each bucket."""
    above = (target + 1.0) * (float(raw.sum()) + BUCKETS)
    return np.floor(1000 * np.log(above / ((raw + 1.0) * (float(target.sum()) + BUCKETS)))).astype(np.int64)


def weighted(documents: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_features, n_words and weight of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(gain)  # BUCKETS integers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = []
            for block in blocks(batch.column(1).to_pylist(), BLOCK):
                document, bucket, words = features(block)
                n = np.bincount(document, minlength=len(block))
                total = np.zeros(len(block), np.int64)
                np.add.at(total, document, shared.value[bucket])
                columns.append((n, words, total // np.maximum(n, 1)))
            if columns:
                whole = [pa.array(np.concatenate(c)) for c in zip(*columns, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *whole], ["doc_id", "n_features", "n_words", "weight"])

    narrow = documents.select("doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, n_features long, n_words long, weight long")


def resampled(documents: DataFrame, target: DataFrame, drawn: int = DRAWN, least_words: int = LEAST_WORDS,
              seed: int = SEED) -> DataFrame:
    """doc_id, n_features, n_words, weight, score and rank of every document: ``drawn`` per cent
    of those with ``least_words`` words or more, by score; others have no rank."""
    rows = weighted(documents, gains(bucket_counts(documents), bucket_counts(target)))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    hashed = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((hashed + 0.5) / F.lit(4294967296.0))))
    scored = stored(rows.withColumn("score", (F.col("weight") + noise).cast("long")), "resampling-scores")
    part = scored.where(F.col("n_words") >= least_words)
    placed = with_global_position(part, [F.col("score").desc(), F.col("doc_id").asc_nulls_first()], "_at", total="_of")
    rank = F.when(F.col("_at") < F.floor(drawn * F.col("_of") / 100), F.col("_at") + 1).cast("long")
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", rank).drop("_at", "_of").unionByName(rest)


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, towards the texts of ``benchmark``."""
    out = resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = {"op12_importance_resampling": f"""
WITH {CRC_TABLE},
texts AS (SELECT row_number() OVER () AS r, doc_id, text, false AS target FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, text, true FROM benchmark),
found AS (SELECT r, target, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM texts),
words AS (SELECT r, target, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM found),
feats AS (SELECT r, target, w AS f FROM words UNION ALL
  SELECT r, target, w || ' ' || w2 FROM (SELECT r, target, w, lead(w) OVER (PARTITION BY r ORDER BY i) AS w2 FROM words) WHERE w2 IS NOT NULL),
hashed AS MATERIALIZED (SELECT f, {crc32_sql("f")} % {BUCKETS} AS b FROM (SELECT DISTINCT f FROM feats), crc_table),
placed AS MATERIALIZED (SELECT r, target, b FROM feats JOIN hashed USING (f)),
sums AS (SELECT count(*) FILTER (NOT target)::DOUBLE AS s_all, count(*) FILTER (target)::DOUBLE AS t_all FROM placed),
by_bucket AS (SELECT b, count(*) FILTER (NOT target)::DOUBLE AS s, count(*) FILTER (target)::DOUBLE AS t FROM placed GROUP BY b),
gain AS (SELECT b, floor(1000 * ln((t + 1) * (s_all + {BUCKETS}) / ((s + 1) * (t_all + {BUCKETS})))) AS g FROM by_bucket, sums),
weights AS (SELECT r, count(*) AS n_features, floor(sum(g) / count(*))::BIGINT AS weight FROM placed JOIN gain USING (b) WHERE NOT target GROUP BY r),
scored AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(ws) >= {LEAST_WORDS} AS part,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)
  / 4294967296)))::BIGINT AS score FROM texts JOIN found USING (r) LEFT JOIN weights USING (r) WHERE NOT texts.target),
ranked AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY score DESC, doc_id NULLS FIRST) AS place, count(*) OVER (PARTITION BY part) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN part AND place <= floor({DRAWN} * n / 100) THEN place END AS rank FROM ranked"""}
QUERIES = {"op12_importance_resampling": op12_importance_resampling}
