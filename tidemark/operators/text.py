"""Training rows and fixed-length token encoding.

The encoding replaces a subword tokenizer with a vocabulary built by Spark: whitespace
tokens of the training texts, ranked by frequency (ties by token text) through the
distributed global position. Id 0 pads, id 1 is an unknown token, known tokens start at 2.
Every row is cut or padded to ``max_length`` ids with an attention mask of 1s then 0s.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import with_global_position
from tidemark.session import ensure_checkpoint_dir

PAD_ID = 0
UNKNOWN_ID = 1
FIRST_ID = 2
ROW = "_tm_row"


def tokens(text: str = "formatted_history") -> F.Column:
    """Whitespace tokens, empty pieces dropped."""
    return F.filter(F.split(F.col(text), r"\s+"), lambda t: t != F.lit(""))


def training_rows(rows: DataFrame, text_col: str = "formatted_history", label: str = "is_ckd") -> DataFrame:
    """Sentence rows for the cross-validation pool (train + val) and the test split:
    scope ('cv' | 'test'), text, integer label."""
    scope = F.when(F.col("split") == "test", F.lit("test")).otherwise(F.lit("cv"))
    return rows.select("patient_id", scope.alias("scope"), F.col(text_col).alias("text"),
                       F.col(label).cast("int").alias("labels"))


def build_vocabulary(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """token, id, count: every distinct token of the given texts."""
    counts = (texts.select(F.explode(tokens(text_col)).alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("count")))
    ranked = with_global_position(counts, [F.col("count").desc(), F.col("token").asc()], "_rank")
    return ranked.select("token", (F.col("_rank") + FIRST_ID).cast("int").alias("id"), "count")


# The most frequent tokens are the hot keys of the token -> id join (a template word occurs
# in every row). Up to HOT_TOKENS of them are resolved map-side from a broadcast whose byte
# size is measured first and must stay under HOT_BYTES.
HOT_TOKENS = 10_000
HOT_BYTES = 16 * 1024 * 1024


def lookup_ids(pieces: DataFrame, vocab: DataFrame) -> DataFrame:
    """Left join of (..., token) rows to the vocabulary: adds ``id`` (null when unknown).

    Ids are frequency ranks, so the tokens with ``id < FIRST_ID + HOT_TOKENS`` are the
    most frequent ones. They are looked up in a broadcast table of at most HOT_TOKENS rows
    (its size is checked); the remaining tokens each have at most the frequency of the last
    hot one and go through an ordinary shuffle join. If the hot table is too large in
    bytes, everything takes the shuffle join, where AQE splits skewed partitions.
    """
    limit = FIRST_ID + HOT_TOKENS
    hot = vocab.where(F.col("id") < limit).select("token", F.col("id").alias("_hot_id"))
    hot_bytes = hot.agg(F.sum(F.octet_length("token") + F.lit(16))).first()[0] or 0
    if hot_bytes > HOT_BYTES:
        return pieces.join(vocab.select("token", "id"), "token", "left")
    # two branches read the tagged pieces: written once, not evaluated twice
    tagged = pieces.join(F.broadcast(hot), "token", "left").checkpoint(eager=True)
    resolved = tagged.where(F.col("_hot_id").isNotNull()).withColumnRenamed("_hot_id", "id")
    cold = vocab.where(F.col("id") >= limit).select("token", "id")
    rest = tagged.where(F.col("_hot_id").isNull()).drop("_hot_id").join(cold, "token", "left")
    return resolved.unionByName(rest)


def with_row_id(rows: DataFrame) -> DataFrame:
    """``rows`` written once, each with a number of its own (``ROW``): whatever its key holds,
    tokens find the way back to their row, and a recomputed task cannot change the numbers."""
    ensure_checkpoint_dir(rows.sparkSession)
    return rows.withColumn(ROW, F.monotonically_increasing_id()).checkpoint(eager=True)


def encode_fixed_length(rows: DataFrame, vocab: DataFrame, text_col: str = "text", max_length: int = 512) -> DataFrame:
    """Add input_ids and attention_mask (both ``max_length`` long) to each row.

    Rows are told apart by ``ROW`` (added and written here unless ``with_row_id`` has done so),
    not by a key of theirs: keys may repeat or be null. Only token positions below
    ``max_length`` can reach the output, so the token array is cut before it is exploded; the
    vocabulary itself comes from whole texts. Other columns (a fold, a scope) stay. A null text
    has no tokens.
    """
    rows = rows if ROW in rows.columns else with_row_id(rows)
    pieces = rows.select(ROW, F.posexplode(F.slice(tokens(text_col), 1, max_length)).alias("pos", "token"))
    looked = lookup_ids(pieces, vocab).withColumn("id", F.coalesce("id", F.lit(UNKNOWN_ID)))
    per_row = looked.groupBy(ROW).agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("_pi"))
    ids = F.transform(F.coalesce(F.col("_pi"), F.array().cast("array<struct<pos:int,id:int>>")),
                      lambda x: x["id"])
    n = F.size(ids)
    pad = F.array_repeat(F.lit(PAD_ID), F.lit(max_length) - n)
    return (rows.join(per_row, ROW, "left")
            .withColumn("input_ids", F.concat(ids, pad))
            .withColumn("attention_mask", F.concat(F.array_repeat(F.lit(1), n),
                                                   F.array_repeat(F.lit(0), F.lit(max_length) - n)))
            .drop("_pi", ROW))
