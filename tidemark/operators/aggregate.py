"""Per-entity roll-up of the history samples (one row per patient).

Definition (``patient_rows_from_nested``): explode every sample's history, then per patient
take the union of diagnosis titles and of abnormal labs, any-positive label, the number of
flattened rows, first age and gender.

Default (``patient_rows``): the samples of a patient are nested prefixes of one ordered
visit list, so the union over all flattened rows equals the union over the visits of the
last kept sample, the label is the max over samples, and the flattened row count is
K(K+1)/2 for K samples. This never builds the quadratic arrays.

Both build the lists in two steps: distinct (patient, item) pairs first (shuffled on both
columns, so a patient with very many visits is spread over tasks), then one sorted list
per patient whose length is bounded by the item vocabulary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import percent, space_join
from tidemark.functions.templates import clinical_sentence, history_text


def _empty():
    return F.array().cast("array<string>")


def _item_lists(long: DataFrame, key: str) -> DataFrame:
    """long: (key, kind, item) -> key, diagnoses, abnormal_labs (sorted distinct)."""
    distinct = long.where(F.col("item").isNotNull()).select(key, "kind", "item").distinct()
    return distinct.groupBy(key).agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "dx", F.col("item")))).alias("diagnoses"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "lab", F.col("item")))).alias("abnormal_labs"),
    )


def _explode_items(df: DataFrame, key: str) -> DataFrame:
    dx = df.select(F.col(key), F.lit("dx").alias("kind"), F.explode("diagnoses").alias("item"))
    lab = df.select(F.col(key), F.lit("lab").alias("kind"), F.explode("abnormal_labs").alias("item"))
    return dx.unionByName(lab)


def _finish(counts: DataFrame, lists: DataFrame, key: str) -> DataFrame:
    return (counts.join(lists, key, "left")
            .withColumn("diagnoses", F.coalesce("diagnoses", _empty()))
            .withColumn("abnormal_labs", F.coalesce("abnormal_labs", _empty())))


_VISIT = "v"  # marker element: one per history visit, carries the visit's sample facts


def _tagged(arr: str, kind: str) -> F.Column:
    """The list's non-null items as (kind, item) structs; a null list is empty."""
    items = F.transform(F.coalesce(F.col(arr), _empty()),
                        lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("item")))
    return F.filter(items, lambda s: s["item"].isNotNull())


def patient_rows(tl: DataFrame) -> DataFrame:
    """One row per patient with at least one kept sample.

    ``tl`` holds the history visits with their lists (``samples.attach_details``).

    Columns: patient_id, age, gender, is_ckd, diagnoses, abnormal_labs, num_visits
    (flattened rows, K(K+1)/2), num_samples (K), num_distinct_visits; plus ``split`` when
    ``tl`` carries it (one value per patient: the split the histories were written with).

    One pass over ``tl``: each history visit becomes a marker element plus one element per
    list item, exploded once. A first aggregation on (patient, kind, item) keeps distinct
    items and sums the markers' facts; a second one on the patient builds the sorted
    lists. Both aggregate partially before their shuffle, so a patient with very many
    visits ships one partial row per task and item, never its raw rows.
    """
    split = [c for c in ("split",) if c in tl.columns]
    marker = F.array(F.struct(F.lit(_VISIT).alias("kind"), F.lit(None).cast("string").alias("item")))
    elements = F.concat(marker, _tagged("diagnoses", "dx"), _tagged("abnormal_labs", "lab"))
    long = tl.where("in_history").select(
        F.col("subject_id").alias("patient_id"), "age", "gender", "kept", "next_ckd", *split,
        F.explode(elements).alias("_e"))
    is_marker = F.col("_e.kind") == _VISIT
    facts = ["age", "gender", *split]  # on the markers alone, as keys: a text in a buffer would make it a sort
    pairs = long.groupBy("patient_id", F.col("_e.kind").alias("kind"), F.col("_e.item").alias("item"),
                         *[F.when(is_marker, F.col(c)).alias(c) for c in facts]).agg(
        F.count_if(is_marker & F.col("kept")).alias("_k"),
        F.max(F.when(is_marker & F.col("kept"), F.col("next_ckd"))).alias("_y"),
        F.count_if(is_marker).alias("_v"))
    marker_only = F.col("kind") == _VISIT
    per = pairs.groupBy("patient_id").agg(
        F.min("age").alias("age"), F.min("gender").alias("gender"),
        F.max(F.when(marker_only, F.col("_y"))).cast("int").alias("is_ckd"),
        F.sum(F.when(marker_only, F.col("_k"))).alias("num_samples"),
        F.sum(F.when(marker_only, F.col("_v"))).alias("num_distinct_visits"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "dx", F.col("item")))).alias("diagnoses"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "lab", F.col("item")))).alias("abnormal_labs"),
        *[F.min(c).alias(c) for c in split])
    return (per.where(F.col("num_samples") > 0)
           .withColumn("num_visits", (F.col("num_samples") * (F.col("num_samples") + 1) / 2).cast("bigint")))


def flatten_history(nested: DataFrame) -> DataFrame:
    """One row per (sample, history visit): sample keys plus the visit's fields; a visit
    field with the same name as a sample field wins."""
    exploded = nested.select("*", F.explode("history").alias("_v")).drop("history")
    visit_cols = [f.name for f in nested.schema["history"].dataType.elementType.fields]
    keep = [c for c in exploded.columns if c not in visit_cols and c != "_v"]
    return exploded.select(*keep, *[F.col(f"_v.{c}").alias(c) for c in visit_cols])


def flatten_counts(tl: DataFrame) -> DataFrame:
    """Run-length form of the flattened table: one row per history visit with
    ``copies``, the number of samples whose history contains it (K - visit_index, with
    K = ``n_kept``, a per-row column of the timeline: no aggregation or join needed)."""
    return (tl.where("in_history")
            .withColumn("copies", (F.col("n_kept") - F.col("visit_index")).cast("bigint"))
            .select(F.col("subject_id").alias("patient_id"), "hadm_id", "visit_index",
                    "length_of_stay", "days_since_first", "copies"))


def patient_rows_from_nested(nested: DataFrame) -> DataFrame:
    """The definition: explode, then aggregate every flattened row."""
    flat = flatten_history(nested)
    counts = flat.groupBy("patient_id").agg(
        F.min("age").alias("age"), F.min("gender").alias("gender"),
        F.max("next_ckd").cast("int").alias("is_ckd"), F.count(F.lit(1)).alias("num_visits"))
    return _finish(counts, _item_lists(_explode_items(flat, "patient_id"), "patient_id"), "patient_id")


def with_text(rows: DataFrame) -> DataFrame:
    """diagnoses_str, abnormal_labs_str (space-joined), patient_history (history form)."""
    return rows.withColumns({
        "diagnoses_str": space_join("diagnoses"),
        "abnormal_labs_str": space_join("abnormal_labs"),
        "patient_history": history_text(),
    })


def with_sentence(rows: DataFrame, out: str = "formatted_history") -> DataFrame:
    return rows.withColumn(out, clinical_sentence())


def class_distribution(rows: DataFrame, label: str = "is_ckd", by: str | None = None) -> DataFrame:
    keys = [by, label] if by else [label]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def aggregate_summary(rows: DataFrame, by: str = "split") -> DataFrame:
    """Per split: patients, positives, negatives, their percentages (1 decimal, null for an
    empty split) and mean flattened visits."""
    return (rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_patients"),
        F.sum("is_ckd").cast("bigint").alias("ckd_positive"),
        F.avg("num_visits").alias("avg_visits"))
        .withColumn("ckd_negative", F.col("total_patients") - F.col("ckd_positive"))
        .withColumn("pct_positive", percent("ckd_positive", "total_patients"))
        .withColumn("pct_negative", percent("ckd_negative", "total_patients")))
