"""Registered queries: one per operator row of the inventory, over the driver tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame with named, typed columns
(arrays are rendered as '|'-joined text and doubles rounded to 6 places, so another engine
can produce byte-identical values). ``tidemark.plans.oracle`` holds the DuckDB SQL for
the same keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.config import FIXTURE_CONFIG, CohortConfig
from tidemark.functions.exprs import argmax_class, class_score, upper_in, whole_days
from tidemark.operators import aggregate, codes, item_sets, labs, membership, metrics, samples, splits, text, visits
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.tables import read_table
from tidemark.sources.views import event_inputs, read_driver, star_schema_inputs

R = 6  # decimals kept for doubles in query output


def _join(col: str) -> F.Column:
    return F.array_join(F.col(col), "|")


class Fixture:
    """The star-schema role views and the pipeline built on them, built lazily once."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: CohortConfig = FIXTURE_CONFIG):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, cfg
        self.inputs = star_schema_inputs(spark, sf_dir)

    @cached_property
    def mapped(self) -> DataFrame:
        i = self.inputs
        return codes.mapped_diagnoses(i.diagnoses_icd, i.d_icd_diagnoses, i.icd9_to_icd10,
                                      i.icd10_to_ccsr, self.cfg.title_join_on_version)

    @cached_property
    def labs(self) -> DataFrame:
        return labs.relevant_labs(self.inputs.labevents, self.inputs.d_labitems,
                                  self.cfg.relevant_labs, self.cfg.abnormal_flags)

    @cached_property
    def target_flags(self) -> DataFrame:
        """hadm_id, has_target: from the crosswalk alone (a title join cannot change "any")."""
        i = self.inputs
        crosswalked = codes.map_codes(i.diagnoses_icd, i.icd9_to_icd10, i.icd10_to_ccsr)
        return visits.visit_target_flag(crosswalked, self.cfg.target_code)

    @cached_property
    def visit_flags(self) -> DataFrame:
        """All admissions, narrow: subject_id, hadm_id, admittime, has_target."""
        return visits.visit_flags(self.inputs.admissions, self.target_flags)

    @cached_property
    def diagnosis_lists(self) -> DataFrame:
        return visits.visit_diagnoses(self.mapped)

    @cached_property
    def abnormal_lists(self) -> DataFrame:
        return visits.visit_abnormal_labs(self.labs)

    @cached_property
    def sequence(self) -> DataFrame:
        """Every admission with its order, successor and entity facts."""
        return samples.sequence(self.visit_flags)

    @cached_property
    def timeline(self) -> DataFrame:
        """Narrow timeline of cohort entities (ordering work never carries the lists)."""
        return samples.timeline(self.visit_flags, self.inputs.patients)

    @cached_property
    def history(self) -> DataFrame:
        """History visits with their lists and length of stay."""
        return samples.attach_details(self.timeline, self.diagnosis_lists, self.abnormal_lists)

    @cached_property
    def samples(self) -> DataFrame:
        return samples.samples(self.timeline)

    @cached_property
    def rows(self) -> DataFrame:
        return aggregate.patient_rows(self.history)

    @cached_property
    def split(self) -> DataFrame:
        ids = self.samples.select("patient_id").distinct()
        return splits.hash_split(ids, "patient_id", self.cfg.seed, self.cfg.train_pct,
                                 self.cfg.train_val_pct)

    @cached_property
    def labels_split(self) -> DataFrame:
        """patient_id, is_ckd, num_visits, split of every patient with a kept sample, from the
        narrow timeline alone: each entity's first visit carries the number of its kept
        samples and its positive one, so no list is built and nothing is aggregated."""
        first = self.timeline.where((F.col("visit_index") == 0) & (F.col("n_kept") > 0))
        k = F.col("n_kept").cast("bigint")
        narrow = first.select(F.col("subject_id").alias("patient_id"),
                              F.col("positive_index").isNotNull().cast("int").alias("is_ckd"),
                              (k * (k + 1) / 2).cast("bigint").alias("num_visits"))
        return splits.hash_split(narrow, "patient_id", self.cfg.seed, self.cfg.train_pct, self.cfg.train_val_pct)

    @cached_property
    def cv_labels_folded(self) -> DataFrame:
        """patient_id, labels, fold of the cross-validation pool: narrow rows only."""
        pool = self.labels_split.where(F.col("split").isin("train", "val"))
        return splits.kfold(pool.select("patient_id", F.col("is_ckd").alias("labels")), self.cfg.k_folds,
                            "patient_id", self.cfg.seed, keep_columns=True)

    @cached_property
    def rows_split(self) -> DataFrame:
        """Patient rows with their split: the hash split is a function of the id alone,
        so it is a column expression here, not a join."""
        return splits.hash_split(self.rows, "patient_id", self.cfg.seed, self.cfg.train_pct,
                                 self.cfg.train_val_pct)

    @cached_property
    def training(self) -> DataFrame:
        """patient_id, scope ('cv' | 'test'), text, labels."""
        return text.training_rows(aggregate.with_sentence(self.rows_split))

    @cached_property
    def stored_training(self) -> DataFrame:
        """``training``, written once for queries that read it more than once."""
        ensure_checkpoint_dir(self.spark)
        return self.training.checkpoint(eager=True)

    @cached_property
    def training_folded(self) -> DataFrame:
        """The cross-validation pool (train + val) of ``stored_training`` with its fold: the written
        rows' ids are ranked, so the timeline is not made a second time for them."""
        pool = self.stored_training.where(F.col("scope") == "cv")
        folds = splits.kfold(pool.select("patient_id"), self.cfg.k_folds, "patient_id", self.cfg.seed)
        return pool.join(folds, "patient_id")

    @cached_property
    def cv_rows_folded(self) -> DataFrame:
        """``training_folded`` under the name of its text in the patient rows."""
        return self.training_folded.withColumnRenamed("text", "formatted_history")

    @cached_property
    def folds(self) -> DataFrame:
        return self.cv_labels_folded.select("patient_id", "fold")


def _fx(spark, sf_dir) -> Fixture:
    return Fixture(spark, sf_dir)


# --- documents: the ranking-metric fixture -------------------------------------------
# Labelled documents scored by length: two-class scores (2000, n_chars), so the predicted
# class is 1 when a document has more than 2000 characters; the class-1 score is n_chars.
DOC_THRESHOLD = 2000.0


def labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_driver(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = read_driver(spark, sf_dir, "labels").select("doc_id", "quality")
    return (docs.join(lab, "doc_id")
            .select("doc_id", F.col("quality").alias("label"),
                    F.array(F.lit(DOC_THRESHOLD), F.col("n_chars").cast("double")).alias("scores")))


def doc_folds(spark: SparkSession, sf_dir: str, k: int = 3, seed: int = 42) -> DataFrame:
    d = labelled_docs(spark, sf_dir)
    return d.join(splits.kfold(d.select("doc_id"), k, "doc_id", seed), "doc_id")


def doc_fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.metric_bundle(doc_folds(spark, sf_dir), "scores", "label", by="fold")


# --- queries ---------------------------------------------------------------------------

def q_length_of_stay(spark, d):
    a = visits.with_length_of_stay(_fx(spark, d).inputs.admissions)
    return a.select("hadm_id", "subject_id", F.round("length_of_stay", R).alias("length_of_stay"))


def q_lab_abnormal_flag(spark, d):
    le = _fx(spark, d).inputs.labevents
    return le.select("hadm_id", "itemid", "flag", upper_in("flag", FIXTURE_CONFIG.abnormal_flags).alias("abnormal"))


def q_relevant_labs(spark, d):
    return _fx(spark, d).labs.select("hadm_id", "itemid", "label", "abnormal")


def q_lab_stats(spark, d):
    return labs.lab_stats(_fx(spark, d).labs)


def q_crosswalk(spark, d):
    i = _fx(spark, d).inputs
    return codes.map_codes(i.diagnoses_icd, i.icd9_to_icd10, i.icd10_to_ccsr).select(
        "hadm_id", "icd_code", "icd_version", "ccsr_code")


def q_dx_titles(spark, d):
    i = _fx(spark, d).inputs
    return codes.add_titles(i.diagnoses_icd, i.d_icd_diagnoses).select("hadm_id", "icd_code", "long_title")


def q_mapping_stats(spark, d):
    return codes.mapping_stats(_fx(spark, d).mapped)


def _versioned(spark, d):
    """Diagnoses of which some have another code version or none, and titles of which some
    exist under both versions."""
    line, part = read_driver(spark, d, "lineitem"), read_driver(spark, d, "part")
    version = (F.when(F.col("l_linenumber") == 1, F.lit(8)).when(F.col("l_linenumber") == 2, F.lit(None))
               .when(F.col("l_linenumber") % 2 == 0, F.lit(9)).otherwise(F.lit(10))).cast("int")
    diagnoses = line.select(F.col("l_orderkey").alias("hadm_id"), F.col("l_partkey").cast("string").alias("icd_code"),
                            version.alias("icd_version"))
    code = F.col("p_partkey").cast("string").alias("icd_code")
    titles = part.select(code, F.lit(9).alias("icd_version"), F.col("p_name").alias("long_title")).unionByName(
        part.where(F.col("p_size") <= 10).select(code, F.lit(10).alias("icd_version"),
                                                 F.concat("p_name", F.lit(" (10)")).alias("long_title")))
    return diagnoses, titles


def q_mapping_stats_versions(spark, d):
    i = _fx(spark, d).inputs
    diagnoses, titles = _versioned(spark, d)
    return codes.mapping_stats(codes.mapped_diagnoses(diagnoses, titles, i.icd9_to_icd10, i.icd10_to_ccsr))


def q_dx_titles_versions(spark, d):
    """Titles joined on the code alone (fanning out) and on (code, version)."""
    diagnoses, titles = _versioned(spark, d)
    out = [codes.add_titles(diagnoses, titles, on_version=v).select(
        F.lit(int(v)).alias("by_version"), "hadm_id", "icd_code", diagnoses["icd_version"], "long_title") for v in (False, True)]
    return out[0].unionByName(out[1])


def q_csv_titles(spark, d):
    """Part names with quotes and line breaks, written as CSV and read by the typed reader."""
    name = F.concat(F.col("p_name"), F.lit(' "'), F.col("p_type"), F.lit('",\n'), F.col("p_brand"))
    rows = read_driver(spark, d, "part").select(F.col("p_partkey").cast("string").alias("icd_code"),
                                                F.lit(9).alias("icd_version"), name.alias("long_title"))
    root = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    rows.write.option("header", True).option("escape", '"').csv(f"{root}/d_icd_diagnoses.csv")
    return read_table(spark, root, "d_icd_diagnoses")


def q_csv_lab_events(spark, d):
    """Lab events whose flags hold quotes and line breaks, written as CSV and read in byte ranges."""
    flag = F.when(F.col("l_linenumber") % 3 == 0, F.concat("l_returnflag", F.lit('\n"'), "l_linestatus", F.lit('",\n')))
    rows = read_driver(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("hadm_id"), F.col("l_partkey").alias("itemid"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("charttime"), flag.otherwise(F.col("l_returnflag")).alias("flag"))
    root = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    rows.write.options(header=True, escape='"', ignoreTrailingWhiteSpace=False).csv(f"{root}/labevents.csv")
    read = read_table(spark, root, "labevents")
    return read.select("hadm_id", "itemid", F.date_format("charttime", "yyyy-MM-dd HH:mm:ss").alias("charttime"), "flag")


def q_visit_diagnoses(spark, d):
    v = visits.visit_diagnoses(_fx(spark, d).mapped)
    return v.select("hadm_id", F.size("diagnoses").alias("n_diagnoses"), _join("diagnoses").alias("diagnoses"))


def q_visit_abnormal_labs(spark, d):
    v = visits.visit_abnormal_labs(_fx(spark, d).labs)
    return v.select("hadm_id", _join("abnormal_labs").alias("abnormal_labs"))


def q_visit_target_flag(spark, d):
    f = _fx(spark, d)
    return visits.visit_target_flag(f.mapped, f.cfg.target_code)


def q_visit_sequence(spark, d):
    return _fx(spark, d).sequence.select("subject_id", "hadm_id", "visit_index")


def q_first_visit(spark, d):
    v = _fx(spark, d).visit_flags
    first = F.min(F.struct(F.col("admittime").isNull().alias("_late"), "admittime", "hadm_id", "has_target"))
    return (v.where(F.col("subject_id").isNotNull()).groupBy("subject_id").agg(first.alias("_f"))
            .select("subject_id", F.col("_f.hadm_id").alias("first_hadm_id"),
                    F.col("_f.has_target").alias("first_has_target")))


def q_days_since_first(spark, d):
    """Whole days since the entity's first visit, for every admission. The entity's first
    time comes from the routed sequence operator (fed by the admissions alone), so an
    entity with a huge number of visits is never one join key or one window task."""
    a = _fx(spark, d).inputs.admissions.select("subject_id", "hadm_id", "admittime",
                                                F.lit(0).alias("has_target"))
    return samples.sequence(a).select(
        "subject_id", "hadm_id", whole_days("first_time", "admittime").alias("days_since_first"))


def q_cohort(spark, d):
    f = _fx(spark, d)
    return samples.cohort(f.sequence, f.inputs.patients).select("subject_id", "n_visits", "age", "gender")


def q_cohort_attrition(spark, d):
    f = _fx(spark, d)
    return samples.cohort_attrition(f.sequence, f.inputs.patients)


def q_next_visit(spark, d):
    return _fx(spark, d).sequence.where(samples.has_next()).select("hadm_id", "next_hadm_id")


def q_next_label(spark, d):
    w = _fx(spark, d).sequence.where(samples.has_next())
    return w.select("subject_id", "hadm_id", "next_hadm_id", F.col("next_label").cast("int").alias("next_ckd"))


def q_censored_samples(spark, d):
    return _fx(spark, d).samples.select("patient_id", "hadm_id", "next_ckd")


def q_next_event_samples(spark, d):
    return _fx(spark, d).samples.select("patient_id", "hadm_id", "visit_index", "history_len", "age",
                                        "gender", "next_hadm_id", "next_ckd")


def q_flatten_history(spark, d):
    """One row per (kept sample, visit of its history)."""
    rows = samples.flattened(_fx(spark, d).history)
    return rows.select("patient_id", "sample_index", "age", "gender", "next_ckd", "hadm_id", "visit_index",
                       F.round("length_of_stay", R).alias("length_of_stay"), "days_since_first",
                       _join("diagnoses").alias("diagnoses"), _join("abnormal_labs").alias("abnormal_labs"))


def q_nested_samples(spark, d):
    """The sample records with their histories, each rendered as text."""
    ns = samples.nested_samples(_fx(spark, d).history)
    each = lambda f: F.array_join(F.transform("history", f), "|")
    return ns.select("patient_id", "visit_index", "age", "gender", "next_ckd", F.size("history").alias("history_len"),
                     each(lambda v: v["days_since_first"].cast("string")).alias("days"),
                     each(lambda v: F.array_join(v["diagnoses"], "+")).alias("diagnoses"),
                     each(lambda v: F.array_join(v["abnormal_labs"], "+")).alias("abnormal_labs"))


def q_job_patient_split(spark, d):
    """The split that ``prepare`` writes with a seed of its own, as the roll-up carries it on."""
    f = _fx(spark, d)
    written = splits.hash_split(f.history, "subject_id", 7, f.cfg.train_pct, f.cfg.train_val_pct)
    return aggregate.patient_rows(written).select("patient_id", "split", "is_ckd")


def q_reduced_visit_lists(spark, d):
    """The lists of the history visits, built from the facts of those visits alone."""
    f = _fx(spark, d)
    ids = f.timeline.where("in_history").select("hadm_id").checkpoint(eager=True)
    wanted = membership.members(ids, "hadm_id")
    dx, lab = visits.lists_of(wanted, f.mapped, f.labs)
    lists = ids.join(dx, "hadm_id", "left").join(lab, "hadm_id", "left")
    return lists.select("hadm_id", F.coalesce(F.size("diagnoses"), F.lit(0)).alias("n_diagnoses"),
                        F.coalesce(_join("diagnoses"), F.lit("")).alias("diagnoses"),
                        F.coalesce(_join("abnormal_labs"), F.lit("")).alias("abnormal_labs"))


def q_history_counts(spark, d):
    """The run-length form of the flattened table."""
    fc = aggregate.flatten_counts(_fx(spark, d).history)
    return fc.select("patient_id", "hadm_id", "visit_index", F.round("length_of_stay", R).alias("length_of_stay"),
                     "days_since_first", "copies")


def q_patient_aggregate(spark, d):
    r = _fx(spark, d).rows
    return r.select("patient_id", "age", "gender", "is_ckd", "num_visits", "num_samples",
                    "num_distinct_visits", _join("diagnoses").alias("diagnoses"),
                    _join("abnormal_labs").alias("abnormal_labs"))


def q_patient_item_sets(spark, d):
    """The patient roll-up with its unions taken on bitmaps over an item dictionary."""
    r = item_sets.patient_rows_by_sets(_fx(spark, d).history.checkpoint(eager=True))
    return r.select("patient_id", "age", "gender", "is_ckd", "num_visits", "num_samples",
                    "num_distinct_visits", _join("diagnoses").alias("diagnoses"),
                    _join("abnormal_labs").alias("abnormal_labs"))


def q_split_item_coverage(spark, d):
    """Distinct items of each kind by split and label: patients' bitmaps merged, bits counted."""
    f = _fx(spark, d)
    held = f.history.withColumnRenamed("subject_id", "patient_id").checkpoint(eager=True)
    words = item_sets.dictionary(item_sets.items_of_history(held))
    sets = item_sets.sets_of(item_sets.items_of_history(held, "patient_id"), words, ["patient_id"])
    by = ["split", "is_ckd"]
    groups = item_sets.merged(sets.join(f.labels_split.select("patient_id", *by), "patient_id"), by)
    return item_sets.sizes(groups, words, by)


def q_patient_text(spark, d):
    r = aggregate.with_text(_fx(spark, d).rows)
    return r.select("patient_id", "diagnoses_str", "abnormal_labs_str", "patient_history")


def q_clinical_sentence(spark, d):
    r = aggregate.with_sentence(_fx(spark, d).rows)
    return r.select("patient_id", "formatted_history")


def q_group_split(spark, d):
    return _fx(spark, d).split.select("patient_id", "split")


def q_group_split_exact(spark, d):
    f = _fx(spark, d)
    return splits.exact_split(f.samples.select("patient_id"), "patient_id", f.cfg.seed)


def q_split_stats(spark, d):
    f = _fx(spark, d)
    return splits.split_stats(splits.hash_split(f.samples, "patient_id", f.cfg.seed, f.cfg.train_pct,
                                                f.cfg.train_val_pct))


def q_class_distribution(spark, d):
    return aggregate.class_distribution(_fx(spark, d).labels_split, "is_ckd", by="split")


def q_aggregate_summary(spark, d):
    s = aggregate.aggregate_summary(_fx(spark, d).labels_split)
    return s.withColumn("avg_visits", F.round("avg_visits", R))


def q_train_val_union(spark, d):
    pool = _fx(spark, d).labels_split.where(F.col("split").isin("train", "val"))
    return pool.select("patient_id", "split", F.col("is_ckd").alias("labels"))


def q_training_rows(spark, d):
    f = _fx(spark, d)
    rows = aggregate.with_sentence(f.rows_split)
    scope = F.when(F.col("split") == "test", F.lit("test")).otherwise(F.lit("cv"))
    return rows.select("patient_id", scope.alias("scope"), "formatted_history",
                       F.col("is_ckd").cast("int").alias("labels"))


def q_kfold(spark, d):
    return _fx(spark, d).folds


def q_kfold_sizes(spark, d):
    sizes = _fx(spark, d).folds.groupBy("fold").agg(F.count(F.lit(1)).alias("n_val"))
    every = Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return sizes.select("fold", (F.sum("n_val").over(every) - F.col("n_val")).alias("n_train"), "n_val")


def q_class_weights(spark, d):
    """Balanced weights on the training part of every fold. A fold's training part is the
    pool minus the fold, so its class counts are the pool's minus the fold's: one small
    (fold, label) count table serves all folds, and no row is copied."""
    f = _fx(spark, d)
    labelled = f.cv_labels_folded
    held = labelled.groupBy("fold", F.col("labels").alias("label")).agg(F.count(F.lit(1)).alias("_held"))
    totals = held.groupBy("label").agg(F.sum("_held").alias("_all"))
    # every (fold, label) pair, so a class absent from one fold still counts in its training part
    per = (totals.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(f.cfg.k_folds - 1))))
           .join(held, ["fold", "label"], "left"))
    counts = per.select("fold", "label", (F.col("_all") - F.coalesce("_held", F.lit(0))).alias("n_c")) \
        .where(F.col("n_c") > 0)
    return metrics.balanced_weights(counts, "fold").withColumn("weight", F.round("weight", R))


def q_roc_auc(spark, d):
    docs = labelled_docs(spark, d)
    m = metrics.ranking_metrics(docs.select(class_score("scores").alias("score"), "label"))
    return m.select(F.round("roc_auc", R).alias("roc_auc"), "positives", "negatives")


def q_pr_auc(spark, d):
    docs = labelled_docs(spark, d)
    m = metrics.ranking_metrics(docs.select(class_score("scores").alias("score"), "label"))
    return m.select(F.round("pr_auc", R).alias("pr_auc"), "positives", "negatives")


def q_pr_curve(spark, d):
    docs = labelled_docs(spark, d)
    c = metrics.curve_points(docs.select(class_score("scores").alias("score"), "label"))
    return c.select(*[F.round(x, R).alias(x) for x in ("threshold", "precision", "recall", "fpr", "tpr")])


def q_argmax_prediction(spark, d):
    docs = labelled_docs(spark, d)
    return docs.select("doc_id", argmax_class("scores").alias("prediction"),
                       class_score("scores").alias("score"))


def q_classification_metrics(spark, d):
    docs = labelled_docs(spark, d).select(argmax_class("scores").alias("prediction"), "label")
    m = metrics.threshold_metrics(docs)
    return m.select(*[F.round(x, R).alias(x) for x in ("accuracy", "precision", "recall", "f1")])


def q_metric_bundle(spark, d):
    m = metrics.metric_bundle(labelled_docs(spark, d))
    return m.select("metric", F.round("value", R).alias("value"))


def q_fold_metrics(spark, d):
    m = doc_fold_metrics(spark, d)
    return m.select("fold", "metric", F.round("value", R).alias("value"))


def q_cv_summary(spark, d):
    s = metrics.cv_summary(doc_fold_metrics(spark, d))
    return s.select("metric", F.round("mean", R).alias("mean"), F.round("std", R).alias("std"))


def q_best_fold(spark, d):
    b = metrics.best_fold(doc_fold_metrics(spark, d))
    return b.select("fold", F.round("value", R).alias("value"))


def q_metrics_report(spark, d):
    """The cross-validation report lines: avg_/std_ of every metric and the best ROC-AUC,
    each as 'name: value' with four decimals."""
    fm = doc_fold_metrics(spark, d).checkpoint(eager=True)  # six rows a fold, read three times
    s = metrics.cv_summary(fm)
    lines = (s.select(F.concat(F.lit("avg_"), "metric").alias("metric"), F.col("mean").alias("value"))
             .unionByName(s.select(F.concat(F.lit("std_"), "metric").alias("metric"), F.col("std").alias("value")))
             .unionByName(metrics.best_fold(fm).select(F.lit("best_roc_auc").alias("metric"), "value")))
    return metrics.metrics_report(lines).select("metric", "text")


def q_encode_fixed_length(spark, d):
    """Vocabulary from the cross-validation pool's sentences; every row encoded to 512 ids."""
    # the training rows feed both the vocabulary and the encoding: materialise them once
    tr = text.with_row_id(_fx(spark, d).training)
    vocab = text.build_vocabulary(tr.where(F.col("scope") == "cv"))
    enc = text.encode_fixed_length(tr, vocab)
    return enc.select("patient_id", "scope", "labels", F.array_join("input_ids", ",").alias("input_ids"),
                      F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_tokens"))


def q_encode_repeated_keys(spark, d):
    """Rows whose key repeats or is null, each encoded by itself; ``row`` tells them apart."""
    tr = _fx(spark, d).training.select(
        F.when(F.col("patient_id") % 7 != 0, F.floor(F.col("patient_id") / 4)).alias("patient_id"), "scope", "text", "labels",
        F.col("patient_id").alias("row"))
    rows = text.with_row_id(tr)
    enc = text.encode_fixed_length(rows, text.build_vocabulary(rows.where(F.col("scope") == "cv")), max_length=64)
    return enc.select("row", "patient_id", "labels", F.array_join("input_ids", ",").alias("input_ids"))


def q_fold_datasets(spark, d):
    """The encoded training and validation set of every fold. Rows are encoded once, with the
    vocabulary of the pool; a fold's sets are the same rows under another role."""
    f = _fx(spark, d)
    pool = text.with_row_id(f.training_folded)
    enc = text.encode_fixed_length(pool, text.build_vocabulary(pool)).select(
        "patient_id", "labels", "fold", F.array_join("input_ids", ",").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_tokens"))
    runs = enc.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(f.cfg.k_folds - 1))))
    role = F.when(F.col("fold") == F.col("run"), F.lit("val")).otherwise(F.lit("train"))
    return runs.select("run", role.alias("role"), "patient_id", "labels", "input_ids", "n_tokens")


def q_event_samples(spark, d):
    """The same sequence operator on the click stream: user = entity, event = episode,
    target = a purchase as the next event."""
    adm, codes_ = event_inputs(spark, d)
    flags = codes_.groupBy("hadm_id").agg(
        F.coalesce(F.max((F.col("ccsr_code") == "purchase").cast("int")), F.lit(0)).alias("has_target"))
    v = adm.join(flags, "hadm_id", "left").withColumn("has_target", F.coalesce("has_target", F.lit(0)))
    users = adm.select("subject_id").distinct().select(
        "subject_id", F.lit(0).alias("anchor_age"), F.lit("U").alias("gender"))
    tl = samples.timeline(v, users)
    return samples.samples(tl).select(F.col("patient_id").alias("user_id"), F.col("hadm_id").alias("event_id"),
                                      "history_len", F.col("next_hadm_id").alias("next_event_id"), "next_ckd")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
