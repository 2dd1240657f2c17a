"""Per-entity sequences: order, cohort rule, next-event label, censoring, history samples.

The clinical loop ("for each patient, for each visit in time order, find the next strictly
later visit, emit a sample, stop after the first positive") becomes a set-based plan,
``sequence``, with two physical paths chosen per entity:

* **window path** (every entity with at most ``hot_threshold`` visits): one hash shuffle on
  the entity id, then windows over that partitioning. ``row_number`` gives the order;
  ``lead`` gives the successor of the last visit of each tie group (visits sharing a
  time), and a window over (entity, time) hands it to the whole group; entity-wide
  facts (visit count, first time, first visit's flag, first positive sample, last sample)
  are whole-partition window aggregates. Every window reuses the one shuffle.
* **position path** (hot entities only): rows get their position in the global order
  (entity, time nulls last, visit id) from ``ranking.with_global_position``, which
  range-partitions, so one entity's visits are spread over many tasks. The successor of
  a tie group is the row just after the group's last position (an equi-join on a unique
  position, once per group), handed to the group's visits through keys of bounded size;
  entity facts are a ``groupBy`` with partial aggregation, broadcast back when the
  counted number of hot entities allows it.

Hot entities are found with one partially aggregated count per entity; their number is
at most (visits / hot_threshold), and it is counted before the id list is broadcast.
Both paths return the same columns and are tested against each other.

Visit order: time ascending with null times last, then visit id (nulls last). A visit with
a null time is never "later" than another, so it neither has nor is a successor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import whole_days
from tidemark.operators.ranking import with_global_position

# An entity with more visits than this is routed to the position path, so no window
# partition (one task) ever holds more than this many rows.
HOT_THRESHOLD = 1_000_000
# Hot ids are broadcast when there are at most this many (8 bytes each); beyond it they
# are joined by shuffle. There can be at most visits / HOT_THRESHOLD of them.
MAX_BROADCAST_KEYS = 2_000_000
# Per-entity tables of the hot entities (facts, demographics: a few dozen bytes a row) are
# broadcast back to the hot entities' rows when there are at most this many hot ids;
# otherwise they are joined by shuffle and AQE splits the skewed partitions.
MAX_BROADCAST_ENTITIES = 200_000
# On the position path a tie group (visits of one entity sharing a time) hands its
# successor to its visits through a key that holds at most this many visits.
TIE_BUCKET_ROWS = 100_000

SEQUENCE_COLS = ("visit_index", "n_visits", "first_time", "first_has_target", "next_time",
                 "next_hadm_id", "next_label", "first_positive_index", "last_sample_index")


def visit_order():
    return (F.col("subject_id").asc(), F.col("admittime").asc_nulls_last(),
            F.col("hadm_id").asc_nulls_last())


def has_next() -> F.Column:
    """Whether a visit has a successor. A successor has a time by definition, but its visit id
    may be null, so the time tells, in both paths."""
    return F.col("next_time").isNotNull()


# --- position path -----------------------------------------------------------------------

def ordered_visits(visits: DataFrame, n_parts: int | None = None) -> DataFrame:
    """Add ``pos``: 0-based position in (entity, time nulls last, visit id) order."""
    return with_global_position(visits.where(F.col("subject_id").isNotNull()), visit_order(), "pos",
                                n_parts)


def tie_group_successors(ordered: DataFrame) -> DataFrame:
    """One row per tie group (visits of an entity sharing a non-null time): subject_id,
    admittime, _tie_first, _tie_last (its positions) and its successor next_time,
    next_hadm_id, next_label.

    A tie group occupies the positions [first, last]; its successor is the visit at
    last + 1 when that visit belongs to the same entity (it then has a later time, or a
    null one, which is no successor). Keys are unique on both sides of the join.
    """
    groups = (ordered.where(F.col("admittime").isNotNull())
              .groupBy("subject_id", "admittime")
              .agg(F.min("pos").alias("_tie_first"), F.max("pos").alias("_tie_last")))
    succ = ordered.select(
        F.col("pos").alias("_succ_pos"), F.col("subject_id").alias("_succ_subject"),
        F.col("admittime").alias("next_time"), F.col("hadm_id").alias("next_hadm_id"),
        F.col("has_target").alias("next_label"))
    cond = ((F.col("_succ_pos") == F.col("_tie_last") + 1)
            & (F.col("_succ_subject") == F.col("subject_id")) & F.col("next_time").isNotNull())
    return groups.join(succ, cond, "left").drop("_succ_pos", "_succ_subject")


def with_successor(ordered: DataFrame, groups: DataFrame | None = None,
                   bucket_rows: int = TIE_BUCKET_ROWS) -> DataFrame:
    """Add ``next_hadm_id``, ``next_label`` (the successor's ``has_target``) and
    ``next_time``: the first visit with a strictly later time, ties broken by visit id.

    Each tie group's successor (``tie_group_successors``) is handed to the group's visits
    on (entity, time, pos div ``bucket_rows``): the group's row is repeated once per
    bucket it spans, so no join key holds more than ``bucket_rows`` visits, however large
    the tie group.
    """
    b = F.lit(bucket_rows)
    groups = tie_group_successors(ordered) if groups is None else groups
    per_bucket = groups.select(
        "subject_id", "admittime", "next_time", "next_hadm_id", "next_label",
        F.explode(F.sequence(F.floor(F.col("_tie_first") / b), F.floor(F.col("_tie_last") / b))).alias("_bucket"))
    keyed = ordered.withColumn("_bucket", F.floor(F.col("pos") / b))
    return keyed.join(per_bucket, ["subject_id", "admittime", "_bucket"], "left").drop("_bucket")


def entity_facts(ordered: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per entity: first_pos, n_visits, first_time, first_has_target,
    first_positive_pos (first sample whose next visit has the target) and last_sample_pos.

    Visits of a tie group share their successor, so the first positive sample is the first
    position of the first tie group whose successor has the target, and the last sample is
    the last position of the last tie group with a successor: both come from the
    one-row-per-group table. Both aggregations are partial before their shuffle.
    """
    visits = ordered.groupBy("subject_id").agg(
        F.min("pos").alias("first_pos"),
        F.count(F.lit(1)).alias("n_visits"),
        F.min("admittime").alias("first_time"),
        F.min_by("has_target", "pos").alias("first_has_target"))
    samples_ = groups.where(has_next()).groupBy("subject_id").agg(
        F.min(F.when(F.col("next_label") == 1, F.col("_tie_first"))).alias("first_positive_pos"),
        F.max("_tie_last").alias("last_sample_pos"))
    return visits.join(samples_, "subject_id", "left")


def _small(df: DataFrame, n_entities: int | None) -> DataFrame:
    """Mark a per-entity table of the hot entities for broadcast when their counted number
    is within MAX_BROADCAST_ENTITIES (an entity's rows all share one key there)."""
    return F.broadcast(df) if n_entities is not None and n_entities <= MAX_BROADCAST_ENTITIES else df


def _sequence_by_position(visits: DataFrame, n_parts: int | None = None,
                          n_entities: int | None = None) -> DataFrame:
    ordered = ordered_visits(visits, n_parts)
    groups = tie_group_successors(ordered)
    with_next = with_successor(ordered, groups)
    facts = entity_facts(ordered, groups)
    rel = lambda c: (F.col(c) - F.col("first_pos")).cast("int")
    return (with_next.join(_small(facts, n_entities), "subject_id")
            .withColumn("visit_index", rel("pos"))
            .withColumn("first_positive_index", rel("first_positive_pos"))
            .withColumn("last_sample_index", rel("last_sample_pos"))
            .drop("pos", "first_pos", "first_positive_pos", "last_sample_pos"))


# --- window path -------------------------------------------------------------------------

def _sequence_by_window(visits: DataFrame) -> DataFrame:
    order = Window.partitionBy("subject_id").orderBy(F.col("admittime").asc_nulls_last(),
                                                     F.col("hadm_id").asc_nulls_last())
    tie_group = Window.partitionBy("subject_id", "admittime")
    whole = Window.partitionBy("subject_id")
    nxt = F.lead(F.struct(F.col("admittime").alias("t"), F.col("hadm_id").alias("h"),
                          F.col("has_target").alias("y"))).over(order)
    step1 = visits.where(F.col("subject_id").isNotNull()).select(
        "*", (F.row_number().over(order) - 1).cast("int").alias("visit_index"), nxt.alias("_lead"))
    # only the last visit of a tie group sees a strictly later time in its lead; the
    # window over (entity, time) gives that successor to every visit of the group
    own = F.when(F.col("admittime").isNotNull() & (F.col("_lead.t") > F.col("admittime")), F.col("_lead"))
    step2 = step1.withColumn("_succ", F.max(own).over(tie_group)).drop("_lead")
    is_sample = F.col("_succ").isNotNull()
    step3 = step2.select(
        "*",
        F.count(F.lit(1)).over(whole).alias("n_visits"),
        F.min("admittime").over(whole).alias("first_time"),
        F.max(F.when(F.col("visit_index") == 0, F.col("has_target"))).over(whole).alias("first_has_target"),
        F.min(F.when(is_sample & (F.col("_succ.y") == 1), F.col("visit_index"))).over(whole)
         .alias("first_positive_index"),
        F.max(F.when(is_sample, F.col("visit_index"))).over(whole).alias("last_sample_index"))
    return (step3.withColumn("next_time", F.col("_succ.t")).withColumn("next_hadm_id", F.col("_succ.h"))
            .withColumn("next_label", F.col("_succ.y")).drop("_succ"))


# --- routing -----------------------------------------------------------------------------

def hot_entities(visits: DataFrame, threshold: int = HOT_THRESHOLD) -> DataFrame:
    """Entity ids with more than ``threshold`` visits (partial aggregation: each task
    ships one count per entity it saw)."""
    return (visits.where(F.col("subject_id").isNotNull()).groupBy("subject_id")
            .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > threshold).select("subject_id"))


def _routed(visits: DataFrame, threshold: int, force: str | None):
    """(normal visits, hot visits or None, hot ids or None, number of hot ids or None)."""
    if force == "window":
        return visits, None, None, None
    if force == "position":
        return None, visits, None, None
    hot = hot_entities(visits.select("subject_id"), threshold)
    n_hot = hot.count()  # proves the size of what is broadcast below
    if n_hot == 0:
        return visits, None, None, 0
    keys = F.broadcast(hot) if n_hot <= MAX_BROADCAST_KEYS else hot
    return (visits.join(keys, "subject_id", "left_anti"), visits.join(keys, "subject_id", "left_semi"),
            keys, n_hot)


def sequence(visits: DataFrame, threshold: int = HOT_THRESHOLD, force: str | None = None,
             n_parts: int | None = None) -> DataFrame:
    """Every visit with its order and successor, and its entity's facts.

    ``visits`` needs subject_id, hadm_id, admittime, has_target (other columns ride along).
    Adds: visit_index, n_visits, first_time, first_has_target, next_time, next_hadm_id,
    next_label, first_positive_index, last_sample_index. ``force`` ('window' | 'position')
    bypasses the routing (tests).
    """
    normal, hot, _, n_hot = _routed(visits, threshold, force)
    parts = []
    if normal is not None:
        parts.append(_sequence_by_window(normal))
    if hot is not None:
        parts.append(_sequence_by_position(hot, n_parts, n_hot))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- cohort, timeline, samples -------------------------------------------------------------

def demographics(patients: DataFrame) -> DataFrame:
    """One row per entity. With duplicated rows the smallest (age, gender) is taken,
    a deterministic stand-in for "first row of the file"."""
    return (patients.where(F.col("subject_id").isNotNull())
            .groupBy("subject_id")
            .agg(F.min(F.struct("anchor_age", "gender")).alias("_d"))
            .select("subject_id", F.col("_d.anchor_age").alias("age"), F.col("_d.gender").alias("gender")))


def in_cohort() -> F.Column:
    """At least two visits and no target code in the first one."""
    return (F.col("n_visits") >= 2) & (F.col("first_has_target") == 0)


def cohort(seq: DataFrame, patients: DataFrame) -> DataFrame:
    """Entities listed in ``patients`` that pass the rule, with n_visits and demographics."""
    first = seq.where((F.col("visit_index") == 0) & in_cohort()).select("subject_id", "n_visits")
    return first.join(demographics(patients), "subject_id")


def cohort_attrition(seq: DataFrame, patients: DataFrame) -> DataFrame:
    """all_patients (distinct ids in ``patients``) and valid_patients (the cohort)."""
    ids = patients.where(F.col("subject_id").isNotNull()).select("subject_id").distinct()
    firsts = seq.where(F.col("visit_index") == 0).select("subject_id", in_cohort().alias("_ok"))
    flagged = ids.join(firsts, "subject_id", "left")
    return flagged.agg(F.count(F.lit(1)).alias("all_patients"),
                       F.count_if(F.coalesce("_ok", F.lit(False))).alias("valid_patients"))


def _finish(seq: DataFrame, demo: DataFrame) -> DataFrame:
    cut = F.coalesce(F.col("first_positive_index"), F.col("last_sample_index"))
    is_sample = has_next()
    # Samples are a prefix of the visit order (a visit before a sample has a time no later
    # than the sample's, so it has a strictly later visit too), and censoring cuts that
    # prefix at ``cut``: the entity keeps cut + 1 samples, and as many history visits.
    return (seq.where(in_cohort()).join(demo, "subject_id")
            .withColumn("days_since_first", whole_days("first_time", "admittime"))
            .withColumn("next_ckd", F.col("next_label").cast("int"))
            .withColumn("is_sample", is_sample)
            .withColumn("kept", is_sample & (F.col("visit_index") <= cut))
            .withColumn("in_history", F.coalesce(F.col("visit_index") <= cut, F.lit(False)))
            .withColumn("n_kept", F.coalesce(cut + 1, F.lit(0)))
            .withColumnRenamed("first_positive_index", "positive_index")
            .drop("next_label", "first_has_target", "last_sample_index"))


def timeline(visits: DataFrame, patients: DataFrame, threshold: int = HOT_THRESHOLD,
             force: str | None = None, n_parts: int | None = None) -> DataFrame:
    """All visits of cohort entities, in order, with sample and censoring columns.

    Output adds to ``visits``: visit_index, n_visits, first_time, days_since_first,
    next_time, next_hadm_id, next_ckd, is_sample, kept (a sample that survives censoring),
    in_history (inside the history of the entity's last kept sample), n_kept (the
    entity's number of kept samples, equal to its number of history visits), positive_index
    (the entity's sample whose next visit has the target, null without one), age, gender.

    Demographics are joined per path: on the window path both sides are already
    partitioned by the entity id, and on the position path the hot entities' demographics
    are at most the (counted) hot-id list.
    """
    normal, hot, keys, n_hot = _routed(visits, threshold, force)
    demo = demographics(patients)
    parts = []
    if normal is not None:
        parts.append(_finish(_sequence_by_window(normal), demo))
    if hot is not None:
        hot_demo = _small(demo.join(keys, "subject_id", "left_semi"), n_hot) if keys is not None else demo
        parts.append(_finish(_sequence_by_position(hot, n_parts, n_hot), hot_demo))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def attach_details(tl: DataFrame, diagnoses: DataFrame, abnormal_labs: DataFrame) -> DataFrame:
    """The history visits of a narrow timeline with their lists: ``diagnoses`` (hadm_id,
    diagnoses) and ``abnormal_labs`` (hadm_id, abnormal_labs) are one row per visit, joined
    on the unique visit id; a visit missing from a list table gets an empty list. Both
    list tables are already partitioned by the visit id (they are its aggregates), so only
    the history visits are shuffled for these joins."""
    empty = F.array().cast("array<string>")
    return (tl.where("in_history")
            .join(diagnoses.select("hadm_id", "diagnoses"), "hadm_id", "left")
            .join(abnormal_labs.select("hadm_id", "abnormal_labs"), "hadm_id", "left")
            .withColumn("diagnoses", F.coalesce("diagnoses", empty))
            .withColumn("abnormal_labs", F.coalesce("abnormal_labs", empty)))


def samples(tl: DataFrame) -> DataFrame:
    """One row per kept sample: patient_id, sample visit, history length, label, demographics."""
    return tl.where("kept").select(
        F.col("subject_id").alias("patient_id"), "hadm_id", "visit_index",
        (F.col("visit_index") + 1).alias("history_len"), "age", "gender", "next_hadm_id", "next_ckd")


VISIT_STRUCT = ("diagnoses", "abnormal_labs", "length_of_stay", "days_since_first")


def flattened(history: DataFrame) -> DataFrame:
    """One row per (kept sample, visit of its history): patient_id, sample_index, age, gender
    and next_ckd of the sample, then the visit's hadm_id, visit_index and ``VISIT_STRUCT``.

    A visit belongs to the samples from its own index up to the entity's last kept one, so
    each visit repeats itself: no shuffle and no window, and a hot entity stays spread.
    ``history`` is ``attach_details`` output.
    """
    sample = F.explode(F.sequence("visit_index", F.col("n_kept").cast("int") - 1)).alias("sample_index")
    rows = history.where(F.col("in_history") & (F.col("visit_index") < F.col("n_kept")))
    label = F.coalesce(F.col("sample_index") == F.col("positive_index"), F.lit(False)).cast("int")
    return (rows.select(F.col("subject_id").alias("patient_id"), sample, "age", "gender", "positive_index",
                        "hadm_id", "visit_index", *VISIT_STRUCT)
            .withColumn("next_ckd", label)
            .select("patient_id", "sample_index", "age", "gender", "next_ckd", "hadm_id", "visit_index", *VISIT_STRUCT))


def nested_samples(history: DataFrame) -> DataFrame:
    """The reference's sample record: ``history`` is the array of every visit up to and
    including the sample's visit (patient_id, visit_index of the sample, history, age,
    gender, next_ckd).

    Quadratic in visits per entity by definition (each sample repeats its prefix). A group
    is one sample, never one entity. Downstream aggregation does not need this form (see
    ``aggregate.patient_rows``).
    """
    visit = F.struct("visit_index", *VISIT_STRUCT)
    grouped = flattened(history).groupBy("patient_id", "sample_index").agg(
        F.array_sort(F.collect_list(visit)).alias("_h"), F.min("age").alias("age"),
        F.min("gender").alias("gender"), F.max("next_ckd").alias("next_ckd"))
    fields = F.transform("_h", lambda v: F.struct(*[v[c].alias(c) for c in VISIT_STRUCT]))
    return grouped.select("patient_id", F.col("sample_index").alias("visit_index"), fields.alias("history"),
                          "age", "gender", "next_ckd")
