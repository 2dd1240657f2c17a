"""Per-entity ordering, successor, cohort rule and censoring on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tidemark.plans.catalog import Fixture

from tidemark.operators import samples
from tidemark.operators.ranking import with_global_position, with_prefix_sums

T = dt.datetime


def _visits(spark, rows):
    return spark.createDataFrame(
        rows, "subject_id long, hadm_id long, admittime timestamp_ntz, has_target int")


def _patients(spark, ids):
    return spark.createDataFrame([(i, "M" if i % 2 == 0 else "F", 50) for i in ids],
                                 "subject_id long, gender string, anchor_age int")


PATHS = ["window", "position", None]


@pytest.mark.parametrize("force", PATHS)
def test_tied_and_null_times(spark, force):
    v = _visits(spark, [
        (1, 10, T(2020, 1, 1), 0), (1, 11, T(2020, 1, 6), 0), (1, 12, T(2020, 1, 6), 0),
        (1, 13, T(2020, 1, 10), 0), (1, 15, None, 0)])
    nxt = {r["hadm_id"]: r["next_hadm_id"] for r in samples.sequence(v, force=force).collect()}
    assert nxt == {10: 11, 11: 13, 12: 13, 13: None, 15: None}
    tl = samples.timeline(v, _patients(spark, [1]), force=force)
    rows = {r["hadm_id"]: r for r in tl.collect()}
    assert rows[15]["visit_index"] == 4 and rows[15]["n_visits"] == 5
    assert not rows[15]["is_sample"] and not rows[13]["is_sample"]
    kept = sorted(r["hadm_id"] for r in tl.where("kept").collect())
    assert kept == [10, 11, 12]
    # history length of each sample: all visits up to and including it
    assert sorted((r["hadm_id"], r["visit_index"] + 1) for r in tl.where("kept").collect()) == [(10, 1), (11, 2), (12, 3)]


@pytest.mark.parametrize("force", PATHS)
def test_cohort_rule_and_censoring(spark, force):
    v = _visits(spark, [
        # entity 1: target in visit 3 -> samples 1, 2 kept (2 is positive), 3.. dropped
        (1, 1, T(2020, 1, 1), 0), (1, 2, T(2020, 2, 1), 0), (1, 3, T(2020, 3, 1), 1),
        (1, 4, T(2020, 4, 1), 0), (1, 5, T(2020, 5, 1), 1),
        # entity 2: target in the first visit -> excluded
        (2, 6, T(2020, 1, 1), 1), (2, 7, T(2020, 2, 1), 0),
        # entity 3: one visit -> excluded
        (3, 8, T(2020, 1, 1), 0),
        # entity 4: not in patients -> excluded
        (4, 9, T(2020, 1, 1), 0), (4, 10, T(2020, 2, 1), 0)])
    tl = samples.timeline(v, _patients(spark, [1, 2, 3]), force=force)
    s = samples.samples(tl).collect()
    assert sorted((r["hadm_id"], r["next_ckd"]) for r in s) == [(1, 0), (2, 1)]
    assert {r["patient_id"] for r in s} == {1}
    hist = sorted(r["hadm_id"] for r in tl.where("in_history").collect())
    assert hist == [1, 2]


def test_days_since_first_whole_days(spark):
    v = _visits(spark, [(1, 1, T(2020, 1, 1, 2), 0), (1, 2, T(2020, 1, 3, 1), 0), (1, 3, T(2020, 1, 9), 0)])
    tl = samples.timeline(v, _patients(spark, [1]))
    d = {r["hadm_id"]: r["days_since_first"] for r in tl.collect()}
    assert d[2] == 1 and d[1] == 0 and d[3] == 7


def test_duplicate_patient_rows_pick_one(spark):
    v = _visits(spark, [(1, 1, T(2020, 1, 1), 0), (1, 2, T(2020, 2, 1), 0)])
    p = spark.createDataFrame([(1, "F", 60), (1, "M", 40)], "subject_id long, gender string, anchor_age int")
    s = samples.samples(samples.timeline(v, p)).collect()
    assert len(s) == 1 and (s[0]["age"], s[0]["gender"]) == (40, "M")


def test_hot_entity_is_split_across_partitions(spark):
    """One entity with most of the rows: positions stay exact and the entity spans many
    range partitions (no single task holds it)."""
    hot = [(1, i, T(2020, 1, 1) + dt.timedelta(hours=i), 0) for i in range(3000)]
    cold = [(k, 10000 + k, T(2021, 1, 1), 0) for k in range(2, 200)]
    v = _visits(spark, hot + cold)
    o = samples.ordered_visits(v, n_parts=16)
    per_part = (o.where("subject_id = 1").select(F.spark_partition_id().alias("p")).distinct().count())
    assert per_part >= 8
    pos = {r["hadm_id"]: r["pos"] for r in o.where("subject_id = 1").collect()}
    assert all(pos[i] == i for i in range(3000))
    seq = samples.sequence(v, threshold=1000, n_parts=16)  # entity 1 is hot, the rest are not
    nxt = seq.where("subject_id = 1")
    assert nxt.where(F.col("next_hadm_id") != F.col("hadm_id") + 1).count() == 0
    assert nxt.where(F.col("next_hadm_id").isNull()).count() == 1  # the last visit
    assert seq.count() == 3000 + 198 and seq.where("visit_index = 0").count() == 199


def test_paths_agree_on_fixture(spark):
    """Window path, position path and the mixed routing give identical timelines."""
    fx = Fixture(spark, SF001)
    cols = ["subject_id", "hadm_id", "visit_index", "n_visits", "next_hadm_id", "next_ckd", "kept",
            "in_history", "n_kept", "days_since_first", "age", "gender"]
    win = samples.timeline(fx.visit_flags, fx.inputs.patients, force="window").select(*cols)
    pos = samples.timeline(fx.visit_flags, fx.inputs.patients, force="position").select(*cols)
    mixed = samples.timeline(fx.visit_flags, fx.inputs.patients, threshold=12).select(*cols)
    assert win.count() == pos.count() == mixed.count()
    assert win.exceptAll(pos).count() == 0 and pos.exceptAll(win).count() == 0
    assert win.exceptAll(mixed).count() == 0


def test_positions_independent_of_partition_count(spark):
    df = spark.range(0, 2000).select((F.col("id") * 7919 % 2003).alias("k"), F.lit(1).alias("one"))
    ref = None
    for n in (1, 4, 17):
        got = with_prefix_sums(df, [F.col("k").asc()], {"one": "cum"}, "pos", n_parts=n)
        rows = sorted((r["k"], r["pos"], r["cum"]) for r in got.collect())
        assert all(p == i and c == i + 1 for i, (_, p, c) in enumerate(rows))
        ref = ref or rows
        assert rows == ref


def test_global_position_empty_and_single(spark):
    empty = spark.createDataFrame([], "k long")
    assert with_global_position(empty, [F.col("k")], "pos", 4).count() == 0
    one = spark.createDataFrame([(5,)], "k long")
    assert with_global_position(one, [F.col("k")], "pos", 4).first()["pos"] == 0


def test_huge_tie_group_spans_buckets(spark):
    """A tie group larger than the bucket size still hands every visit the same successor."""
    tied = [(1, i, T(2020, 1, 1), 0) for i in range(250)]
    tail = [(1, 1000, T(2020, 1, 2), 1), (1, 1001, None, 0)]
    o = samples.ordered_visits(_visits(spark, tied + tail), n_parts=4)
    got = samples.with_successor(o, bucket_rows=16)
    nxt = {r["hadm_id"]: (r["next_hadm_id"], r["next_label"]) for r in got.collect()}
    assert all(nxt[i] == (1000, 1) for i in range(250))
    assert nxt[1000] == (None, None) and nxt[1001] == (None, None)
    assert got.count() == 252
