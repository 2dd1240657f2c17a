"""Per-patient roll-up: hand-made histories against a brute-force roll-up, the per-row
kept count, and independence from the shuffle partition count."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tidemark.operators import aggregate, samples
from tidemark.plans.catalog import Fixture

HIST = ("subject_id long, visit_index int, diagnoses array<string>, abnormal_labs array<string>, "
        "kept boolean, in_history boolean, next_ckd int, age int, gender string")


def _history(spark):
    rows = []
    # a hot patient: many visits, the same few items over and over, one null list
    for i in range(400):
        dx = None if i == 7 else [f"d{i % 3}", f"d{i % 3}", None]
        rows.append((1, i, dx, [f"l{i % 2}"], i < 399, True, 1 if i == 398 else 0, 70, "M"))
    # a patient with empty lists only
    rows.append((2, 0, [], [], True, True, 0, 30, "F"))
    rows.append((2, 1, [], [], False, True, None, 30, "F"))
    # a patient without any kept sample: not in the output
    rows.append((3, 0, ["x"], [], False, True, None, 40, "F"))
    # a visit outside the history is ignored
    rows.append((2, 2, ["late"], ["late"], False, False, None, 30, "F"))
    return spark.createDataFrame(rows, HIST)


def _brute(rows):
    out = {}
    for r in rows:
        if not r["in_history"]:
            continue
        p = out.setdefault(r["subject_id"], {"dx": set(), "lab": set(), "k": 0, "v": 0, "y": None,
                                             "age": r["age"], "gender": r["gender"]})
        p["dx"].update(x for x in (r["diagnoses"] or []) if x is not None)
        p["lab"].update(x for x in (r["abnormal_labs"] or []) if x is not None)
        p["v"] += 1
        if r["kept"]:
            p["k"] += 1
            p["y"] = max(p["y"] or 0, r["next_ckd"])
    return {pid: (p["age"], p["gender"], p["y"], sorted(p["dx"]), sorted(p["lab"]), p["k"], p["v"],
                  p["k"] * (p["k"] + 1) // 2)
            for pid, p in out.items() if p["k"] > 0}


def test_patient_rows_match_brute_force(spark):
    h = _history(spark)
    got = {r["patient_id"]: (r["age"], r["gender"], r["is_ckd"], r["diagnoses"], r["abnormal_labs"],
                             r["num_samples"], r["num_distinct_visits"], r["num_visits"])
           for r in aggregate.patient_rows(h).collect()}
    assert got == _brute(h.collect())
    assert got[1][5] == 399 and got[1][7] == 399 * 400 // 2 and got[2][3] == []


@pytest.mark.parametrize("force", ["window", "position"])
def test_n_kept_counts_samples_and_history(spark, force):
    fx = Fixture(spark, SF0001)
    tl = samples.timeline(fx.visit_flags, fx.inputs.patients, force=force)
    per = tl.groupBy("subject_id").agg(F.count_if("kept").alias("k"), F.count_if("in_history").alias("h"),
                                       F.min("n_kept").alias("lo"), F.max("n_kept").alias("hi"))
    bad = per.where((F.col("k") != F.col("lo")) | (F.col("lo") != F.col("hi")) | (F.col("h") != F.col("k")))
    assert bad.count() == 0
    assert per.agg(F.sum("k")).first()[0] == 495


def test_roll_up_independent_of_partition_count(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for n in (1, 17):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            rows = aggregate.patient_rows(Fixture(spark, SF0001).history)
            seen.append(sorted(tuple(r) for r in rows.select(
                "patient_id", "is_ckd", "num_visits", F.array_join("diagnoses", "|"),
                F.array_join("abnormal_labs", "|")).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] and len(seen[0]) == 122


def test_distinct_items_are_hashed_not_sorted(spark):
    """Demographics are texts too: in an aggregation buffer they would make every item row part of a sort."""
    plan = aggregate.patient_rows(_history(spark))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
