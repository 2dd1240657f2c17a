"""Membership filter: exact on wanted keys, few others, no shuffle of facts that leave."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tidemark.operators import membership, samples, visits
from tidemark.plans.catalog import Fixture


@pytest.mark.parametrize("n", [0, 1, 63, 5000])
def test_keeps_every_member_and_few_others(spark, n):
    rng = random.Random(n)
    wanted = rng.sample(range(10 ** 12), n)
    others = [x for x in rng.sample(range(10 ** 12), 20_000) if x not in set(wanted)]
    ids = spark.createDataFrame([(x,) for x in [*wanted, *wanted[:10], None]], "id long")
    facts = spark.createDataFrame([(x, "f") for x in [*wanted, *others, None]], "id long, _word string")  # a clashing name
    held = membership.members(ids, "id")
    kept = {r.id for r in held.keep(facts, "id").collect()}
    assert set(wanted) <= kept and None not in kept
    assert len(kept) - n <= 0.03 * len(others)
    assert held.words & (held.words - 1) == 0 and held.words * 64 >= membership.BITS_PER_KEY * n


def test_too_many_keys_make_no_filter(spark):
    held = membership.members(spark.range(100), "id", max_keys=50)
    assert held.table is None and held.keep(spark.range(200), "id").count() == 200


def test_string_keys(spark):
    held = membership.members(spark.createDataFrame([("a",), ("b",)], "k string"), "k")
    got = held.keep(spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("zz", 4)], "k string, n int"), "k")
    assert {1, 2, 3} <= {r.n for r in got.collect()}


def test_reduced_lists_equal_all_lists_and_shuffle_less(spark):
    f = Fixture(spark, SF0001)
    ids = f.timeline.where("in_history").select("hadm_id").checkpoint(eager=True)
    held = membership.members(ids, "hadm_id")
    dx, lab = visits.lists_of(held, f.mapped, f.labs)
    whole = samples.attach_details(f.timeline, f.diagnosis_lists, f.abnormal_lists)
    reduced = samples.attach_details(f.timeline, dx, lab)
    key = ("hadm_id", "diagnoses", "abnormal_labs")
    assert sorted(map(str, whole.select(*key).collect())) == sorted(map(str, reduced.select(*key).collect()))
    n_all, n_kept = f.mapped.count(), held.keep(f.mapped, "hadm_id").count()
    exact = f.mapped.join(ids, "hadm_id", "left_semi").count()
    assert exact <= n_kept <= exact + 0.03 * n_all and n_kept < n_all
    plan = dx._jdf.queryExecution().executedPlan().toString()
    # read bottom up: the filter's join stands below the first exchange of the facts
    assert "LeftSemi" in plan.split("Exchange hashpartitioning(hadm_id")[-1]


def test_no_python_in_the_filter(spark):
    held = membership.members(spark.range(10), "id")
    plan = held.keep(spark.range(100), "id").groupBy("id").agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "LeftSemi" in plan


@pytest.mark.parametrize("max_keys", [membership.MAX_KEYS, 0])
def test_without_is_an_exact_anti_join(spark, monkeypatch, max_keys):
    real = membership.members
    monkeypatch.setattr(membership, "members", lambda ids, key: real(ids, key, max_keys))
    facts = spark.createDataFrame([(x, f"t{x}") for x in [*range(3000), 5, 6, None, None]], "id long, text string")
    gone = spark.createDataFrame([(x,) for x in [*range(0, 3000, 7), 5, None]], "id long")
    left = membership.without(facts, gone, "id")
    want = sorted((x or -1, f"t{x}") for x in [*range(3000), 6, None, None] if x is None or (x % 7 and x != 5))
    assert left.columns == facts.columns and sorted((r.id if r.id is not None else -1, r.text) for r in left.collect()) == want


def test_rows_that_stay_are_not_shuffled(spark):
    facts = spark.range(20_000).selectExpr("id", "repeat('x', 500) as text").checkpoint(eager=True)
    gone = spark.range(0, 20_000, 100).checkpoint(eager=True)
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = membership.without(facts, gone, "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    staying, rest = plan.split("Union")[-1].split("SortMergeJoin")
    assert "LeftAnti, BuildRight" in staying and "Exchange hashpartitioning(id" not in staying
    assert "LeftSemi, BuildRight" in rest  # only rows that may leave reach the exchange
