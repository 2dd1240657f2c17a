"""Sets on bitmaps against Python sets and the roll-up by strings; every way of meeting the dictionary."""

import random

import pytest

from conftest import SF0001
from tidemark.operators import aggregate, item_sets
from tidemark.plans.catalog import Fixture

ITEMS = "g string, id long, kind string, item string"


def _rows(seed=0):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), 1 if rng.random() < 0.4 else rng.randint(2, 30), rng.choice(["dx", "lab"]), f"i{rng.randint(0, 400)}")
            for _ in range(4000)]
    rows += [("a", 5, "dx", "hot")] * 2000 + [("a", i, "dx", "hot") for i in range(2, 20)]  # a third of all rows
    rows += [("b", 50, "dx", None), (None, None, "dx", "lost"), ("b", 51, "dx", ""), ("b", 51, "lab", "é|ü")]
    return rows


def _expected(rows):
    out = {}
    for _, key, kind, item in rows:
        if key is not None and item is not None:
            out.setdefault(key, {"dx": set(), "lab": set()})[kind].add(item)
    return {k: (sorted(v["dx"]), sorted(v["lab"])) for k, v in out.items()}


def _lists(sets, words):
    got = item_sets.lists_of(sets, words, "id", {"dx": "dxs", "lab": "labs"})
    return {r["id"]: (r["dxs"], r["labs"]) for r in got.collect()}


@pytest.mark.parametrize("way", ["broadcast", "hot and cold", "shuffle"])
def test_sets_equal_python_sets(spark, monkeypatch, way):
    if way != "broadcast":
        monkeypatch.setattr(item_sets, "BROADCAST_ITEMS", 0)
        monkeypatch.setattr(item_sets, "HOT_ITEMS", 5)
        monkeypatch.setattr(item_sets, "BROADCAST_BYTES", 1000 if way == "hot and cold" else 0)
    rows = _rows()
    df = spark.createDataFrame(rows, ITEMS)
    words = item_sets.dictionary(df)
    ids = sorted((r["item_id"], r["kind"], r["item"]) for r in words.table.collect())
    assert [i for i, _, _ in ids] == list(range(words.n_items)) and ids[0][1:] == ("dx", "hot")
    assert words.n_items == len({(k, i) for _, _, k, i in rows if i is not None})
    assert _lists(item_sets.sets_of(df, words, ["id"]), words) == _expected(rows)


def test_merged_sets_sizes_and_overlaps(spark):
    rows = _rows(1)
    df = spark.createDataFrame(rows, ITEMS)
    words = item_sets.dictionary(df)
    each = item_sets.sets_of(df, words, ["g", "id"])
    groups = item_sets.merged(each, ["g"])
    held = {(g, kind): {i for a, key, k, i in rows if (a, k) == (g, kind) and None not in (i, key)} for g in "ab" for kind in ("dx", "lab")}
    assert {(r["g"], r["kind"]): r["n"] for r in item_sets.sizes(groups, words, ["g"]).collect()} == {k: len(v) for k, v in held.items()}
    shared = item_sets.overlaps(groups.where("g = 'a'"), groups.where("g = 'b'")).first()["n_shared"]
    assert shared == sum(len(held["a", k] & held["b", k]) for k in ("dx", "lab"))


def test_empty_tables(spark):
    df = spark.createDataFrame([], ITEMS)
    words = item_sets.dictionary(df)
    sets = item_sets.sets_of(df, words, ["id"])
    assert words.n_items == 0 and _lists(sets, words) == {} and item_sets.sizes(sets, words, ["id"]).count() == 0
    assert item_sets.overlaps(sets, sets).first()["n_shared"] == 0


def test_roll_up_equals_the_one_by_strings(spark):
    hist = Fixture(spark, SF0001).history.checkpoint(eager=True)
    cols = ["patient_id", "age", "gender", "is_ckd", "num_visits", "num_samples", "num_distinct_visits", "diagnoses", "abnormal_labs"]
    got, want = (f(hist).select(*cols) for f in (item_sets.patient_rows_by_sets, aggregate.patient_rows))
    assert got.count() == want.count() == 122
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_strings_do_not_cross_the_list_shuffle(spark):
    rows = spark.createDataFrame(_rows(2), ITEMS)
    words = item_sets.dictionary(rows)
    sets = item_sets.sets_of(rows, words, ["id"]).checkpoint(eager=True)
    plan = item_sets.lists_of(sets, words, "id", {"dx": "dxs", "lab": "labs"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id") == 1, plan
    assert "EvalPython" not in plan
