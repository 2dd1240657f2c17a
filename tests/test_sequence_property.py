"""Property test: both physical paths of the sequence operator equal a brute-force loop
over each entity (order by time nulls last then visit id; successor = first visit with a
strictly later time; cohort = at least two visits and no target in the first; samples stop
after the first positive)."""

import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import samples

T0 = dt.datetime(2020, 1, 1)

visit = st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 1))
# an entity: its visits, and which of them (if any) has no id
entities = st.lists(st.tuples(st.lists(visit, min_size=1, max_size=7), st.integers(0, 9)), min_size=1, max_size=4)


def _rows(ents):
    rows, hadm = [], 100
    for sid, (visits, nameless) in enumerate(ents, start=1):
        for i, (day, target) in enumerate(visits):
            hadm += 1
            rows.append((sid, None if i == nameless else hadm, None if day is None else T0 + dt.timedelta(days=day), target))
    return rows


def _brute(rows):
    out = Counter()
    for sid in sorted({r[0] for r in rows}):
        vs = sorted((r for r in rows if r[0] == sid),
                    key=lambda r: (r[2] is None, r[2] or T0, r[1] is None, r[1] or 0))
        if len(vs) < 2 or vs[0][3] == 1:
            continue
        for v in vs:
            if v[2] is None:
                continue
            later = [w for w in vs if w[2] is not None and w[2] > v[2]]
            if not later:
                continue
            nxt = min(later, key=lambda w: (w[2], w[1] is None, w[1] or 0))
            out[sid, v[1], nxt[1], nxt[3]] += 1
            if nxt[3] == 1:
                break
    return out


@pytest.mark.parametrize("force,threshold", [("window", 1), ("position", 1), (None, 3)])
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ents=entities)
def test_paths_equal_brute_force(spark, force, threshold, ents):
    rows = _rows(ents)
    v = spark.createDataFrame(rows, "subject_id long, hadm_id long, admittime timestamp_ntz, has_target int")
    p = spark.createDataFrame([(s, "F", 40) for s in {r[0] for r in rows}],
                              "subject_id long, gender string, anchor_age int")
    tl = samples.timeline(v, p, threshold, force=force, n_parts=3)
    got = Counter((r["patient_id"], r["hadm_id"], r["next_hadm_id"], r["next_ckd"])
                  for r in samples.samples(tl).collect())
    assert got == _brute(rows)
