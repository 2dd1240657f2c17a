"""Property test: the distributed exact metrics equal brute-force definitions on random
scores with many ties, for any number of range partitions.

ROC-AUC: the share of (positive, negative) pairs ranked correctly, a tie counting half.
PR-AUC: the trapezoid over (recall, precision) at each distinct threshold, descending,
starting from (0, 1)."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import metrics

rows = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 1)), min_size=0, max_size=40)


def _roc(rs):
    pos = [s for s, y in rs if y == 1]
    neg = [s for s, y in rs if y != 1]
    if not pos or not neg:
        return None
    good = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return good / (len(pos) * len(neg))


def _pr(rs):
    P = sum(y for _, y in rs)
    if P == 0:
        return None
    area, r0, p0 = 0.0, 0.0, 1.0
    for t in sorted({s for s, _ in rs}, reverse=True):
        tp = sum(1 for s, y in rs if s >= t and y == 1)
        fp = sum(1 for s, y in rs if s >= t and y != 1)
        r, p = tp / P, tp / (tp + fp)
        area += (r - r0) * (p + p0) / 2
        r0, p0 = r, p
    return area


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rs=rows, parts=st.integers(1, 5))
def test_ranking_metrics_equal_brute_force(spark, rs, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame([(float(s), y) for s, y in rs], "score double, label int")
        m = metrics.ranking_metrics(df).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for got, want in ((m["roc_auc"], _roc(rs)), (m["pr_auc"], _pr(rs))):
        assert (got is None and want is None) or got == pytest.approx(want)
