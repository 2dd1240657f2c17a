"""Driver contract and physical-plan checks."""

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF0001
from tidemark.plans import catalog, oracle
from tidemark.sources.views import DRIVER_TABLES
from tools.compare import digest

KEYS = sorted(set(catalog.QUERIES) & set(oracle.oracle_sql()))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 495 and sum(r["next_ckd"] for r in rows) == 101
    assert df.columns == ["patient_id", "hadm_id", "visit_index", "history_len", "age", "gender",
                          "next_hadm_id", "next_ckd"]


def test_every_sql_key_is_a_query():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    assert {"train_classifier", "cross_validate", "evaluate_test"} <= set(q) - set(sql)


@pytest.mark.parametrize("name", KEYS)
def test_oracle_agrees_at_sf0001(spark, name):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    df = entry.queries()[name](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, rows) == digest(ocols, orows)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_core_plans(spark):
    for name in ["next_event_samples", "patient_aggregate", "encode_fixed_length", "pr_curve"]:
        p = _plan(entry.queries()[name](spark, SF0001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_filters_reach_the_scan(spark):
    p = _plan(entry.queries()["relevant_labs"](spark, SF0001))
    # the label filter runs on the lab-item (part) scan, before the join
    assert "PushedFilters: [In(p_type" in p or "PushedFilters: [IsNotNull(p_type), In(p_type" in p
    # only the needed lineitem columns are read
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_returnflag:string>" in p


def test_no_single_partition_exchange_on_data(spark):
    """What meets in one partition is a partial aggregate, or the few rows of a per-partition
    totals table: never data rows."""
    for name in ["next_event_samples", "roc_auc", "kfold", "metric_bundle", "aggregate_summary", "flatten_history"]:
        lines = _plan(entry.queries()[name](spark, SF0001)).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = next(x for x in lines[i + 1:] if "Exchange" in x or "HashAggregate" in x or "Scan" in x or "Join" in x)
                assert "HashAggregate" in below, (name, below)


def test_a_plain_global_window_would_be_caught(spark):
    lines = _plan(spark.range(10).withColumn("r", F.row_number().over(Window.orderBy("id")))).splitlines()
    at = next(i for i, line in enumerate(lines) if "Exchange SinglePartition" in line)
    assert "HashAggregate" not in lines[at + 1]


def test_metrics_report_reads_its_fold_table_once(spark):
    p = _plan(entry.queries()["metrics_report"](spark, SF0001))
    assert p.count("Exchange") < 10 and "parquet" not in p


def test_summary_builds_no_lists(spark):
    p = _plan(entry.queries()["aggregate_summary"](spark, SF0001))
    assert "collect_list" not in p and "collect_set" not in p and p.count("Scan parquet") <= 5


def test_timeline_is_computed_once(spark):
    """Plans built on the history compute the ordered timeline once: the ordering window
    appears a single time (no second branch re-deriving it for counts or facts)."""
    for name in ["patient_aggregate", "patient_text", "flatten_history", "aggregate_summary", "next_event_samples"]:
        p = _plan(entry.queries()[name](spark, SF0001))
        assert p.count("Window [row_number()") == 1, name
