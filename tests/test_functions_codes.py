"""Scalar expressions, crosswalk, titles, lab flags."""

import datetime as dt

import duckdb
from pyspark.sql import functions as F

from tidemark.functions.exprs import (argmax_class, fractional_days, not_equal_null_safe, seeded_bucket,
                                      upper_in, whole_days)
from tidemark.functions.templates import clinical_sentence, history_text
from tidemark.operators import codes, labs


def test_whole_days_and_length_of_stay(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 2), dt.datetime(2020, 1, 3, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(whole_days("a", "b").alias("d"), F.round(fractional_days("a", "b"), 6).alias("los"),
                  whole_days("b", "a").alias("neg")).first()
    assert r["d"] == 1 and r["los"] == 1.958333 and r["neg"] == -2


def test_flags_and_null_safe(spark):
    df = spark.createDataFrame([("abnormal",), (None,), ("delta",), ("High",)], "flag string")
    assert [r[0] for r in df.select(upper_in("flag", ["ABNORMAL", "HIGH", "LOW", "CRITICAL"])).collect()] == [1, 0, 0, 1]
    c = spark.createDataFrame([(None,), ("Invalid",), ("X",)], "c string")
    assert c.where(not_equal_null_safe("c", "Invalid")).count() == 2


def test_argmax_ties_go_to_class_zero(spark):
    df = spark.createDataFrame([([1.0, 1.0],), ([0.2, 0.9],), ([0.7, 0.1],)], "s array<double>")
    assert [r[0] for r in df.select(argmax_class("s")).collect()] == [0, 1, 0]


def test_seeded_bucket_equals_duckdb(spark):
    ids = list(range(1, 300))
    got = {r[0]: r[1] for r in spark.createDataFrame([(i,) for i in ids], "id long")
           .select("id", seeded_bucket("id", 42)).collect()}
    con = duckdb.connect()
    want = dict(con.execute(
        "SELECT i, ('0x' || substr(md5(concat('42:', CAST(i AS VARCHAR))), 1, 8))::BIGINT % 100 "
        "FROM range(1, 300) t(i)").fetchall())
    assert got == want


def test_templates_empty_lists_and_gender(spark):
    df = spark.createDataFrame([(63, None, [], [], 3), (40, "M", ["a b", "c"], ["K"], 1)],
                               "age int, gender string, diagnoses array<string>, abnormal_labs array<string>, num_visits long")
    r = df.select(history_text().alias("h"), clinical_sentence().alias("s")).collect()
    assert r[0]["h"] == "diagnoses: ,  age:63 , gender:nan , number of visits:3"
    assert r[0]["s"] == "The patient is a 63 years old female. Diagnoses include none. Abnormal lab tests include none."
    assert r[1]["s"] == "The patient is a 40 years old male. Diagnoses include a b, c. Abnormal lab tests include K."
    assert r[1]["h"] == "diagnoses:a b c , K age:40 , gender:M , number of visits:1"


def test_crosswalk_versions(spark):
    dx = spark.createDataFrame(
        [(1, "0010", 9), (1, "A01", 10), (2, "0010", None), (2, "0010", 11), (3, "999", 9), (3, "B99", 10)],
        "hadm_id long, icd_code string, icd_version int")
    x9 = spark.createDataFrame([("0010", "A01"), ("0010", "A02")], "icd9 string, icd10 string")
    x10 = spark.createDataFrame([("A01", "INF001")], "icd10 string, ccsr string")
    got = sorted(repr((r["icd_code"], r["icd_version"], r["ccsr_code"])) for r in codes.map_codes(dx, x9, x10).collect())
    want = [("0010", 9, "INF001"), ("A01", 10, "INF001"), ("0010", None, "Invalid"),
            ("0010", 11, "Invalid"), ("999", 9, None), ("B99", 10, None)]
    assert got == sorted(repr(w) for w in want)
    stats = codes.mapping_stats(codes.map_codes(dx, x9, x10)).first()
    assert (stats["total_codes"], stats["valid_mappings"], stats["failed_mappings"]) == (6, 4, 2)


def test_title_join_fans_out_on_code_only(spark):
    dx = spark.createDataFrame([(1, "100", 9), (2, "200", 10)], "hadm_id long, icd_code string, icd_version int")
    titles = spark.createDataFrame([("100", 9, "nine"), ("100", 10, "ten")],
                                   "icd_code string, icd_version int, long_title string")
    assert codes.add_titles(dx, titles).count() == 3
    assert codes.add_titles(dx, titles, on_version=True).count() == 2


def test_relevant_labs_exact_case_sensitive(spark):
    le = spark.createDataFrame([(1, 1, "HIGH"), (1, 2, None), (2, 3, "low")], "hadm_id long, itemid long, flag string")
    items = spark.createDataFrame([(1, "Creatinine"), (2, "creatinine"), (3, "BUN")], "itemid long, label string")
    got = labs.relevant_labs(le, items, ["Creatinine", "BUN"]).collect()
    assert sorted((r["itemid"], r["abnormal"]) for r in got) == [(1, 1), (3, 1)]
