"""Byte-range CSV reading against Python's csv module, with ranges of a few bytes."""

import csv
import io
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.sources import csv_ranges
from tidemark.sources.tables import SCHEMAS, read_table


@pytest.fixture()
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "67b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def open_after(line, inside):
    """The quoting state machine, character by character."""
    state = "in" if inside else "start"
    for c in line:
        if state == "in":
            state = "maybe" if c == '"' else "in"
        elif state == "maybe" and c == '"':
            state = "in"
        elif c == ",":
            state = "start"
        elif state == "start" and c == '"':
            state = "in"
        else:
            state = "plain"
    return state == "in"


def test_open_lines_equal_the_state_machine(spark):
    rng = random.Random(1)
    lines = ["".join(rng.choice('",,"ab') for _ in range(rng.randrange(12))) for _ in range(4000)]
    places, outside, inside = csv_ranges._quoted(pa.array(lines))
    for i, a, b in zip(places, outside, inside, strict=True):
        assert (a, b) == (open_after(lines[i], False), open_after(lines[i], True)), lines[i]
    assert all('"' not in lines[i] for i in set(range(len(lines))) - set(places))
    table = spark.createDataFrame([(x,) for x in lines], "line string")
    for r in table.select("line", csv_ranges.opens(F.col("line")).alias("o")).collect():
        assert r.o == open_after(r.line, False), r.line


def written(folder, rows, files=3, end="\n", seed=0):
    """CSV files with a header each; returns the rows as the csv module reads them back."""
    rng, back = random.Random(seed), []
    os.makedirs(folder)
    for f in range(files):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
        writer.writerow(["hadm_id", "itemid", "charttime", "flag"])
        for r in rows[f::files]:
            writer.writerow(r)
            if rng.random() < .05:
                out.write(end)  # a blank line
        text = out.getvalue()
        with open(f"{folder}/part-{f}.csv", "w", newline="") as sink:
            sink.write(text)
        back += [r for r in csv.reader(io.StringIO(text, newline="")) if r][1:]
    return sorted(tuple(x or None for x in r) for r in back)


def lab_rows(n, seed, broken=.4):
    rng = random.Random(seed)
    piece = lambda: rng.choice(["a", "bc", '"', '""', ",", "é", "\n", "\n\n", '",\n"', " x ", "long " * 20])
    flag = lambda: "".join(piece() for _ in range(rng.randrange(6))) if rng.random() < broken else rng.choice(["HIGH", "", "low"])
    return [(i, rng.randrange(5), "2020-01-01 00:00:00", flag()) for i in range(n)]


@pytest.mark.parametrize(("seed", "end"), [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_ranges_equal_the_csv_module(spark, tmp_out, small_ranges, seed, end):
    want = written(f"{tmp_out}/labevents.csv", lab_rows(150, seed), end=end, seed=seed)
    lines = csv_ranges.text_lines(spark, f"{tmp_out}/labevents.csv")
    states = csv_ranges.range_states(lines)
    assert states.count() > 60 and states.where("begins").count() > 5  # many ranges, some begin inside quotes
    got = read_table(spark, tmp_out, "labevents")
    assert got.schema == SCHEMAS["labevents"]
    rows = sorted((str(r.hadm_id), str(r.itemid), str(r.charttime), r.flag) for r in got.collect())
    assert rows == want


def test_one_field_over_many_ranges(spark, tmp_out, small_ranges):
    long = "\n".join(f"line {i}" for i in range(100))
    want = written(f"{tmp_out}/labevents.csv", [(1, 1, "2020-01-01 00:00:00", long), (2, 1, "2020-01-01 00:00:00", "x")], files=1)
    rows = read_table(spark, tmp_out, "labevents").collect()
    assert sorted(r.flag for r in rows) == sorted(w[3] for w in want) and long in [r.flag for r in rows]


def test_plain_files_take_the_native_reader(spark, tmp_out):
    written(f"{tmp_out}/labevents.csv", [(1, 2, "2020-01-01 00:00:00", 'say ""a"", b'), (2, 2, "2020-01-01 00:00:00", 'x"y')])
    table = read_table(spark, tmp_out, "labevents").select("hadm_id")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv [hadm_id" in plan and "ReadSchema: struct<hadm_id:string>" in plan and "MapInArrow" not in plan


def test_every_table_reads_line_breaks(spark, tmp_out, small_ranges):
    for name, schema in SCHEMAS.items():
        values = {"bigint": "7", "int": "9", "timestamp_ntz": "2020-01-02 03:04:05", "string": 'a\n"b",\nc'}
        os.makedirs(f"{tmp_out}/{name}.csv")
        with open(f"{tmp_out}/{name}.csv/a.csv", "w", newline="") as sink:
            writer = csv.writer(sink, lineterminator="\n")
            writer.writerow([*schema.names, "unused"])
            writer.writerows([[values[f.dataType.simpleString()] for f in schema.fields] + ["x\ny"]] * 20)
        rows = read_table(spark, tmp_out, name).collect()
        assert len(rows) == 20 and len(set(rows)) == 1
        assert all(getattr(rows[0], f.name) == values["string"] for f in schema.fields if f.dataType.simpleString() == "string")


def test_errors_name_the_file(spark, tmp_out):
    os.makedirs(f"{tmp_out}/a/labevents.csv")
    with open(f"{tmp_out}/a/labevents.csv/x.csv", "w") as sink:
        sink.write('hadm_id,itemid,charttime,flag\n1,2,2020-01-01 00:00:00,"never closed\n')
    with pytest.raises(ValueError, match="x.csv has no end"):
        read_table(spark, f"{tmp_out}/a", "labevents")
    os.makedirs(f"{tmp_out}/b/labevents.csv")
    for name, header in (("x", "hadm_id,itemid,charttime,flag"), ("y", "itemid,hadm_id,charttime,flag")):
        with open(f"{tmp_out}/b/labevents.csv/{name}.csv", "w") as sink:
            sink.write(f'{header}\n1,2,2020-01-01 00:00:00,"a\nb"\n')
    with pytest.raises(Exception, match="differs from that of other files"):
        read_table(spark, f"{tmp_out}/b", "labevents").collect()


def test_too_many_crossings_are_read_whole(spark, tmp_out, small_ranges, monkeypatch):
    want = written(f"{tmp_out}/labevents.csv", lab_rows(60, 4))
    monkeypatch.setattr(csv_ranges, "MAX_RANGES", 3)
    rows = read_table(spark, tmp_out, "labevents").collect()
    assert sorted(str(r.hadm_id) for r in rows) == sorted(w[0] for w in want)


def test_ranges_split_in_another_way_are_an_error(spark, tmp_out, small_ranges):
    written(f"{tmp_out}/labevents.csv", lab_rows(60, 5))
    table = read_table(spark, tmp_out, "labevents")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "91b")
    with pytest.raises(Exception, match="split in another way"):
        table.collect()
