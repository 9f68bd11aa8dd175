from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadgrain.operators.ingest import coverage, merge_batches
from loadgrain.operators.intervals import overlap_pairs
from loadgrain.sources.csv_batches import read_batches
from loadgrain.sources.readings_store import read_readings, write_readings

# the name rule of the fixtures
PATTERN = r"(T\d+)_(U\d+)_(\d{8})\.csv$"
SCHEMA = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("power", T.DoubleType())])
FILES = {
    "T001_U9_20240101.csv": "ts,power\n2024-01-01 00:00:00,1.5\n2024-01-01 00:15:00,oops\n2024-01-02 00:00:00,3.5\n",
    "T001_U9_20240102.csv": "ts,power\n2024-01-02 00:00:00,4.5\n2024-01-02 00:15:00,5.5,9\n2024-01-02 00:30:00,\n",
    "T002_U9_20240101.csv": 'power,ts\n7.5,2024-01-01 00:00:00\n"8.5","2024-01-01 00:15:00"\n',
    "T002_U9_20240102.csv": "ts,power\n",
    "T003_U9_20240101.csv": "2024-01-01 00:00:00,1.0\n",
}


@pytest.fixture
def batches(spark, tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    return read_batches(spark, str(tmp_path), SCHEMA, PATTERN, ["terminal", "user", "day"])


def test_columns_go_by_header_and_name(batches):
    rows, _ = batches
    got = sorted((r["terminal"], r["user"], r["day"], str(r["ts"]), r["power"]) for r in rows.collect() if r["power"])
    assert got == [
        ("T001", "U9", "20240101", "2024-01-01 00:00:00", 1.5),
        ("T001", "U9", "20240101", "2024-01-02 00:00:00", 3.5),
        ("T001", "U9", "20240102", "2024-01-02 00:00:00", 4.5),
        ("T002", "U9", "20240101", "2024-01-01 00:00:00", 7.5),
        ("T002", "U9", "20240101", "2024-01-01 00:15:00", 8.5),
    ]
    assert rows.filter(F.col("power").isNull()).count() == 1


def test_bad_rows_are_kept_aside(batches):
    _, rejected = batches
    got = sorted((r["terminal"], r["reason"], r["raw"]) for r in rejected.collect())
    assert [(t, reason) for t, reason, _ in got] == [
        ("T001", "number of values"),
        ("T001", "value"),
        ("T003", "no header"),
    ]
    assert got[1][2] == "2024-01-01 00:15:00,oops"


def test_known_order_other_separator_and_byte_order_mark(spark, tmp_path):
    (tmp_path / "T001_U9_20240101.csv").write_text("\ufeffpower;ts\n7.5;2024-01-01 00:00:00\n")
    (tmp_path / "other.csv").write_text("power;ts\n8.5;2024-01-01 00:00:00\n")
    for order in (["power", "ts"], None):
        rows, rejected = read_batches(
            spark, str(tmp_path), SCHEMA, PATTERN, ["terminal", "user", "day"], column_order=order, options={"sep": ";"}
        )
        assert [(r["terminal"], r["power"]) for r in rows.collect()] == [("T001", 7.5)]
        assert [r["reason"] for r in rejected.collect()] == ["file name"]


def test_timestamp_format(spark, tmp_path):
    (tmp_path / "T001_U9_20240101.csv").write_text("ts,power\n2024/01/01 00:15,7.5\nsoon,1\n")
    args = (spark, str(tmp_path), SCHEMA, PATTERN, ["terminal", "user", "day"])
    rows, rejected = read_batches(*args, timestamp_format="yyyy/MM/dd HH:mm")
    assert [str(r["ts"]) for r in rows.collect()] == ["2024-01-01 00:15:00"]
    assert [r["raw"] for r in rejected.collect()] == ["soon,1"]


def test_overlapping_files_are_found_and_merged(batches):
    rows, _ = batches
    spans = coverage(rows, ["terminal", "source_file"])
    assert spans.count() == 3
    iv = spans.select("terminal", "source_file", "first_ts", (F.col("last_ts") + F.expr("INTERVAL 1 SECOND")).alias("end"))
    pairs = overlap_pairs(iv, ["terminal"], "source_file", "first_ts", "end").collect()
    assert [p["terminal"] for p in pairs] == ["T001"]

    merged, conflicts = merge_batches([rows], ["terminal"], F.col("day").cast("int"))
    assert merged.count() == rows.count() - 1
    kept = merged.filter("terminal = 'T001' AND ts = timestamp_ntz'2024-01-02 00:00:00'").first()
    assert kept["power"] == 4.5
    assert [(r["power"], r["copies"]) for r in conflicts.collect()] == [(3.5, 1)]


def test_merge_prefers_priority_then_file_and_counts_copies(spark):
    at = datetime(2024, 1, 1)
    schema = "k bigint, ts timestamp_ntz, power double, source_file string, priority int"
    first = spark.createDataFrame([(1, at, 1.0, "b.csv", 1), (1, at, 2.0, "a.csv", 1)] + [(2, at, 9.0, "a.csv", 1)] * 4, schema)
    second = spark.createDataFrame([(1, at, 3.0, None, None), (None, at, 5.0, "c.csv", 2)], schema)
    merged, conflicts = merge_batches([first, second], ["k"], F.col("priority"))
    assert sorted((r["k"] or 0, r["power"]) for r in merged.collect()) == [(0, 5.0), (1, 2.0), (2, 9.0)]
    assert sorted((r["k"], r["power"], r["copies"]) for r in conflicts.collect()) == [(1, 1.0, 1), (1, 3.0, 1), (2, 9.0, 3)]
    total = first.count() + second.count()
    assert merged.count() + conflicts.agg(F.sum("copies")).first()[0] == total


def test_store_replaces_only_the_days_written(spark, tmp_path):
    schema = "user_id bigint, ts timestamp_ntz, power double"
    path = str(tmp_path / "store")
    write_readings(
        spark.createDataFrame([(1, datetime(2024, 1, 1), 1.0), (1, datetime(2024, 1, 2), 2.0)], schema), path, ["user_id"]
    )
    write_readings(spark.createDataFrame([(1, datetime(2024, 1, 2, 3), 7.0)], schema), path, ["user_id"])
    assert sorted(r["power"] for r in read_readings(spark, path).collect()) == [1.0, 7.0]
    one_day = read_readings(spark, path, "2024-01-02", "2024-01-02")
    assert [r["power"] for r in one_day.collect()] == [7.0]
    plan = one_day._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
