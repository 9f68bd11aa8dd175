"""Cases whose result is defined and was not covered: files, splits, models and stored days."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadgrain.operators.evaluate import ablation, compare_models, dropped_keys, split
from loadgrain.plans.queries import QUERIES
from loadgrain.sources.csv_batches import read_batches
from loadgrain.sources.readings_store import read_readings, write_readings

SMALL = "/root/testdata/sf0.001"


def test_fine_fractions(spark):
    rows = split(spark.range(20_000).withColumnRenamed("id", "user"), ["user"], (0.99, 0.004, 0.006))
    counts = {r["set"]: r["count"] for r in rows.groupBy("set").count().collect()}
    assert counts["val"] == 75 and sum(counts.values()) == 20_000


def test_a_hundred_models_and_one_without_rows(spark):
    one = spark.range(30).select(F.col("id").alias("key"), F.lit(5.0).alias("actual"))
    models = spark.range(100).select(F.concat(F.lit("m"), F.lpad("id", 3, "0")).alias("model"), (F.col("id") / 10).alias("predicted"))
    preds = one.join(models, F.lit(True)).select("model", "key", "actual", "predicted")
    preds = preds.filter("not (model = 'm007' and key = 3)")
    names = [f"m{i:03}" for i in range(100)]
    found = {r["model"]: r for r in compare_models(preds, ["key"], names).collect()}
    assert len(found) == 100 and {r["n"] for r in found.values()} == {29}
    assert found["m050"]["rank"] == 1 and found["m050"]["rmse"] == 0
    assert {r["dropped"] for m, r in found.items() if m != "m007"} == {1} and found["m007"]["dropped"] == 0
    assert dropped_keys(preds, ["key"], names).count() == 99
    # no key is common to all once one model has none of the others'
    apart = preds.filter("model in ('m001', 'm002')").withColumn("key", F.when(F.col("model") == "m001", F.col("key")).otherwise(F.col("key") + 100))
    ranked = compare_models(apart, ["key"], ["m001", "m002"]).orderBy("rank").collect()
    assert [(r["model"], r["n"], r["rmse"], r["rank"]) for r in ranked] == [("m001", 0, None, 1), ("m002", 0, None, 2)]


def test_unknown_or_repeated_baseline(spark):
    results = spark.createDataFrame([("a", 1.0, 2.0, 0.5), ("b", 2.0, 3.0, 0.4), ("b", 2.0, 3.0, 0.4)], "variant string, mae double, rmse double, r2 double")
    assert ablation(results, "a").count() == 3
    for name, n in (("c", 0), ("b", 2)):
        with pytest.raises(Exception, match=f"rows of baseline {name}: {n}"):
            ablation(results, name).collect()


SCHEMA = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("power", T.DoubleType())])


def test_rejected_text_is_whole_and_two_headers_reject_a_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ts,power\n2024-01-02 00:15:00,5.5,9\n2024-01-02 00:30:00,1.0\n")
    (tmp_path / "b.csv").write_text("ts,power\n2024-01-01 00:00:00,1.0\npower,ts\n2.0,2024-01-01 00:15:00\n")
    rows, rejected = read_batches(spark, str(tmp_path), SCHEMA, r"([ab])\.csv$", ["file"])
    assert [(r["file"], r["power"]) for r in rows.collect()] == [("a", 1.0)]
    got = sorted((r["file"], r["reason"], r["raw"]) for r in rejected.collect())
    assert got == [
        ("a", "number of values", "2024-01-02 00:15:00,5.5,9"),
        ("b", "several headers", "2.0,2024-01-01 00:15:00"),
        ("b", "several headers", "2024-01-01 00:00:00,1.0"),
    ]


def test_stored_days_of_several_months(spark, tmp_path):
    start = datetime(2024, 2, 28, 12)
    rows = [(1, start + timedelta(days=i), float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, power double")
    write_readings(df, str(tmp_path / "store"), ["k"])
    write_readings(df.filter("power = 3").withColumn("power", F.lit(30.0)), str(tmp_path / "store"), ["k"])
    found = read_readings(spark, str(tmp_path / "store"), "2024-02-29", "2024-03-02").orderBy("ts").collect()
    assert [(str(r["day"]), r["power"]) for r in found] == [("2024-02-29", 1.0), ("2024-03-01", 2.0), ("2024-03-02", 30.0)]
    assert read_readings(spark, str(tmp_path / "store")).count() == 5


def test_stream_over_a_folder_of_files(spark, tmp_path):
    """The table of readings as a folder of three part files gives the rows of the single file."""
    rows = spark.read.parquet(f"{SMALL}/events.parquet")
    rows.repartition(3).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    assert sum(f.endswith(".parquet") for f in os.listdir(tmp_path / "sf" / "events.parquet")) == 3
    found = QUERIES["stream_readings"](spark, str(tmp_path / "sf"))
    assert found.count() == rows.count() == 1_000
