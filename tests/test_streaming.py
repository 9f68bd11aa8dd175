from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from checks import spark_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadgrain.functions.columns import as_wall_clock
from loadgrain.operators.load import detect_events
from loadgrain.streaming.events import stream_events
from loadgrain.streaming.readings import run_available, stream_readings
from loadgrain.streaming.windows import stream_windows

START = datetime(2024, 1, 1)
SCHEMA = T.StructType(
    [
        T.StructField("k", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("tie", T.LongType()),
        T.StructField("power", T.DoubleType()),
    ]
)
COLUMNS = ["k", "ts", "p_before", "p_after", "step", "direction"]


@pytest.fixture
def files(spark, tmp_path):
    """Readings in six files; each file is shuffled and overlaps its neighbours by 20 minutes."""
    rng = random.Random(4)
    rows = [(i % 3 or None, START + timedelta(minutes=2 * i), i, round(rng.uniform(0, 300), 1)) for i in range(600)]
    rows[100] = (*rows[100][:3], None)
    shuffled = [[] for _ in range(6)]
    for row in rows:
        late = row[2] + rng.randrange(-10, 11)
        shuffled[min(5, max(0, late // 100))].append(row)
    for n, part in enumerate(shuffled):
        rng.shuffle(part)
        # one reading of every file is sent twice
        df = spark.createDataFrame([*part, part[0]], SCHEMA).coalesce(1)
        df.write.mode("append").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in"), rows


@pytest.mark.parametrize(("cell", "minutes"), [("1 minute", 1), ("1 hour", 60)])
def test_events_equal_batch_when_files_come_out_of_order(spark, files, cell, minutes):
    path, rows = files
    stream = stream_readings(spark, path, SCHEMA, ["k"], "1 hour", files_per_trigger=1)
    found = run_available(stream_events(stream, ["k"], 100.0, tie="tie", cell=cell), "test_events")
    batch = detect_events(spark.createDataFrame(rows, SCHEMA), ["k"], 100.0, tie=("tie",))
    # whole cells below the watermark
    closed = (max(r[1] for r in rows) - timedelta(hours=1) - START) // timedelta(minutes=minutes)
    until = START + closed * timedelta(minutes=minutes)
    want = batch.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz")).select(*COLUMNS)
    assert want.count() > 100
    assert spark_rows(found.withColumn("ts", as_wall_clock("ts")).select(*COLUMNS)) == spark_rows(want)


def test_repeated_readings_are_dropped(spark, files):
    path, rows = files
    stream = stream_readings(spark, path, SCHEMA, ["k"], "1 hour", files_per_trigger=2)
    done = run_available(stream, "test_readings")
    assert done.count() == len(rows)


@pytest.mark.parametrize("window", [{"size": "1 hour"}, {"size": "1 hour", "slide": "30 minutes"}, {"gap": "5 minutes"}])
def test_windows_close_with_the_watermark(spark, files, window):
    path, rows = files
    stream = stream_readings(spark, path, SCHEMA, ["k"], "1 hour", files_per_trigger=3)
    done = run_available(stream_windows(stream, ["k"], **window), "test_windows")
    frame = F.session_window("ts", window["gap"]) if "gap" in window else F.window("ts", *window.values())
    want = (
        spark.createDataFrame(rows, SCHEMA)
        .withColumn("ts", F.col("ts").cast("timestamp"))
        .groupBy("k", frame.alias("w"))
        .agg(F.count("*").alias("n"))
        .filter(F.col("w.end") <= F.lit(max(r[1] for r in rows) - timedelta(hours=1)).cast("timestamp"))
        .select("k", F.col("w.start").alias("window_start"), "n")
    )
    assert spark_rows(done.select("k", "window_start", "n")) == spark_rows(want)


def test_windows_need_one_kind_of_frame(spark):
    with pytest.raises(ValueError, match="either"):
        stream_windows(spark.range(1), ["id"])
