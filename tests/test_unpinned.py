"""The ways taken when a side table is too large to broadcast give the same results."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from checks import spark_rows
from pyspark.sql import functions as F

from loadgrain.functions import quantile
from loadgrain.operators import intervals, load
from loadgrain.operators.ingest import merge_batches
from loadgrain.operators.series import features
from loadgrain.operators.windows import row_windows
from loadgrain.plans import series_split

SCHEMA = "k bigint, ts timestamp_ntz, tie bigint, power double"


@pytest.fixture(scope="module")
def readings(spark):
    rng = random.Random(12)
    start = datetime(2024, 1, 1)
    rows = [
        (rng.choice([1, 1, 1, 2, None]), start + timedelta(seconds=rng.randrange(300_000)), i, round(rng.uniform(0, 300), 2))
        for i in range(150)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def never(df, max_rows=None):
    return df, None


def both_ways(monkeypatch, module, query):
    pinned = spark_rows(query())
    monkeypatch.setattr(module, "pin_small", never)
    assert spark_rows(query()) == pinned
    assert len(pinned) > 0


def test_long_series(conf, monkeypatch, readings):
    conf("spark.loadgrain.seriesRows", 6)
    columns = ["k", "tie", "lag_2", "roll_max_3"]

    def query():
        found = features(readings, ["k"], [2], [3], tie=("tie",)).select(*columns)
        states = load.steady_states(readings, ["k"], 100.0, tie=("tie",))
        states = states.select("k", F.col("segment").alias("tie"), F.col("n").alias("lag_2"), F.lit(0.0).alias("roll_max_3"))
        blocks = row_windows(readings, ["k"], 5, 2, tie=("tie",))
        blocks = blocks.select("k", F.col("window_no").alias("tie"), F.element_at("values", 1).alias("lag_2"), F.element_at("values", 5).alias("roll_max_3"))
        return found.unionByName(states).unionByName(blocks)

    both_ways(monkeypatch, series_split, query)


def test_dense_bins(monkeypatch, readings):
    iv = readings.select(
        "k", F.col("tie").alias("interval_id"), F.col("ts").alias("start"), (F.col("ts") + F.expr("INTERVAL 90 MINUTES")).alias("end")
    )
    both_ways(monkeypatch, intervals, lambda: intervals.overlap_pairs(iv, ["k"], bin_rows=3, small_rows=0))


def test_dense_pieces(monkeypatch, readings):
    monkeypatch.setattr(load, "CELL_ROWS", 1)
    events = load.detect_events(readings, ["k"], 150.0, tie=("tie",))
    query = lambda: load.transient_features(readings, events, ["k"], "5 hours", "2 hours", tie=("tie",)).select(
        "k", "tie", "n_before", "min_before", "n_after", "max_after"
    )
    both_ways(monkeypatch, load, query)


def test_large_groups(conf, monkeypatch, readings):
    conf("spark.loadgrain.quantileValues", 4)
    both_ways(
        monkeypatch, quantile, lambda: quantile.exact_quantile(readings, ["k"], "power", 0.4, "p").select("k", F.round("p", 9))
    )


def test_a_key_that_repeats_endlessly_is_merged(spark):
    at = datetime(2024, 1, 1)
    copies = spark.range(20_000).select(
        F.lit(1).cast("bigint").alias("k"),
        F.lit(at).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 3).cast("double").alias("power"),
        F.lit("a.csv").alias("source_file"),
        F.lit(1).alias("priority"),
    )
    merged, conflicts = merge_batches([copies], ["k"], F.col("priority"))
    assert [r["power"] for r in merged.collect()] == [0.0]
    assert conflicts.agg(F.sum("copies")).first()[0] == 19_999
    assert conflicts.count() == 3
