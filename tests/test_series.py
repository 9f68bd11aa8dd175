"""Series operators against plain Python on small random tables."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from checks import spark_rows
from pyspark.sql import functions as F

from loadgrain.operators.series import features, long_rolls, resample, rollup_granularity, running
from loadgrain.operators.windows import row_windows, time_windows
from loadgrain.plans.series_split import CHUNK, split_series

START = datetime(2024, 3, 9, 22, 0, 0)
SCHEMA = "k bigint, ts timestamp_ntz, tie bigint, power double"


def table(spark, seed: int, sizes: list[int], spread_seconds: float = 200_000):
    rng = random.Random(seed)
    rows = []
    for k, size in enumerate(sizes):
        for _ in range(size):
            at = START + timedelta(microseconds=int(rng.random() * spread_seconds * 1e6))
            rows.append((k if k else None, at, len(rows), round(rng.uniform(0, 500), 2)))
    return spark.createDataFrame(rows, SCHEMA), rows


def by_key(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(r[0], []).append(r)
    return groups


def test_long_series_are_cut_and_short_ones_are_not(spark, conf):
    df, rows = table(spark, 1, [40, 3, 200])
    assert not split_series(df, ["k"]).split
    conf("spark.loadgrain.seriesRows", 10)
    series = split_series(df, ["k"])
    assert series.split
    chunks = series.rows.groupBy("k", CHUNK).count().collect()
    assert max(r["count"] for r in chunks if r["k"] == 2) < 60
    assert [r[CHUNK] for r in chunks if r["k"] == 1] == [None]
    assert len([r for r in chunks if r["k"] is None]) > 2
    assert sum(r["count"] for r in chunks) == len(rows)


@pytest.mark.parametrize("limit", [1, 7, 10_000])
def test_features(spark, conf, limit):
    conf("spark.loadgrain.seriesRows", limit)
    df, rows = table(spark, 2, [30, 1, 55])
    got = {r["tie"]: r for r in features(df, ["k"], [1, 3], [4], tie=("tie",)).collect()}
    assert len(got) == len(rows)
    for series in by_key(rows).values():
        for i, r in enumerate(series):
            assert got[r[2]]["lag_1"] == (series[i - 1][3] if i >= 1 else None)
            assert got[r[2]]["lag_3"] == (series[i - 3][3] if i >= 3 else None)
            full = [x[3] for x in series[i - 3 : i + 1]] if i >= 3 else None
            assert got[r[2]]["roll_max_4"] == (max(full) if full else None)
            assert got[r[2]]["hour"] == r[1].hour
            assert got[r[2]]["weekday"] == r[1].weekday()


@pytest.mark.parametrize(("size", "stride"), [(8, 4), (1, 1), (5, 1), (3, 7), (6, 5), (50, 1)])
@pytest.mark.parametrize("limit", [6, 10_000])
def test_row_windows(spark, conf, size, stride, limit):
    conf("spark.loadgrain.seriesRows", limit)
    df, rows = table(spark, 3, [70, 4, 133])
    got = sorted(
        (r["k"] or 0, r["window_no"], r["start_ts"], tuple(r["values"]))
        for r in row_windows(df, ["k"], size, stride, tie=("tie",)).collect()
    )
    want = []
    for k, series in by_key(rows).items():
        for no, at in enumerate(range(0, len(series) - size + 1, stride)):
            want.append((k or 0, no, series[at][1], tuple(r[3] for r in series[at : at + size])))
    assert got == sorted(want)


def test_row_windows_rejects_bad_sizes(spark):
    df, _ = table(spark, 3, [3])
    with pytest.raises(ValueError, match="positive"):
        row_windows(df, ["k"], 0, 1)


@pytest.mark.parametrize(("size", "slide"), [("1 hour", None), ("3 hours", "1 hour"), ("50 minutes", "20 minutes")])
def test_time_windows(spark, size, slide):
    df, _ = table(spark, 4, [60, 2, 40])
    frame = F.window("ts", size, slide) if slide else F.window("ts", size)
    want = df.groupBy("k", frame.alias("w")).agg(
        F.count("*").alias("n"), F.round(F.avg("power"), 6).alias("mean"), F.max("power").alias("max")
    )
    got = time_windows(df, ["k"], size, slide)
    assert spark_rows(got.select("k", "window_start", "window_end", "n", F.round("mean", 6).alias("mean"), "max")) == (
        spark_rows(want.select("k", "w.start", "w.end", "n", "mean", "max").toDF(
            "k", "window_start", "window_end", "n", "mean", "max"))
    )


@pytest.mark.parametrize("limit", [2, 10_000])
def test_resample_edges(spark, conf, limit):
    conf("spark.loadgrain.seriesRows", limit)
    day = lambda n, hour=5: datetime(2024, 1, n, hour)
    rows = [
        (1, day(2), 0, 10.0),
        (1, day(2, 9), 1, 20.0),
        (1, day(3), 2, None),
        (1, day(5), 3, 7.0),
        (1, day(20), 4, 99.0),
        (2, day(20), 5, 1.0),
        (3, day(1), 6, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    args = (df, ["k"], "1 day", "2024-01-01 00:00:00", "2024-01-06 00:00:00")
    values = {}
    for fill in ("none", "forward", "zero"):
        found = resample(*args, fill=fill).orderBy("k", "bucket").collect()
        values[fill] = {k: [r["value"] for r in found if r["k"] == k] for k in (1, 2, 3)}
    assert values["none"] == {1: [None, 15.0, None, None, 7.0, None], 2: [None] * 6, 3: [None] * 6}
    assert values["forward"] == {1: [None, 15.0, 15.0, 15.0, 7.0, 7.0], 2: [None] * 6, 3: [None] * 6}
    assert values["zero"] == {1: [0.0, 15.0, 0.0, 0.0, 7.0, 0.0], 2: [0.0] * 6, 3: [0.0] * 6}
    assert [r["value"] for r in resample(*args, agg="sum").filter("k = 1").orderBy("bucket").collect()][1] == 30.0


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert features(empty, ["k"], [1], [2]).count() == 0
    assert row_windows(empty, ["k"], 3, 1).count() == 0
    assert time_windows(empty, ["k"], "1 hour").count() == 0
    assert resample(empty, ["k"], "1 day", "2024-01-01", "2024-01-02").count() == 0


def test_rollup_counts_null_power(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "b", None), (2, "c", 4.0)], "u bigint, t string, power double")
    got = {(r["level"], r["u"], r["t"]): (r["sum"], r["mean"], r["n"]) for r in rollup_granularity(df, ["u", "t"]).collect()}
    assert got[("total", None, None)] == (6.0, 3.0, 3)
    assert got[("u", 1, None)] == (2.0, 2.0, 2)
    assert got[("t", 1, "b")] == (None, None, 1)
    assert len(got) == 6


@pytest.mark.parametrize("spread", [840, 60])
def test_bursts_are_cut(spark, conf, spread):
    """Most rows of a day within minutes, or within one minute."""
    conf("spark.loadgrain.seriesRows", 300)
    rng = random.Random(spread)
    burst = [(1, START + timedelta(microseconds=rng.randrange(spread * 10**6)), i, 1.0) for i in range(3000)]
    rest = [(1, START + timedelta(hours=1 + i % 40, seconds=i), 3000 + i, 2.0) for i in range(40)]
    df = spark.createDataFrame(burst + rest, SCHEMA)
    sizes = [r["count"] for r in split_series(df, ["k"]).rows.groupBy(CHUNK).count().collect()]
    assert max(sizes) <= 600 and sum(sizes) == 3040


@pytest.mark.parametrize("lag", [1, 70, 400])
def test_long_lags_over_many_chunks(spark, conf, lag):
    df, rows = table(spark, 5, [300, 2, 500])
    want = spark_rows(features(df, ["k"], [lag], [lag + 1], tie=("tie",)))
    conf("spark.loadgrain.seriesRows", 50)
    assert spark_rows(features(df, ["k"], [lag], [lag + 1], tie=("tie",))) == want


@pytest.mark.parametrize("limit", [7, 100_000])
@pytest.mark.parametrize("n", [1, 3, 40, 95, 500])
def test_long_rolls_equal_pandas(spark, conf, limit, n):
    """Frames shorter and longer than a chunk, a block and a series; nulls, null keys, equal timestamps."""
    conf("spark.loadgrain.seriesRows", limit)
    rng = np.random.default_rng(n)
    size = 300
    frame = pd.DataFrame(
        {
            "k": rng.choice([1, 1, 1, 2, 3], size),
            "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 400_000, size) // 60 * 60, unit="s"),
            "tie": np.arange(size),
            "power": np.where(rng.random(size) < 0.1, np.nan, 1e6 + rng.random(size)),
        }
    )
    frame.loc[frame["k"] == 3, "power"] = np.nan
    rows = [(None if k == 2 else int(k), ts.to_pydatetime(), int(tie), None if np.isnan(x) else float(x)) for k, ts, tie, x in frame.to_numpy()]
    table = spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, tie bigint, power double")
    found = long_rolls(table, ["k"], n, tie=("tie",)).toPandas().sort_values("tie").reset_index(drop=True)
    assert len(found) == size
    order = frame.sort_values(["k", "ts", "tie"])
    for _, own in order.groupby("k"):
        rolling = own["power"].rolling(n, min_periods=1)
        full = np.arange(len(own)) >= n - 1
        got = found.loc[own.index]
        for name, want in (("mean", rolling.mean()), ("min", rolling.min()), ("max", rolling.max()), ("std", rolling.std(ddof=0))):
            want = np.where(full, want, np.nan)
            assert np.allclose(got[f"roll_{name}_{n}"].astype(float), want, rtol=1e-12, atol=1e-6, equal_nan=True), name


def test_a_day_of_seconds_in_one_frame(spark, conf):
    """A frame of 86,400 rows over a cut series of 200,000: linear, and the same as from running sums."""
    conf("spark.loadgrain.seriesRows", 20_000)
    rows = spark.range(200_000).selectExpr(
        "1 as k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) as ts", "cast((id * 7919) % 1000003 as double) as power"
    )
    found = features(rows, ["k"], [1], [86_400]).selectExpr("unix_date(date(ts)) as d", "*").orderBy("ts").toPandas()
    power = (np.arange(200_000) * 7919 % 1_000_003).astype(float)
    total = np.concatenate([[0], np.cumsum(power)])
    for i in (0, 86_398, 86_399, 86_400, 123_456, 199_999):
        row = found.iloc[i]
        if i < 86_399:
            assert np.isnan(row["roll_mean_86400"])
            continue
        own = power[i - 86_399 : i + 1]
        assert row["roll_mean_86400"] == pytest.approx((total[i + 1] - total[i - 86_399]) / 86_400)
        assert (row["roll_min_86400"], row["roll_max_86400"]) == (own.min(), own.max())
        assert row["roll_std_86400"] == pytest.approx(own.std()) and row["lag_1"] == power[i - 1]


def test_running_without_values(spark):
    rows = [(1, datetime(2024, 1, 1, i), None if i % 2 else float(i)) for i in range(5)]
    found = running(spark.createDataFrame(rows, "k int, ts timestamp_ntz, power double"), ["k"]).orderBy("ts").collect()
    assert [(r["run_n"], r["run_mean"], r["run_min"], r["run_max"]) for r in found] == [
        (0, None, None, None), (1, 0.0, 0.0, 0.0), (1, 0.0, 0.0, 0.0), (2, 1.0, 0.0, 2.0), (2, 1.0, 0.0, 2.0)
    ]
