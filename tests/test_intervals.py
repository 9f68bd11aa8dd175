from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadgrain.operators import intervals as operators_intervals
from loadgrain.operators.intervals import invalid_intervals, merge_intervals, overlap_counts, overlap_pairs
from loadgrain.plans.small import pin_small

START = datetime(2024, 1, 1)
SCHEMA = "key bigint, interval_id bigint, start timestamp_ntz, end timestamp_ntz"


def intervals(spark, seed: int, n: int, keys: int, longest: float):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # whole minutes make equal and touching ends likely
        start = START + timedelta(minutes=rng.randrange(0, 6_000))
        length = timedelta(minutes=int(rng.random() ** 3 * longest), microseconds=rng.choice([0, 0, 0, 250_000]))
        rows.append((rng.randrange(keys), i, start, start + length))
    return spark.createDataFrame(rows, SCHEMA), rows


@pytest.mark.parametrize("bin_rows", [1, 3, 100_000])
@pytest.mark.parametrize("small_rows", [0, 60, 1_000_000])
@pytest.mark.parametrize("longest", [90, 4_000])
def test_pairs_equal_brute_force(spark, bin_rows, small_rows, longest):
    df, rows = intervals(spark, 5, 200, 3, longest)
    # one over the whole time, and one within a moment
    rows += [(1, 900, START - timedelta(days=9), START + timedelta(days=900)), (1, 901, START, START + timedelta(microseconds=1))]
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(
        (a[0], a[1], b[1])
        for a in rows
        for b in rows
        if a[0] == b[0] and a[1] < b[1] and a[2] < b[3] and b[2] < a[3]
    )
    found = overlap_pairs(df, ["key"], bin_rows=bin_rows, small_rows=small_rows).collect()
    assert sorted((r["key"], r["id_a"], r["id_b"]) for r in found) == want
    assert len(want) > 20
    by_id = {r[1]: r for r in rows}
    for r in found:
        a, b = by_id[r["id_a"]], by_id[r["id_b"]]
        assert (r["overlap_start"], r["overlap_end"]) == (max(a[2], b[2]), min(a[3], b[3]))


@pytest.mark.parametrize("limit", [1, 9, 100_000])
@pytest.mark.parametrize("longest", [30, 600])
def test_islands_equal_a_sweep(spark, conf, limit, longest):
    conf("spark.loadgrain.seriesRows", limit)
    df, rows = intervals(spark, 6, 200, 3, longest)
    want = []
    for key in {r[0] for r in rows}:
        open_island, gap = None, None
        for _, _, start, end in sorted((r for r in rows if r[0] == key), key=lambda r: (r[2], r[1])):
            if open_island and start <= open_island[1]:
                open_island = (open_island[0], max(end, open_island[1]), open_island[2] + 1)
            else:
                if open_island:
                    want.append((key, *open_island, gap))
                    gap = open_island[1]
                open_island = (start, end, 1)
        want.append((key, *open_island, gap))
    got = [
        (r["key"], r["island_start"], r["island_end"], r["n_intervals"], r["gap_start"])
        for r in merge_intervals(df, ["key"]).collect()
    ]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("limit", [1, 9, 100_000])
@pytest.mark.parametrize("longest", [30, 4_000])
def test_counts_equal_brute_force(spark, conf, limit, longest):
    conf("spark.loadgrain.seriesRows", limit)
    _, rows = intervals(spark, 7, 200, 3, longest)
    at = START + timedelta(minutes=11)
    # empty ones at one moment, at the ends of others and inside them
    rows += [(2, 1_000 + i, at, at) for i in range(3)] + [(2, 1_010, at - timedelta(minutes=1), at), (2, 1_011, at, at + timedelta(minutes=1))]
    rows += [(2, 1_020, START, START + timedelta(days=9)), (None, 1, at, at + timedelta(hours=1)), (None, 2, at, at + timedelta(hours=2))]
    want = sorted(
        (a[0], a[1], sum(a[0] == b[0] and a[1] != b[1] and a[2] < b[3] and b[2] < a[3] for b in rows)) for a in rows if a[0] is not None
    )
    found = overlap_counts(spark.createDataFrame(rows, SCHEMA), ["key"]).collect()
    assert sorted((r["key"], r["interval_id"], r["n_overlaps"]) for r in found if r["key"] is not None) == want
    assert sorted(r["n_overlaps"] for r in found if r["key"] is None) == [1, 1]


def test_invalid_intervals(spark):
    hour = timedelta(hours=1)
    rows = [(1, 1, START, START + hour), (1, 2, START, START - hour), (1, 3, START, None), (1, 4, None, START), (1, 5, START, START)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r["interval_id"] for r in invalid_intervals(df).collect()) == [2, 3, 4]
    for operator in (overlap_pairs, overlap_counts):
        with pytest.raises(Exception, match="invalid interval [234]"):
            operator(df, ["key"]).collect()
        assert operator(df.filter("interval_id in (1, 5)"), ["key"]).count() == (0 if operator is overlap_pairs else 2)


def test_one_long_interval_is_two_rows(spark):
    """Whatever its length, an interval lies in two bins of its level, and the others are not looked up more often for it."""
    rows = [(1, i, START + timedelta(seconds=i), START + timedelta(seconds=i + 1)) for i in range(5_000)]
    rows.append((1, 9_999, START - timedelta(days=36_500), START + timedelta(days=36_500)))
    found = overlap_pairs(spark.createDataFrame(rows, SCHEMA), ["key"], small_rows=0)
    assert found.count() == 5_000
    assert found.agg({"id_b": "min"}).first()[0] == 9_999


def test_nothing_overlaps_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert overlap_pairs(empty, ["key"]).count() == 0
    assert overlap_counts(empty, ["key"]).count() == 0
    assert merge_intervals(empty, ["key"]).count() == 0


def test_touching_is_no_overlap_but_one_island(spark):
    rows = [(1, 1, START, START + timedelta(hours=1)), (1, 2, START + timedelta(hours=1), START + timedelta(hours=2))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert overlap_pairs(df, ["key"]).count() == 0
    assert merge_intervals(df, ["key"]).count() == 1


def test_only_small_levels_go_through_the_driver(spark, monkeypatch):
    """Levels of many intervals are shuffled: fetched and broadcast, they take several times their size in the driver."""
    fetched = []

    def pinned(df, *bounds):
        found = pin_small(df, *bounds)
        fetched.append(df.count() if found[1] is not None else 0)
        return found

    monkeypatch.setattr(operators_intervals, "pin_small", pinned)
    start = F.expr(f"timestamp_ntz'{START}'")
    second = lambda n: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))
    length = F.when(F.col("id") % 1_000 == 0, 40).otherwise(2)
    rows = spark.range(120_000).select(
        (F.col("id") % 100).alias("key"),
        F.col("id").alias("interval_id"),
        (start + second(F.col("id"))).alias("start"),
        (start + second(F.col("id") + length)).alias("end"),
    )
    assert overlap_pairs(rows, ["key"]).count() == 0
    assert 0 < sum(fetched) <= 100_000
