"""Every registered query against its SQL, and the pinned results of the blueprint."""

from __future__ import annotations

import pytest
from checks import TABLES, duck, duck_rows, spark_rows
from pyspark.sql import functions as F

from loadgrain.plans.oracle import ORACLE
from loadgrain.plans.queries import QUERIES, _csv_batches

SMALL = str(TABLES / "sf0.001")
MEDIUM = str(TABLES / "sf0.01")
ORDERED = [
    "merge_intervals",
    "resample_forward",
    "row_windows",
    "features",
    "long_rolls",
    "running",
    "overlap_counts",
    "detect_events",
    "steady_states",
    "pair_cycles",
    "metrics_per_user",
    "compare_models",
    "load_signatures",
    "robust_metrics_per_model",
]
COUNTS = {
    "merge_batches": 10_000,
    "merge_conflicts": 3_333,
    "coverage": 750,
    "overlap_pairs": 762,
    "merge_intervals": 9_267,
    "stored_readings": 10_000,
    "resample_forward": 4_500,
    "rollup_granularity": 901,
    "row_windows": 2_294,
    "time_windows_hourly": 9_567,
    "time_windows_sliding": 123,
    "fit_scaler": 150,
    "detect_events": 1_287,
    "steady_states": 1_437,
    "transient_features": 1_287,
    "load_signatures": 10,
    "pair_cycles": 339,
    "match_signatures": 1_287,
    "disaggregate": 9_567,
    "fit_linear_per_user": 150,
    "score": 2_294,
    "stream_readings": 10_000,
    "stream_windows_hourly": 9_539,
    "stream_sessions": 9_525,
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, MEDIUM)
    got = spark_rows(df)
    assert len(got) > 0
    if name in COUNTS:
        assert len(got) == COUNTS[name]
    if name in ORACLE:
        con = duck(MEDIUM)
        assert sorted(df.columns) == sorted(d[0] for d in con.execute(ORACLE[name]).description)
        assert got == duck_rows(con, ORACLE[name])


@pytest.mark.parametrize("name", ORDERED)
def test_long_series_give_the_same_result(spark, conf, name):
    conf("spark.loadgrain.seriesRows", 5)
    conf("spark.loadgrain.quantileValues", 20)
    assert spark_rows(QUERIES[name](spark, SMALL)) == duck_rows(duck(SMALL), ORACLE[name])


def test_pinned_values(spark):
    events = QUERIES["detect_events"](spark, MEDIUM)
    assert {r[0]: r[1] for r in events.groupBy("direction").count().collect()} == {"rise": 644, "fall": 643}

    states = QUERIES["steady_states"](spark, MEDIUM)
    assert states.agg(F.max("n")).first()[0] == 67

    around = QUERIES["transient_features"](spark, MEDIUM)
    assert tuple(around.agg(F.sum("n_before"), F.sum("n_after")).first()) == (2_009, 1_982)

    view_rise = QUERIES["load_signatures"](spark, MEDIUM).filter("label = 'view' AND direction = 'rise'").first()
    assert (view_rise["n"], round(view_rise["mean_step"], 4)) == (115, 139.8645)

    matched = QUERIES["match_signatures"](spark, MEDIUM)
    assert matched.filter("label = matched_label").count() == 279
    assert matched.select("matched_label").distinct().count() == 5

    split = QUERIES["disaggregate"](spark, MEDIUM)
    row = split.agg(F.count_distinct("state"), F.sum("error"), F.sum("n_on")).first()
    assert tuple(row) == (32, 110_001_480, 9_698)

    sets = QUERIES["split_entities"](spark, MEDIUM).groupBy("set")
    counted = {r[0]: (r[1], r[2]) for r in sets.agg(F.count("*"), F.count_distinct("user_id")).collect()}
    assert counted == {"train": (8_080, 121), "val": (1_257, 19), "test": (663, 10)}

    total = QUERIES["metrics_total"](spark, MEDIUM).first()
    assert tuple(total[c] for c in ("n", "mae", "rmse", "r2")) == (9_850, 49.326028, 69.3324, -1.009492)
    robust = QUERIES["robust_metrics"](spark, MEDIUM).first()
    assert tuple(robust[c] for c in ("n", "mae", "rmse", "r2")) == (9_751, 47.074263, 63.953775, -0.942851)

    compared = {r["model"]: r for r in QUERIES["compare_models"](spark, MEDIUM).collect()}
    assert {r["n"] for r in compared.values()} == {9_550}
    assert {m: r["rmse"] for m, r in compared.items()} == {
        "previous": 69.295677,
        "mean3": 56.895385,
        "running": 50.267267,
    }
    line = QUERIES["fit_linear_global"](spark, MEDIUM).first()
    assert (line["slope"], line["intercept"], line["n"]) == (-0.000026, 49.583761, 9_850)

    days = QUERIES["resample_forward"](spark, MEDIUM)
    empty = days.filter("NOT observed")
    assert (empty.count(), empty.filter("value IS NULL").count()) == (494, 16)
    lags = QUERIES["features"](spark, MEDIUM)
    assert lags.filter("lag_3 IS NOT NULL").count() == 9_550


def test_all_csv_rows_are_kept_or_rejected(spark):
    rows, rejected = _csv_batches(spark, SMALL)
    total = spark.read.parquet(f"{SMALL}/events.parquet").count()
    assert rows.count() + rejected.count() == total


def test_session_time_zone_does_not_matter(spark, conf):
    con = duck(SMALL)
    conf("spark.sql.session.timeZone", "America/New_York")
    for name in ("resample_zero", "pair_cycles", "transient_features", "stream_windows_hourly", "stream_events"):
        assert spark_rows(QUERIES[name](spark, SMALL)) == duck_rows(con, ORACLE[name])
