from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from checks import spark_rows
from pyspark.sql import functions as F

from loadgrain.operators import evaluate, models, scaling
from loadgrain.plans import small

SCHEMA = "k bigint, i bigint, actual double, predicted double"


def predictions(spark, seed: int = 1):
    rng = random.Random(seed)
    rows = [(i % 4, i, rng.uniform(0, 50), rng.uniform(0, 50)) for i in range(200)]
    return spark.createDataFrame(rows, SCHEMA), rows


def test_perfect_predictor(spark):
    df, _ = predictions(spark)
    row = evaluate.metrics(df, predicted="actual").first()
    assert tuple(row) == (200, 0.0, 0.0, 1.0)


def test_metrics_equal_their_definition(spark):
    df, rows = predictions(spark)
    for r in evaluate.metrics(df, ["k"]).collect():
        y, p = (np.array([x[c] for x in rows if x[0] == r["k"]]) for c in (2, 3))
        assert r["mae"] == pytest.approx(np.abs(y - p).mean())
        assert r["rmse"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
        assert r["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_constant_actual_has_no_r2_and_nulls_do_not_count(spark):
    df = spark.createDataFrame([(1, 1, 5.0, 4.0), (1, 2, 5.0, 7.0), (1, 3, None, 1.0), (1, 4, 9.0, None)], SCHEMA)
    row = evaluate.metrics(df).first()
    assert (row["n"], row["mae"], row["r2"]) == (2, 1.5, None)
    assert evaluate.metrics(df.limit(0)).first()["n"] == 0


def test_robust_metrics_drop_only_the_largest_errors(spark):
    rows = [(1, i, 10.0 + i, 10.0 + i + 1) for i in range(99)] + [(1, 99, 10.0, 5_000.0)]
    row = evaluate.robust_metrics(spark.createDataFrame(rows, SCHEMA), 0.98, ["k"]).first()
    assert (row["n"], row["mae"]) == (99, 1.0)


def test_compare_uses_common_keys_only(spark):
    rows = [(m, i, float(i), float(i) + e) for m, e in (("a", 1.0), ("b", 0.5), ("c", 1.0)) for i in range(10)]
    rows = [r for r in rows if not (r[0] == "b" and r[1] == 3)] + [("a", 50, 1.0, 900.0), ("c", 60, 2.0, None)]
    df = spark.createDataFrame(rows, "model string, i bigint, actual double, predicted double")
    got = [(r["rank"], r["model"], r["n"], r["dropped"]) for r in evaluate.compare_models(df, ["i"]).collect()]
    assert sorted(got) == [(1, "b", 9, 0), (2, "a", 9, 2), (3, "c", 9, 1)]


def test_ablation_of_the_baseline_is_zero(spark):
    results = spark.createDataFrame([("base", 2.0, 4.0, 0.5), ("less", 3.0, 5.0, 0.25)], "variant string, mae double, rmse double, r2 double")
    got = {r["variant"]: r for r in evaluate.ablation(results, "base").collect()}
    assert {got["base"][c] for c in ("mae_delta", "rmse_delta", "r2_delta", "mae_relative")} == {0.0}
    assert (got["less"]["mae_delta"], got["less"]["mae_relative"], got["less"]["r2_relative"]) == (1.0, 0.5, -0.5)


def test_split_depends_on_the_entity_only(spark):
    df = spark.range(3_000).select((F.col("id") % 300).alias("user_id"), "id")
    one, other = evaluate.split(df, ["user_id"]), evaluate.split(df.repartition(7, "id"), ["user_id"])
    assert spark_rows(one) == spark_rows(other)
    assert one.groupBy("user_id").agg(F.count_distinct("set").alias("n")).filter("n > 1").count() == 0
    shares = {r["set"]: r["count"] / 3_000 for r in one.groupBy("set").count().collect()}
    assert shares["train"] == pytest.approx(0.7, abs=0.08)
    assert spark_rows(evaluate.split(df, ["user_id"], seed=7)) != spark_rows(one)


def test_split_by_time_keeps_order(spark):
    rows = [(datetime(2024, 1, 1) + timedelta(hours=i),) for i in range(101)]
    sets = evaluate.split_by_time(spark.createDataFrame(rows, "ts timestamp_ntz")).orderBy("ts").collect()
    assert [r["set"] for r in sets] == ["train"] * 70 + ["val"] * 15 + ["test"] * 16
    single = evaluate.split_by_time(spark.createDataFrame(rows[:1], "ts timestamp_ntz"))
    assert single.first()["set"] == "train"


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("by", [["k"], None])
@pytest.mark.parametrize("method", [scaling.ZSCORE, scaling.MINMAX])
def test_scaling_is_invertible(spark, monkeypatch, by, method, broadcast):
    if not broadcast:
        monkeypatch.setattr(scaling, "pin_small", lambda df: (df, None))
    df, _ = predictions(spark)
    params = scaling.fit_scaler(df, "actual", by, method)
    scaled = scaling.apply_scaler(df, params, "actual", "s", by)
    back = scaling.invert_scaler(scaled, params, "s", "back", by)
    assert back.count() == 200
    assert back.filter(F.abs(F.col("back") - F.col("actual")) > 1e-9).count() == 0
    low, high = scaled.agg(F.min("s"), F.max("s")).first()
    if method == scaling.MINMAX:
        assert (low, high) == (0.0, 1.0)


def test_constant_series_scales_to_zero(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 1.0), (2, 3.0), (3, None)], "k bigint, v double")
    params = scaling.fit_scaler(df, "v", ["k"])
    got = sorted(((r["k"], r["s"]) for r in scaling.apply_scaler(df, params, "v", "s", ["k"]).collect()), key=str)
    assert got == [(1, 0.0), (1, 0.0), (2, -1.0), (2, 1.0), (3, None)]


@pytest.mark.parametrize("by", [["k"], None])
def test_dual_scale(spark, by):
    df, _ = predictions(spark)
    scaled, target = scaling.dual_scale(df, "predicted", "actual", by)
    back = scaling.invert_scaler(scaled, target, "y_scaled", "back", by)
    assert back.filter(F.abs(F.col("back") - F.col("actual")) > 1e-9).count() == 0
    assert scaled.agg(F.avg("x_scaled")).first()[0] == pytest.approx(0, abs=1e-9)


def test_small_tables_are_pinned_and_large_ones_are_not(spark):
    df = spark.range(50).select("id")
    pinned, n = small.pin_small(df, 50)
    assert n == 50 and pinned.count() == 50
    left, n = small.pin_small(df, 49)
    assert n is None and left.count() == 50


def test_a_larger_side_is_computed_once_and_not_fetched(spark, monkeypatch):
    computed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    fetched = []
    wide = spark.range(1_000).selectExpr("id", "repeat('x', 5000) as t", "array(id, null) as a", "map('k', id) as m", "named_struct('s', 'é') as s")
    monkeypatch.setattr(type(wide), "toArrow", lambda df: fetched.append(df))
    side, n = small.pin_small(wide.mapInArrow(count, wide.schema), max_bytes=4_000_000)
    assert n is None and fetched == []
    assert (side.count(), side.agg(F.sum(F.length("t"))).first()[0]) == (1_000, 5_000_000)
    assert computed.value == 1_000
    monkeypatch.undo()
    side, n = small.pin_small(wide.mapInArrow(count, wide.schema), max_bytes=6_000_000)
    assert n == side.count() == 1_000 and computed.value == 2_000


def lines(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        a, b = rng.uniform(-1, 1), rng.uniform(-1, 1)
        rows.append((i, "train" if i % 4 else "val", a, b if i % 50 else None, 3 * a - 2 * b + 1))
    return spark.createDataFrame(rows, "i bigint, set string, a double, b double, y double")


def test_linear_models_find_the_line(spark):
    df = lines(spark)
    model = models.fit_linear_many(df, "y", ["a", "b"])
    assert list(model.coefficients) == pytest.approx([3, -2]) and model.intercept == pytest.approx(1)
    predicted = models.predict(model, df, ["a", "b"])
    assert predicted.count() == 400
    assert predicted.filter("predicted IS NULL").count() == df.filter("b IS NULL").count()
    exact = df.withColumn("z", 2 * F.col("a") + 5)
    row = models.fit_linear(exact, "z", "a").first()
    assert (row["slope"], row["intercept"], row["n"]) == (pytest.approx(2), pytest.approx(5), 400)


def test_trees_beat_the_mean(spark):
    df = lines(spark)
    model = models.fit_trees(df.filter("set = 'train'"), "y", ["a", "b"], maxIter=10, maxDepth=4)
    row = evaluate.metrics(models.predict(model, df.filter("set = 'val'"), ["a", "b"]), actual="y").first()
    assert row["r2"] > 0.8


def test_search_ranks_every_parameter_set(spark):
    df = lines(spark)
    grid = {"regParam": [10.0, 0.0, 1.0]}
    found = models.search(df, "y", ["a", "b"], grid).collect()
    assert [r["params"] for r in found] == [f'{{"regParam":"{v}"}}' for v in (0.0, 1.0, 10.0)]
    drawn = models.search(df, "y", ["a", "b"], grid, metric="r2", n_random=2, seed=5)
    again = models.search(df, "y", ["a", "b"], grid, metric="r2", n_random=2, seed=5)
    assert drawn.count() == 2 and spark_rows(drawn.select("params")) == spark_rows(again.select("params"))


def test_search_in_groups(spark, monkeypatch):
    monkeypatch.setattr(models, "GROUP", 2)
    df = lines(spark)
    grid = {"regParam": [0.0, 0.1, 1.0], "fitIntercept": [True, False]}
    grouped = spark_rows(models.search(df, "y", ["a", "b"], grid))
    monkeypatch.setattr(models, "GROUP", 20)
    assert spark_rows(models.search(df, "y", ["a", "b"], grid)) == grouped
    assert len(grouped) == 6


def noisy(spark, n=600):
    rng = np.random.default_rng(6)
    x = rng.normal([1, -2, 1_000, 5, 0], [1, 0.1, 30, 0, 3], (n, 5))
    y = 2 * x[:, 0] - 7 * x[:, 1] + 0.01 * x[:, 2] + rng.normal(0, 1, n) + 4
    frame = pd.DataFrame(x, columns=list("abcde")).assign(y=y, set=np.where(np.arange(n) % 3 == 0, "val", "train"))
    frame.loc[::50, "a"] = np.nan
    frame.loc[7, "set"] = "test"
    return spark.createDataFrame(frame).repartition(7)


@pytest.mark.parametrize("metric", ["rmse", "mae", "r2"])
def test_linear_search_equals_fits(spark, metric):
    df = noisy(spark).withColumn("a", F.when(~F.isnan("a"), F.col("a")))
    grid = {"regParam": [0.0, 0.3, 2.0], "elasticNetParam": [0.0, 0.5, 1.0], "fitIntercept": [True, False], "standardization": [True, False]}
    found = {r["params"]: r for r in models.search_linear(df, "y", list("abcde"), grid, metric).collect()}
    fitted = {r["params"]: r for r in models.search(df, "y", list("abcde"), grid, metric, n_random=12).collect()}
    assert len(found) == 36 and len(fitted) == 12
    for params, row in fitted.items():
        assert found[params]["n"] == row["n"] > 150
        assert found[params]["rmse"] == pytest.approx(row["rmse"], rel=1e-4)
        assert found[params]["r2"] == pytest.approx(row["r2"], abs=1e-4)
        if metric == "mae":
            assert found[params]["mae"] == pytest.approx(row["mae"], rel=1e-4)
        else:
            assert found[params]["mae"] is None


def test_linear_search_reads_the_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = noisy(spark)
    df = df.mapInArrow(count, df.schema)
    found = models.search_linear(df, "y", list("abc"), {"regParam": [i / 100 for i in range(1_000)]})
    assert found.count() == 1_000 and read.value == 600


def test_linear_search_without_rows(spark):
    df = noisy(spark)
    with pytest.raises(ValueError, match="train"):
        models.search_linear(df.limit(0), "y", ["a"], {"regParam": [0.0]})
    with pytest.raises(ValueError, match="maxIter"):
        models.search_linear(df, "y", ["a"], {"maxIter": [3]})
    row = models.search_linear(df.filter("set <> 'val'"), "y", ["a"], {"regParam": [0.0]}).first()
    assert (row["n"], row["rmse"]) == (0, None)


def test_levels_equal_metrics(spark):
    rng = random.Random(8)
    rows = []
    for i in range(500):
        user = rng.choice([1, 2, 3, None])
        actual = rng.choice([1e6 + rng.random(), rng.gauss(50, 9)]) if user != 3 else 4.0
        terminal = None if user is None else f"{user}-{rng.randrange(4)}"
        rows.append((rng.choice("ab"), user, terminal, rng.choice([actual, None]) if i % 9 == 0 else actual, rng.choice([50.0, None, 1e6])))
    df = spark.createDataFrame(rows, "model string, user_id int, terminal_id string, actual double, predicted double")
    found = evaluate.metrics_by_level(df, ["user_id", "terminal_id"], ["model"])
    assert found.columns == ["level", "model", "user_id", "terminal_id", "n", "mae", "rmse", "r2"]
    found = found.collect()
    for level, by in (("terminal_id", ["model", "user_id", "terminal_id"]), ("user_id", ["model", "user_id"]), ("total", ["model"])):
        want = {tuple(r[c] for c in by): r for r in evaluate.metrics(df, by).collect()}
        got = {tuple(r[c] for c in by): r for r in found if r["level"] == level}
        assert set(got) == set(want)
        for key, r in want.items():
            assert got[key]["n"] == r["n"]
            for m in ("mae", "rmse", "r2"):
                assert got[key][m] == (r[m] if r[m] is None else pytest.approx(r[m], rel=1e-9))
    total = evaluate.metrics_by_level(df, ["user_id"]).filter("level = 'total'").first()
    assert total["rmse"] == pytest.approx(evaluate.metrics(df).first()["rmse"])
    assert evaluate.metrics_by_level(df.limit(0), ["user_id"]).filter("n > 0").count() == 0


def test_score_runs_the_given_model(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0, 2.0]) for i in range(20)], "i bigint, values array<double>")
    got = models.score(df.repartition(3), lambda: lambda batch: batch.sum(axis=1))
    assert sorted((r["i"], r["predicted"]) for r in got.collect()) == [(i, i + 3.0) for i in range(20)]
    assert models.score(df.limit(0), lambda: lambda batch: batch.sum(axis=1)).count() == 0
