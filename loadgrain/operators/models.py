"""Fitting, scoring and searching models on Spark."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadgrain.functions.moments import Moments, complete_rows, moments
from loadgrain.operators.evaluate import metric_columns
from loadgrain.plans.least_squares import LINEAR, solve_linear

# models that one plan predicts with, and errors held at once
GROUP = 20
BLOCK_VALUES = 2_000_000


def fit_linear(df: DataFrame, y: str, x: str, by: list[str] | None = None) -> DataFrame:
    """Least squares with one feature, exact, per group or over all rows."""
    b, a = F.col(y), F.col(x)
    aggs = [
        F.regr_slope(b, a).alias("slope"),
        F.regr_intercept(b, a).alias("intercept"),
        F.regr_r2(b, a).alias("r2"),
        F.regr_count(b, a).alias("n"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def fit_linear_many(df: DataFrame, y: str, features: list[str], **params) -> Model:
    """Linear regression with several features over all rows."""
    return LinearRegression(featuresCol="_features", labelCol=y, **params).fit(_assembled(df, features, y))


def fit_trees(df: DataFrame, y: str, features: list[str], seed: int = 42, **params) -> Model:
    """Boosted regression trees."""
    return GBTRegressor(featuresCol="_features", labelCol=y, seed=seed, **params).fit(_assembled(df, features, y))


def predict(model: Model, df: DataFrame, features: list[str]) -> DataFrame:
    """One ``predicted`` per row whose features are complete; null for the others."""
    vectors = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep").transform(df)
    scored = model.transform(vectors)
    return scored.withColumn("predicted", F.when(_complete(features), F.col("prediction"))).drop(
        "_features", "prediction"
    )


def score(
    df: DataFrame, make_predict: Callable[[], Callable], values: str = "values", out: str = "predicted"
) -> DataFrame:
    """Score windows with any model: ``make_predict()`` loads it once per task and returns a
    function from a 2-D array, one window per row, to one number per row.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_predict()
        for batch in batches:
            if len(batch):
                batch[out] = np.asarray(model(np.stack(batch[values].to_numpy())), dtype="float64")
            else:
                batch[out] = pd.Series(dtype="float64")
            yield batch

    return df.mapInPandas(run, schema)


def search(
    df: DataFrame,
    y: str,
    features: list[str],
    grid: dict[str, list],
    metric: str = "rmse",
    estimator: Callable[..., Model] = fit_linear_many,
    n_random: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Fit each parameter set on the train rows and score it on the validation rows of ``set``.

    All combinations of ``grid``, or ``n_random`` of them drawn with the seed. One row per
    set, best first. The driver holds parameters and scores only. ``GROUP`` models are scored in one pass.
    """
    sets = _parameter_sets(grid, n_random, seed)
    train = df.filter(F.col("set") == "train").select(*features, y).persist()
    val = df.filter(F.col("set") == "val").select(*features, y).persist()
    results = []
    try:
        for at in range(0, len(sets), GROUP):
            group, scored = sets[at : at + GROUP], val
            for i, params in enumerate(group):
                model = estimator(train, y, features, **params)
                scored = predict(model, scored, features).withColumnRenamed("predicted", f"_p{i}")
            # one pass over the validation rows scores the group
            row = scored.agg(
                *[F.struct(*metric_columns(F.col(y), F.col(f"_p{i}"))).alias(f"_m{i}") for i in range(len(group))]
            ).first()
            results += [tuple(row[f"_m{i}"][m] for m in ("n", "mae", "rmse", "r2")) for i in range(len(group))]
    finally:
        train.unpersist()
        val.unpersist()
    return _ranked(df.sparkSession, sets, results, metric)


def search_linear(
    df: DataFrame,
    y: str,
    features: list[str],
    grid: dict[str, list],
    metric: str = "rmse",
    n_random: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """``search`` over linear models, from one pass over the rows however many parameter sets there are.

    Number, means and co-moments of the train and the validation rows are all that least squares, ridge and elastic net
    need: each set (``regParam``, ``elasticNetParam``, ``fitIntercept``, ``standardization``, as in Spark's linear regression) is
    solved from those of the train rows, and its RMSE and R2 follow from those of the validation rows. MAE does not; only if it
    is the ``metric`` a second pass adds up the errors of all sets over the validation rows, else it is null. Rows with a
    null or NaN value are left out. The driver holds a square of the number of features.
    """
    unknown = set(grid) - set(LINEAR)
    if unknown:
        raise ValueError(f"no parameters of a linear search: {sorted(unknown)}")
    sets = _parameter_sets(grid, n_random, seed)
    known = moments(df.filter(F.col("set").isin("train", "val")), [*features, y], "set")
    if "train" not in known:
        raise ValueError("no complete train rows")
    models = [solve_linear(known["train"], **params) for params in sets]
    val = known.get("val")
    results = [(0, None, None, None) if val is None else _linear_scores(val, *model) for model in models]
    if metric == "mae" and val is not None:
        errors = _absolute_errors(df.filter(F.col("set") == "val"), y, features, models)
        results = [(n, errors[i] / n, rmse, r2) for i, (n, _, rmse, r2) in enumerate(results)]
    return _ranked(df.sparkSession, sets, results, metric)


def _linear_scores(val: Moments, weights: np.ndarray, constant: float) -> tuple:
    """n, MAE (unknown), RMSE and R2 of a linear model from the moments of features and target."""
    along = np.append(-weights, 1.0)
    bias = float(along @ val.mean) - constant
    square = max(float(along @ val.spread @ along), 0.0) + val.n * bias * bias
    spread = float(val.spread[-1, -1])
    return val.n, None, math.sqrt(square / val.n), 1 - square / spread if spread else None


def _absolute_errors(val: DataFrame, y: str, features: list[str], models: list) -> list[float]:
    """The sum of absolute errors of each model, all in one pass."""
    weights = np.array([w for w, _ in models]).T
    constants = np.array([c for _, c in models])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(constants))
        for values in complete_rows(batches):
            block = max(BLOCK_VALUES // len(constants), 1)
            for at in range(0, len(values), block):
                some = values[at : at + block]
                total += np.abs(some[:, -1:] - some[:, :-1] @ weights - constants).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "total"])

    columns = [F.col(c).cast("double").alias(c) for c in (*features, y)]
    sums = val.select(*columns).mapInArrow(add, "place long, total double").groupBy("place").agg(F.sum("total").alias("total"))
    return [r["total"] for r in sums.orderBy("place").collect()]


def _parameter_sets(grid: dict[str, list], n_random: int | None, seed: int) -> list[dict]:
    total = math.prod(len(values) for values in grid.values())
    places = range(total) if n_random is None else random.Random(seed).sample(range(total), min(n_random, total))
    return [_nth(grid, place) for place in places]


def _ranked(spark: SparkSession, sets: list[dict], results: list[tuple], metric: str) -> DataFrame:
    """One row per parameter set, best first."""
    rows = [({k: str(v) for k, v in params.items()}, *scores) for params, scores in zip(sets, results, strict=True)]
    table = spark.createDataFrame(rows, "params map<string,string>, n bigint, mae double, rmse double, r2 double")
    best_first = F.desc_nulls_last(metric) if metric == "r2" else F.asc_nulls_last(metric)
    return table.select(F.to_json("params").alias("params"), "n", "mae", "rmse", "r2").orderBy(best_first, "params")


def _nth(grid: dict[str, list], place: int) -> dict:
    """The parameter set at a place in the order of ``itertools.product``, without listing those before it."""
    out = {}
    for name in reversed(grid):
        place, i = divmod(place, len(grid[name]))
        out[name] = grid[name][i]
    return {name: out[name] for name in grid}


def _complete(features: list[str]) -> Column:
    ok = F.lit(True)
    for f in features:
        ok = ok & F.col(f).isNotNull()
    return ok


def _assembled(df: DataFrame, features: list[str], y: str) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="skip").transform(
        df.filter(F.col(y).isNotNull()).select(*features, y)
    )
