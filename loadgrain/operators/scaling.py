"""Scalers fitted on one table and applied to others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadgrain.functions.columns import join_null_safe
from loadgrain.plans.small import pin_small

ZSCORE, MINMAX = "zscore", "minmax"


def fit_scaler(train: DataFrame, value: str, by: list[str] | None = None, method: str = ZSCORE) -> DataFrame:
    """Offset and scale per key, or one row for all: mean and deviation, or minimum and range.

    Fit on the training split only. The deviation is that of the population.
    """
    if method not in (ZSCORE, MINMAX):
        raise ValueError(f"unknown method {method!r}")
    offset = F.avg(value) if method == ZSCORE else F.min(value)
    scale = F.stddev_pop(value) if method == ZSCORE else F.max(value) - F.min(value)
    aggs = [offset.alias("offset"), scale.alias("scale"), F.count(value).alias("n")]
    return train.groupBy(*by).agg(*aggs) if by else train.agg(*aggs)


def apply_scaler(df: DataFrame, params: DataFrame, value: str, out: str, by: list[str] | None = None) -> DataFrame:
    """``(value - offset) / scale``; 0.0 where the scale is 0, null for a key that was not fitted."""
    scaled = F.when(F.col("_scale") == 0, F.when(F.col(value).isNotNull(), F.lit(0.0))).otherwise(
        (F.col(value) - F.col("_offset")) / F.nullif(F.col("_scale"), F.lit(0.0))
    )
    return _with_params(df, params, by, out, scaled)


def invert_scaler(df: DataFrame, params: DataFrame, value: str, out: str, by: list[str] | None = None) -> DataFrame:
    """``value * scale + offset``."""
    return _with_params(df, params, by, out, F.col(value) * F.col("_scale") + F.col("_offset"))


def dual_scale(
    df: DataFrame, x: str, y: str, by: list[str] | None = None, train: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Scale input ``x`` and target ``y`` by scalers of their own.

    Returns the table with ``x_scaled`` and ``y_scaled`` and the parameters of the target,
    by which predictions are inverted. This is our definition of scaling by two scalers.
    """
    train = df if train is None else train
    both = train.groupBy(*(by or [])).agg(
        *[
            f.alias(f"{name}_{c}")
            for c in (x, y)
            for name, f in (("offset", F.avg(c)), ("scale", F.stddev_pop(c)), ("n", F.count(c)))
        ]
    )
    both, _ = pin_small(both)
    names = ("offset", "scale", "n")
    pick = lambda c: both.select(*(by or []), *[F.col(f"{n}_{c}").alias(n) for n in names])
    target = pick(y)
    scaled = apply_scaler(apply_scaler(df, pick(x), x, "x_scaled", by), target, y, "y_scaled", by)
    return scaled, target


def _with_params(df: DataFrame, params: DataFrame, by: list[str] | None, out: str, value: Column) -> DataFrame:
    small = params.select(*(by or []), F.col("offset").alias("_offset"), F.col("scale").alias("_scale"))
    if by:
        # as many rows as keys: broadcast if that is few, joined on the key otherwise
        joined = join_null_safe(df, pin_small(small)[0], list(by), "left")
    else:
        joined = df.withColumns({c: small.select(c).scalar() for c in ("_offset", "_scale")})
    return joined.withColumn(out, value).drop("_offset", "_scale")
