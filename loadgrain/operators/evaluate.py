"""Splits, metrics and the comparison of models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadgrain.functions.columns import elapsed, hash_bucket, join_null_safe
from loadgrain.functions.quantile import exact_quantile
from loadgrain.plans.small import pin_small

SETS = ("train", "val", "test")
# models are told apart by the bits of bigints
WORD_BITS = 62


def split(
    df: DataFrame, by: list[str], fractions: tuple[float, float, float] = (0.7, 0.15, 0.15), seed: int = 42
) -> DataFrame:
    """Assign whole entities to train, validation and test.

    The set depends on the entity's id and the seed only, so it stays the same under any
    partitioning and no entity is in two sets. Fractions add up to 1; whole hundredths take 100 buckets,
    finer ones as many as they need, up to 100 million.
    """
    if min(fractions) < 0 or abs(sum(fractions) - 1) > 1e-9:
        raise ValueError("fractions must be positive and add up to 1")
    buckets = 100
    while buckets < 100_000_000 and any(abs(f * buckets - round(f * buckets)) > 1e-9 * buckets for f in fractions):
        buckets *= 10
    cut1, cut2 = round(fractions[0] * buckets), round((fractions[0] + fractions[1]) * buckets)
    bucket = hash_bucket(seed, *by, buckets=buckets)
    return df.withColumn("set", F.when(bucket < cut1, SETS[0]).when(bucket < cut2, SETS[1]).otherwise(SETS[2]))


def split_by_time(
    df: DataFrame, fractions: tuple[float, float, float] = (0.7, 0.15, 0.15), ts: str = "ts"
) -> DataFrame:
    """Assign readings by time: the first part of the whole span trains, the last tests."""
    span = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    with_span = df.withColumns({f"_{c}": span.select(c).scalar() for c in ("lo", "hi")})
    part = elapsed(F.col("_lo"), F.col(ts)).cast("double") / F.nullif(
        elapsed(F.col("_lo"), F.col("_hi")).cast("double"), F.lit(0.0)
    )
    label = (
        F.when(F.coalesce(part, F.lit(0.0)) < fractions[0], SETS[0])
        .when(part < fractions[0] + fractions[1], SETS[1])
        .otherwise(SETS[2])
    )
    return with_span.withColumn("set", label).drop("_lo", "_hi")


def metric_columns(actual: Column, predicted: Column) -> list[Column]:
    """n, MAE, RMSE and R2 as aggregates that combine before the shuffle.

    R2 is null where the actual values do not vary.
    """
    ok = actual.isNotNull() & predicted.isNotNull()
    error = F.when(ok, actual - predicted)
    spread = F.var_pop(F.when(ok, actual)) * F.count(error)
    return [
        F.count(error).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.sum(error * error) / F.nullif(spread, F.lit(0.0))).alias("r2"),
    ]


def metrics(
    pred: DataFrame, by: list[str] | None = None, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """MAE, RMSE and R2 per group or over all rows."""
    aggs = metric_columns(F.col(actual), F.col(predicted))
    return pred.groupBy(*by).agg(*aggs) if by else pred.agg(*aggs)


def robust_metrics(
    pred: DataFrame, q: float, by: list[str] | None = None, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """Metrics without the errors above quantile ``q``, and scale-free ``mae_rel``, ``rmse_rel``."""
    by = list(by or [])
    errors = pred.withColumn("_abs", F.abs(F.col(actual) - F.col(predicted)))
    cutoff = exact_quantile(errors, by, "_abs", q, "_cut")
    if by:
        kept = join_null_safe(errors, pin_small(cutoff)[0], by)
    else:
        kept = errors.withColumn("_cut", cutoff.scalar())
    mean = F.avg(F.when(F.col("_abs").isNotNull(), F.col(actual)))
    return (
        kept.filter(F.col("_abs") <= F.col("_cut"))
        .groupBy(*by)
        .agg(*metric_columns(F.col(actual), F.col(predicted)), mean.alias("_mean"))
        .withColumn("mae_rel", F.col("mae") / F.nullif(F.col("_mean"), F.lit(0.0)))
        .withColumn("rmse_rel", F.col("rmse") / F.nullif(F.col("_mean"), F.lit(0.0)))
        .drop("_mean")
    )


def compare_models(preds: DataFrame, keys: list[str], models: list[str] | None = None) -> DataFrame:
    """Metrics per model on the keys that every model predicted, ranked by RMSE, ties by name.

    ``models`` names the models, which spares finding them in the predictions. ``dropped`` counts
    the predictions of each model whose key some other model lacks; ``dropped_keys`` lists them. A model
    without a row to be scored on ranks last.
    """
    marked = _mark_common(preds, keys, models)
    on_common = F.col("_common").isNotNull()
    scored = marked.groupBy("model").agg(
        *metric_columns(F.when(on_common, F.col("actual")), F.when(on_common, F.col("predicted"))),
        F.count(F.when(~on_common, True)).alias("dropped"),
    )
    # one row per model
    return scored.withColumn("rank", F.rank().over(Window.orderBy(F.asc_nulls_last("rmse"), "model")))


def dropped_keys(preds: DataFrame, keys: list[str], models: list[str] | None = None) -> DataFrame:
    """The model and key of each prediction that ``compare_models`` leaves out because some other model lacks the key."""
    return _mark_common(preds, keys, models).filter(F.col("_common").isNull()).select("model", *keys)


def _mark_common(preds: DataFrame, keys: list[str], models: list[str] | None) -> DataFrame:
    """Predictions with ``_common``, true where every model predicted the key and null elsewhere."""
    made = preds.filter(F.col("predicted").isNotNull())
    if models is None:
        models = [r[0] for r in made.select("model").distinct().collect()]
    else:
        models = list(dict.fromkeys(models))
        made = made.filter(F.col("model").isin(*models))
    # one bit per model, combined before the shuffle
    names = F.array(*[F.lit(m) for m in models]).cast("array<string>")
    place = (F.array_position(names, F.col("model")) - 1).cast("int")
    words, everyone = [], F.lit(True)
    for i, first in enumerate(range(0, max(len(models), 1), WORD_BITS)):
        n = min(WORD_BITS, len(models) - first)
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place - first)
        words.append(F.bit_or(F.when(place.between(first, first + n - 1), bit).otherwise(F.lit(0).cast("bigint"))).alias(f"_w{i}"))
        everyone = everyone & (F.col(f"_w{i}") == F.lit((1 << n) - 1).cast("bigint"))
    seen = made.groupBy(*keys).agg(*words)
    common = seen.filter(everyone).select(*keys, F.lit(True).alias("_common"))
    return join_null_safe(made, common, keys, "left")


def ablation(
    results: DataFrame,
    baseline: str,
    variant: str = "variant",
    values: tuple[str, ...] = ("mae", "rmse", "r2"),
) -> DataFrame:
    """Difference of each variant's metrics to the baseline's, absolute and relative.

    An unknown baseline, or one that stands for several rows, ends the job with an error.
    """
    # one scalar with all metrics; results has one row per variant
    base = results.filter(F.col(variant) == baseline).agg(
        F.when(F.count(F.lit(1)) == 1, F.first(F.struct(*values))).otherwise(
            F.raise_error(F.concat(F.lit(f"rows of baseline {baseline}: "), F.count(F.lit(1)).cast("string")))
        )
    )
    results = results.withColumn("_base", base.scalar())
    of_base = {f"_{v}": F.col(f"_base.{v}") for v in values}
    deltas = {}
    for v in values:
        deltas[f"{v}_delta"] = F.col(v) - F.col(f"_{v}")
        deltas[f"{v}_relative"] = (F.col(v) - F.col(f"_{v}")) / F.nullif(F.abs(F.col(f"_{v}")), F.lit(0.0))
    return results.withColumns(of_base).withColumns(deltas).drop("_base", *of_base)


def metrics_by_level(
    pred: DataFrame, levels: list[str], by: list[str] | None = None, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """MAE, RMSE and R2 for each of ``levels``, coarse to fine (as user, terminal), and over all rows, per ``by`` (as model).

    ``level`` names the finest key of a row, or ``total``; keys finer than it are null. Predictions are shuffled once, as moments
    of the finest level that combine before the shuffle; coarser levels are merged from those of the next finer
    one: numbers and sums add up, and spreads are merged exactly, by what the means of the parts differ.
    Levels are nested: a terminal with readings of two users is one row for each. Null keys are a group of their own.
    """
    by, levels = list(by or []), list(levels)
    ok = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    error, value = F.when(ok, F.col(actual) - F.col(predicted)), F.when(ok, F.col(actual))
    keys = [*by, *levels]
    now = pred.groupBy(*keys).agg(
        F.count(error).alias("n"),
        F.sum(F.abs(error)).alias("_abs"),
        F.sum(error * error).alias("_square"),
        F.avg(value).alias("_mean"),
        (F.var_pop(value) * F.count(value)).alias("_spread"),
    )
    parts = []
    for depth in range(len(levels), -1, -1):
        if depth < len(levels):
            now = _merged(now, [*by, *levels[:depth]])
        name = levels[depth - 1] if depth else "total"
        missing = {c: F.lit(None).cast(pred.schema[c].dataType) for c in levels[depth:]}
        parts.append(now.withColumns({**missing, "level": F.lit(name)}).select("level", *keys, *now.columns[len(by) + depth :]))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    n = F.nullif(F.col("n"), F.lit(0))
    return rows.select(
        "level",
        *keys,
        "n",
        (F.col("_abs") / n).alias("mae"),
        F.sqrt(F.col("_square") / n).alias("rmse"),
        (1 - F.col("_square") / F.nullif(F.col("_spread"), F.lit(0.0))).alias("r2"),
    )


def _merged(parts: DataFrame, by: list[str]) -> DataFrame:
    """Moments of groups from those of their parts, after Chan, Golub and LeVeque (1979)."""
    sums = parts.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum("_abs").alias("_abs"),
        F.sum("_square").alias("_square"),
        (F.sum(F.col("n") * F.col("_mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("_mean"),
    )
    own = parts.select(*by, F.col("n").alias("_n"), F.col("_mean").alias("_part"), F.col("_spread").alias("_inside"))
    means = sums.select(*by, "_mean")
    both = join_null_safe(own, means, by) if by else own.withColumn("_mean", means.select("_mean").scalar())
    apart = F.col("_n") * (F.col("_part") - F.col("_mean")) * (F.col("_part") - F.col("_mean"))
    spread = both.groupBy(*by).agg((F.sum("_inside") + F.sum(apart)).alias("_spread"))
    if by:
        return join_null_safe(sums, spread, by)
    return sums.withColumn("_spread", spread.select("_spread").scalar())
