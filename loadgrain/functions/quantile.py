"""Exact quantiles of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadgrain.functions.columns import join_null_safe
from loadgrain.plans.scratch import ensure_checkpoint_dir
from loadgrain.plans.small import pin_small

# values of one group that a task may sort
GROUP_VALUES_CONF = "spark.loadgrain.quantileValues"
GROUP_VALUES = 4_000_000
ACCURACY = 10_000
# three times the rank error of percentile_approx on either side
MARGIN = 3 / ACCURACY
GRID = [i / 64 for i in range(65)]


def exact_quantile(df: DataFrame, by: list[str], value: str, q: float, alias: str) -> DataFrame:
    """The ``q`` quantile per group, interpolated between neighbours as ``percentile`` does.

    Equal values are counted before anything is sorted. If a group has too many values for one
    task, approximate quantiles just below and above give cut points, exact counts tell which
    of the parts between them hold the wanted ranks, and only those values go on.
    """
    limit = int(df.sparkSession.conf.get(GROUP_VALUES_CONF, str(GROUP_VALUES)))
    names = [f"_g{i}" for i in range(max(len(by), 1))]
    group = [F.col(c).alias(n) for c, n in zip(by, names, strict=True)] if by else [F.lit(0).alias("_g0")]
    values = df.filter(F.col(value).isNotNull()).select(*group, F.col(value).alias("_v"))

    bracket = None
    cuts = _cut_points(values, names, [max(0.0, q - MARGIN), min(1.0, q + MARGIN)])
    left = _largest(cuts, F.col("_n"))
    while left > limit:
        bracket = _narrow(_inside(values, bracket, names), cuts, names, q)
        # copies of one value are counted, not sorted
        now = _largest(bracket, F.when(F.col("_lo") == F.col("_hi"), 1).otherwise(F.col("_rows")))
        if now <= limit or now >= left:
            break
        left = now
        cuts = _cut_points(_inside(values, bracket, names), names, GRID)

    inside = _inside(values, bracket, names)
    if bracket is None:
        counted = inside.groupBy(*names, "_v").agg(F.count(F.lit(1)).alias("_w"))
        counted = counted.withColumns(
            {"_n": F.sum("_w").over(Window.partitionBy(*names)), "_below": F.lit(0).cast("bigint")}
        )
    else:
        counted = inside.groupBy(*names, "_v", "_n", "_below").agg(F.count(F.lit(1)).alias("_w"))
    up_to = F.sum("_w").over(Window.partitionBy(*names).orderBy("_v")) + F.col("_below")
    low, high = _ranks(q)
    picked = (
        counted.withColumn("_to", up_to)
        .groupBy(*names)
        .agg(
            F.max(F.when(_holds(low), F.col("_v"))).alias("_a"),
            F.max(F.when(_holds(high), F.col("_v"))).alias("_b"),
            F.max((F.col("_n") - 1) * F.lit(q) - low).alias("_part"),
        )
    )
    return picked.select(
        *[F.col(n).alias(c) for n, c in zip(names, by, strict=False)],
        (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")).alias(alias),
    )


def _ranks(q: float) -> tuple[Column, Column]:
    rank = (F.col("_n") - 1) * F.lit(q)
    return F.floor(rank), F.ceil(rank)


def _holds(rank: Column) -> Column:
    return (rank >= F.col("_to") - F.col("_w")) & (rank < F.col("_to"))


def _largest(table: DataFrame, size: Column) -> int:
    return table.agg(F.max(size)).first()[0] or 0


def _inside(values: DataFrame, bracket: DataFrame | None, names: list[str]) -> DataFrame:
    if bracket is None:
        return values
    return join_null_safe(values, bracket, names).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def _cut_points(inner: DataFrame, names: list[str], percents: list[float]) -> DataFrame:
    """Approximate quantiles per group, fixed before anything is counted with them."""
    first = "_n" not in inner.columns
    cuts = inner.groupBy(*names).agg(
        (F.count(F.lit(1)) if first else F.max("_n")).alias("_n"),
        (F.lit(0).cast("bigint") if first else F.max("_below")).alias("_below"),
        F.percentile_approx("_v", percents, ACCURACY).alias("_cuts"),
    )
    pinned, size = pin_small(cuts)
    if size is None:
        ensure_checkpoint_dir(inner.sparkSession)
        pinned = cuts.checkpoint()
    return pinned


def _narrow(inner: DataFrame, cuts: DataFrame, names: list[str], q: float) -> DataFrame:
    """Bounds per group that hold both neighbours of the quantile, and how many values lie below."""
    rows = join_null_safe(inner.select(*names, "_v"), cuts.select(*names, "_cuts"), names)
    # below the first cut, between cuts, above the last one
    slot = F.size(F.filter("_cuts", lambda c: c < F.col("_v"))) + F.when(
        F.array_min("_cuts") == F.col("_v"), 1
    ).otherwise(0)
    slots = rows.groupBy(*names, slot.alias("_slot")).agg(
        F.count(F.lit(1)).alias("_w"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    slots = join_null_safe(slots, cuts.drop("_cuts"), names)
    # a few rows per group
    up_to = F.sum("_w").over(Window.partitionBy(*names).orderBy("_slot")) + F.col("_below")
    low, high = _ranks(q)
    narrowed = (
        slots.withColumn("_to", up_to)
        .filter(_holds(low) | _holds(high))
        .groupBy(*names)
        .agg(
            F.max("_n").alias("_n"),
            F.min("_lo").alias("_lo"),
            F.max("_hi").alias("_hi"),
            F.min(F.col("_to") - F.col("_w")).alias("_below"),
            F.sum("_w").alias("_rows"),
        )
    )
    return pin_small(narrowed)[0]
