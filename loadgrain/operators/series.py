"""Putting readings on a grid, summing them up and deriving features."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadgrain.functions.columns import floor_div, grid_start, interval, join_null_safe, seconds
from loadgrain.plans.series_split import Series, series_rows, split_series
from loadgrain.plans.small import pin_small

# rows of a rolling frame up to which a window goes through each frame
LONG_FRAME = 1_000


def resample(
    df: DataFrame,
    keys: list[str],
    every: str,
    start: str,
    end: str,
    agg: str = "mean",
    fill: str = "none",
    ts: str = "ts",
    value: str = "power",
) -> DataFrame:
    """One row per key and bucket from that of ``start`` to that of ``end``, both included.

    Buckets are aligned with 1970; a ``start`` or ``end`` within a bucket stands for the whole bucket. ``fill`` is ``none``, ``forward`` or ``zero``; nulls before
    the first value stay null under ``forward``. ``observed`` tells whether the bucket had
    values; null readings count as missing. Each bucket with readings also writes out the empty ones before it, so there is
    no join with a grid and only as many sorted rows as buckets with readings.
    """
    if fill not in ("none", "forward", "zero"):
        raise ValueError(f"unknown fill {fill!r}")
    step = interval(every)
    kind = df.schema[ts].dataType
    first, last = (grid_start(df.sparkSession, moment, every, kind) for moment in (start, end))
    bucket = F.window(ts, every)["start"].cast(kind)
    # a key without a value in the range still gets its rows, hence the null bucket
    inside = df.select(*keys, bucket.alias("_b"), value).withColumn(
        "_b", F.when((F.col("_b") >= first) & (F.col("_b") <= last) & F.col(value).isNotNull(), F.col("_b"))
    )
    buckets = inside.groupBy(*keys, "_b").agg(_aggregate(agg, value).alias("_v"))

    known = buckets.filter(F.col("_b").isNotNull())
    # the range bounds how many buckets a series can have
    most = (pd.Timestamp(end) - pd.Timestamp(start)).total_seconds() / seconds(every) + 2
    series = Series(known, tuple(keys), False) if most <= series_rows(df) else split_series(known, keys, "_b")
    series = series.with_lookback(["_b"], ["_v"], 1)
    w = series.window(["_b"])
    series = series.with_rows(
        series.rows.withColumns({"_pb": F.lag("_b").over(w), "_pv": F.lag("_v").over(w)})
    )
    upto = series.finish().select(
        *keys,
        F.explode(F.sequence(F.coalesce(F.col("_pb") + step, first), F.col("_b"), step)).alias("bucket"),
        "_b",
        "_v",
        "_pv",
    )
    # buckets after the last one with readings, and all of them for a key without any
    ends = buckets.groupBy(*keys).agg(
        F.max("_b").alias("_b"), F.max_by("_v", "_b").alias("_pv")
    )
    after = (
        ends.withColumn("_from", F.coalesce(F.col("_b") + step, first))
        .filter(F.col("_from") <= last)
        .select(
            *keys,
            F.explode(F.sequence("_from", last, step)).alias("bucket"),
            F.lit(None).cast(kind).alias("_b"),
            F.lit(None).cast("double").alias("_v"),
            "_pv",
        )
    )
    gap = {"none": F.lit(None).cast("double"), "forward": F.col("_pv"), "zero": F.lit(0.0)}[fill]
    observed = F.coalesce(F.col("bucket") == F.col("_b"), F.lit(False))
    filled = F.when(observed, F.col("_v")).otherwise(gap)
    return upto.unionByName(after).select(*keys, "bucket", filled.alias("value"), observed.alias("observed"))


def _aggregate(agg: str, value: str) -> Column:
    functions = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}
    if agg not in functions:
        raise ValueError(f"unknown aggregate {agg!r}")
    return functions[agg](value)


def rollup_granularity(df: DataFrame, levels: list[str], measure: str = "power") -> DataFrame:
    """Sum, mean and count per finest level, each coarser one, and in total.

    ``levels`` go from coarse to fine, such as user then terminal. Rows are summed at the
    finest level first, so the rollup multiplies those sums and not the readings.
    """
    finest = df.groupBy(*levels).agg(
        F.sum(measure).alias("_sum"), F.count(measure).alias("_n"), F.count(F.lit(1)).alias("_rows")
    )
    names = ["total", *levels]
    depth = F.lit(len(levels)) - F.bit_count(F.grouping_id())
    return (
        finest.rollup(*levels)
        .agg(
            F.element_at(F.array(*[F.lit(n) for n in names]), (depth + 1).cast("int")).alias("level"),
            F.sum("_sum").alias("sum"),
            (F.sum("_sum") / F.nullif(F.sum("_n"), F.lit(0))).alias("mean"),
            F.sum("_rows").alias("n"),
        )
        .select("level", *levels, "sum", "mean", "n")
    )


def features(
    df: DataFrame,
    keys: list[str],
    lags: list[int],
    rolls: list[int],
    ts: str = "ts",
    value: str = "power",
    tie: tuple[str, ...] = (),
) -> DataFrame:
    """Lags, differences, rolling mean/std/min/max over the last rows, hour and weekday.

    A rolling value covers the row itself and the rows before it; it is null until the frame is
    full. Weekday 0 is Monday. Frames of more than ``LONG_FRAME`` rows come from ``long_rolls``, which takes the same time
    for any length; ``tie`` has to order rows of equal time for them.
    """
    order = [ts, *tie]
    long = [n for n in rolls if n > LONG_FRAME]
    rolls = [n for n in rolls if n <= LONG_FRAME]
    for n in long:
        df = long_rolls(df, keys, n, ts, value, tie)
    series = split_series(df, keys, ts).with_lookback(order, [value], max([0, *lags, *[r - 1 for r in rolls]]))
    w = series.window(order)
    new = {}
    for n in lags:
        new[f"lag_{n}"] = F.lag(value, n).over(w)
        new[f"diff_{n}"] = F.col(value) - F.lag(value, n).over(w)
    for n in rolls:
        frame = w.rowsBetween(1 - n, 0)
        full = F.count(F.lit(1)).over(frame) == n
        for name, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max)):
            new[f"roll_{name}_{n}"] = F.when(full, f(value).over(frame))
    new["hour"] = F.hour(ts)
    new["weekday"] = F.weekday(ts)
    return series.with_rows(series.rows.withColumns(new)).finish()


def long_rolls(
    df: DataFrame, keys: list[str], n: int, ts: str = "ts", value: str = "power", tie: tuple[str, ...] = ()
) -> DataFrame:
    """``roll_mean_n``, ``roll_std_n``, ``roll_min_n`` and ``roll_max_n`` over the last ``n`` rows, in time that doesn't grow with ``n``.

    Rows of a series are numbered and get the running sums so far, carried over its chunks. A sum over the last ``n`` rows is the
    difference to the row ``n`` before. For the extremes a series is cut into blocks of ``n`` rows: a frame is the end of
    one block and the beginning of the next, whose extremes run from and to the block's edge (van Herk, 1992). So a row meets
    one other row, by their numbers, and no frame is gone through or borrowed. Sums are taken of distances from the mean of the
    series. Null values don't count; a frame is full by its rows.
    """
    order = [ts, *tie]
    mean = df.groupBy(*keys).agg(F.avg(value).alias("_middle"))
    rows = join_null_safe(df, pin_small(mean)[0], keys, "left").withColumn("_x", F.col(value) - F.col("_middle"))
    none = F.lit(0.0)
    series = split_series(rows, keys, ts, sized_by=df).with_carry(
        _rows=(F.count(F.lit(1)), F.sum, F.lit(0).cast("bigint")),
        _count=(F.count("_x"), F.sum, F.lit(0).cast("bigint")),
        _sum=(F.coalesce(F.sum("_x"), none), F.sum, none),
        _square=(F.coalesce(F.sum(F.col("_x") * F.col("_x")), none), F.sum, none),
    )
    so_far = series.window(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = series.with_rows(
        series.rows.withColumns(
            {
                "_no": F.count(F.lit(1)).over(so_far) + F.col("_rows") - 1,
                "_count": F.count("_x").over(so_far) + F.col("_count"),
                "_sum": F.coalesce(F.sum("_x").over(so_far), none) + F.col("_sum"),
                "_square": F.coalesce(F.sum(F.col("_x") * F.col("_x")).over(so_far), none) + F.col("_square"),
            }
        )
    ).finish()
    numbered = numbered.withColumn("_block", floor_div(F.col("_no"), n))
    block = Window.partitionBy(*keys, "_block")
    # backwards, as a frame that ends with its block would be gone through anew for each row
    upto = block.orderBy("_no").rowsBetween(Window.unboundedPreceding, 0)
    behind = block.orderBy(F.desc("_no")).rowsBetween(Window.unboundedPreceding, -1)
    numbered = numbered.withColumns(
        {
            "_low": F.min(value).over(upto),
            "_high": F.max(value).over(upto),
            "_low_behind": F.min(value).over(behind),
            "_high_behind": F.max(value).over(behind),
        }
    )
    on = [*keys, "_block", "_no"]
    before = numbered.select(
        *keys,
        (F.col("_block") + 1).alias("_block"),
        (F.col("_no") + n).alias("_no"),
        *[F.col(c).alias(f"_b{c}") for c in ("_count", "_sum", "_square", "_low_behind", "_high_behind")],
    )
    met = join_null_safe(numbered.drop("_low_behind", "_high_behind", "_rows", "_x"), before, on, "left")
    count, total, square = (F.col(c) - F.coalesce(f"_b{c}", F.lit(0)) for c in ("_count", "_sum", "_square"))
    count = F.nullif(count, F.lit(0))
    apart = total / count
    full = F.col("_no") >= n - 1
    new = {
        f"roll_mean_{n}": F.when(full, F.col("_middle") + apart),
        f"roll_std_{n}": F.when(full & count.isNotNull(), F.sqrt(F.greatest(square / count - apart * apart, none))),
        f"roll_min_{n}": F.when(full, F.least("_low", "_b_low_behind")),
        f"roll_max_{n}": F.when(full, F.greatest("_high", "_b_high_behind")),
    }
    return met.withColumns(new).select(*df.columns, *new)


def running(df: DataFrame, keys: list[str], ts: str = "ts", value: str = "power", tie: tuple[str, ...] = ()) -> DataFrame:
    """``run_n``, ``run_mean``, ``run_min`` and ``run_max`` of all earlier values of the series; null, and 0, before the first."""
    nothing = F.lit(None).cast("double")
    series = split_series(df, keys, ts).with_carry(
        run_n=(F.count(value), F.sum, F.lit(0).cast("bigint")),
        _run_sum=(F.coalesce(F.sum(value), F.lit(0.0)), F.sum, F.lit(0.0)),
        run_min=(F.min(value).cast("double"), F.min, nothing),
        run_max=(F.max(value).cast("double"), F.max, nothing),
    )
    earlier = series.window([ts, *tie]).rowsBetween(Window.unboundedPreceding, -1)
    n = F.count(value).over(earlier) + F.col("run_n")
    total = F.coalesce(F.sum(value).over(earlier), F.lit(0.0)) + F.col("_run_sum")
    new = {
        "run_mean": total / F.nullif(n, F.lit(0)),
        "run_min": F.least(F.min(value).over(earlier).cast("double"), "run_min"),
        "run_max": F.greatest(F.max(value).over(earlier).cast("double"), "run_max"),
        "run_n": n,
    }
    return series.with_rows(series.rows.withColumns(new)).finish().drop("_run_sum")
