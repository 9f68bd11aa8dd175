"""Sliding windows over rows and over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadgrain.functions.columns import interval, seconds
from loadgrain.plans.series_split import split_series


def row_windows(
    df: DataFrame,
    keys: list[str],
    size: int,
    stride: int,
    ts: str = "ts",
    value: str = "power",
    tie: tuple[str, ...] = (),
) -> DataFrame:
    """Every full window of ``size`` consecutive rows that begins at row 0, stride, 2*stride ...

    Rows are numbered along each series and gathered in blocks of a few windows. A block also
    receives the first rows of the next one, so a row is shuffled about once instead of
    once for each window it belongs to, and no task gathers more than a block.
    """
    if size < 1 or stride < 1:
        raise ValueError("size and stride must be positive")
    order = [ts, *tie]
    # a multiple of the stride, and long enough that a window reaches one block further at most
    block = stride * max(-(-4 * size // stride), 8)
    series = split_series(df, keys, ts).with_carry(
        _before=(F.count(F.lit(1)), F.sum, F.lit(0).cast("bigint"))
    )
    number = F.row_number().over(series.window(order)) - 1 + F.col("_before")
    numbered = series.with_rows(series.rows.withColumn("_rn", number)).finish()

    own = F.floor(F.col("_rn") / block)
    # the previous block's last window ends at own*block - stride + size
    shared = (F.col("_rn") < own * block - stride + size) & (own > 0)
    blocks = (
        numbered.select(
            *keys,
            F.struct("_rn", F.col(ts).alias("_ts"), F.col(value).alias("_x")).alias("_row"),
            F.explode(F.when(shared, F.array(own, own - 1)).otherwise(F.array(own))).alias("_block"),
        )
        .groupBy(*keys, "_block")
        .agg(F.array_sort(F.collect_list("_row")).alias("_rows"))
    )
    full = F.floor((F.size("_rows") - size) / stride)
    # windows that begin in this block; the rows borrowed from the next one begin none
    last = F.least(full, F.lit(block // stride - 1))
    first_row = F.col("_i") * stride + 1
    return (
        blocks.filter(F.size("_rows") >= size)
        .withColumn("_i", F.explode(F.sequence(F.lit(0), last.cast("int"))))
        .select(
            *keys,
            (F.col("_block") * (block // stride) + F.col("_i")).alias("window_no"),
            F.element_at("_rows", first_row)["_ts"].alias("start_ts"),
            F.slice(F.col("_rows")["_x"], first_row, F.lit(size)).alias("values"),
        )
    )


def time_windows(
    df: DataFrame, keys: list[str], size: str, slide: str | None = None, ts: str = "ts", value: str = "power"
) -> DataFrame:
    """Number, sum, mean, min and max per tumbling or sliding window, aligned with 1970.

    Sliding windows are built from panes of the slide's length when it divides the size, so a
    reading is aggregated once and only the panes are copied into each window.
    """
    parts = [
        F.count(value).alias("_n"),
        F.sum(value).alias("_sum"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
        F.count(F.lit(1)).alias("_rows"),
    ]
    kind = df.schema[ts].dataType
    slide = slide or size
    if slide == size or seconds(size) % seconds(slide):
        direct = df.groupBy(*keys, F.window(ts, size, slide).alias("_w")).agg(*parts)
        windows = direct.select(
            *keys, F.col("_w.start").cast(kind).alias("window_start"), "_n", "_sum", "_min", "_max", "_rows"
        )
    else:
        span, step = interval(size), interval(slide)
        panes = (
            df.groupBy(*keys, F.window(ts, slide).alias("_w"))
            .agg(*parts)
            .withColumn("_pane", F.col("_w.start").cast(kind))
        )
        starts = F.sequence(F.col("_pane") - span + step, F.col("_pane"), step)
        windows = (
            panes.withColumn("window_start", F.explode(starts))
            .groupBy(*keys, "window_start")
            .agg(
                F.sum("_n").alias("_n"),
                F.sum("_sum").alias("_sum"),
                F.min("_min").alias("_min"),
                F.max("_max").alias("_max"),
                F.sum("_rows").alias("_rows"),
            )
        )
    return windows.select(
        *keys,
        "window_start",
        (F.col("window_start") + interval(size)).alias("window_end"),
        F.col("_rows").alias("n"),
        F.col("_sum").alias("sum"),
        (F.col("_sum") / F.nullif(F.col("_n"), F.lit(0))).alias("mean"),
        F.col("_min").alias("min"),
        F.col("_max").alias("max"),
    )
