"""Merging batches of readings and checking what they cover."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadgrain.functions.columns import join_null_safe


def merge_batches(
    dfs: list[DataFrame],
    keys: list[str],
    priority: Column,
    ts: str = "ts",
    source: str = "source_file",
) -> tuple[DataFrame, DataFrame]:
    """Union batches and keep one row per (keys, ts): ``(merged, conflicts)``.

    The row with the highest ``priority`` wins, then the smallest source file, then the
    smallest remaining values. ``conflicts`` holds the rows that lost, with ``copies`` for
    how often each occurred. Copies are counted, and winners picked, before the shuffle, so
    a key that repeats endlessly stays cheap.
    """
    everything = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    at = [*keys, ts]
    values = [c for c in everything.columns if c not in at]
    rest = [c for c in values if c != source]
    # ascending order of this struct is the order of preference
    rank = F.struct(priority.isNull().alias("_none"), (-priority).alias("_p"), F.col(source), *rest)
    ranked = everything.withColumn("_rank", rank)
    winners = ranked.groupBy(*at).agg(F.min("_rank").alias("_win"), F.count(F.lit(1)).alias("_n"))
    merged = winners.select(*at, *[F.col(f"_win.{c}").alias(c) for c in values]).select(*everything.columns)

    variants = ranked.groupBy(*at, "_rank").agg(F.count(F.lit(1)).alias("_copies"))
    contested = winners.filter(F.col("_n") > 1).drop("_n")
    lost = F.col("_copies") - F.when(F.col("_rank") == F.col("_win"), 1).otherwise(0)
    conflicts = (
        join_null_safe(variants, contested, at)
        .withColumn("copies", lost)
        .filter(F.col("copies") > 0)
        .select(*at, *[F.col(f"_rank.{c}").alias(c) for c in values], "copies")
    )
    return merged, conflicts


def coverage(df: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """First and last timestamp and number of rows per key, for example (terminal, file)."""
    return df.groupBy(*keys).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n")
    )
