"""Merged readings as parquet, one folder per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "day"


def write_readings(df: DataFrame, path: str, keys: list[str], ts: str = "ts") -> None:
    """Write readings by day; only the days present in ``df`` are replaced.

    ``rebalance`` lets adaptive execution split a day that is too big for one task and join
    small ones; sorted files give narrow row-group statistics on the keys.
    """
    (
        df.withColumn(DAY, F.to_date(ts))
        .hint("rebalance", F.col(DAY))
        .sortWithinPartitions(DAY, *keys, ts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def read_readings(
    spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None
) -> DataFrame:
    """Read stored readings; the day bounds prune folders before any file is opened."""
    df = spark.read.parquet(path)
    if first_day:
        df = df.filter(F.col(DAY) >= F.lit(first_day).cast("date"))
    if last_day:
        df = df.filter(F.col(DAY) <= F.lit(last_day).cast("date"))
    return df
