"""The driver's ``events`` table read as load readings (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

USER = ["user_id"]
TERMINAL = ["terminal_id"]
TIE = ("event_id",)
THRESHOLD = 100.0


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(spark.read.parquet(f"{sf_dir}/events.parquet"))


def as_readings(events: DataFrame) -> DataFrame:
    return events.select(
        "user_id",
        F.concat_ws("-", "user_id", "event_type").alias("terminal_id"),
        "ts",
        F.col("value").alias("power"),
        "event_id",
        "event_type",
    )


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.round(F.col("power") * 60).cast("decimal(18,6)"))
    return readings(spark, sf_dir).select(
        F.col("user_id").alias("key"),
        F.col("event_id").alias("interval_id"),
        F.col("ts").alias("start"),
        (F.col("ts") + span).alias("end"),
    )


def batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two overlapping batches; the second has the higher priority."""
    rows = readings(spark, sf_dir)
    third = F.col("event_id") % 3
    return [
        rows.filter(third != missing).withColumns(
            {"batch_id": F.lit(name), "source_file": F.lit(f"{name}.csv"), "priority": F.lit(rank)}
        )
        for name, missing, rank in (("batch1", 0, 1), ("batch2", 1, 2))
    ]
