"""Readings as a stream of files."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loadgrain.functions.columns import as_instant
from loadgrain.plans.scratch import new_folder

SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def stream_readings(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: list[str],
    delay: str,
    ts: str = "ts",
    file_filter: str | None = None,
    files_per_trigger: int = 1_000,
) -> DataFrame:
    """Parquet files as they arrive, without repeated (keys, ts).

    Wall-clock timestamps become instants in UTC, because watermarks need TIMESTAMP. Repeats
    are recognised while the watermark, ``delay`` behind the newest reading, has not passed
    them, so the state stays bounded.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    stream = reader.parquet(path)
    if isinstance(schema[ts].dataType, T.TimestampNTZType):
        stream = stream.withColumn(ts, as_instant(ts))
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([*keys, ts])


def run_available(stream: DataFrame, name: str) -> DataFrame:
    """Process what has arrived, write it to parquet in the shared folder and read it back."""
    spark = stream.sparkSession
    folder = new_folder(spark, name)
    with stream_settings(spark):
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", f"{folder}/data")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/data")


@contextmanager
def stream_settings(spark: SparkSession) -> Iterator[None]:
    """Session options a query should start with; they are put back afterwards.

    State goes to disk, as it may outgrow the heap and ``stream_events`` works with no other
    store. Sessions are merged before the shuffle, which a busy key needs.
    """
    before = {key: spark.conf.get(key) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
