"""Column helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def elapsed(start: Column, end: Column) -> Column:
    """Seconds between two timestamps of one type, as decimal with microseconds.

    Subtracting keeps TIMESTAMP_NTZ free of the session time zone, which
    ``timestampdiff`` does not.
    """
    return (end - start).cast("decimal(20,6)")


def epoch_seconds(df: DataFrame, ts: str) -> Column:
    """Whole seconds since 1970 as bigint, for TIMESTAMP and TIMESTAMP_NTZ alike."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return (F.col(ts) - F.expr(EPOCH)).cast("bigint")
    return F.unix_seconds(F.col(ts))


def epoch_micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970 as bigint, for TIMESTAMP and TIMESTAMP_NTZ alike."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return (elapsed(F.expr(EPOCH), F.col(ts)) * 1_000_000).cast("bigint")
    return F.unix_micros(F.col(ts))


def floor_div(number: Column, width: Column | int) -> Column:
    """Whole number of ``width`` below an integer, exact for negative ones too."""
    width = F.lit(width) if isinstance(width, int) else width
    return ((number - F.pmod(number, width)) / width).cast("bigint")


def as_instant(ts: str) -> Column:
    """TIMESTAMP of a TIMESTAMP_NTZ read as UTC, whatever the session time zone."""
    return F.timestamp_micros((elapsed(F.expr(EPOCH), F.col(ts)) * 1_000_000).cast("bigint"))


def as_wall_clock(ts: str) -> Column:
    """The inverse of ``as_instant``."""
    secs = (F.unix_micros(ts).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.expr(EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def interval(text: str) -> Column:
    """Interval literal from text such as ``6 hours``."""
    return F.expr(f"INTERVAL '{text}'")


def grid_start(spark: SparkSession, moment: str, every: str, kind: T.DataType) -> Column:
    """Start of the bucket of ``every`` that holds ``moment``; buckets are aligned with 1970.

    A moment for TIMESTAMP is read in the session time zone unless it names one, and buckets are aligned in UTC.
    """
    at = pd.Timestamp(moment)
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(str(_floored(at.tz_localize(None), every))).cast(kind)
    at = at.tz_localize(spark.conf.get("spark.sql.session.timeZone")) if at.tzinfo is None else at
    at = _floored(at.tz_convert("UTC").tz_localize(None), every)
    return F.timestamp_micros(F.lit((at - pd.Timestamp(0)) // pd.Timedelta(microseconds=1)))


def _floored(at: pd.Timestamp, every: str) -> pd.Timestamp:
    return at - (at - pd.Timestamp(0)) % pd.Timedelta(every)


def seconds(text: str) -> float:
    """Length of a duration such as ``6 hours``."""
    return pd.Timedelta(text).total_seconds()


def hash_bucket(seed: int, *ids: str, buckets: int = 100) -> Column:
    """Bucket of an entity that depends on its id and the seed only, never on partitioning."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; keeps the left key columns."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in on])
