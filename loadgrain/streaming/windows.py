"""Window aggregates on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_windows(
    df: DataFrame,
    keys: list[str],
    size: str | None = None,
    slide: str | None = None,
    gap: str | None = None,
    ts: str = "ts",
    value: str = "power",
) -> DataFrame:
    """Number, mean, min and max per window of a watermarked stream, in append mode.

    Tumbling with ``size``, sliding with ``size`` and ``slide``, sessions with ``gap``. A window is
    written once the watermark has passed its end; readings that come later are dropped.
    """
    if (size is None) == (gap is None):
        raise ValueError("give either size or gap")
    frame = F.session_window(ts, gap) if gap else F.window(ts, size, slide)
    return (
        df.groupBy(*keys, frame.alias("_w"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(value).alias("mean"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )
        .select(
            *keys,
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            "n",
            "mean",
            "min",
            "max",
        )
    )
