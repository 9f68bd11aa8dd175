"""Switching events on a stream whose readings may arrive out of order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

EVENT_GROUPS = 256


def stream_events(
    df: DataFrame,
    keys: list[str],
    threshold: float,
    ts: str = "ts",
    power: str = "power",
    tie: str | None = None,
    cell: str = "1 minute",
) -> DataFrame:
    """The events ``detect_events`` finds, from a watermarked stream.

    Readings wait in cells of time until the watermark has passed the cell. Then no earlier one
    can arrive; they are sorted and compared inside the cell. What remains per series is to
    compare the first reading of a cell with the last one before it, so only that pair and
    the events found go on, and a busy series is spread over its cells. Start the query
    inside ``stream_settings``.
    """
    tie_value = F.col(tie).cast("bigint") if tie else F.lit(0).cast("bigint")
    reading = F.struct(F.unix_micros(ts).alias("us"), tie_value.alias("tie"), F.col(power).alias("x"))
    closed = (
        df.groupBy(*keys, F.window(ts, cell).alias("_w"))
        .agg(F.array_sort(F.collect_list(reading)).alias("_r"))
        .withColumn("_size", F.size("_r"))
    )
    steps = F.zip_with(
        F.slice("_r", 1, F.col("_size") - 1),
        F.slice("_r", 2, F.col("_size") - 1),
        lambda a, b: _found(b["us"], a["x"], b["x"]),
    )
    events = F.filter(steps, lambda s: F.abs(s["p_after"] - s["p_before"]) >= threshold)
    opening = F.element_at("_r", 1)
    edge = _found(opening["us"], F.lit(None), opening["x"], F.element_at("_r", -1)["x"])
    rows = closed.select(
        *keys,
        F.explode(F.concat(F.array(edge), events)).alias("_e"),
        F.xxhash64(*keys, "_w").alias("_hash"),
    )
    # the edges of a series meet in a group of their own, where they have state; the events found
    # need none and pass in a few large groups. Text, as pandas turns bigint keys next to null
    # ones into floats, which would be other keys of the state
    is_edge = F.col("_e.is_edge")
    passing = F.concat(F.lit("event "), F.pmod("_hash", F.lit(EVENT_GROUPS)))
    group = F.when(is_edge, F.to_json(F.struct(*keys))).otherwise(passing)
    rows = rows.select(*keys, group.alias("_group"), "_e.*")
    out = T.StructType([*[df.schema[k] for k in keys], *[rows.schema[c] for c in ("us", "p_before", "p_after")]])
    return (
        rows.groupBy("_group")
        .transformWithStateInPandas(_CompareEdges(out.names, threshold), out, "append", "None")
        .select(
            *keys,
            F.timestamp_micros("us").alias("ts"),
            "p_before",
            "p_after",
            (F.col("p_after") - F.col("p_before")).alias("step"),
            F.when(F.col("p_after") > F.col("p_before"), "rise").otherwise("fall").alias("direction"),
        )
    )


def _found(us, p_before, p_after, closing=None):
    return F.struct(
        us.alias("us"),
        p_before.cast("double").alias("p_before"),
        p_after.cast("double").alias("p_after"),
        (F.lit(None) if closing is None else closing).cast("double").alias("closing"),
        F.lit(closing is not None).alias("is_edge"),
    )


class _CompareEdges(StatefulProcessor):
    """Passes events by; for the edges of a series, keeps the last reading of the newest cell."""

    def __init__(self, columns: list[str], threshold: float):
        self.columns, self.threshold = columns, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "last double")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0].startswith("event"):
            for batch in rows:
                yield batch[self.columns]
            return
        # cells that close later are later cells, so every batch continues the one before
        edges = pd.concat(list(rows)).sort_values("us")
        last = self.last.get()[0] if self.last.exists() else np.nan
        before = np.concatenate([[last], edges["closing"].to_numpy()])
        edges["p_before"] = before[:-1]
        self.last.update((float(before[-1]),))
        yield edges.loc[np.abs(edges["p_after"] - edges["p_before"]) >= self.threshold, self.columns]

    def close(self) -> None:
        pass
