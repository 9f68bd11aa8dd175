"""Overlaps and unions of half-open time intervals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadgrain.functions.columns import epoch_micros, join_null_safe
from loadgrain.plans.series_split import split_series
from loadgrain.plans.small import pin_small

# starts of one bin in a task; a bin with more is spread over several
BIN_ROWS = 100_000
# rows of the levels that go through the driver to all starts; there each takes several hundred bytes for a while
SMALL_ROWS = 100_000


def _valid(iv: DataFrame, key: list[str], interval_id: str, start: str, end: str) -> DataFrame:
    """``_id``, ``_start``, ``_end`` and their microseconds ``_s``, ``_e``; an invalid interval ends the job with an error."""
    invalid = F.raise_error(F.concat(F.lit("invalid interval "), F.coalesce(F.col(interval_id).cast("string"), F.lit("null"))))
    return iv.filter(F.when(F.col(start) <= F.col(end), F.lit(True)).otherwise(invalid.cast("boolean"))).select(
        *key,
        F.col(interval_id).alias("_id"),
        F.col(start).alias("_start"),
        F.col(end).alias("_end"),
        epoch_micros(iv, start).alias("_s"),
        epoch_micros(iv, end).alias("_e"),
    )


def overlap_pairs(
    iv: DataFrame,
    key: list[str],
    interval_id: str = "interval_id",
    start: str = "start",
    end: str = "end",
    bin_rows: int = BIN_ROWS,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Pairs of intervals of one key that overlap; touching ones do not.

    An interval that ends before it starts, or lacks an end, has no place among the pairs and ends the job
    with an error; ``invalid_intervals`` finds such rows.

    The later start of an overlapping pair lies inside the other interval. Intervals are dealt into levels by the power of
    two that their length reaches; the bins of a level are that long, so an interval lies in two bins of its level at most,
    and at least a quarter of the starts that it meets there are inside it, if they are spread evenly. Each start
    is looked up in its bin of every level that occurs. Levels with few intervals (``small_rows`` together) are sent to
    the starts. Starts meet the others on a shuffle, where a bin with many starts is spread
    over several tasks.
    """
    valid = _valid(iv, key, interval_id, start, end)
    length = F.col("_e") - F.col("_s")
    # bits of the length less one: 2**level is the first power of two that is not shorter
    longer = valid.filter(length > 0).withColumn("_level", F.length(F.bin(length - 1)))
    counts = sorted((r["n"], r["_level"]) for r in longer.groupBy("_level").agg(F.count(F.lit(1)).alias("n")).collect())
    few, total = [], 0
    for n, level in counts:
        total += 2 * n
        if total <= small_rows:
            few.append(level)
    many = [level for _, level in counts if level not in few]

    bin_of = lambda c: F.call_function("shiftright", F.col(c), F.col("_level"))
    on = [*key, "_level", "_bin"]
    covers = longer.withColumn("_bin", F.explode(F.array_distinct(F.array(bin_of("_s"), bin_of("_e")))))
    covers = covers.select(*on, *[F.col(c).alias(f"_a{c}") for c in ("_id", "_start", "_end")])
    met = []
    for levels, small in ((few, True), (many, False)):
        if not levels:
            continue
        at = F.explode(F.array(*[F.lit(level) for level in levels]))
        b = valid.withColumn("_level", at).withColumn("_bin", bin_of("_s"))
        b = b.select(*on, *[F.col(c).alias(f"_b{c}") for c in ("_id", "_start", "_end")])
        a = covers.filter(F.col("_level").isin(levels))
        if small:
            met.append(join_null_safe(b, pin_small(a, small_rows)[0], on))
        else:
            met.append(_meet_spread(b, a, on, bin_rows))
    if not met:
        met.append(join_null_safe(valid.select(*key, *[F.col(c).alias(f"_b{c}") for c in ("_id", "_start", "_end")]), covers, key))
    ordered = (F.col("_a_start") < F.col("_b_start")) | (
        (F.col("_a_start") == F.col("_b_start")) & (F.col("_a_id") < F.col("_b_id"))
    )
    overlap = (F.col("_b_start") < F.col("_a_end")) & (F.col("_a_start") < F.col("_b_end"))
    return (
        reduce(DataFrame.unionByName, met)
        .filter(ordered & overlap)
        .select(
            *key,
            F.least("_a_id", "_b_id").alias("id_a"),
            F.greatest("_a_id", "_b_id").alias("id_b"),
            F.col("_b_start").alias("overlap_start"),
            F.least("_a_end", "_b_end").alias("overlap_end"),
        )
    )


def _meet_spread(starts: DataFrame, covers: DataFrame, on: list[str], bin_rows: int) -> DataFrame:
    """Starts and covers of equal bins; a bin with more than ``bin_rows`` starts is dealt out, and its covers go to all parts."""
    full = starts.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > bin_rows)
    full, n_full = pin_small(full.select(*on, F.ceil(F.col("_n") / bin_rows).cast("int").alias("_parts")))
    if n_full == 0:
        return join_null_safe(starts, covers, on)
    parts = F.coalesce("_parts", F.lit(1))
    starts = join_null_safe(starts, full, on, "left").withColumn("_part", F.pmod(F.xxhash64("_b_id", "_b_start"), parts).cast("int"))
    covers = join_null_safe(covers, full, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return join_null_safe(starts.drop("_parts"), covers.drop("_parts"), [*on, "_part"]).drop("_part")


def overlap_counts(
    iv: DataFrame, key: list[str], interval_id: str = "interval_id", start: str = "start", end: str = "end"
) -> DataFrame:
    """For each interval how many others of its key it overlaps (``n_overlaps``), without making pairs.

    Overlaps and invalid intervals are those of ``overlap_pairs``; ``interval_id`` is unique within a key. An interval overlaps all
    that start before its end, less those that end by its start. Both are running counts over the starts and ends of a
    key in the order of time; a key of any size is cut into chunks of time. An empty interval counts those around it:
    others that are empty at the same moment start and end there, so they don't count.
    """
    valid = _valid(iv, key, interval_id, start, end)
    empty = F.col("_s") == F.col("_e")
    point = lambda at, us, opens: F.struct(
        F.col(at).alias("_at"), F.col(us).alias("_us"), F.lit(opens).alias("_opens")
    )
    points = valid.select(
        *key, "_id", empty.alias("_empty"), F.inline(F.array(point("_start", "_s", True), point("_end", "_e", False)))
    )
    one = lambda c: F.when(c, 1).otherwise(0).cast("bigint")
    points = points.withColumns(
        {
            "_starts": one(F.col("_opens")),
            "_ends": one(~F.col("_opens")),
            "_dots": one(F.col("_opens") & F.col("_empty")),
        }
    )
    series = split_series(points, key, "_at").with_carry(
        _opened=(F.sum("_starts"), F.sum, F.lit(0).cast("bigint")), _closed=(F.sum("_ends"), F.sum, F.lit(0).cast("bigint"))
    )
    by_time = series.window(["_us"])
    before = by_time.rangeBetween(Window.unboundedPreceding, -1)
    upto = by_time.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    here = by_time.rangeBetween(Window.currentRow, Window.currentRow)
    opened = F.coalesce(F.sum("_starts").over(before), F.lit(0)) + F.col("_opened")
    closed = F.sum("_ends").over(upto) + F.col("_closed")
    # what each of the two points of an interval adds; the interval itself is among those that start before its end
    adds = F.when(F.col("_opens"), -closed).when(F.col("_empty"), opened + F.sum("_dots").over(here)).otherwise(opened - 1)
    rows = series.with_rows(series.rows.withColumn("_adds", adds)).rows
    return rows.groupBy(*key, F.col("_id").alias(interval_id)).agg(F.sum("_adds").alias("n_overlaps"))


def invalid_intervals(iv: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Intervals without a start or end, or with the end before the start."""
    return iv.filter(~F.coalesce(F.col(start) <= F.col(end), F.lit(False)))


def merge_intervals(
    iv: DataFrame, key: list[str], interval_id: str = "interval_id", start: str = "start", end: str = "end"
) -> DataFrame:
    """Islands: unions of overlapping or touching intervals, with the gap before each.

    An interval opens an island when it starts after the end of everything before it.
    """
    order = [start, interval_id]
    no_time = F.lit(None).cast(iv.schema[end].dataType)
    series = split_series(iv, key, start).with_carry(_reached=(F.max(end), F.max, no_time))
    before = series.window(order).rowsBetween(Window.unboundedPreceding, -1)
    series = series.with_rows(
        series.rows.withColumn("_reached", F.greatest(F.max(end).over(before), F.col("_reached"))).withColumn(
            "_opens", F.when(F.coalesce(F.col(start) > F.col("_reached"), F.lit(True)), F.col(start))
        )
    ).with_carry(_opened=(F.max("_opens"), F.max, no_time))
    so_far = series.window(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        series.rows.withColumn("island_start", F.coalesce(F.max("_opens").over(so_far), F.col("_opened")))
        .groupBy(*key, "island_start")
        .agg(
            F.max(end).alias("island_end"),
            F.count(F.lit(1)).alias("n_intervals"),
            # what the opening interval found behind it is the end of the island before
            F.min(F.when(F.col("_opens").isNotNull(), F.col("_reached"))).alias("gap_start"),
        )
    )
