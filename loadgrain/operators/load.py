"""Switching events, steady states, load signatures and disaggregation."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadgrain.functions.columns import elapsed, epoch_micros, join_null_safe, seconds
from loadgrain.functions.quantile import exact_quantile
from loadgrain.plans.half_sums import HalfSums
from loadgrain.plans.near_pieces import rows_with_keys
from loadgrain.plans.series_split import Series, split_series
from loadgrain.plans.signature_index import Signatures
from loadgrain.plans.small import MAX_BROADCAST_ROWS, pin_small, stored

RISE, FALL = "rise", "fall"
# readings that a cell of time should hold where transients are sought, and bins of one level in one of the next
CELL_ROWS = 16
FAN_BITS = 2
FAN = 1 << FAN_BITS
# appliances up to which all states are listed, and the most there may be
HALVED, MOST_APPLIANCES = 12, 40
# signatures up to which an event is compared with each
SCANNED = 64


def _with_steps(df: DataFrame, keys: list[str], ts: str, power: str, tie: tuple[str, ...]) -> Series:
    order = [ts, *tie]
    series = split_series(df, keys, ts).with_lookback(order, [power], 1)
    before = F.lag(power).over(series.window(order))
    rows = series.rows.withColumn("p_before", before).withColumn("step", F.col(power) - F.col("p_before"))
    return series.with_rows(rows)


def detect_events(
    df: DataFrame,
    keys: list[str],
    threshold: float,
    ts: str = "ts",
    power: str = "power",
    tie: tuple[str, ...] = (),
) -> DataFrame:
    """Readings that differ from the one before by at least ``threshold``, as rise or fall.

    A null reading has no step, and neither has the reading after it: a change that falls into a gap is not
    dated. Filter nulls out first to compare across them. ``stream_events`` does the same. ``tie`` orders readings of the same timestamp.
    """
    steps = _with_steps(df, keys, ts, power, tie).finish()
    return (
        steps.filter(F.abs("step") >= threshold)
        .withColumn("direction", F.when(F.col("step") > 0, RISE).otherwise(FALL))
        .withColumnRenamed(power, "p_after")
    )


def steady_states(
    df: DataFrame,
    keys: list[str],
    threshold: float,
    ts: str = "ts",
    power: str = "power",
    tie: tuple[str, ...] = (),
) -> DataFrame:
    """Runs of readings between two events: first and last ts, size, mean and deviation."""
    series = _with_steps(df, keys, ts, power, tie).own_rows()
    switches = F.when(F.abs("step") >= threshold, 1).otherwise(0).cast("bigint")
    series = series.with_rows(series.rows.withColumn("_event", switches)).with_carry(
        _before=(F.sum("_event"), F.sum, F.lit(0).cast("bigint"))
    )
    so_far = series.window([ts, *tie]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    segment = F.sum("_event").over(so_far) + F.col("_before")
    return (
        series.rows.withColumn("segment", segment)
        .groupBy(*keys, "segment")
        .agg(
            F.min(ts).alias("start_ts"),
            F.max(ts).alias("end_ts"),
            F.count(F.lit(1)).alias("n"),
            F.avg(power).alias("mean_power"),
            F.stddev_pop(power).alias("std_power"),
        )
    )


def transient_features(
    df: DataFrame,
    events: DataFrame,
    keys: list[str],
    before: str,
    after: str,
    ts: str = "ts",
    power: str = "power",
    tie: tuple[str, ...] = (),
) -> DataFrame:
    """Count, min, max and mean of the power around each event of ``df``, and the overshoot.

    The frames ``[ts - before, ts]`` and ``[ts, ts + after]`` both include the event's reading. Readings in pieces of time
    that no event looks into go before anything is counted or shuffled.

    Time is cut into cells of about ``CELL_ROWS`` readings, a cell with many more again, and totals are kept of cells, of ``FAN``
    cells, of ``FAN`` of those, and so on. A frame is made of a few such totals, as in a tree, and of the readings
    in the cells where it begins and ends, so an event meets some dozens of rows however many its frames hold.
    """
    back, ahead = round(seconds(before) * 1e6), round(seconds(after) * 1e6)
    who = [*keys, ts, *tie]
    start, at, end = F.col("_at") - back, F.col("_at"), F.col("_at") + ahead
    # narrow, and read twice: for the pieces that matter and for the frames
    moments = stored(events.select(*who, epoch_micros(events, ts).alias("_at")), "transient-events")
    top = _level(max(back, ahead, 1))
    piece = lambda us: _bin(us, top).alias("_piece")
    readings = df.filter(F.col(power).isNotNull()).select(*keys, epoch_micros(df, ts).alias("_us"), F.col(power).alias("_x"))
    pieces = moments.select(*keys, F.explode(F.array(*[_bin(us, top) for us in (start, at, end)])).alias("_piece"))
    readings = rows_with_keys(readings.select("*", piece(F.col("_us"))), pieces, [*keys, "_piece"])

    sizes = readings.groupBy(*keys, "_piece").agg(F.count(F.lit(1)).alias("_n")).agg(F.avg("_n").alias("mean")).first()
    base = max(top - _level(max(int((sizes["mean"] or 1) / CELL_ROWS), 1)), 0)
    cell = lambda us: _bin(us, base)
    readings = readings.drop("_piece").withColumn("_cell", cell(F.col("_us")))
    by_cell = [*keys, "_cell"]
    finer = F.least(F.lit(base), F.ceil(F.log2(F.col("_n") / CELL_ROWS) / 2)).cast("int")
    dense = (
        readings.groupBy(*by_cell)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > CELL_ROWS * FAN)
        .select(*by_cell, finer.alias("_finer"))
    )
    dense, n_dense = pin_small(dense)
    deepest = 0 if n_dense == 0 else dense.agg(F.max("_finer")).first()[0] or 0
    # the level of the smallest bins of a cell
    leveled = lambda rows: (
        rows.withColumn("_level", F.lit(base))
        if n_dense == 0
        else join_null_safe(rows, dense, by_cell, "left")
        .withColumn("_level", F.lit(base) - F.coalesce("_finer", F.lit(0)))
        .drop("_finer")
    )
    by_bin = [*keys, "_level", "_bin"]
    sums = [
        F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")
    ]
    facts = leveled(readings).select(
        *keys,
        "_level",
        _bin(F.col("_us"), F.col("_level")).alias("_bin"),
        F.lit(True).alias("_single"),
        "_us",
        F.lit(1).cast("bigint").alias("_n"),
        *[F.col("_x").alias(c) for c in ("_sum", "_lo", "_hi")],
    )
    upper = F.transform(
        F.sequence(F.col("_level"), F.lit(top)),
        lambda k: F.struct(k.alias("_level"), _bin(F.col("_bin"), k - F.col("_level")).alias("_bin")),
    )
    totals = (
        facts.groupBy(*by_bin)
        .agg(*sums)
        .select(*keys, "_n", "_sum", "_lo", "_hi", F.inline(upper))
        .groupBy(*by_bin)
        .agg(*sums)
        .withColumn("_single", F.lit(False))
    )
    facts = facts.unionByName(totals, allowMissingColumns=True)

    asked = leveled(moments.withColumn("_cell", F.explode(F.array_distinct(F.array(cell(start), cell(at), cell(end))))))
    level, first_us, last_us = F.col("_level"), _begin(F.col("_cell"), base), _begin(F.col("_cell") + 1, base) - 1
    wanted, singles = [], []
    for side, begin, stop in (("before", start, at), ("after", at, end)):
        touched = F.col("_cell").between(cell(begin), cell(stop))
        lo, hi = (_bin(us, level) for us in (F.greatest(begin, first_us), F.least(stop, last_us)))
        singles += [(touched, lo), (touched, hi)]
        # bins inside the cell, then the cells between, which only the row of the event's own cell asks for
        wanted.append(_wanted(level, lo + 1, F.when(touched, hi).otherwise(lo), deepest, False, side))
        own = F.when(F.col("_cell") == cell(at), cell(stop)).otherwise(cell(begin))
        wanted.append(_wanted(F.lit(base), cell(begin) + 1, own, top - base, False, side))
    # the bins where the frames begin and end, in the order of time and each once
    before = None
    for wants, number in singles:
        new = wants if before is None else wants & F.coalesce(number > before, F.lit(True))
        wanted.append(_wanted(level, number, F.when(new, number + 1).otherwise(number), 0, True, "both"))
        now = F.when(wants, number)
        before = now if before is None else F.coalesce(now, before)
    joined = _covering(asked.select(*who, "_at", F.inline(F.array(*wanted))))
    joined = join_null_safe(joined, facts, [*by_bin, "_single"])

    aggs = []
    for side, begin, stop in (("before", start, at), ("after", at, end)):
        counts = (F.col("_side") == side) | (F.col("_single") & F.col("_us").between(begin, stop))
        n, total = F.sum(F.when(counts, F.col("_n"))), F.sum(F.when(counts, F.col("_sum")))
        aggs += [
            n.alias(f"n_{side}"),
            F.min(F.when(counts, F.col("_lo"))).alias(f"min_{side}"),
            F.max(F.when(counts, F.col("_hi"))).alias(f"max_{side}"),
            (total / n).alias(f"mean_{side}"),
        ]
    return joined.groupBy(*who).agg(*aggs).withColumn("overshoot", F.col("max_after") - F.col("mean_after"))


def _level(width: int) -> int:
    """The first level whose bins hold ``width`` microseconds or bins."""
    return next(k for k in range(64) if FAN**k >= width)


def _bin(number: Column, level: Column | int) -> Column:
    """The bin of a microsecond, or of a bin of level 0, ``level`` levels up; exact for negative numbers too."""
    return F.call_function("shiftright", number, (F.lit(level) * FAN_BITS).cast("int"))


def _begin(number: Column, level: int) -> Column:
    return F.call_function("shiftleft", number, F.lit(level * FAN_BITS))


def _wanted(level: Column, lo: Column, hi: Column, above: int, single: bool, side: str) -> Column:
    """Bins ``lo`` to ``hi - 1`` of a level, or totals of up to ``above`` levels more that make them up."""
    return F.struct(
        level.cast("int").alias("_level"),
        lo.alias("_lo"),
        hi.alias("_hi"),
        F.lit(above).alias("_above"),
        F.lit(single).alias("_single"),
        F.lit(side).alias("_side"),
    )


def _covering(ranges: DataFrame) -> DataFrame:
    """``_level`` and ``_bin`` of the bins that together make up ``_lo`` to ``_hi - 1`` of ``_level``, a few of each level.

    Of a level those bins are taken that lie in no whole bin of the next: some at the beginning and some at the end.
    """
    k, lo, hi = F.col("_k"), F.col("_lo"), F.col("_hi")
    up = lambda number, by: _bin(number + _shifted(F.lit(1).cast("bigint"), by) - 1, by)
    a, b = up(lo, k), _bin(hi, k)
    c, d = _shifted(up(lo, k + 1), F.lit(1)), _shifted(_bin(hi, k + 1), F.lit(1))
    each = ranges.filter("_lo < _hi").withColumn("_k", F.explode(F.sequence(F.lit(0), "_above")))
    each = each.withColumns({"_a": a, "_b": b, "_c": c, "_d": d}).filter("_a < _b")
    inner = (k < F.col("_above")) & (F.col("_c") < F.col("_d"))
    parts = F.array(
        F.struct(F.col("_a").alias("_from"), F.when(inner, F.col("_c")).otherwise(F.col("_b")).alias("_to")),
        F.struct(F.when(inner, F.col("_d")).otherwise(F.col("_b")).alias("_from"), F.col("_b").alias("_to")),
    )
    rest = [c for c in ranges.columns if c not in ("_level", "_lo", "_hi", "_above")]
    each = each.select(*rest, (F.col("_level") + k).alias("_level"), F.inline(parts)).filter("_from < _to")
    return each.withColumn("_bin", F.explode(F.sequence(F.col("_from"), F.col("_to") - 1))).drop("_from", "_to")


def _shifted(number: Column, levels: Column) -> Column:
    return F.call_function("shiftleft", number, (levels * FAN_BITS).cast("int"))


def load_signatures(events: DataFrame, label: str, step: str = "step") -> DataFrame:
    """Number, mean, deviation and median of the step per label and direction."""
    by = [label, "direction"]
    moments = events.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(step).alias("mean_step"), F.stddev_samp(step).alias("std_step")
    )
    medians = exact_quantile(events, by, step, 0.5, "median_step")
    return join_null_safe(moments, medians, by, "left").withColumnRenamed(label, "label")


def pair_cycles(
    events: DataFrame,
    keys: list[str],
    tol: float,
    ts: str = "ts",
    tie: tuple[str, ...] = (),
    readings: DataFrame | None = None,
) -> DataFrame:
    """On/off cycles: a rise whose next event is a fall of about the same size.

    ``energy`` is step times hours. ``readings``, from which the events came, spares counting
    the events.
    """
    order = [ts, *tie]
    series = split_series(events, keys, ts, sized_by=readings).with_lookback(order, ["step"], 1)
    w = series.window(order)
    rows = series.rows.withColumns({"on_ts": F.lag(ts).over(w), "rise": F.lag("step").over(w)})
    hours = elapsed(F.col("on_ts"), F.col("off_ts")).cast("double") / 3600
    return (
        series.with_rows(rows)
        .finish()
        .filter((F.col("rise") > 0) & (F.col("step") < 0) & (F.abs(F.col("rise") + F.col("step")) <= tol * F.col("rise")))
        .select(*keys, "on_ts", F.col(ts).alias("off_ts"), "rise", F.col("step").alias("fall"))
        .withColumn("hours", hours)
        .withColumn("energy", F.col("rise") * F.col("hours"))
    )


def match_signatures(
    events: DataFrame, signatures: DataFrame, scanned: int = SCANNED, indexed: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """The signature of the same direction nearest to each step, in units of its deviation.

    Distances are rounded to 9 places; ties go to the smallest label. Signatures without a deviation, mean or direction
    cannot be measured against and never match, and neither do events without a step.

    Up to ``scanned`` signatures travel to the events as one array per direction and each is compared. More of them form a
    search index (``plans/signature_index.py``) that is sent to every task, ``indexed`` signatures at most: an event is
    compared with the few that may be nearest. If there are more, the distinct steps go through one index after the other, and
    the events meet their results on the shuffle.
    """
    usable = signatures.filter((F.col("std_step") > 0) & F.col("mean_step").isNotNull() & F.col("direction").isNotNull())
    # of equal signatures the smallest label wins
    usable = usable.groupBy("direction", F.col("mean_step").cast("double").alias("mean_step"), F.col("std_step").cast("double").alias("std_step"))
    usable = usable.agg(F.min("label").alias("label")).select("direction", "label", "mean_step", "std_step")
    known, n_known = pin_small(usable, indexed)
    result = [F.col("_best.label").alias("matched_label"), F.col("_best.distance").alias("distance")]
    if n_known is not None and n_known <= scanned:
        signature = F.collect_list(F.struct("label", "mean_step", "std_step")).alias("_near")
        arrays = F.broadcast(known.groupBy("direction").agg(signature))
        return events.join(arrays, "direction", "left").withColumn("_best", _nearest()).select(*events.columns, *result)
    if n_known is not None:
        found = events.withColumn("_near", _finalists(known)("direction", "step")).withColumn("_best", _nearest())
        return found.select(*events.columns, *result)
    return _match_in_parts(events, known, indexed).select(*events.columns, *result)


def _nearest() -> Column:
    """The nearest of ``_near``: its distance and label."""
    distance = lambda s: F.round(F.abs(F.col("step") - s["mean_step"]) / s["std_step"], 9)
    each = F.transform("_near", lambda s: F.struct(distance(s).alias("distance"), s["label"].alias("label")))
    return F.when(F.col("step").isNotNull(), F.array_min(each))


def _finalists(known: DataFrame):
    """A function of direction and step that gives the signatures that may be nearest."""
    index = known.sparkSession.sparkContext.broadcast(Signatures(known.toArrow()))
    kinds = {f.name: f.dataType for f in known.schema}
    fields = [T.StructField(c, kinds[c]) for c in ("label", "mean_step", "std_step")]

    @F.arrow_udf(T.ArrayType(T.StructType(fields)))
    def finalists(direction: pa.Array, step: pa.Array) -> pa.Array:
        return index.value.finalists(direction, step)

    return finalists


def _match_in_parts(events: DataFrame, known: DataFrame, indexed: int) -> DataFrame:
    """``events`` with ``_best``, from the distinct steps and one index for each ``indexed`` signatures or fewer."""
    parts = -(-known.count() // max(indexed // 2, 1))
    part = F.pmod(F.xxhash64("direction", "mean_step", "std_step"), F.lit(parts))
    dealt = stored(known.withColumn("_part", part), "signatures")
    steps = stored(events.select("direction", "step").filter(F.col("step").isNotNull()).distinct(), "signature-steps")
    best = None
    for i in range(parts):
        own = dealt.filter(F.col("_part") == i).drop("_part")
        found = steps if best is None else best
        found = found.withColumn("_near", _finalists(own)("direction", "step")).withColumn("_now", _nearest()).drop("_near")
        # the smaller distance, then the smaller label; a part without a signature of the direction gives null
        found = found.withColumn("_best", F.col("_now") if best is None else F.least("_best", "_now")).drop("_now")
        best = stored(found, "signature-best")
    return join_null_safe(events, best, ["direction", "step"], "left")


def disaggregate(
    mains: DataFrame,
    appliances: DataFrame,
    total: str = "total",
    label: str = "label",
    rated: str = "rated",
    k_max: int = 12,
) -> DataFrame:
    """The on/off state of the appliances whose rated sum is nearest to each total.

    Combinatorial disaggregation after Hart, Proc. IEEE 80(12), 1992. Totals and ratings are
    integers, for example milliwatts, so ties are exact: fewer appliances on, then the lower
    state. Bit i of ``state`` is the i-th appliance by label. More than ``k_max`` appliances are refused; ``k_max`` may be
    set up to ``MOST_APPLIANCES``.

    Up to 12 appliances, the sums of all states are sorted once and every total finds its neighbours among them by
    halving, without a join. More are split into two halves by label, whose sums are sorted each (Horowitz and
    Sahni, 1974): distinct totals walk up one table and down the other, so 30 appliances take 65,536 steps and not a billion.
    """
    if not 0 < k_max <= MOST_APPLIANCES:
        raise ValueError(f"k_max must be between 1 and {MOST_APPLIANCES}")
    rows = appliances.select(label, rated).orderBy(label).limit(k_max + 1).collect()
    k = len(rows)
    if k > k_max:
        raise ValueError(f"more than {k_max} appliances")
    if k == 0:
        raise ValueError("no appliances")
    if k > HALVED:
        return _disaggregate_by_halves(mains, [int(r[1]) for r in rows], total)
    spark = mains.sparkSession
    bit = lambda i: F.shiftright(F.col("id"), i).bitwiseAND(F.lit(1))
    sums = reduce(lambda a, b: a + b, [bit(i) * F.lit(int(r[1])) for i, r in enumerate(rows)])
    states = (
        spark.range(1 << k)
        .select(sums.alias("sum"), F.struct(F.bit_count("id").alias("n_on"), F.col("id").alias("state")).alias("s"))
        .groupBy("sum")
        .agg(F.min("s").alias("s"))
        .orderBy("sum")
        .select("sum", "s.state")
        .collect()
    )
    # constants of at most 2**k_max numbers
    numbers = lambda i: F.split(F.lit(",".join(str(r[i]) for r in states)), ",").cast("array<bigint>")
    known, ids = numbers(0), numbers(1)
    halves = F.array(*[F.lit(1 << i) for i in reversed(range(len(states).bit_length()))])
    value = F.col(total)
    # how many sums are at most the total
    position = F.aggregate(
        halves,
        F.lit(0),
        lambda at, jump: F.when(
            (at + jump <= len(states)) & (F.get(known, at + jump - 1) <= value), at + jump
        ).otherwise(at),
    )
    candidates = F.array(F.greatest(F.col("_at") - 1, F.lit(0)), F.least(F.col("_at"), F.lit(len(states) - 1)))
    best = F.array_min(
        F.transform(
            candidates,
            lambda i: F.struct(
                F.abs(value - F.get(known, i)).alias("error"),
                F.bit_count(F.get(ids, i)).alias("n_on"),
                F.get(ids, i).alias("state"),
            ),
        )
    )
    return (
        mains.withColumn("_at", position)
        .withColumn("_best", best)
        .select(*mains.columns, "_best.state", "_best.n_on", "_best.error")
    )


def _disaggregate_by_halves(mains: DataFrame, rated: list[int], total: str) -> DataFrame:
    """Each distinct total is solved once; totals meet their states on the shuffle."""
    tables = mains.sparkSession.sparkContext.broadcast(HalfSums(rated))

    @F.arrow_udf("state bigint, n_on int, error bigint")
    def nearest(totals: pa.Array) -> pa.Array:
        state, error = tables.value.nearest(totals.to_numpy(zero_copy_only=False).astype(np.int64))
        arrays = [pa.array(state), pa.array(np.bitwise_count(state).astype(np.int32)), pa.array(error)]
        return pa.StructArray.from_arrays(arrays, names=["state", "n_on", "error"])

    wanted = mains.select(F.col(total).cast("bigint").alias("_total")).filter("_total is not null").distinct()
    solved = wanted.withColumn("_best", nearest("_total"))
    met = mains.join(solved, F.col(total) == F.col("_total"), "left")
    return met.select(*mains.columns, "_best.state", "_best.n_on", "_best.error")
