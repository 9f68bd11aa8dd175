"""One query per operator on the driver's tables, checked against ``plans/oracle.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadgrain.functions.columns import as_wall_clock
from loadgrain.operators import evaluate, ingest, intervals, load, models, scaling, series, windows
from loadgrain.plans import readings as fx
from loadgrain.plans.readings import THRESHOLD, TIE, USER
from loadgrain.plans.scratch import new_folder
from loadgrain.plans.series_split import split_series
from loadgrain.sources.csv_batches import read_batches
from loadgrain.sources.readings_store import read_readings, write_readings
from loadgrain.streaming.events import stream_events
from loadgrain.streaming.readings import run_available, stream_readings
from loadgrain.streaming.windows import stream_windows


def r6(c: str | Column) -> Column:
    return F.round(c, 6)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


# load analysis


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.detect_events(fx.readings(spark, sf_dir), USER, THRESHOLD, tie=TIE).withColumnRenamed(
        "event_type", "label"
    )


def _signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.load_signatures(_events(spark, sf_dir), "label")


def detect_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        "user_id", "event_id", "ts", "label", "p_before", "p_after", r6("step").alias("step"), "direction"
    )


def load_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_signatures(spark, sf_dir), "mean_step", "std_step", "median_step")


def steady_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = load.steady_states(fx.readings(spark, sf_dir), USER, THRESHOLD, tie=TIE)
    return rounded(found, "mean_power", "std_power")


def transient_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = load.transient_features(
        fx.readings(spark, sf_dir), _events(spark, sf_dir), USER, "6 hours", "6 hours", tie=TIE
    )
    return rounded(found, "mean_before", "mean_after", "overshoot")


def pair_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = load.pair_cycles(_events(spark, sf_dir), USER, 0.2, tie=TIE, readings=fx.readings(spark, sf_dir))
    return rounded(found, "rise", "fall", "hours", "energy")


def match_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = load.match_signatures(_events(spark, sf_dir), _signatures(spark, sf_dir))
    return found.select("user_id", "event_id", "label", "direction", "matched_label", r6("distance").alias("distance"))


def _milli(c: Column) -> Column:
    return F.round(F.round(c, 2) * 1000).cast("bigint")


def disaggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.readings(spark, sf_dir)
    mains = rows.groupBy("user_id", F.window("ts", "1 hour")["start"].alias("hour")).agg(
        _milli(F.sum("power")).alias("total")
    )
    appliances = rows.groupBy(F.col("event_type").alias("label")).agg(_milli(F.avg("power")).alias("rated"))
    return load.disaggregate(mains, appliances)


# series


def resample_query(fill: str, every: str = "1 day") -> Callable[[SparkSession, str], DataFrame]:
    """A grid over the whole time of the readings."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = fx.readings(spark, sf_dir)
        first, last = rows.agg(F.min("ts"), F.max("ts")).first()
        return rounded(series.resample(rows, USER, every, str(first), str(last), fill=fill), "value")

    return query


def rollup_granularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settled(series.rollup_granularity(fx.readings(spark, sf_dir), ["user_id", "terminal_id"]))


def _settled(df: DataFrame) -> DataFrame:
    """Sums and means rounded; a mean half-way between two roundings goes up, whatever its last digits are."""
    return rounded(df, "sum").withColumn("mean", r6(F.col("mean") + 1e-9))


def row_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = windows.row_windows(fx.readings(spark, sf_dir), USER, 8, 4, tie=TIE)
    cents = F.transform("values", lambda x: F.round(x * 100).cast("bigint").cast("string"))
    return found.select("user_id", "window_no", "start_ts", F.array_join(cents, ",").alias("values_cents"))


def time_windows_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settled(windows.time_windows(fx.readings(spark, sf_dir), USER, "1 hour"))


def time_windows_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settled(windows.time_windows(fx.readings(spark, sf_dir), [], "1 day", "6 hours"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = series.features(fx.readings(spark, sf_dir), USER, [1, 2, 3], [4], tie=TIE)
    return rounded(
        found.drop("terminal_id", "event_type"), "diff_1", "diff_2", "diff_3", "roll_mean_4", "roll_std_4"
    )


def long_rolls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = series.long_rolls(fx.readings(spark, sf_dir), USER, 20, tie=TIE)
    return rounded(found.drop("terminal_id", "event_type"), "roll_mean_20", "roll_std_20")


def running(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = series.running(fx.readings(spark, sf_dir), USER, tie=TIE)
    # a mean half-way between two roundings goes up, whatever its last digits are
    return found.drop("terminal_id", "event_type").withColumn("run_mean", r6(F.col("run_mean") + 1e-9))


# ingest


def merge_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, sf_dir)[0].drop("priority", "terminal_id")


def merge_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, sf_dir)[1].drop("priority", "terminal_id")


def _merge(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return ingest.merge_batches(fx.batches(spark, sf_dir), ["user_id", "event_type"], F.col("priority"))


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.coverage(fx.readings(spark, sf_dir), ["terminal_id"])


def overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.overlap_pairs(fx.intervals(spark, sf_dir), ["key"])


def overlap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.overlap_counts(fx.intervals(spark, sf_dir), ["key"])


def merge_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.merge_intervals(fx.intervals(spark, sf_dir), ["key"])


CSV_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("power", T.DoubleType()),
    ]
)


def _csv_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Readings written as CSV batches per kind and week, in two column orders, then read back.

    Readings of kind ``error`` get a power that is no number.
    """
    folder = new_folder(spark, "batches")
    rows = fx.readings(spark, sf_dir).select(
        "event_id",
        "user_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("power").cast("string")).alias("power"),
        F.concat_ws("_", "event_type", F.date_format(F.date_trunc("week", "ts"), "yyyyMMdd")).alias("batch"),
    )
    orders = (["event_id", "user_id", "ts", "power"], ["power", "ts", "event_id", "user_id"])
    for i, order in enumerate(orders):
        part = rows.filter(F.col("event_id") % 2 == i).select(*order, "batch")
        part.hint("rebalance", F.col("batch")).write.partitionBy("batch").option("header", True).csv(f"{folder}/layout{i}")
    return read_batches(
        spark,
        [f"{folder}/layout{i}" for i in range(len(orders))],
        CSV_SCHEMA,
        r"batch=([a-z]+)_(\d{8})/",
        ["kind", "week"],
    )


def csv_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _csv_batches(spark, sf_dir)[0].drop("source_file")


def csv_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = _csv_batches(spark, sf_dir)[1]
    return rejected.groupBy("kind", "week", "reason").agg(F.count(F.lit(1)).alias("n"))


def stored_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "readings")
    rows = fx.readings(spark, sf_dir).select("user_id", "event_id", "ts", "power")
    write_readings(rows, folder, USER)
    return read_readings(spark, folder)


# scaling


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.split(fx.readings(spark, sf_dir), USER)


def fit_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scaling.fit_scaler(fx.readings(spark, sf_dir), "power", USER), "offset", "scale")


def apply_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.readings(spark, sf_dir).select("user_id", "event_id", "power")
    params = scaling.fit_scaler(rows, "power", USER)
    return rounded(scaling.apply_scaler(rows, params, "power", "scaled", USER), "scaled")


def apply_scaler_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _split(spark, sf_dir).select("event_id", "set", "power")
    params = scaling.fit_scaler(rows.filter(F.col("set") == "train"), "power", method=scaling.MINMAX)
    return rounded(scaling.apply_scaler(rows, params, "power", "scaled"), "scaled")


def dual_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input is the reading before, target the reading; ``restored`` inverts the target."""
    rows = _lagged(spark, sf_dir).filter(F.col("previous").isNotNull()).select("user_id", "event_id", "previous", "power")
    scaled, target = scaling.dual_scale(rows, "previous", "power", USER)
    restored = scaling.invert_scaler(scaled, target, "y_scaled", "restored", USER)
    return rounded(restored, "x_scaled", "y_scaled", "restored")


# modelling and evaluation


def _lagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with three predictions made from earlier readings of the same user."""
    rows = fx.readings(spark, sf_dir)
    order = ["ts", *TIE]
    back = split_series(rows, USER).with_lookback(order, ["power"], 3)
    w = back.window(order)
    three = w.rowsBetween(-3, -1)
    back = back.with_rows(
        back.rows.withColumns(
            {
                "previous": F.lag("power").over(w),
                "mean3": F.when(F.count("power").over(three) == 3, F.avg("power").over(three)),
            }
        )
    ).own_rows()
    so_far = back.with_carry(
        _sum=(F.sum("power"), F.sum, F.lit(0.0)), _n=(F.count("power"), F.sum, F.lit(0).cast("bigint"))
    )
    earlier = so_far.window(order).rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("power").over(earlier), F.lit(0.0)) + F.col("_sum")
    n = F.count("power").over(earlier) + F.col("_n")
    return so_far.with_rows(so_far.rows.withColumn("running", total / F.nullif(n, F.lit(0)))).finish().drop("_sum", "_n")


MODELS = ("previous", "mean3", "running")


def _predictions(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = MODELS) -> DataFrame:
    made = F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("predicted")) for m in names]))
    return (
        _lagged(spark, sf_dir)
        .select("user_id", "terminal_id", "ts", "event_id", F.col("power").alias("actual"), made)
        .filter(F.col("predicted").isNotNull())
    )


def split_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).select("event_id", "user_id", "set")


def split_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.split_by_time(fx.readings(spark, sf_dir)).select("event_id", "set")


def fit_linear_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = models.fit_linear(_lagged(spark, sf_dir), "power", "previous", USER)
    return rounded(fitted, "slope", "intercept", "r2")


def fit_linear_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(models.fit_linear(_lagged(spark, sf_dir), "power", "previous"), "slope", "intercept", "r2")


def metrics_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.metrics(_predictions(spark, sf_dir, ("previous",))), "mae", "rmse", "r2")


def metrics_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluate.metrics(_predictions(spark, sf_dir), ["model", "user_id"])
    return rounded(found, "mae", "rmse", "r2")


def metrics_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluate.metrics_by_level(_predictions(spark, sf_dir), ["user_id", "terminal_id"], ["model"])
    # a terminal has few readings, and its R2 may be in the thousands
    return rounded(found, "mae", "rmse").withColumn("r2", F.round("r2", 3))


def robust_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluate.robust_metrics(_predictions(spark, sf_dir, ("previous",)), 0.99)
    return rounded(found, "mae", "rmse", "r2", "mae_rel", "rmse_rel")


def robust_metrics_per_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluate.robust_metrics(_predictions(spark, sf_dir), 0.95, ["model"])
    return rounded(found, "mae", "rmse", "r2", "mae_rel", "rmse_rel")


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.compare_models(_predictions(spark, sf_dir), ["user_id", "ts"], list(MODELS))


def compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_compared(spark, sf_dir), "mae", "rmse", "r2")


def compare_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.dropped_keys(_predictions(spark, sf_dir), ["user_id", "ts"], list(MODELS))


def ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _compared(spark, sf_dir).select(F.col("model").alias("variant"), "mae", "rmse", "r2")
    deltas = evaluate.ablation(results, "running")
    return rounded(deltas, *[c for c in deltas.columns if c != "variant"])


LAGS = ["lag_1", "lag_2", "lag_3"]


def _lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.split(series.features(fx.readings(spark, sf_dir), USER, [1, 2, 3], [], tie=TIE), USER)


def fit_linear_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lag_features(spark, sf_dir)
    model = models.fit_linear_many(rows.filter(F.col("set") == "train"), "power", LAGS)
    return rounded(models.predict(model, rows, LAGS).select("event_id", "set", "power", "predicted"), "predicted")


def fit_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree of one split on the hour: with 24 values every split is tried, so SQL can find the best one."""
    rows = _lag_features(spark, sf_dir)
    model = models.fit_trees(rows.filter(F.col("set") == "train"), "power", ["hour"], maxIter=1, maxDepth=1)
    return rounded(models.predict(model, rows, ["hour"]).select("event_id", "set", "hour", "predicted"), "predicted")


def fit_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lag_features(spark, sf_dir)
    model = models.fit_trees(rows.filter(F.col("set") == "train"), "power", LAGS, maxIter=5, maxDepth=3)
    return models.predict(model, rows, LAGS).select("event_id", "set", "power", "predicted")


def _mean_model():
    return lambda batch: batch.mean(axis=1)


def score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = windows.row_windows(fx.readings(spark, sf_dir), USER, 8, 4, tie=TIE)
    return models.score(found, _mean_model).select("user_id", "window_no", r6("predicted").alias("predicted"))


def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lag_features(spark, sf_dir)
    return models.search(rows, "power", LAGS, {"regParam": [0.0, 0.1, 1.0], "elasticNetParam": [0.0, 0.5]})


def search_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid whose models have exact solutions, so that SQL can score them too."""
    rows = _lag_features(spark, sf_dir)
    found = models.search(rows, "power", LAGS, {"regParam": [0.0], "fitIntercept": [True, False]})
    return rounded(found, "mae", "rmse", "r2")


def search_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same grid, solved and scored from moments; the absolute errors take a second pass."""
    rows = _lag_features(spark, sf_dir)
    found = models.search_linear(rows, "power", LAGS, {"regParam": [0.0], "fitIntercept": [True, False]}, metric="mae")
    return rounded(found, "mae", "rmse", "r2")


# streaming


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # the table may be a file or a folder of part files
    stream = stream_readings(spark, f"{sf_dir}/events.parquet*", schema, ["user_id", "event_type"], "1 hour")
    return fx.as_readings(stream)


def stream_readings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = run_available(_stream(spark, sf_dir).select("event_id", "user_id", "ts", "power"), "stream_readings")
    return done.withColumn("ts", as_wall_clock("ts"))


def stream_windows_query(**window: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        done = run_available(stream_windows(_stream(spark, sf_dir), USER, **window), "stream_windows")
        both = {c: as_wall_clock(c) for c in ("window_start", "window_end")}
        return rounded(done.withColumns(both), "mean")

    return query


def stream_events_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stream_events(_stream(spark, sf_dir), USER, THRESHOLD, tie="event_id")
    return rounded(run_available(found, "stream_events").withColumn("ts", as_wall_clock("ts")), "step")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_batches": csv_batches,
    "csv_rejected": csv_rejected,
    "merge_batches": merge_batches,
    "merge_conflicts": merge_conflicts,
    "coverage": coverage,
    "overlap_pairs": overlap_pairs,
    "overlap_counts": overlap_counts,
    "merge_intervals": merge_intervals,
    "stored_readings": stored_readings,
    "resample_forward": resample_query("forward"),
    "resample_zero": resample_query("zero"),
    "resample_none": resample_query("none"),
    "resample_offset": resample_query("forward", "10 hours"),
    "resample_weekly": resample_query("zero", "7 days"),
    "rollup_granularity": rollup_granularity,
    "row_windows": row_windows,
    "time_windows_hourly": time_windows_hourly,
    "time_windows_sliding": time_windows_sliding,
    "features": features,
    "long_rolls": long_rolls,
    "running": running,
    "fit_scaler": fit_scaler,
    "apply_scaler": apply_scaler,
    "apply_scaler_train": apply_scaler_train,
    "dual_scale": dual_scale,
    "detect_events": detect_events,
    "steady_states": steady_states,
    "transient_features": transient_features,
    "load_signatures": load_signatures,
    "pair_cycles": pair_cycles,
    "match_signatures": match_signatures,
    "disaggregate": disaggregate,
    "split_entities": split_entities,
    "split_by_time": split_by_time,
    "fit_linear_per_user": fit_linear_per_user,
    "fit_linear_global": fit_linear_global,
    "fit_linear_many": fit_linear_many,
    "fit_trees": fit_trees,
    "fit_stump": fit_stump,
    "score": score,
    "search": search,
    "search_exact": search_exact,
    "search_linear": search_linear,
    "metrics_total": metrics_total,
    "metrics_per_user": metrics_per_user,
    "metrics_by_level": metrics_by_level,
    "robust_metrics": robust_metrics,
    "robust_metrics_per_model": robust_metrics_per_model,
    "compare_models": compare_models,
    "compare_dropped": compare_dropped,
    "ablation": ablation,
    "stream_readings": stream_readings_query,
    "stream_windows_hourly": stream_windows_query(size="1 hour"),
    "stream_windows_sliding": stream_windows_query(size="2 hours", slide="1 hour"),
    "stream_sessions": stream_windows_query(gap="30 minutes"),
    "stream_events": stream_events_query,
}
