"""The queries of ``plans/queries.py`` as SQL for DuckDB, on the driver's tables."""

from __future__ import annotations

READINGS = """r AS (
    SELECT user_id, concat_ws('-', user_id, event_type) AS terminal_id, ts, value AS power, event_id, event_type
    FROM events)"""

STEPS = (
    READINGS
    + """,
s AS (
    SELECT *, lag(power) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p_before,
           power - lag(power) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step
    FROM r),
e AS (
    SELECT user_id, event_id, ts, event_type AS label, p_before, power AS p_after, step,
           CASE WHEN step > 0 THEN 'rise' ELSE 'fall' END AS direction
    FROM s WHERE abs(step) >= 100)"""
)

SIGNATURES = (
    STEPS
    + """,
sig AS (
    SELECT label, direction, count(*) AS n, avg(step) AS mean_step, stddev_samp(step) AS std_step,
           quantile_cont(step, 0.5) AS median_step
    FROM e GROUP BY ALL)"""
)

INTERVALS = """iv AS (
    SELECT user_id AS key, event_id AS interval_id, ts AS "start",
           ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS "end"
    FROM events)"""

BATCHES = """b AS (
    SELECT user_id, ts, value AS power, event_id, event_type, 'batch1' AS batch_id,
           'batch1.csv' AS source_file, 1 AS priority FROM events WHERE event_id % 3 <> 0
    UNION ALL
    SELECT user_id, ts, value, event_id, event_type, 'batch2', 'batch2.csv', 2 FROM events WHERE event_id % 3 <> 1),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type, ts ORDER BY priority DESC, source_file) AS k
    FROM b)"""

ROW_WINDOWS = (
    READINGS
    + """,
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rn FROM r),
x AS (
    SELECT *, unnest(range(CAST(greatest(0, ceil((rn - 7) / 4.0)) AS BIGINT), CAST(floor(rn / 4.0) AS BIGINT) + 1))
           AS window_no
    FROM n),
w AS (
    SELECT user_id, window_no, min(ts) AS start_ts, list(power ORDER BY rn) AS "values"
    FROM x GROUP BY user_id, window_no HAVING count(*) = 8)"""
)

LAGGED = (
    READINGS
    + """,
l AS (
    SELECT *, lag(power) OVER w AS previous,
           CASE WHEN count(power) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 3
                THEN avg(power) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END AS mean3,
           avg(power) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS running
    FROM r WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
p AS (
    SELECT 'previous' AS model, user_id, ts, power AS actual, previous AS predicted FROM l
    UNION ALL SELECT 'mean3', user_id, ts, power, mean3 FROM l
    UNION ALL SELECT 'running', user_id, ts, power, running FROM l),
q AS (SELECT * FROM p WHERE predicted IS NOT NULL)"""
)

METRICS = """count(*) AS n, round(avg(abs(actual - predicted)), 6) AS mae,
    round(sqrt(avg((actual - predicted) ** 2)), 6) AS rmse,
    round(1 - sum((actual - predicted) ** 2) / nullif(sum((actual - m) ** 2), 0), 6) AS r2"""

COMPARED = (
    LAGGED
    + """,
seen AS (SELECT user_id, ts FROM q GROUP BY user_id, ts HAVING count(DISTINCT model) = 3),
common AS (SELECT q.* FROM q JOIN seen USING (user_id, ts)),
centred AS (SELECT *, avg(actual) OVER (PARTITION BY model) AS m FROM common),
kept AS (
    SELECT model, count(*) AS n, avg(abs(actual - predicted)) AS mae, sqrt(avg((actual - predicted) ** 2)) AS rmse,
           1 - sum((actual - predicted) ** 2) / nullif(sum((actual - m) ** 2), 0) AS r2
    FROM centred GROUP BY model)"""
)

SCALERS = """f AS (
    SELECT user_id, avg(value) AS "offset", stddev_pop(value) AS scale, count(value) AS n
    FROM events GROUP BY user_id)"""

SPLIT = """sp AS (
    SELECT event_id, user_id, value AS power,
           ('0x' || substr(md5(concat('42:', user_id)), 1, 8))::BIGINT % 100 AS bucket
    FROM events),
sets AS (
    SELECT event_id, user_id, power,
           CASE WHEN bucket < 70 THEN 'train' WHEN bucket < 85 THEN 'val' ELSE 'test' END AS "set"
    FROM sp)"""

LAG_ROWS = (
    READINGS
    + f""",
{SPLIT},
x AS (
    SELECT event_id, power AS y, hour(ts) AS hour, lag(power, 1) OVER w AS x1, lag(power, 2) OVER w AS x2, lag(power, 3) OVER w AS x3
    FROM r WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
lagged AS (SELECT x.*, "set" FROM x JOIN sets USING (event_id)),
train AS (SELECT * FROM lagged WHERE "set" = 'train' AND y IS NOT NULL AND x1 + x2 + x3 IS NOT NULL)"""
)


def _solved(name: str, intercept: bool) -> str:
    """Least squares on three lags by Cramer's rule; without an intercept nothing is centred."""
    of = lambda c: f"({c} - m.{c}m)" if intercept else c
    pairs = [("x1", "x1"), ("x1", "x2"), ("x1", "x3"), ("x2", "x2"), ("x2", "x3"), ("x3", "x3"), ("x1", "y"), ("x2", "y"), ("x3", "y")]
    sums = ", ".join(f"sum({of(a)} * {of(b)}) AS {a}{b}" for a, b in pairs)
    rows = [["x1x1", "x1x2", "x1x3"], ["x1x2", "x2x2", "x2x3"], ["x1x3", "x2x3", "x3x3"]]

    def det(m: list[list[str]]) -> str:
        (a, b, c), (d, e, f), (g, h, i) = m
        return f"({a}*({e}*{i} - {f}*{h}) - {b}*({d}*{i} - {f}*{g}) + {c}*({d}*{h} - {e}*{g}))"

    right = ["x1y", "x2y", "x3y"]
    with_right = [[[right[r] if c == k else rows[r][c] for c in range(3)] for r in range(3)] for k in range(3)]
    weights = ", ".join(f"{det(with_right[k])} / {det(rows)} AS b{k + 1}" for k in range(3))
    constant = "ym - b1 * x1m - b2 * x2m - b3 * x3m" if intercept else "0"
    return f"""{name}_m AS (SELECT avg(y) AS ym, avg(x1) AS x1m, avg(x2) AS x2m, avg(x3) AS x3m FROM train),
{name}_s AS (SELECT {sums} FROM train, {name}_m m),
{name}_b AS (SELECT *, {weights} FROM {name}_s, {name}_m),
{name} AS (SELECT lagged.*, {constant} + b1 * x1 + b2 * x2 + b3 * x3 AS predicted FROM lagged, {name}_b)"""


WATERMARK = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


def _resample(value: str, every: str = "1 DAY") -> str:
    bucket = f"time_bucket(INTERVAL {every}, {{}}, TIMESTAMP '1970-01-01')"
    return f"""WITH {READINGS},
        g AS (
            SELECT user_id, unnest(generate_series(lo, hi, INTERVAL {every})) AS bucket
            FROM (SELECT DISTINCT user_id FROM r),
                 (SELECT {bucket.format("min(ts)")} AS lo, {bucket.format("max(ts)")} AS hi FROM r)),
        d AS (SELECT user_id, {bucket.format("ts")} AS bucket, avg(power) AS v FROM r GROUP BY ALL),
        j AS (SELECT g.user_id, g.bucket, d.v FROM g LEFT JOIN d USING (user_id, bucket))
        SELECT user_id, bucket, round({value}, 6) AS value, v IS NOT NULL AS observed FROM j"""


def _windows(keys: str, starts: str, size: str, extra: str = "") -> str:
    return f"""WITH {READINGS}, x AS (SELECT *, {starts} AS window_start FROM r)
        SELECT {keys} window_start, window_start + INTERVAL {size} AS window_end, count(*) AS n,
               round(sum(power), 6) AS sum, round(avg(power) + 1e-9, 6) AS mean, min(power) AS min, max(power) AS max
        FROM x GROUP BY {keys} window_start {extra}"""


def _stream_windows(starts: str, size: str) -> str:
    return f"""WITH {READINGS}, x AS (SELECT *, {starts} AS window_start FROM r)
        SELECT user_id, window_start, window_start + INTERVAL {size} AS window_end, count(*) AS n,
               round(avg(power), 6) AS mean, min(power) AS min, max(power) AS max
        FROM x GROUP BY user_id, window_start
        HAVING window_start + INTERVAL {size} <= {WATERMARK}"""


HOUR = "time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01')"
QUARTER = "time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01')"

ORACLE: dict[str, str] = {
    "csv_batches": """SELECT event_type AS kind, strftime(date_trunc('week', ts), '%Y%m%d') AS week, event_id, user_id, ts, value AS power
        FROM events WHERE event_type <> 'error'""",
    "csv_rejected": """SELECT event_type AS kind, strftime(date_trunc('week', ts), '%Y%m%d') AS week, 'value' AS reason, count(*) AS n
        FROM events WHERE event_type = 'error' GROUP BY ALL""",
    "merge_batches": f"""WITH {BATCHES}
        SELECT user_id, ts, power, event_id, event_type, batch_id, source_file FROM ranked WHERE k = 1""",
    "merge_conflicts": f"""WITH {BATCHES}
        SELECT user_id, ts, power, event_id, event_type, batch_id, source_file, count(*) AS copies
        FROM ranked WHERE k > 1 GROUP BY ALL""",
    "coverage": f"""WITH {READINGS}
        SELECT terminal_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n FROM r GROUP BY terminal_id""",
    "overlap_pairs": f"""WITH {INTERVALS}
        SELECT a.key, a.interval_id AS id_a, b.interval_id AS id_b, greatest(a."start", b."start") AS overlap_start,
               least(a."end", b."end") AS overlap_end
        FROM iv a JOIN iv b ON a.key = b.key AND a.interval_id < b.interval_id
             AND a."start" < b."end" AND b."start" < a."end" """,
    "overlap_counts": f"""WITH {INTERVALS}
        SELECT a.key, a.interval_id, count(b.interval_id) AS n_overlaps
        FROM iv a LEFT JOIN iv b ON a.key = b.key AND a.interval_id <> b.interval_id
             AND a."start" < b."end" AND b."start" < a."end"
        GROUP BY a.key, a.interval_id""",
    "merge_intervals": f"""WITH {INTERVALS},
        m AS (
            SELECT *, max("end") OVER (PARTITION BY key ORDER BY "start", interval_id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
            FROM iv),
        f AS (
            SELECT *, sum(CASE WHEN reached IS NULL OR "start" > reached THEN 1 ELSE 0 END)
                      OVER (PARTITION BY key ORDER BY "start", interval_id) AS island
            FROM m)
        SELECT key, min("start") AS island_start, max("end") AS island_end, count(*) AS n_intervals,
               min(CASE WHEN "start" > reached THEN reached END) AS gap_start
        FROM f GROUP BY key, island""",
    "stored_readings": "SELECT user_id, event_id, ts, value AS power, CAST(ts AS DATE) AS day FROM events",
    "resample_forward": _resample(
        "coalesce(v, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY bucket"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"
    ),
    "resample_zero": _resample("coalesce(v, 0.0)"),
    "resample_none": _resample("v"),
    "resample_offset": _resample("coalesce(v, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY bucket"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))", "10 HOUR"),
    "resample_weekly": _resample("coalesce(v, 0.0)", "7 DAY"),
    "rollup_granularity": f"""WITH {READINGS}
        SELECT CASE grouping(user_id, terminal_id) WHEN 0 THEN 'terminal_id' WHEN 1 THEN 'user_id' ELSE 'total' END
                   AS level,
               user_id, terminal_id, round(sum(power), 6) AS sum, round(avg(power) + 1e-9, 6) AS mean, count(*) AS n
        FROM r GROUP BY ROLLUP (user_id, terminal_id)""",
    "row_windows": f"""WITH {ROW_WINDOWS}
        SELECT user_id, window_no, start_ts,
               array_to_string([CAST(round(v * 100) AS BIGINT)::VARCHAR FOR v IN "values"], ',')
                   AS values_cents
        FROM w""",
    "time_windows_hourly": _windows("user_id,", HOUR, "1 HOUR"),
    "time_windows_sliding": _windows(
        "", f"unnest([{QUARTER} - INTERVAL 6 HOURS * k FOR k IN range(4)])", "1 DAY"
    ),
    "features": f"""WITH {READINGS}
        SELECT user_id, ts, power, event_id,
               lag(power, 1) OVER w AS lag_1, round(power - lag(power, 1) OVER w, 6) AS diff_1,
               lag(power, 2) OVER w AS lag_2, round(power - lag(power, 2) OVER w, 6) AS diff_2,
               lag(power, 3) OVER w AS lag_3, round(power - lag(power, 3) OVER w, 6) AS diff_3,
               CASE WHEN count(*) OVER f = 4 THEN round(avg(power) OVER f, 6) END AS roll_mean_4,
               CASE WHEN count(*) OVER f = 4 THEN round(stddev_pop(power) OVER f, 6) END AS roll_std_4,
               CASE WHEN count(*) OVER f = 4 THEN min(power) OVER f END AS roll_min_4,
               CASE WHEN count(*) OVER f = 4 THEN max(power) OVER f END AS roll_max_4,
               CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday
        FROM r WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id),
             f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
    "long_rolls": f"""WITH {READINGS}
        SELECT user_id, ts, power, event_id,
               CASE WHEN count(*) OVER f = 20 THEN round(avg(power) OVER f, 6) END AS roll_mean_20,
               CASE WHEN count(*) OVER f = 20 THEN round(stddev_pop(power) OVER f, 6) END AS roll_std_20,
               CASE WHEN count(*) OVER f = 20 THEN min(power) OVER f END AS roll_min_20,
               CASE WHEN count(*) OVER f = 20 THEN max(power) OVER f END AS roll_max_20
        FROM r WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "running": f"""WITH {READINGS}
        SELECT user_id, ts, power, event_id, count(power) OVER f AS run_n, round(avg(power) OVER f + 1e-9, 6) AS run_mean,
               min(power) OVER f AS run_min, max(power) OVER f AS run_max
        FROM r WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "fit_scaler": f"""WITH {SCALERS}
        SELECT user_id, round("offset", 6) AS "offset", round(scale, 6) AS scale, n FROM f""",
    "apply_scaler": f"""WITH {SCALERS}
        SELECT user_id, event_id, value AS power,
               round(CASE WHEN scale = 0 THEN 0.0 ELSE (value - "offset") / nullif(scale, 0) END, 6) AS scaled
        FROM events JOIN f USING (user_id)""",
    "apply_scaler_train": f"""WITH {SPLIT},
        f AS (SELECT min(power) AS lo, max(power) - min(power) AS span FROM sets WHERE "set" = 'train')
        SELECT event_id, "set", power, round((power - lo) / nullif(span, 0), 6) AS scaled FROM sets, f""",
    "dual_scale": f"""WITH {LAGGED},
        t AS (SELECT user_id, event_id, previous, power FROM l WHERE previous IS NOT NULL),
        f AS (SELECT user_id, avg(previous) AS ox, stddev_pop(previous) AS sx, avg(power) AS oy, stddev_pop(power) AS sy
              FROM t GROUP BY user_id)
        SELECT user_id, event_id, previous, power, round((previous - ox) / sx, 6) AS x_scaled,
               round((power - oy) / sy, 6) AS y_scaled, round((power - oy) / sy * sy + oy, 6) AS restored
        FROM t JOIN f USING (user_id)""",
    "detect_events": f"""WITH {STEPS}
        SELECT user_id, event_id, ts, label, p_before, p_after, round(step, 6) AS step, direction FROM e""",
    "steady_states": f"""WITH {STEPS},
        g AS (
            SELECT *, CAST(sum(CASE WHEN abs(step) >= 100 THEN 1 ELSE 0 END)
                           OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS segment
            FROM s)
        SELECT user_id, segment, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n,
               round(avg(power), 6) AS mean_power, round(stddev_pop(power), 6) AS std_power
        FROM g GROUP BY user_id, segment""",
    "transient_features": f"""WITH {STEPS},
        f AS (
            SELECT user_id, ts, event_id, step,
                   count(*) OVER b AS n_before, min(power) OVER b AS min_before, max(power) OVER b AS max_before,
                   avg(power) OVER b AS mean_before,
                   count(*) OVER a AS n_after, min(power) OVER a AS min_after, max(power) OVER a AS max_after,
                   avg(power) OVER a AS mean_after
            FROM s WINDOW
                b AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW),
                a AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN CURRENT ROW AND INTERVAL 6 HOURS FOLLOWING))
        SELECT user_id, ts, event_id, n_before, min_before, max_before, round(mean_before, 6) AS mean_before,
               n_after, min_after, max_after, round(mean_after, 6) AS mean_after,
               round(max_after - mean_after, 6) AS overshoot
        FROM f WHERE abs(step) >= 100""",
    "load_signatures": f"""WITH {SIGNATURES}
        SELECT label, direction, n, round(mean_step, 6) AS mean_step, round(std_step, 6) AS std_step,
               round(median_step, 6) AS median_step
        FROM sig""",
    "pair_cycles": f"""WITH {STEPS},
        n AS (
            SELECT *, lead(step) OVER w AS fall, lead(ts) OVER w AS off_ts
            FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        SELECT user_id, ts AS on_ts, off_ts, round(step, 6) AS rise, round(fall, 6) AS fall,
               round(datediff('microsecond', ts, off_ts) / 3600e6, 6) AS hours,
               round(step * (datediff('microsecond', ts, off_ts) / 3600e6), 6) AS energy
        FROM n WHERE step > 0 AND fall < 0 AND abs(step + fall) <= 0.2 * step""",
    "match_signatures": f"""WITH {SIGNATURES},
        d AS (
            SELECT e.*, sig.label AS matched_label, round(abs(step - mean_step) / std_step, 9) AS distance
            FROM e JOIN sig ON e.direction = sig.direction AND std_step > 0),
        k AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY distance, matched_label) AS nth FROM d)
        SELECT user_id, event_id, label, direction, matched_label, round(distance, 6) AS distance FROM k WHERE nth = 1""",
    "disaggregate": f"""WITH {READINGS},
        mains AS (
            SELECT user_id, {HOUR} AS hour, CAST(round(round(sum(power), 2) * 1000) AS BIGINT) AS total
            FROM r GROUP BY ALL),
        app AS (
            SELECT row_number() OVER (ORDER BY event_type) - 1 AS i,
                   CAST(round(round(avg(power), 2) * 1000) AS BIGINT) AS rated
            FROM r GROUP BY event_type),
        states AS (
            SELECT state, sum(CASE WHEN (state >> i) & 1 = 1 THEN rated ELSE 0 END) AS rated, bit_count(state) AS n_on
            FROM range(32) AS t(state), app GROUP BY state),
        k AS (
            SELECT user_id, hour, total, state, n_on, abs(total - rated) AS error,
                   row_number() OVER (PARTITION BY user_id, hour ORDER BY abs(total - rated), n_on, state) AS nth
            FROM mains, states)
        SELECT user_id, hour, total, state, CAST(n_on AS INTEGER) AS n_on, CAST(error AS BIGINT) AS error
        FROM k WHERE nth = 1""",
    "split_entities": f"""WITH {SPLIT} SELECT event_id, user_id, "set" FROM sets""",
    "split_by_time": """WITH b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events),
        f AS (SELECT event_id, datediff('microsecond', lo, ts) / datediff('microsecond', lo, hi) AS part FROM events, b)
        SELECT event_id, CASE WHEN part < 0.7 THEN 'train' WHEN part < 0.85 THEN 'val' ELSE 'test' END AS "set"
        FROM f""",
    "fit_linear_per_user": f"""WITH {LAGGED}
        SELECT user_id, round(regr_slope(power, previous), 6) AS slope,
               round(regr_intercept(power, previous), 6) AS intercept, round(regr_r2(power, previous), 6) AS r2,
               CAST(regr_count(power, previous) AS BIGINT) AS n
        FROM l GROUP BY user_id""",
    "fit_linear_global": f"""WITH {LAGGED}
        SELECT round(regr_slope(power, previous), 6) AS slope,
               round(regr_intercept(power, previous), 6) AS intercept, round(regr_r2(power, previous), 6) AS r2,
               CAST(regr_count(power, previous) AS BIGINT) AS n
        FROM l""",
    "score": f"""WITH {ROW_WINDOWS}
        SELECT user_id, window_no, round(list_avg("values"), 6) AS predicted FROM w""",
    "metrics_total": f"""WITH {LAGGED},
        c AS (SELECT *, avg(actual) OVER () AS m FROM q WHERE model = 'previous')
        SELECT {METRICS} FROM c""",
    "fit_linear_many": f"""WITH {LAG_ROWS}, {_solved("fitted", True)}
        SELECT event_id, "set", y AS power, round(predicted, 6) AS predicted FROM fitted""",
    "fit_stump": f"""WITH {LAG_ROWS},
        t AS (SELECT hour, count(*) AS n, sum(y) AS s FROM lagged WHERE "set" = 'train' AND y IS NOT NULL GROUP BY hour),
        cut AS (
            SELECT hour, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER () AS n, sum(s) OVER () AS s
            FROM t WINDOW w AS (ORDER BY hour)),
        best AS (
            SELECT * FROM cut WHERE nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1)
        SELECT event_id, "set", lagged.hour AS hour,
               round(CASE WHEN lagged.hour <= best.hour THEN sl / nl ELSE (s - sl) / (n - nl) END, 6) AS predicted
        FROM lagged, best""",
    "search_exact": f"""WITH {LAG_ROWS}, {_solved("a", True)}, {_solved("b", False)},
        q AS (
            SELECT '{{"regParam":"0.0","fitIntercept":"True"}}' AS params, y AS actual, predicted FROM a WHERE "set" = 'val'
            UNION ALL SELECT '{{"regParam":"0.0","fitIntercept":"False"}}', y, predicted FROM b WHERE "set" = 'val'),
        c AS (SELECT *, avg(actual) OVER (PARTITION BY params) AS m FROM q WHERE predicted IS NOT NULL)
        SELECT params, {METRICS} FROM c GROUP BY params""",
    "metrics_by_level": f"""WITH {LAGGED},
        t AS (SELECT q.*, r.terminal_id FROM q JOIN r USING (user_id, ts))
        SELECT CASE grouping(user_id, terminal_id) WHEN 0 THEN 'terminal_id' WHEN 1 THEN 'user_id' ELSE 'total' END AS level,
               model, user_id, terminal_id, count(*) AS n, round(avg(abs(actual - predicted)), 6) AS mae,
               round(sqrt(avg((actual - predicted) ** 2)), 6) AS rmse,
               round(1 - sum((actual - predicted) ** 2) / nullif(var_pop(actual) * count(*), 0), 3) AS r2
        FROM t GROUP BY GROUPING SETS ((model, user_id, terminal_id), (model, user_id), (model))""",
    "metrics_per_user": f"""WITH {LAGGED},
        c AS (SELECT *, avg(actual) OVER (PARTITION BY model, user_id) AS m FROM q)
        SELECT model, user_id, {METRICS} FROM c GROUP BY model, user_id""",
    "robust_metrics": f"""WITH {LAGGED},
        a AS (SELECT * FROM q WHERE model = 'previous'),
        k AS (SELECT * FROM a WHERE abs(actual - predicted)
                    <= (SELECT quantile_cont(abs(actual - predicted), 0.99) FROM a)),
        c AS (SELECT *, avg(actual) OVER () AS m FROM k)
        SELECT {METRICS}, round(avg(abs(actual - predicted)) / nullif(avg(actual), 0), 6) AS mae_rel,
               round(sqrt(avg((actual - predicted) ** 2)) / nullif(avg(actual), 0), 6) AS rmse_rel
        FROM c""",
    "robust_metrics_per_model": f"""WITH {LAGGED},
        cut AS (SELECT model, quantile_cont(abs(actual - predicted), 0.95) AS cut FROM q GROUP BY model),
        k AS (SELECT q.* FROM q JOIN cut USING (model) WHERE abs(actual - predicted) <= cut),
        c AS (SELECT *, avg(actual) OVER (PARTITION BY model) AS m FROM k)
        SELECT model, {METRICS}, round(avg(abs(actual - predicted)) / nullif(avg(actual), 0), 6) AS mae_rel,
               round(sqrt(avg((actual - predicted) ** 2)) / nullif(avg(actual), 0), 6) AS rmse_rel
        FROM c GROUP BY model""",
    "compare_models": f"""WITH {COMPARED},
        lost AS (SELECT q.model, count(*) AS dropped FROM q ANTI JOIN seen USING (user_id, ts) GROUP BY q.model)
        SELECT model, n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2,
               coalesce(dropped, 0) AS dropped, CAST(rank() OVER (ORDER BY rmse, model) AS INTEGER) AS rank
        FROM kept LEFT JOIN lost USING (model)""",
    "compare_dropped": f"""WITH {COMPARED}
        SELECT model, user_id, ts FROM q ANTI JOIN seen USING (user_id, ts)""",
    "ablation": f"""WITH {COMPARED}, b AS (SELECT * FROM kept WHERE model = 'running')
        SELECT k.model AS variant, round(k.mae, 6) AS mae, round(k.rmse, 6) AS rmse, round(k.r2, 6) AS r2,
               round(k.mae - b.mae, 6) AS mae_delta, round((k.mae - b.mae) / nullif(abs(b.mae), 0), 6) AS mae_relative,
               round(k.rmse - b.rmse, 6) AS rmse_delta,
               round((k.rmse - b.rmse) / nullif(abs(b.rmse), 0), 6) AS rmse_relative,
               round(k.r2 - b.r2, 6) AS r2_delta, round((k.r2 - b.r2) / nullif(abs(b.r2), 0), 6) AS r2_relative
        FROM kept k, b""",
    "stream_readings": "SELECT event_id, user_id, ts, value AS power FROM events",
    "stream_windows_hourly": _stream_windows(HOUR, "1 HOUR"),
    "stream_windows_sliding": _stream_windows(
        f"unnest([{HOUR} - INTERVAL 1 HOUR * k FOR k IN range(2)])", "2 HOURS"
    ),
    "stream_sessions": f"""WITH {READINGS},
        g AS (
            SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTES
                           THEN 0 ELSE 1 END AS opens
            FROM r),
        x AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)
        SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTES AS window_end, count(*) AS n,
               round(avg(power), 6) AS mean, min(power) AS min, max(power) AS max
        FROM x GROUP BY user_id, session HAVING max(ts) + INTERVAL 30 MINUTES <= {WATERMARK}""",
    "stream_events": f"""WITH {STEPS}
        SELECT user_id, ts, p_before, p_after, round(step, 6) AS step, direction
        FROM e WHERE ts < time_bucket(INTERVAL 1 MINUTE, {WATERMARK}, TIMESTAMP '1970-01-01')""",
}
ORACLE["search_linear"] = ORACLE["search_exact"]
