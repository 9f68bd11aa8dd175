from __future__ import annotations

import random
import statistics
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from checks import spark_rows

from loadgrain.functions.quantile import exact_quantile
from loadgrain.operators import load
from loadgrain.plans import near_pieces
from loadgrain.plans.signature_index import SignatureIndex

START = datetime(2024, 1, 1)
SCHEMA = "k bigint, ts timestamp_ntz, tie bigint, power double"


def readings(spark, seed: int, sizes: list[int], span: float):
    rng = random.Random(seed)
    rows = []
    for k, size in enumerate(sizes):
        for _ in range(size):
            at = START + timedelta(microseconds=int(rng.random() * span * 1e6))
            rows.append((k, at, len(rows), round(rng.uniform(0, 300), 2)))
    return spark.createDataFrame(rows, SCHEMA), rows


def test_threshold_is_inclusive_and_nulls_are_no_events(spark):
    powers = [0.0, 100.0, None, 500.0, 100.0, 100.0]
    rows = [(1, START + timedelta(minutes=i), i, p) for i, p in enumerate(powers)]
    events = load.detect_events(spark.createDataFrame(rows, SCHEMA), ["k"], 100.0, tie=("tie",)).collect()
    assert [(r["tie"], r["step"], r["direction"]) for r in events] == [(1, 100.0, "rise"), (4, -400.0, "fall")]


def test_equal_power_is_one_state(spark):
    rows = [(k, START + timedelta(minutes=i), i, 5.0) for k in (1, 2) for i in range(9)]
    states = load.steady_states(spark.createDataFrame(rows, SCHEMA), ["k"], 1.0, tie=("tie",)).collect()
    assert [(r["n"], r["mean_power"], r["std_power"]) for r in states] == [(9, 5.0, 0.0)] * 2


@pytest.mark.parametrize(
    ("before", "after", "span"),
    [("6 hours", "6 hours", 400_000), ("2 seconds", "1 seconds", 20), ("10 minutes", "1 seconds", 4_000), ("3 seconds", "90 minutes", 9_000), ("300 milliseconds", "2 seconds", 20)],
)
@pytest.mark.parametrize("cell_rows", [1, 4, 1_000])
def test_transients_equal_brute_force(spark, monkeypatch, before, after, span, cell_rows):
    monkeypatch.setattr(load, "CELL_ROWS", cell_rows)
    df, rows = readings(spark, 7, [90, 40], span)
    events = load.detect_events(df, ["k"], 120.0, tie=("tie",))
    found = load.transient_features(df, events, ["k"], before, after, tie=("tie",)).collect()
    assert len(found) == events.count() > 20
    import pandas as pd

    back, ahead = pd.Timedelta(before).to_pytimedelta(), pd.Timedelta(after).to_pytimedelta()
    for r in found:
        left = [x[3] for x in rows if x[0] == r["k"] and r["ts"] - back <= x[1] <= r["ts"]]
        right = [x[3] for x in rows if x[0] == r["k"] and r["ts"] <= x[1] <= r["ts"] + ahead]
        assert (r["n_before"], r["min_before"], r["max_before"]) == (len(left), min(left), max(left))
        assert (r["n_after"], r["min_after"], r["max_after"]) == (len(right), min(right), max(right))
        assert r["mean_before"] == pytest.approx(statistics.fmean(left))
        assert r["overshoot"] == pytest.approx(max(right) - statistics.fmean(right), abs=1e-9)


@pytest.mark.parametrize("small", [True, False])
def test_transients_of_bursts(spark, monkeypatch, small):
    """Some cells hold far more readings than others; few events, so most readings matter to none."""
    if not small:
        monkeypatch.setattr(near_pieces, "pin_small", lambda df: (df, None))
    monkeypatch.setattr(load, "CELL_ROWS", 2)
    rng = random.Random(9)
    times = sorted({rng.randrange(-90_000_000, 90_000_000) for _ in range(150)} | {5_000_000 + 7 * i for i in range(300)})
    rows = [(k, START + timedelta(microseconds=t), i, rng.random()) for k in (1, None) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, SCHEMA)
    chosen = [r for r in rows if r[0] == 1 and r[2] % 40 == 0]
    events = spark.createDataFrame(chosen, SCHEMA)
    found = {r["tie"]: r for r in load.transient_features(df, events, ["k"], "20 seconds", "2 seconds", tie=("tie",)).collect()}
    assert len(found) == len(chosen)
    for k, at, tie, _ in chosen:
        left = [x[3] for x in rows if x[0] == k and at - timedelta(seconds=20) <= x[1] <= at]
        right = [x[3] for x in rows if x[0] == k and at <= x[1] <= at + timedelta(seconds=2)]
        r = found[tie]
        assert (r["n_before"], r["min_before"], r["max_before"]) == (len(left), min(left), max(left))
        assert (r["n_after"], r["min_after"], r["max_after"]) == (len(right), min(right), max(right))
        assert r["mean_after"] == pytest.approx(statistics.fmean(right))


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("bits", [1 << 16, 1 << 27])
def test_rows_with_keys(spark, monkeypatch, small, bits):
    if not small:
        monkeypatch.setattr(near_pieces, "pin_small", lambda df: (df, None))
    rows = spark.range(50_000).selectExpr("if(id % 100 = 7, null, id) as a", "id % 3 as b", "id as _bit")
    keys = spark.range(200).selectExpr("if(id = 5, null, id * 211) as a", "id * 211 % 3 as b", "id as other")
    exact = rows.join(keys, rows.a.eqNullSafe(keys.a) & (rows.b == keys.b), "left_semi").count()
    found = near_pieces.rows_with_keys(rows, keys, ["a", "b"], bits)
    assert found.columns == rows.columns
    kept = found.join(keys, found.a.eqNullSafe(keys.a) & (found.b == keys.b), "left_semi").count()
    assert kept == exact > 300
    assert found.count() == exact if small else exact <= found.count() < exact + 50_000 * 400 / bits


def test_transients_join_before_the_shuffle(spark):
    """Readings meet the pieces that events look into before they are exchanged."""
    df, _ = readings(spark, 7, [90, 40], 400_000)
    events = load.detect_events(df, ["k"], 120.0, tie=("tie",))
    plan = load.transient_features(df, events, ["k"], "6 hours", "6 hours", tie=("tie",))._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    below = text[text.index("LeftSemi") :]
    assert "Aggregate" not in below.split("Join LeftSemi")[1].split("LogicalRDD")[0]


@pytest.mark.parametrize("limit", [2, 10_000])
@pytest.mark.parametrize("q", [0.0, 0.37, 0.5, 0.99, 1.0])
def test_quantile_is_exact(spark, conf, limit, q):
    conf("spark.loadgrain.quantileValues", limit)
    rng = random.Random(8)
    rows = [("wide", rng.gauss(0, 1) * 10 ** rng.randrange(0, 9)) for _ in range(300)]
    rows += [("flat", 4.0)] * 200 + [("two", 1.0), ("two", 2.0)] + [(None, float(i)) for i in range(41)]
    rows += [("mixed", 3.0)] * 150 + [("mixed", rng.random()) for _ in range(150)] + [("mixed", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["p"] for r in exact_quantile(df, ["g"], "v", q, "p").collect()}
    for g in ("wide", "flat", "two", None, "mixed"):
        values = [v for h, v in rows if h == g and v is not None]
        assert got[g] == pytest.approx(float(np.quantile(values, q)), rel=1e-12)
    assert len(got) == 5
    everything = exact_quantile(df, [], "v", q, "p").collect()
    assert [r["p"] for r in everything] == [pytest.approx(float(np.quantile([v for _, v in rows if v is not None], q)))]


def events_and_signatures(spark, n_labels: int):
    rng = random.Random(9)
    events = [(i, rng.choice(["rise", "fall"]), round(rng.uniform(-300, 300), 1)) for i in range(80)]
    events.append(events[-1])
    signatures = [
        (f"L{i:03}", d, round(rng.uniform(-300, 300), 0), rng.choice([10.0, 20.0, 0.0, None]))
        for i in range(n_labels)
        for d in ("rise", "fall")
    ]
    return (
        spark.createDataFrame(events, "id bigint, direction string, step double"),
        spark.createDataFrame(signatures, "label string, direction string, mean_step double, std_step double"),
        events,
        signatures,
    )


@pytest.mark.parametrize(("scanned", "indexed"), [(100, 1_000), (0, 1_000), (0, 20)])
def test_match_signatures(spark, scanned, indexed):
    events, signatures, event_rows, signature_rows = events_and_signatures(spark, 40)
    want = []
    for i, direction, step in event_rows:
        near = min((round(abs(step - m) / s, 9), label) for label, d, m, s in signature_rows if d == direction and s)
        want.append((i, near[1], near[0]))
    got = [(r["id"], r["matched_label"], r["distance"]) for r in load.match_signatures(events, signatures, scanned, indexed).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize(("scanned", "indexed"), [(100, 1_000), (0, 1_000), (0, 2)])
def test_events_that_match_nothing(spark, scanned, indexed):
    events = spark.createDataFrame(
        [(1, "rise", 5.0), (2, "fall", 5.0), (3, None, 5.0), (4, "rise", None)], "id int, direction string, step double"
    )
    signatures = spark.createDataFrame(
        [(7, "rise", 4.0, 2.0), (6, "rise", 4.0, 2.0), (5, "rise", 4.0, 0.0), (4, None, 5.0, 1.0), (3, "rise", None, 1.0), (2, "other", 1.0, 1.0)],
        "label int, direction string, mean_step double, std_step double",
    )
    for known, first in ((signatures, (6, 0.5)), (signatures.limit(0), (None, None))):
        found = load.match_signatures(events, known, scanned, indexed).collect()
        got = {r["id"]: (r["matched_label"], r["distance"]) for r in found}
        assert got == {1: first, 2: (None, None), 3: (None, None), 4: (None, None)}


def test_index_of_many_signatures(spark):
    """100,000 signatures, some far from all steps, in clusters or with wide deviations, against a scan of all."""
    rng = np.random.default_rng(4)
    means = np.concatenate([rng.uniform(-300, 300, 60_000), 5_000 + rng.normal(0, 1e-3, 20_000), rng.normal(50, 1, 20_000)])
    stds = np.exp(rng.uniform(-6, 4, 100_000))
    steps = np.concatenate([rng.uniform(-400, 400, 400), [5_000.0, 4_900.0, 1e6, means[7]]])
    index = SignatureIndex(means, stds)
    rows, count = index.finalists(steps)
    ends = np.cumsum(count)
    for i, step in enumerate(steps):
        distance = np.abs(step - means) / stds
        mine = rows[ends[i] - count[i] : ends[i]]
        assert set(np.flatnonzero(distance <= distance.min() + 1e-9)) <= set(mine.tolist())
        assert (distance[mine] <= distance.min() * (1 + 1e-9) + 1e-8).all()
    assert len(rows) < 3 * len(steps)
    names = [f"L{i:06}" for i in range(100_000)]
    frame = pd.DataFrame({"label": names, "direction": "rise", "mean_step": means, "std_step": stds})
    events = spark.createDataFrame([(i, "rise", float(s)) for i, s in enumerate(steps)], "id int, direction string, step double")
    found = {r["id"]: r for r in load.match_signatures(events, spark.createDataFrame(frame)).collect()}
    for i, step in enumerate(steps):
        distance = np.round(np.abs(step - means) / stds, 9)
        assert found[i]["distance"] == pytest.approx(distance.min(), abs=2e-9, rel=1e-12)
        assert abs(distance[int(found[i]["matched_label"][1:])] - distance.min()) <= 2e-9 + 1e-12 * distance.min()


@pytest.mark.parametrize("k", [1, 3, 12])
def test_disaggregate_equals_brute_force(spark, k):
    rng = random.Random(k)
    # few distinct ratings make ties likely
    rated = [rng.choice([100, 200, 250, 300, 1_000]) for _ in range(k)]
    totals = [rng.randrange(-50, sum(rated) + 200) for _ in range(60)] + [0, sum(rated)]
    states = [(sum(r for i, r in enumerate(rated) if s >> i & 1), bin(s).count("1"), s) for s in range(1 << k)]
    mains = spark.createDataFrame([(i, t) for i, t in enumerate(totals)], "id bigint, total bigint")
    appliances = spark.createDataFrame([(f"a{i:02}", r) for i, r in enumerate(rated)], "label string, rated bigint")
    got = {r["id"]: (r["error"], r["n_on"], r["state"]) for r in load.disaggregate(mains, appliances).collect()}
    for i, total in enumerate(totals):
        assert got[i] == min((abs(total - s), n_on, state) for s, n_on, state in states)


@pytest.mark.parametrize("k", [13, 20])
def test_many_appliances_equal_brute_force(spark, k):
    rng = random.Random(k)
    rated = [rng.choice([100, 200, 250, 300, 1_000, rng.randrange(1, 10_000)]) for _ in range(k)]
    states = np.arange(1 << k)
    sums = sum((states >> i & 1) * r for i, r in enumerate(rated))
    totals = [rng.randrange(-50, sum(rated) + 200) for _ in range(60)] + [0, sum(rated), 450, 450]
    mains = spark.createDataFrame([*enumerate(totals), (999, None)], "id bigint, total bigint")
    appliances = spark.createDataFrame([(f"a{i:02}", r) for i, r in enumerate(rated)], "label string, rated bigint")
    found = load.disaggregate(mains, appliances, k_max=20).collect()
    got = {r["id"]: (r["error"], r["n_on"], r["state"]) for r in found}
    assert len(found) == len(got) == len(totals) + 1 and got[999] == (None, None, None)
    for i, total in enumerate(totals):
        error = np.abs(total - sums)
        best = states[error == error.min()]
        assert got[i] == min((int(error.min()), int(s).bit_count(), int(s)) for s in best)


def test_disaggregate_refuses_too_many_appliances(spark):
    mains = spark.createDataFrame([(1, 5)], "id bigint, total bigint")
    appliances = spark.createDataFrame([(f"a{i:02}", 1) for i in range(13)], "label string, rated bigint")
    with pytest.raises(ValueError, match="more than 12"):
        load.disaggregate(mains, appliances)
    with pytest.raises(ValueError, match="k_max"):
        load.disaggregate(mains, appliances, k_max=41)


@pytest.mark.parametrize("limit", [2, 10_000])
def test_cycles_pair_neighbours_only(spark, conf, limit):
    conf("spark.loadgrain.seriesRows", limit)
    steps = [100.0, -95.0, 200.0, 50.0, -50.0, -200.0, 80.0, -40.0]
    rows = [(1, START + timedelta(hours=12 * i), i, s) for i, s in enumerate(steps)]
    df = spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, tie bigint, step double")
    found = load.pair_cycles(df, ["k"], 0.2, tie=("tie",)).orderBy("on_ts").collect()
    assert [(r["rise"], r["fall"], r["hours"], r["energy"]) for r in found] == [
        (100.0, -95.0, 12.0, 1_200.0),
        (50.0, -50.0, 12.0, 600.0),
    ]


def test_signature_of_a_single_event(spark):
    df = spark.createDataFrame([("a", "rise", 7.0)], "kind string, direction string, step double")
    row = load.load_signatures(df, "kind").first()
    assert (row["label"], row["n"], row["mean_step"], row["std_step"], row["median_step"]) == ("a", 1, 7.0, None, 7.0)


def test_plain_and_split_plans_agree(spark, conf):
    df, _ = readings(spark, 11, [150, 3], 900_000)
    plain = spark_rows(load.steady_states(df, ["k"], 100.0, tie=("tie",)).select("k", "segment", "start_ts", "n"))
    for limit in (1, 2, 13):
        conf("spark.loadgrain.seriesRows", limit)
        split = load.steady_states(df, ["k"], 100.0, tie=("tie",)).select("k", "segment", "start_ts", "n")
        assert spark_rows(split) == plain
