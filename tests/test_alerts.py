"""Mini fixtures with hand-derived answers, and the breach state machine
simulated in plain Python against the closed form."""

import datetime as dt
import random

import pytest

from eventlens.operators import alerts

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)


def _temps(spark, temps, start=T0, step=dt.timedelta(minutes=1), key="s1"):
    rows = [(key, start + i * step, (start + i * step).strftime("%Y-%m-%d %H:%M:%S"), float(t), i)
            for i, t in enumerate(temps)]
    return spark.createDataFrame(rows, "id string, ts timestamp_ntz, time string, temp double, seq long")


@pytest.mark.parametrize("width", ["1 minute", "1 day"])
def test_running_mean_fixture(spark, width):
    df = _temps(spark, [20, 21, 30, 10])
    out = alerts.running_mean_alerts(df, slice_width=width).orderBy("ts").collect()
    assert [(r.temp, r.kind) for r in out] == [(30.0, "high"), (10.0, "low")]
    assert out[0].message == "s1,2024-01-01 08:02:00,30; 温度过高"


def test_running_mean_strict_threshold(spark):
    # a reading exactly at mean + 5 or mean - 5 gives no alert
    df = _temps(spark, [15, 20]).unionByName(_temps(spark, [15, 10], key="s2"))
    assert alerts.running_mean_alerts(df, slice_width="1 minute").count() == 0


def test_window_mean_restarts_per_day(spark):
    day1 = _temps(spark, [20, 21, 30, 10])
    # next day: 30 again.  In-window mean restarts (first reading of the day:
    # no alert); the per-key mean (20.25) would alert
    day2 = _temps(spark, [30], start=T0 + dt.timedelta(days=1)).selectExpr(
        "id", "ts", "time", "temp", "seq + 10 AS seq")
    df = day1.unionByName(day2)
    w = alerts.window_mean_alerts(df).collect()
    assert [(r.temp, r.kind) for r in w] == [(30.0, "high")]
    k = alerts.running_mean_alerts(df).orderBy("ts").collect()
    assert [(r.temp, r.kind) for r in k] == [(30.0, "high"), (10.0, "low"), (30.0, "high")]


def _acid(spark, seq):
    rows = [(1, T0 + dt.timedelta(minutes=i), i, float(a), 10, 0.05) for i, a in enumerate(seq)]
    return spark.createDataFrame(rows, "id long, ts timestamp_ntz, seq long, acid double, cons long, water_rate double")


@pytest.mark.parametrize("seq,keep,drop", [
    ([1.0, 1.2, 1.3], [3], [3]),
    ([1.0, 1.0, 1.2, 1.3], [4], []),
    ([1.0, 1.2, 1.0], [], []),
    ([1.0, 1.2, 1.3, 1.5, 1.6], [3, 5], [3, 5]),
])
def test_breach_fixture(spark, seq, keep, drop):
    df = _acid(spark, seq)
    for variant, want in (("keep", keep), ("drop", drop)):
        got = alerts.breach_alerts(df, "id", "ts", order=["seq"], variant=variant)
        assert sorted(r.seq + 1 for r in got.collect()) == want, variant


def simulate(rows, rate, variant):
    """The reference's two-reading state machine, row by row."""
    out, state = [], []
    f = 1 + rate
    for r in rows:
        if not state:
            state = [r]
        elif len(state) == 1:
            s0 = state[0]
            if any(r[m] > s0[m] * f for m in range(3)):
                state = [s0, r]
            else:
                state = [r] if variant == "keep" else []
        else:
            s0, s1 = state
            for m in range(3):
                if r[m] > s0[m] * f and s1[m] > s0[m] * f:
                    out.append((r[3], m))
            state = [r]
    return out


@pytest.mark.parametrize("seed", [5, 6])
def test_breach_matches_simulation(spark, seed):
    rng = random.Random(seed)
    keys = {1: 300, 2: 40, 3: 5}          # one hot key
    rows = []
    seq = 0
    for k, n in keys.items():
        for i in range(n):
            rows.append((k, T0 + dt.timedelta(seconds=i), seq, float(rng.randint(5, 15)),
                         rng.randint(5, 15), float(rng.randint(5, 15)) / 100))
            seq += 1
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, seq long, acid double, cons long, water_rate double")
    names = ["acid", "cons", "water_rate"]
    for variant in ("keep", "drop"):
        want = []
        for k in keys:
            kr = [(r[3], float(r[4]), r[5], r[2]) for r in rows if r[0] == k]
            want += [(s, names[m]) for s, m in simulate(kr, 0.1, variant)]
        got = alerts.breach_alerts(df, "id", "ts", order=["seq"], variant=variant)
        assert sorted((r.seq, r.metric) for r in got.collect()) == sorted(want), variant


def test_arrival_order(spark):
    # readings arrive out of event-time order: by arrival 20, 30, 10 (the 30
    # is stamped last); by event time 20, 10, 30
    rows = [("s1", T0, "t0", 20.0, 0), ("s1", T0 + dt.timedelta(minutes=5), "t2", 30.0, 1),
            ("s1", T0 + dt.timedelta(minutes=1), "t1", 10.0, 2)]
    df = spark.createDataFrame(rows, "id string, ts timestamp_ntz, time string, temp double, seq long")
    by_time = alerts.running_mean_alerts(df).collect()
    by_arrival = alerts.running_mean_alerts(df, arrival=True).collect()
    assert sorted((r.temp, r.kind) for r in by_time) == [(10.0, "low"), (30.0, "high")]
    assert sorted((r.temp, r.kind) for r in by_arrival) == [(10.0, "low"), (30.0, "high")]
    assert {r.temp: r.n_before for r in by_time} == {10.0: 1, 30.0: 2}
    assert {r.temp: r.n_before for r in by_arrival} == {30.0: 1, 10.0: 2}


def test_sums_do_not_depend_on_slices(spark):
    from eventlens.sources import stand_ins
    t = stand_ins.temperature_readings(spark, "/root/testdata/sf0.1")
    runs = [alerts.running_mean_alerts(t, slice_width=w).selectExpr("id", "ts", "kind", "sum_before") for w in ("1 hour", "30 days")]
    assert runs[0].exceptAll(runs[1]).count() == 0 and runs[0].count() == runs[1].count() > 0


@pytest.mark.parametrize("temps,kinds", [
    ([1, 1, 1, float("inf"), 3], [None, None, None, "high", "low"]),
    ([1, 1, float("-inf"), 3], [None, None, "low", "high"]),
    ([1, 1, float("nan"), 900], [None, None, None, None]),
    ([1e15, 1e15, 1e15 + 8, 1e15 - 8], [None, None, "high", "low"]),
    ([1e300, 1e300, -1e300], [None, None, "low"]),
    ([float("inf"), float("-inf"), 3], [None, "low", None]),
])
def test_extreme_readings(spark, temps, kinds):
    out = {r.seq_: r.kind for r in alerts.running_mean_alerts(_temps(spark, temps)).selectExpr("n_before AS seq_", "kind").collect()}
    assert [out.get(i) for i in range(len(temps))] == kinds
