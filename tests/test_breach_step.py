"""Carried state: an operator run over consecutive parts of the data equals
the row-by-row state machine over all of it, for any split."""

import datetime as dt
import random

import pytest
from test_alerts import simulate

from eventlens.operators import alerts

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, ts timestamp_ntz, seq long, acid double, cons long, water_rate double, time string"


@pytest.mark.parametrize("seed,variant", [(1, "keep"), (2, "keep"), (1, "drop"), (2, "drop")])
def test_split_runs_equal_state_machine(spark, seed, variant):
    rng = random.Random(seed)
    rows = []
    for i in range(90):
        k = 1 if rng.random() < .8 else rng.choice([2, 3])
        rows.append((k, T0 + dt.timedelta(minutes=i), i, float(rng.randint(5, 15)), rng.randint(5, 15), float(rng.randint(5, 15)), str(i)))
    cuts = [0, *sorted(rng.sample(range(1, 90), 3)), 90]
    names = ["acid", "cons", "water_rate"]
    want = []
    for k in (1, 2, 3):
        want += [(s, names[m]) for s, m in simulate([(r[3], float(r[4]), r[5], r[2]) for r in rows if r[0] == k], 0.1, variant)]
    state, got = None, []
    for a, b in zip(cuts, cuts[1:]):
        df = spark.createDataFrame(rows[a:b], SCHEMA)
        out, state = alerts.breach_step(df, state, order=["seq"], variant=variant, slice_width="7 minutes")
        got += [(r.seq, r.metric) for r in out.collect()]
        state = state.checkpoint()
    assert sorted(got) == sorted(want)
