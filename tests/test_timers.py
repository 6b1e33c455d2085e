"""Timers: rows wait in state until the watermark (or the clock) passes their
time, fire once, and what is open at the end is read from the checkpoint."""

import datetime as dt
from collections.abc import Iterator
from typing import Any

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventlens.operators import udf
from eventlens.session import own_session, scratch_path
from eventlens.streaming import jobs, timers

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)
SCHEMA = "id string, ts timestamp, temp double"


def _rows(spark, items):
    return spark.createDataFrame([(k, T0 + dt.timedelta(minutes=m), float(v)) for k, m, v in items], SCHEMA).repartition(1)


def _elements():
    def elements(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes, values = [], []
        for b in batches:
            sizes.append(len(b))
            values += b["temp"].tolist()
        yield pd.DataFrame({"id": [key[0]], "window_end": [key[-1]], "n": [len(values)], "top": [max(values)], "batch": [max(sizes)]})
    return elements          # by value: workers cannot import a test module


OUT = "id string, window_end timestamp_ntz, n bigint, top double, batch bigint"


def test_elements_until_the_window_ends(spark, monkeypatch):
    root = scratch_path(spark, "test/timers")

    def writer():
        s = jobs.file_stream(spark, f"{root}/in", SCHEMA, max_files_per_trigger=1).withWatermark("ts", "1 second")
        s = s.select("id", F.window("ts", "10 minutes").alias("window"), "temp")
        return jobs.to_parquet(timers.collect_until(s, ["id"], "window", _elements(), OUT), f"{root}/out")()

    def run(*parts):
        for part in parts:
            jobs.stage(_rows(spark, part), f"{root}/in")
        jobs.run_available_now(writer, f"{root}/ck")

    at = lambda m: T0 + dt.timedelta(minutes=m)
    read = lambda: sorted((r.id, r.window_end, r.n, r.top) for r in spark.read.parquet(f"{root}/out").collect())
    run([("a", 1, 20), ("a", 2, 21), ("b", 3, 5)], [("a", 9, 30), ("b", 12, 6)])
    assert read() == [("a", at(10), 3, 30.0), ("b", at(10), 1, 5.0)]
    # restart: state and timers go on; the late 99 met a window that has ended
    run([("a", 4, 99), ("b", 13, 7), ("b", 14, 8)])
    assert len(read()) == 2
    run([("a", 60, 1)])
    assert read() == [("a", at(10), 3, 30.0), ("b", at(10), 1, 5.0), ("b", at(20), 3, 8.0)]
    # the end of the input: the one open window, from the store, and nothing else
    monkeypatch.setattr(timers, "BATCH_ROWS", 2)
    still = timers.open_collected(spark, f"{root}/ck", ["id"], _elements(), OUT).collect()
    assert [(r.id, r.window_end, r.n, r.top) for r in still] == [("a", at(70), 1, 1.0)]


def test_state_rows_come_in_bounded_batches():
    parts = list(timers._batches(((k,) for k in range(25)), ["v"], 10))
    assert [len(p) for p in parts] == [10, 10, 5] and pd.concat(parts)["v"].tolist() == list(range(25))


def _mean():
    keys = ["id", "pane"]
    return {"partial": udf.mean_partial(keys, "temp"), "combine": udf.mean_combine(keys), "finish": udf.mean_finish(["id", "window_end"]),
            "partial_schema": "id string, pane timestamp_ntz, sum_value double, n bigint",
            "out_schema": "id string, window_end timestamp_ntz, n bigint, avg_value double"}


def _window_means(items, size=10, slide=5):
    """(id, end) -> (n, mean), by definition."""
    out = {}
    for k, m, v in items:
        first = m // slide * slide + slide
        for end in range(first, first + size, slide):
            out.setdefault((k, T0 + dt.timedelta(minutes=end)), []).append(v)
    return sorted(((*key, len(v), sum(v) / len(v)) for key, v in out.items()), key=repr)


def test_accumulators_merge_pane_by_pane(spark):
    items = [("a", m, m % 7) for m in range(0, 40, 2)] + [("b", 11, 3), ("b", 31, 4), (None, 7, 1)]
    df = _rows(spark, items).repartition(3)
    got = udf.user_aggregate_windows(df, ["id"], "ts", "10 minutes", "5 minutes", **_mean())
    rows = lambda d: sorted(((r.id, r.window_end, r.n, r.avg_value) for r in d.collect()), key=repr)
    assert rows(got) == _window_means(items)
    with pytest.raises(ValueError):
        udf.user_aggregate_windows(df, ["id"], "ts", "10 minutes", "3 minutes", **_mean())


def test_accumulators_on_a_stream(spark):
    root = scratch_path(spark, "test/panes")
    mean = _mean()

    def writer():
        s = jobs.file_stream(spark, f"{root}/in", SCHEMA, max_files_per_trigger=1).withWatermark("ts", "1 second")
        return jobs.to_parquet(timers.aggregate_windows(s, ["id"], "ts", "10 minutes", "5 minutes", **mean), f"{root}/out")()

    def run(*parts):
        for part in parts:
            jobs.stage(_rows(spark, part), f"{root}/in")
        jobs.run_available_now(writer, f"{root}/ck")

    first, second = [("a", 1, 10), ("a", 4, 20), ("b", 2, 5)], [("a", 8, 30)]
    late = [("a", 6, 50), ("a", 2, 1000)]       # 08:06 counts in its open window alone, 08:02 in none
    run(first, second)
    run([("a", 12, 40)])
    run(late)
    run([("b", 33, 7)])
    out = spark.read.parquet(f"{root}/out")
    still = timers.open_aggregates(spark, f"{root}/ck", ["id"], "10 minutes", "5 minutes", mean["combine"], mean["finish"], mean["out_schema"])
    got = sorted(((r.id, r.window_end, r.n, r.avg_value) for r in out.unionByName(still).collect()), key=repr)
    want = _window_means([*first, *second, ("a", 12, 40), ("b", 33, 7)])
    k = next(i for i, w in enumerate(want) if w[:2] == ("a", T0 + dt.timedelta(minutes=15)))
    want[k] = (*want[k][:2], 3, 40.0)           # 30 and 40, and the late 50
    assert got == want


def test_clock_windows_fire_once(spark):
    own = own_session(spark)
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    root = scratch_path(own, "test/clock")
    for k in range(4):
        jobs.stage(_rows(own, [("a", k, k), ("b", k, k)]), f"{root}/in")

    def writer():
        s = jobs.file_stream(own, f"{root}/in", SCHEMA, max_files_per_trigger=1)
        return jobs.to_parquet(timers.count_by_clock(s, ["id"], "1 second"), f"{root}/out")()

    jobs.run_available_now(writer, f"{root}/ck")
    fired = own.read.parquet(f"{root}/out").collect()
    open_ = timers.open_clock_counts(own, f"{root}/ck").collect()
    assert len({(r.id, r.window_end) for r in [*fired, *open_]}) == len(fired) + len(open_)
    assert sum(r.n for r in [*fired, *open_]) == 8


def test_a_batch_of_rows_is_one_element_of_the_state(spark):
    root = scratch_path(spark, "test/chunks")

    def writer():
        s = jobs.file_stream(spark, f"{root}/in", SCHEMA, max_files_per_trigger=1).withWatermark("ts", "1 second")
        s = s.select("id", F.window("ts", "10 minutes").alias("window"), "temp")
        return jobs.to_parquet(timers.collect_until(s, ["id"], "window", _elements(), OUT), f"{root}/out")()

    jobs.stage(_rows(spark, [("a", m % 10, m) for m in range(50)] + [("b", 3, 7)]), f"{root}/in")
    jobs.run_available_now(writer, f"{root}/ck")
    kept = spark.read.format("statestore").option("stateVarName", "rows").load(f"{root}/ck")
    assert kept.count() == 2
    still = timers.open_collected(spark, f"{root}/ck", ["id"], _elements(), OUT).collect()
    assert sorted((r.id, r.n, r.top) for r in still) == [("a", 50, 49.0), ("b", 1, 7.0)]
    parts = list(timers._chunks(pd.DataFrame({"v": range(25), "w": [None, *range(24)]}), 10))
    assert [len(v) for v, _ in parts] == [10, 10, 5] and parts[0][1][:2] == [None, 0]
