"""Streams against batch: several files, two runs on one checkpoint, one
late row that the windowed mean drops and the alert processor sees."""

import datetime as dt
import pathlib

from pyspark.sql import functions as F

from eventlens.operators import alerts
from eventlens.session import scratch_path
from eventlens.streaming import jobs
from eventlens.streaming.processors import RunningSumProcessor
from eventlens.streaming.state import KeyedState

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)
SCHEMA = "id string, ts timestamp, time string, temp double, seq long"


def _rows(spark, items):
    rows = [("s1", t, t.strftime("%Y-%m-%d %H:%M:%S"), float(v), s) for s, (t, v) in enumerate(items)]
    return spark.createDataFrame(rows, SCHEMA)


def test_stream_late_row(spark):
    root = scratch_path(spark, "test/stream")
    inp, sink_w, sink_a = f"{root}/in", f"{root}/win", f"{root}/alerts"
    first = [(T0 + dt.timedelta(minutes=i), v) for i, v in enumerate([20, 21, 30, 10])]
    jobs.stage(_rows(spark, first[:2]), inp)
    jobs.stage(_rows(spark, first[2:]).withColumn("seq", F.col("seq") + 2), inp)

    def win():
        s = jobs.file_stream(spark, inp, SCHEMA)
        return jobs.to_parquet(jobs.window_mean(s, "id", "ts", "temp", "1 day", "1 second"), sink_w)()

    def alr():
        return jobs.to_batches(jobs.file_stream(spark, inp, SCHEMA),
                               jobs.carried(alerts.running_mean_step, sink_a, f"{root}/state", "ts"))()

    jobs.run_available_now(win, f"{root}/ck_w")
    jobs.run_available_now(alr, f"{root}/ck_a")
    # the next day's reading moves the watermark past day 1; a late day-1
    # reading and a far-future row follow in later files
    jobs.stage(_rows(spark, [(T0 + dt.timedelta(days=1), 22)]).withColumn("seq", F.lit(10).cast("long")), inp)
    jobs.run_available_now(win, f"{root}/ck_w")
    jobs.run_available_now(alr, f"{root}/ck_a")
    jobs.stage(_rows(spark, [(T0 + dt.timedelta(minutes=30), 100),
                             (dt.datetime(2100, 1, 1), 0)]).withColumn("seq", F.col("seq") + 20), inp)
    jobs.run_available_now(win, f"{root}/ck_w")
    jobs.run_available_now(alr, f"{root}/ck_a")

    days = {r.window_start.date(): (r.n, r.avg_value) for r in spark.read.parquet(sink_w).collect()}
    assert days[dt.date(2024, 1, 1)] == (4, 20.25)     # the late 100 was dropped
    assert days[dt.date(2024, 1, 2)] == (1, 22.0)
    got = sorted((r.temp, r.kind) for r in spark.read.parquet(sink_a).collect())
    # 30 high, 10 low (batch answers), then the late 100 is still seen, and the
    # far-future 0 is low against the mean of everything before it
    assert got == [(0.0, "low"), (10.0, "low"), (30.0, "high"), (100.0, "high")]


def test_stream_equals_batch_alerts(spark):
    root = scratch_path(spark, "test/stream2")
    items = [(T0 + dt.timedelta(minutes=i), v) for i, v in enumerate([20, 21, 30, 10, 27, 5, 40, 12, float("inf"), 3])]
    df = _rows(spark, items)
    jobs.stage_in_order(df, f"{root}/in", "ts", parts=5, files=1)
    jobs.run_available_now(
        lambda: jobs.to_batches(jobs.file_stream(spark, f"{root}/in", SCHEMA, max_files_per_trigger=1),
                                jobs.carried(alerts.running_mean_step, f"{root}/out", f"{root}/state", "ts"))(), f"{root}/ck")
    out = spark.read.parquet(f"{root}/out")
    assert out.select("batch").distinct().count() >= 4
    cols = ["temp", "kind", "n_before", "sum_before", "message"]
    assert sorted(map(tuple, out.select(*cols).collect())) == sorted(map(tuple, alerts.running_mean_alerts(df).select(*cols).collect()))


def test_window_state_is_cleared(spark):
    root = scratch_path(spark, "test/stream3")
    days = [(T0 + dt.timedelta(days=d, minutes=i), 20 + i) for d in range(4) for i in range(3)]
    jobs.stage_in_order(_rows(spark, days), f"{root}/in", "ts", parts=4, files=1)
    late = _rows(spark, [(T0 + dt.timedelta(minutes=30), 500)]).withColumn("seq", F.lit(99).cast("long"))
    jobs.stage(late.repartition(1), f"{root}/in")
    step = jobs.carried(alerts.window_mean_step, f"{root}/out", f"{root}/state", "ts", delay="1 second", window="1 day")
    jobs.run_available_now(lambda: jobs.to_batches(
        jobs.file_stream(spark, f"{root}/in", SCHEMA, max_files_per_trigger=1), step)(), f"{root}/ck")
    assert spark.read.parquet(f"{root}/out").count() == 0      # the late 500 met no state and was dropped
    state = KeyedState.newest(spark, f"{root}/state")
    starts = {r[0].date() for r in state.table().select("key.window_start").collect()}
    assert starts <= {dt.date(2024, 1, 3), dt.date(2024, 1, 4)} and state.latest.date() == dt.date(2024, 1, 4)


def test_ttl_clears_idle_keys(spark):
    root = scratch_path(spark, "test/stream4")
    a = _rows(spark, [(T0, 20)])
    b = _rows(spark, [(T0 + dt.timedelta(days=9), 21)]).withColumn("id", F.lit("s2"))
    c = _rows(spark, [(T0 + dt.timedelta(days=10), 21)]).withColumn("id", F.lit("s3"))
    for part in (a, b, c):
        jobs.stage(part.repartition(1), f"{root}/in")
    step = jobs.carried(alerts.running_mean_step, f"{root}/out", f"{root}/state", "ts", ttl="2 days")
    jobs.run_available_now(lambda: jobs.to_batches(
        jobs.file_stream(spark, f"{root}/in", SCHEMA, max_files_per_trigger=1), step)(), f"{root}/ck")
    assert [r[0] for r in KeyedState.newest(spark, f"{root}/state").table().select("key.id").orderBy("id").collect()] == ["s2", "s3"]


def _size(path):
    return sum(f.stat().st_size for f in pathlib.Path(path).rglob("*.parquet"))


def test_a_trigger_writes_the_state_of_its_own_keys(spark, monkeypatch):
    """Bytes and rows written follow the trigger's keys, not all keys; a
    replayed trigger finds what it started from; merged runs are deleted."""
    folder = scratch_path(spark, "test/state")
    wide = lambda n: spark.range(n).select(F.struct("id").alias("key"), F.lit(1).alias("n"), F.rand(1).alias("x")).coalesce(1)
    KeyedState(spark, folder, 0).commit(wide(20000), None)
    whole, written = _size(f"{folder}/run=0"), []
    for batch in range(1, 9):
        rows = spark.range(5).select(F.struct("id").alias("key"), F.lit(batch + 1).alias("n"), F.rand(1).alias("x")).coalesce(1)
        for _ in range(1 + (batch == 4)):                       # the fourth runs twice
            state = KeyedState(spark, folder, batch)
            assert {r.n for r in state.of(rows.select("key")).collect()} == {batch}
            state.commit(rows, dt.datetime(2024, 1, 1 + batch))
        written.append(_size(f"{folder}/run={batch}"))
    assert max(written) < whole / 20
    state = KeyedState.newest(spark, folder)
    assert state.latest == dt.datetime(2024, 1, 9) and state.runs[0] == (0, 20000) and len(state.runs) <= 4
    table = state.table()
    assert table.count() == 20000 and table.where("n = 9").count() == 5 and table.where("n = 1").count() == 19995
    kept = {int(p.name[4:]) for p in pathlib.Path(folder).glob("run=*")}
    assert kept == {b for b, _ in state.runs} | set(state.merged)


def test_counts_as_changes(spark):
    root = scratch_path(spark, "test/changes")
    parts = [["a", "a", "b"], ["b", None], ["a", "c"], ["d"]]
    for ids in parts:
        jobs.stage(spark.createDataFrame([(i,) for i in ids], "id string").repartition(1), f"{root}/in")
    jobs.run_available_now(lambda: jobs.to_batches(jobs.file_stream(spark, f"{root}/in", "id string", max_files_per_trigger=1),
                                                   jobs.changing_counts("id", f"{root}/out", f"{root}/state"))(), f"{root}/ck")
    log = [(r.batch, r.id, r.add, r.cnt) for r in spark.read.parquet(f"{root}/out").collect()]
    assert sorted(log, key=repr) == sorted([
        (0, "a", True, 2), (0, "b", True, 1), (1, "b", False, 1), (1, "b", True, 2), (1, None, True, 0),
        (2, "a", False, 2), (2, "a", True, 3), (2, "c", True, 1), (3, "d", True, 1)], key=repr)
    assert {r.id: r.cnt for r in jobs.current_counts(spark, f"{root}/state").collect()} == {"a": 3, "b": 2, "c": 1, "d": 1, None: 0}


def test_keyed_process_hook(spark):
    """UDF6: any user processor; rows of a key in order, state kept between runs."""
    root = scratch_path(spark, "test/keyed")
    jobs.stage(_rows(spark, [(T0 + dt.timedelta(minutes=i), v) for i, v in enumerate([1, 2, 3])]).repartition(1), f"{root}/in")
    for extra in (None, 4):
        if extra:
            jobs.stage(_rows(spark, [(T0 + dt.timedelta(hours=1), extra)]).repartition(1), f"{root}/in")
        jobs.run_available_now(lambda: jobs.to_parquet(jobs.keyed_process(
            jobs.file_stream(spark, f"{root}/in", SCHEMA), ["id"], RunningSumProcessor("temp", ["ts", "seq"], ["id", "temp"]),
            "id string, temp double, running_temp double"), f"{root}/out")(), f"{root}/ck")
    assert sorted((r.temp, r.running_temp) for r in spark.read.parquet(f"{root}/out").collect()) == [(1, 1), (2, 3), (3, 6), (4, 10)]


def test_ddl_table_stream_watermark(spark):
    from eventlens.sources import files, tables
    root = scratch_path(spark, "test/ddl")
    lines = spark.createDataFrame([("sensor_1,1547718199,35.8001",), ("sensor_1,1547718299,36.8001",),
                                   ("sensor_6,1547718399,15.4",), ("sensor_1,1647718399,0.0",)], "value string")
    files.write_lines(lines, f"{root}/in")
    df = tables.create_csv_table_ddl(spark, "dataTableStream", f"{root}/in", "id string, ts bigint, temperature double",
                                     computed={"rt": "to_timestamp(from_unixtime(ts))"},
                                     watermark=("rt", "1 second"), stream=True)
    assert df.isStreaming and dict(df.dtypes)["rt"] == "timestamp"
    counts = spark.sql("SELECT id, window(rt, '1 hour').start AS w, count(*) AS n FROM dataTableStream "
                       "GROUP BY id, window(rt, '1 hour')")
    jobs.run_available_now(lambda: jobs.to_parquet(counts, f"{root}/out")(), f"{root}/ck")
    got = sorted((r.id, r.n) for r in spark.read.parquet(f"{root}/out").collect())
    # the 2022 row moves the watermark past the 2019 windows and stays open itself
    assert got == [("sensor_1", 2), ("sensor_6", 1)]
