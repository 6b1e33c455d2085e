"""Sliding counts (direct and panes), top-N edges, routing, user aggregate."""

import datetime as dt
import random

from pyspark.sql import functions as F

from eventlens.operators import ranking, select, udf, windows
from eventlens.sources import files
from eventlens import schemas

T0 = dt.datetime(2024, 1, 1)


def test_panes_equal_direct(spark):
    rng = random.Random(3)
    rows = [(rng.randint(1, 6), T0 + dt.timedelta(seconds=rng.randint(0, 6 * 3600))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "item_id long, ts timestamp_ntz")
    a = windows.window_counts(df, "item_id", "ts", "1 hour", "5 minutes")
    b = windows.window_counts_panes(df, "item_id", "ts", "1 hour", "5 minutes")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_top_n_edges(spark):
    e1, e2 = T0, T0 + dt.timedelta(hours=1)
    rows = [(e1, 5, 3), (e1, 2, 3), (e1, 9, 1), (e1, 7, 3),   # ties: lower id first
            (e2, 1, 4)]                                         # fewer items than N
    df = spark.createDataFrame(rows, "window_end timestamp_ntz, item_id long, cnt long")
    got = ranking.top_n(df, "window_end", "cnt", 3, tie="item_id").collect()
    assert sorted((r.window_end, r.rk, r.item_id) for r in got) == [
        (e1, 1, 2), (e1, 2, 5), (e1, 3, 7), (e2, 1, 1)]


def test_no_view_window_has_no_output(spark):
    rows = [(1, T0, "buy"), (2, T0 + dt.timedelta(minutes=1), "buy")]
    df = spark.createDataFrame(rows, "item_id long, ts timestamp_ntz, behavior string")
    pv = df.filter(F.col("behavior") == "pv")
    assert windows.window_counts(pv, "item_id", "ts", "1 hour", "5 minutes").count() == 0


def test_sensor_alarm_elements(spark):
    # the four readings of the reference, as elements
    rows = [("sensor_1", 1547718199, 35.80018327300259), ("sensor_6", 1547718199, 15.402984393403084),
            ("sensor_6", 1547718199, 6.720945201171228), ("sensor_10", 1547718199, 38.101067604893444)]
    df = files.elements(spark, rows, schemas.SENSOR_ELEMENT)
    routed = select.sensor_alarm(df)
    assert select.side_output(routed, "main").count() == 4
    assert [r.message for r in select.side_output(routed, "tmp-output").collect()] == ["6传感器id：sensor_6"] * 2
    assert [r.message for r in select.side_output(routed, "qa-output").collect()] == ["1传感器id：sensor_1"]
    assert df.filter(F.col("id") == "sensor_6").count() == 2


def test_user_aggregate_mean(spark):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.8 else "cold", float(rng.randint(0, 100))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "id string, temp double").repartition(7)
    keys = ["id"]
    out = udf.user_aggregate(df, keys, udf.mean_partial(keys, "temp"), udf.mean_combine(keys),
                             udf.mean_finish(keys), "id string, sum_value double, n bigint",
                             "id string, n bigint, avg_value double")
    want = {r.id: (r.n, r.a) for r in df.groupBy("id").agg(F.count("*").alias("n"), F.avg("temp").alias("a")).collect()}
    got = {r.id: (r.n, r.avg_value) for r in out.collect()}
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9


def test_split_outputs_and_seq(spark, tmp_path):
    from eventlens.session import scratch_path
    df = spark.createDataFrame([("sensor_1", 1), ("sensor_6", 2), ("sensor_6", 3)], "id string, v int")
    parts = select.split_outputs(df, {"six": F.col("id") == "sensor_6"})
    assert parts["main"].count() == 3 and parts["six"].count() == 2
    path = scratch_path(spark, "test/lines")
    files.write_lines(spark.createDataFrame([(f"line{i}",) for i in range(50)], "value string").coalesce(1), path)
    seq = files.with_seq(files.read_lines(spark, path)).orderBy("_file", "_block", "_pos")
    assert [r.value for r in seq.collect()] == [f"line{i}" for i in range(50)]


def test_report_texts(spark):
    from eventlens.functions import messages
    df = spark.createDataFrame([(T0, 0.125), (T0, 1.005), (T0, 12.0)], "d timestamp_ntz, a double")
    texts = [r.t for r in df.select(messages.daily_report("d", "a").alias("t")).collect()]
    # Java's %.2f rounds half up on the decimal form: 0.125 -> 0.13, 1.005 -> 1.01
    assert texts == ["\n报表结果：\n温度：2024-01-01 0.13\n", "\n报表结果：\n温度：2024-01-01 1.01\n",
                     "\n报表结果：\n温度：2024-01-01 12.00\n"]
    ranked = spark.createDataFrame([(T0, 1, 7, 5), (T0, 2, 3, 4)], "window_end timestamp_ntz, rk long, item_id long, cnt long")
    rep = ranking.top_n_report(ranked, "window_end", "item_id", "cnt").collect()[0].report
    assert "No1:  商品ID=7  浏览量=5\nNo2:  商品ID=3  浏览量=4" in rep
    assert rep.startswith("====") and "时间: 2024-01-01 00:00:00" in rep


def test_alert_text_int_like_jvm(spark):
    from eventlens.functions import messages
    df = spark.createDataFrame([("s", "t", 36.9, "high"), ("s", "t", -2.7, "low"), ("s", "t", 1e12, "high"),
                                ("s", "t", float("nan"), "high")], "id string, time string, temp double, kind string")
    got = [r.m for r in df.select(messages.temp_alert("id", "time", "temp", "kind").alias("m")).collect()]
    assert got == ["s,t,36; 温度过高", "s,t,-2; 温度过低", "s,t,2147483647; 温度过高", "s,t,0; 温度过高"]
