"""Line numbers, alerts in line order and lateness line by line."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventlens.operators import alerts, arrival
from eventlens.session import own_session, scratch_path
from eventlens.sources import files


def _write(spark, texts):
    root = scratch_path(spark, "test/lines")
    for name, lines in texts.items():
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).sortWithinPartitions("value").write.text(f"{root}/{name}")
    return root


@pytest.mark.parametrize("split", [64, 1 << 20])
def test_lines_are_numbered_across_files_and_splits(spark, split):
    own = own_session(spark)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    own.conf.set("spark.sql.files.openCostInBytes", "1")
    texts = {"a": [f"a{k:03}" for k in range(40)], "b": [f"b{k:03}" for k in range(7)], "c": [f"c{k:03}" for k in range(90)]}
    lines = files.with_place(files.read_lines(own, _write(own, texts) + "/*"))
    assert split > 64 or lines.select("_file", "_block").distinct().count() > 5
    want = [x for name in sorted(texts) for x in texts[name]]
    for start in (0, 1000):
        got = sorted((r.line, r.value) for r in files.number_lines(lines, start=start).collect())
        assert got == [(start + k, x) for k, x in enumerate(want)]


T0 = dt.datetime(2024, 1, 1, 8, 0, 0)


def test_lateness_follows_the_lines_before(spark):
    seconds = [0, 3599, 3600, 3598, 3601, 3599, 7300, 3700, None, 7199, 7200]
    rows = [(k, None if s is None else T0 + dt.timedelta(seconds=s)) for k, s in enumerate(seconds)]
    df = spark.createDataFrame(rows, "line bigint, ts timestamp_ntz").repartition(3)
    want, top = [], None
    for line, t in rows:
        end = None if t is None else t.replace(minute=0, second=0) + dt.timedelta(hours=1)
        want.append((line, t is not None and top is not None and end <= top - dt.timedelta(seconds=1)))
        top = max((x for x in (top, t) if x is not None), default=None)
    assert [late for _, late in want].count(True) == 3
    for width in (1, 4, None):
        out = arrival.mark_late(df, size="1 hour", slice_width=width)
        assert sorted((r.line, r.late) for r in out.collect()) == want
    # in two parts, with the state of the first
    a, after = arrival.mark_late_step(df.where("line < 5"), None, size="1 hour")
    b, _ = arrival.mark_late_step(df.where("line >= 5"), after, size="1 hour")
    assert sorted((r.line, r.late) for r in a.unionByName(b).collect()) == want


def test_alerts_follow_line_order_where_seconds_tie(spark):
    rows = [("s", T0, "t", 20.0, 0), ("s", T0, "t", 40.0, 1), ("s", T0, "t", 22.0, 2)]
    df = spark.createDataFrame(rows, "id string, ts timestamp_ntz, time string, temp double, line bigint")
    got = lambda d: sorted((r.temp, r.kind) for r in alerts.running_mean_alerts(d, order=["line"], arrival=True).collect())
    assert got(df) == [(22.0, "low"), (40.0, "high")]
    assert got(df.withColumn("line", -F.col("line"))) == [(20.0, "low"), (40.0, "high")]
