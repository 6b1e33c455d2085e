"""Parser edges from FIXTURES.md: missing and repeated tags, short lines,
prefix selection, bad numbers by mode."""

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from eventlens.functions import parsing


def _lines(spark, *ls):
    return spark.createDataFrame([(x,) for x in ls], "value string")


def test_quality_tags(spark):
    lines = _lines(spark,
                   "Q1a,2024-01-01 00:00:01,AB:1.5,CE:0.2;",            # no AE: cons 0
                   "Q1b,2024-01-01 00:00:02,AB:1.0,AE:7,AB:2.5,CE:0.1;",  # AB twice: last wins
                   "Q1c,2024-01-01 00:00:03,CE:0.3,XX:9,AE:4,AB:3.0;")    # any order, unknown tag
    got = {r.id: (r.acid, r.cons, r.water_rate) for r in parsing.parse_quality(lines).collect()}
    assert got == {"Q1a": (1.5, 0, 0.2), "Q1b": (2.5, 7, 0.1), "Q1c": (3.0, 4, 0.3)}


def test_prefix_filter_short_lines(spark):
    lines = _lines(spark, "", "T", "T10,2024-01-01 00:00:00,1.0;", "Q1,x", "T1,2024-01-01 00:00:00,2.5;")
    t = parsing.parse_temperature(parsing.prefix_filter(lines, "T1")).collect()
    assert sorted((r.id, r.temp) for r in t) == [("T1", 2.5), ("T10", 1.0)]


def test_bad_number_modes(spark):
    lines = _lines(spark, "T1,2024-01-01 00:00:00,abc;", "T1,2024-01-01 00:00:01,3.0;")
    with pytest.raises((PySparkException, Py4JJavaError)):
        parsing.parse_temperature(lines).collect()
    nulls = parsing.parse_temperature(lines, on_error="null").collect()
    assert sorted((r.temp is None) for r in nulls) == [False, True]
    good, bad = parsing.parse_temperature(lines, on_error="quarantine")
    assert [r.temp for r in good.collect()] == [3.0]
    assert [r.value for r in bad.collect()] == ["T1,2024-01-01 00:00:00,abc;"]


def test_access_log_sample(spark):
    line = ("83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET "
            "/presentations/logstash-monitorama-2013/images/kibana-search.png")
    r = parsing.parse_access_log(_lines(spark, line)).collect()[0]
    assert (r.ip, r.user_id, str(r.ts), r.method) == ("83.149.9.216", "-", "2015-05-17 10:05:03", "GET")
    assert r.url.endswith("kibana-search.png")


def test_sensor_csv_sample(spark):
    rows = parsing.parse_sensor_csv(_lines(spark, "sensor_1,1547718199,35.8001", "sensor_1,1547718299,36.8001"))
    assert [(r.id, r.ts, r.temperature) for r in rows.collect()] == [
        ("sensor_1", 1547718199, 35.8001), ("sensor_1", 1547718299, 36.8001)]


def test_behavior_line(spark):
    r = parsing.parse_user_behavior(_lines(spark, "543462,1715,1464116,pv,1511658000")).collect()[0]
    assert (r.user_id, r.item_id, r.category_id, r.behavior, str(r.ts)) == (
        543462, 1715, 1464116, "pv", "2017-11-26 01:00:00")


def test_quality_bad_tag_value_modes(spark):
    lines = _lines(spark, "Q1a,2024-01-01 00:00:01,AB:x1,AE:3,CE:0.2;", "Q1b,2024-01-01 00:00:02,AB:1.0;")
    with pytest.raises((PySparkException, Py4JJavaError)):
        parsing.parse_quality(lines).collect()
    good, bad = parsing.parse_quality(lines, on_error="quarantine")
    assert [(r.id, r.acid, r.cons, r.water_rate) for r in good.collect()] == [("Q1b", 1.0, 0, 0.0)]
    assert bad.count() == 1


def test_behavior_and_log_short_lines_null_mode(spark):
    b = parsing.parse_user_behavior(_lines(spark, "1,2,3", "1,2,3,pv,1511658000"), on_error="null").collect()
    assert sorted((r.behavior is None, r.ts is None) for r in b) == [(False, False), (True, True)]
    good, bad = parsing.parse_access_log(_lines(spark, "1.2.3.4 - -", "1.2.3.4 - - 17/05/2015:10:05:03 +0000 GET /a"),
                                         on_error="quarantine")
    assert [r.url for r in good.collect()] == ["/a"]
    assert [r.value for r in bad.collect()] == ["1.2.3.4 - -"]


def test_lenient_times_roll_over(spark):
    """What the reference's date parser makes of odd fields."""
    rolled = {"2024-13-01 00:00:00": "2025-01-01 00:00:00", "2024-00-10 00:00:00": "2023-12-10 00:00:00",
              "2024-02-30 10:00:00": "2024-03-01 10:00:00", "2023-2-29 1:2:3": "2023-03-01 01:02:03",
              "2024-01-00 00:00:00": "2023-12-31 00:00:00", "2024-12-31 24:00:00": "2025-01-01 00:00:00",
              "2024-01-01 00:61:200": "2024-01-01 01:04:20", "2024-01-01 00:00:-1": "2023-12-31 23:59:59",
              "2024-01-05 06:07:08 and more": "2024-01-05 06:07:08", "2024-01-05 06:07:08": "2024-01-05 06:07:08",
              "2024-14-35 30:00:00": "2025-03-08 06:00:00"}
    bad = ["", "2024-01-01", "yesterday", "2024/01/01 00:00:00"]
    lines = _lines(spark, *[f"T1,{t},1.0;" for t in [*rolled, *bad]])
    got = {r.time: r.ts and str(r.ts) for r in parsing.parse_temperature(lines, on_error="null", lenient=True).collect()}
    assert got == rolled | dict.fromkeys(bad)
    with pytest.raises((PySparkException, Py4JJavaError)):
        parsing.parse_temperature(_lines(spark, "T1,yesterday,1.0;"), lenient=True).collect()
    log = _lines(spark, "10.0.0.1 - u 32/13/2024:25:00:00 +0000 GET /a")
    assert str(parsing.parse_access_log(log, lenient=True).first().ts) == "2025-02-02 01:00:00"


def test_declared_lengths_and_nulls_are_checked(spark):
    from eventlens.session import scratch_path
    from eventlens.sources import files, tables
    ddl = "id varchar(8) not null, ts bigint, temperature double"
    good, long, null = ("sensor_1,1,2.5", "sensor_10,1,2.5", ",1,2.5")

    def read(*lines):
        path = files.write_lines(_lines(spark, *lines), scratch_path(spark, "test/ddl-check"))
        return tables.create_csv_table_ddl(spark, "declared", path, ddl, computed={"rt": "timestamp_seconds(ts)"})

    assert [(r.id, r.ts, r.temperature) for r in read(good).collect()] == [("sensor_1", 1, 2.5)]
    for line, message in ((long, "longer than 8"), (null, "declared not null")):
        with pytest.raises((PySparkException, Py4JJavaError), match=message):
            read(good, line).collect()


def test_a_quality_line_is_split_once(spark):
    df = parsing.parse_quality(spark.range(3).selectExpr("concat('Q1_', id, ',2024-01-01 00:00:00,AB:1.5,AE:2,CE:0.5;') AS value"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert [r.acid for r in df.collect()] == [1.5] * 3
