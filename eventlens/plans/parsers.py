"""Line sources and parsers: round trips from typed tables to text and back."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import parsing
from ..session import scratch_path
from ..sources import files, line_source, stand_ins, tables
from ..streaming import jobs
from .registry import query

TEMP_PARSED = """
SELECT 'T1_' || event_type AS id, date_trunc('second', ts) AS ts, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time,
       value AS temp
FROM events
"""

QUALITY_PARSED = """
SELECT 'Q1_' || CAST(l_suppkey AS VARCHAR) AS id, date_trunc('second', l_shipdate) AS ts,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS time, l_extendedprice AS acid,
       CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(trunc(l_quantity) AS BIGINT) END AS cons,
       l_tax AS water_rate
FROM lineitem
"""

BEHAVIOR_PARSED = """
SELECT event_id AS user_id, user_id AS item_id, CAST(user_id % 10 AS INTEGER) AS category_id,
       CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior,
       date_trunc('second', ts) AS ts
FROM events
"""

ACCESS_PARSED = """
SELECT '10.' || CAST((e.event_id >> 16) % 256 AS VARCHAR) || '.' || CAST((e.event_id >> 8) % 256 AS VARCHAR)
       || '.' || CAST(e.event_id % 256 AS VARCHAR) AS ip,
       CASE WHEN e.event_type = 'purchase' THEN 'u' || CAST(e.user_id AS VARCHAR) ELSE '-' END AS user_id,
       date_trunc('second', e.ts) AS ts,
       CASE WHEN e.event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
       coalesce(p.url, '/item/' || CAST(e.user_id AS VARCHAR)) AS url
FROM events e LEFT JOIN pages p ON e.user_id = p.page_id
"""

SENSOR_PARSED = """
SELECT 'sensor_' || CAST(user_id AS VARCHAR) AS id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS ts,
       value AS temperature
FROM events
"""


@query("text_scan_prefix_filter", TEMP_PARSED)
def text_scan_prefix_filter(spark, sf_dir):
    """SRC1 + FLT1 + PRJ1: the mixed IoT line file (temperature and quality
    lines) written as text, scanned with ``read.text``, the ``T1`` lines
    selected by prefix and parsed."""
    path = files.write_lines(stand_ins.iot_lines(spark, sf_dir), scratch_path(spark, "lines/iot"))
    lines = files.read_lines(spark, path)
    return parsing.parse_temperature(parsing.prefix_filter(lines, "T1"))


@query("parse_temp_lines", TEMP_PARSED)
def parse_temp_lines(spark, sf_dir):
    """PRJ1: ``id,yyyy-MM-dd HH:mm:ss,temp;`` lines to typed readings."""
    return parsing.parse_temperature(stand_ins.temperature_lines(spark, sf_dir).select("value"))


@query("parse_quality_lines", QUALITY_PARSED)
def parse_quality_lines(spark, sf_dir):
    """PRJ2: tagged quality lines (tags in any order, a missing ``AE:``,
    a repeated ``AB:``)."""
    lines = stand_ins.quality_lines(spark, sf_dir).select("value")
    return parsing.parse_quality(parsing.prefix_filter(lines, "Q1"))


@query("parse_behavior_lines", BEHAVIOR_PARSED)
def parse_behavior_lines(spark, sf_dir):
    """PRJ3 + FN13: user-behaviour CSV lines with epoch seconds."""
    return parsing.parse_user_behavior(stand_ins.user_behavior_lines(spark, sf_dir))


@query("parse_access_log", ACCESS_PARSED)
def parse_access_log(spark, sf_dir):
    """PRJ4 + FN9: web access-log lines."""
    return parsing.parse_access_log(stand_ins.access_log_lines(spark, sf_dir).select("value"))


@query("parse_sensor_csv", SENSOR_PARSED)
def parse_sensor_csv(spark, sf_dir):
    """PRJ5: ``id,epochSeconds,temperature`` lines."""
    return parsing.parse_sensor_csv(stand_ins.sensor_csv_lines(spark, sf_dir))


FILES = 6
LINES_PER_FILE = 1 << 22


def _line_files(lines: int) -> int:
    """Files for so many lines: a task writes one, whose size is bounded."""
    return max(FILES, math.ceil(lines / LINES_PER_FILE))


@query("stream_source_lines", TEMP_PARSED)
def stream_source_lines(spark, sf_dir):
    """SRC7 + SRC1 + FLT1: the mixed line files as a stream of the line
    source, a few files per trigger; ``T1`` lines parsed."""
    root = scratch_path(spark, "stream/source_lines")
    n = sum(tables.load(spark, sf_dir, t).count() for t in ("events", "lineitem"))
    files.write_lines(stand_ins.iot_lines(spark, sf_dir).repartition(_line_files(n)), f"{root}/input")
    lines = line_source.stream_lines(spark, f"{root}/input", f"{root}/progress/offset.json", files_per_trigger=3)
    temps = parsing.parse_temperature(parsing.prefix_filter(lines, "T1"))
    jobs.run_until_caught_up(jobs.to_parquet(temps, f"{root}/sink"), f"{root}/checkpoint", timeout_s=3600)
    return spark.read.parquet(f"{root}/sink")


LENIENT_PARSED = """
WITH p AS (SELECT *, user_id % 30 AS mo, event_id % 70 AS d, event_id % 50 AS h, event_id % 130 AS mi, event_id % 200 AS s FROM events)
SELECT 'T1_' || event_type AS id, '2024-' || mo || '-' || d || ' ' || h || ':' || mi || ':' || s AS time, value AS temp,
       TIMESTAMP '2024-01-01 00:00:00' + to_months(CAST(mo - 1 AS INTEGER)) + to_days(CAST(d - 1 AS INTEGER)) + to_hours(h)
       + to_minutes(mi) + to_seconds(s) AS ts
FROM p
"""


@query("parse_lenient_lines", LENIENT_PARSED)
def parse_lenient_lines(spark, sf_dir):
    """FN8: lines whose months, days, hours, minutes and seconds lie out of
    range roll over, as with the reference's date parser."""
    ev = tables.load(spark, sf_dir, "events")
    e = F.col("event_id")
    time = F.concat(F.concat_ws("-", F.lit("2024"), F.col("user_id") % 30, e % 70), F.lit(" "), F.concat_ws(":", e % 50, e % 130, e % 200))
    lines = ev.select(F.concat(F.concat_ws(",", F.concat(F.lit("T1_"), "event_type"), time, F.col("value").cast("string")), F.lit(";")).alias("value"))
    return parsing.parse_temperature(lines, lenient=True)
