"""Arrival order: alerts and lateness by line number, in batch and as streams.

The lines are the temperature readings in an order of their own (a reading
comes up to fifty places late), written to several files; times have whole
seconds, so some tie.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parsing
from ..functions.timecols import to_ntz, to_stream_time
from ..operators import alerts, arrival
from ..session import scratch_path
from ..sources import files, stand_ins
from ..streaming import jobs
from . import iot
from .registry import query

FILES = 2
DISORDER = 50
COLS = ["id", "ts", "time", "temp", "n_before", "sum_before", "kind", "message"]

LINES_CTE = f"""temp AS (
  SELECT 'T1_' || event_type AS id, date_trunc('second', ts) AS ts, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, value AS temp,
         row_number() OVER (ORDER BY event_id + event_id * 7919 % {DISORDER}, event_id) - 1 AS line
  FROM events)"""
ARRIVAL_ALERTS = iot.RUNNING_MEAN.replace(iot.TEMP_CTE, LINES_CTE).replace("ORDER BY ts, seq", "ORDER BY line")
LATENESS = f"""
WITH {LINES_CTE},
m AS (SELECT *, date_trunc('hour', ts) AS window_start,
             max(ts) OVER (ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 SECOND AS mark FROM temp)
SELECT id, window_start, count(*) FILTER (late) AS n_late, count(*) FILTER (NOT late) AS n,
       round(sum(temp) FILTER (NOT late) / count(*) FILTER (NOT late), 6) AS avg_value
FROM (SELECT *, coalesce(window_start + INTERVAL 1 HOUR <= mark, false) AS late FROM m) GROUP BY id, window_start
"""


def _stage(spark, sf_dir) -> str:
    """The lines in arrival order, as files whose names and times follow it."""
    path = scratch_path(spark, "lines/arrival")
    lines = stand_ins.temperature_lines(spark, sf_dir)
    place = F.col("seq") + F.col("seq") * 7919 % DISORDER
    return jobs.stage_in_order(lines, path, F.struct(place, F.col("seq")), files=FILES, fmt="text", columns=["value"])


def _numbered(spark, path):
    return files.number_lines(files.with_place(files.read_lines(spark, path)))


def _stream(spark, path, step, kind):
    root = scratch_path(spark, f"stream/{kind}")
    parse = lambda lines: parsing.parse_temperature(lines, keep=["line"]).withColumn("ts", to_stream_time("ts"))

    def writer():
        lines = files.with_place(files.read_lines(spark, path, stream=True, max_files_per_trigger=FILES))
        return jobs.to_batches(lines, jobs.carried(step, f"{root}/sink", f"{root}/state", "ts", parse=parse))()

    jobs.run_available_now(writer, f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/sink")


def _alert_step(rows, state):
    return alerts.running_mean_step(rows, state, order=["line"], arrival=True)


def _late_step(rows, state):
    return arrival.mark_late_step(rows, state, size="1 hour", delay="1 second")


def _means(marked):
    kept = F.when(~F.col("late"), F.col("temp"))
    return marked.groupBy("id", "window_start").agg(
        F.count_if("late").alias("n_late"), F.count_if(~F.col("late")).alias("n"), F.round(F.avg(kept), 6).alias("avg_value"))


@query("arrival_alerts", ARRIVAL_ALERTS)
def arrival_alerts(spark, sf_dir):
    """SRC1 + ALR1 in line order: readings compared with the mean of the
    lines of their sensor read before."""
    rows = parsing.parse_temperature(_numbered(spark, _stage(spark, sf_dir)), keep=["line"])
    out = _alert_step(rows, None)[0]
    return out.select(*COLS).withColumn("sum_before", F.round("sum_before", 6))


@query("stream_arrival_alerts", ARRIVAL_ALERTS)
def stream_arrival_alerts(spark, sf_dir):
    """The same over several triggers, lines numbered on from trigger to
    trigger."""
    out = _stream(spark, _stage(spark, sf_dir), _alert_step, "arrival_alerts")
    return out.select(*COLS).withColumn("ts", to_ntz("ts")).withColumn("sum_before", F.round("sum_before", 6))


@query("lateness_by_arrival", LATENESS)
def lateness_by_arrival(spark, sf_dir):
    """STR2 + STR15: hourly means without exactly those rows that a watermark
    of one second's disorder drops, line by line."""
    rows = parsing.parse_temperature(_numbered(spark, _stage(spark, sf_dir)), keep=["line"])
    return _means(_late_step(rows, None)[0])


@query("stream_lateness_by_arrival", LATENESS)
def stream_lateness_by_arrival(spark, sf_dir):
    """The same over several triggers: the largest time so far is carried."""
    marked = _stream(spark, _stage(spark, sf_dir), _late_step, "lateness")
    return _means(marked).withColumn("window_start", to_ntz("window_start"))
