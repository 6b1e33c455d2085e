"""Entry point A from lines: one text source, three branches (daily report,
running-mean alerts, breach alerts), in batch and as a stream.

Readings of one key and second follow their values (lines carry no sequence
number), in both forms and in the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import messages, parsing
from ..functions.timecols import to_ntz, to_stream_time
from ..operators import alerts, ordered_scan, windows
from ..session import scratch_path
from ..sources import files, stand_ins
from ..streaming import jobs
from . import iot
from .registry import query

FILES = 2
QUALITY = ["acid", "cons", "water_rate"]

LINES_CTE = """temp AS (
  SELECT 'T1_' || event_type AS id, date_trunc('second', ts) AS ts, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time,
         value AS temp, value AS seq
  FROM events)"""
CONS = "CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(l_quantity AS BIGINT) END"
BREACH = (iot._breach_oracle("keep").replace("l_suppkey AS id", "'Q1_' || l_suppkey AS id")
          .replace("CAST(l_quantity AS BIGINT) AS cons", f"{CONS} AS cons")
          .replace("ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey", f"ORDER BY l_shipdate, l_extendedprice, {CONS}, l_tax"))
JOB = f"""
SELECT 'report' AS branch, id, window_start AS ts, report AS message FROM ({iot.DAILY_REPORT.replace(iot.TEMP_CTE, LINES_CTE)}) a
UNION ALL
SELECT 'temperature', id, ts, message FROM ({iot.RUNNING_MEAN.replace(iot.TEMP_CTE, LINES_CTE)}) b
UNION ALL
SELECT 'quality', id, ts, {iot._breach_text()} FROM ({BREACH}) c
"""


def temperatures(lines: DataFrame) -> DataFrame:
    """FLT1 + PRJ1."""
    return parsing.parse_temperature(parsing.prefix_filter(lines, "T1"))


def qualities(lines: DataFrame) -> DataFrame:
    """FLT1 + PRJ2."""
    return parsing.parse_quality(parsing.prefix_filter(lines, "Q1"))


def _as(branch: str, df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.select(F.lit(branch).alias("branch"), "id", F.col(ts).alias("ts"), "message")


def _temperature_step(rows, state):
    return alerts.running_mean_step(rows, state, order=["temp"])


def _quality_step(rows, state):
    return alerts.breach_step(rows, state, order=QUALITY, variant="keep", with_message=True, slice_width="30 days",
                              hot_rows=ordered_scan.HOT_ROWS)


def _report(temps: DataFrame) -> DataFrame:
    exact = temps.withColumn("temp", F.col("temp").cast(alerts.SUM_TYPE))
    return windows.window_mean(exact, "id", "ts", "temp", "1 day", incremental=True)


def _reported(means: DataFrame) -> DataFrame:
    means = means.withColumn("mean", F.col("sum_value").cast("double") / F.col("n"))
    return means.withColumn("message", messages.daily_report("window_start", "mean"))


@query("iot_job", JOB)
def iot_job(spark, sf_dir):
    """The program's three branches over one line source."""
    path = files.write_lines(stand_ins.iot_lines(spark, sf_dir), scratch_path(spark, "lines/iot"))
    lines = files.read_lines(spark, path)
    temps = temperatures(lines)
    return (_as("report", _reported(_report(temps)), "window_start")
            .unionByName(_as("temperature", _temperature_step(temps, None)[0]))
            .unionByName(_as("quality", _quality_step(qualities(lines), None)[0])))


@query("stream_iot_job", JOB)
def stream_iot_job(spark, sf_dir):
    """The same as streams over one folder of lines: a windowed mean with a
    watermark, and the two alert branches with state carried between
    triggers."""
    root = scratch_path(spark, "stream/iot_job")
    inp = f"{root}/input"
    at = F.to_timestamp(F.split("value", ",")[1], stand_ins.TIME_FMT)
    jobs.stage_in_order(stand_ins.iot_lines(spark, sf_dir).withColumn("at", at), inp, "at", files=FILES, fmt="text", columns=["value"])

    def source(parse):
        rows = parse(files.read_lines(spark, inp, stream=True, max_files_per_trigger=FILES))
        return rows.withColumn("ts", to_stream_time("ts"))

    def report():
        return jobs.to_parquet(_report(source(temperatures).withWatermark("ts", "1 second")), f"{root}/report")()

    def alert(parse, step, name):
        return lambda: jobs.to_batches(source(parse), jobs.carried(step, f"{root}/{name}", f"{root}/{name}-state", "ts"))()

    jobs.run_available_now(report, f"{root}/report-checkpoint")
    jobs.run_available_now(alert(temperatures, _temperature_step, "temperature"), f"{root}/temperature-checkpoint")
    jobs.run_available_now(alert(qualities, _quality_step, "quality"), f"{root}/quality-checkpoint")
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    # the end of the input ends the last days
    still = jobs.open_windows(spark, f"{root}/report-checkpoint").select(
        "id", F.col("window.start").alias("window_start"), F.col("sum").alias("sum_value"), F.col("count").alias("n"))
    means = read("report").select("id", "window_start", "sum_value", "n").unionByName(still)
    out = (_as("report", _reported(means), "window_start")
           .unionByName(_as("temperature", read("temperature")))
           .unionByName(_as("quality", read("quality"))))
    return out.withColumn("ts", to_ntz("ts"))
