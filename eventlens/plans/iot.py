"""Entry point A: IoT temperature reports and alerts, quality alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import messages
from ..operators import alerts, windows
from ..sources import stand_ins
from .registry import query

TEMP_CTE = """temp AS (
  SELECT event_type AS id, ts, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, value AS temp, event_id AS seq
  FROM events)"""

DAILY_AVG = f"""
WITH {TEMP_CTE}
SELECT id, date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       count(*) AS n, round(avg(temp), 6) AS avg_value
FROM temp GROUP BY id, date_trunc('day', ts)
"""

DAILY_AVG_INC = f"""
WITH {TEMP_CTE}
SELECT id, date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       round(sum(temp), 6) AS sum_value, count(*) AS n, round(sum(temp) / count(*), 6) AS avg_value
FROM temp GROUP BY id, date_trunc('day', ts)
"""

MSG = """id || ',' || time || ',' || CAST(trunc(temp) AS INTEGER) || '; ' ||
         CASE kind WHEN 'high' THEN '温度过高' ELSE '温度过低' END"""

RUNNING_MEAN = f"""
WITH {TEMP_CTE},
r AS (SELECT *, count(*) OVER w AS n_before,
             CAST(coalesce(sum(CAST(temp AS DECIMAL(28, 10))) OVER w, 0) AS DOUBLE) AS sum_before
      FROM temp WINDOW w AS (PARTITION BY id ORDER BY ts, seq
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT *, 'high' AS kind FROM r WHERE n_before > 0 AND temp > sum_before / n_before + 5
      UNION ALL
      SELECT *, 'low' AS kind FROM r WHERE n_before > 0 AND temp < sum_before / n_before - 5)
SELECT id, ts, time, temp, n_before, round(sum_before, 6) AS sum_before, kind, {MSG} AS message FROM k
"""

WINDOW_MEAN = f"""
WITH {TEMP_CTE},
r AS (SELECT *, date_trunc('day', ts) AS window_start, count(*) OVER w AS n_before,
             CAST(coalesce(sum(CAST(temp AS DECIMAL(28, 10))) OVER w, 0) AS DOUBLE) AS sum_before
      FROM temp WINDOW w AS (PARTITION BY id, date_trunc('day', ts) ORDER BY ts, seq
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT *, 'high' AS kind FROM r WHERE n_before > 0 AND temp - sum_before / n_before > 5.0::DOUBLE)
SELECT id, window_start, ts, time, temp, n_before, round(sum_before, 6) AS sum_before, kind,
       {MSG} AS message FROM k
"""


def _breach_oracle(variant: str) -> str:
    """Independent form: the reference's state machine as a recursive CTE
    over each supplier's readings (state = number of stored readings)."""
    no_breach = "1" if variant == "keep" else "0"
    return f"""
WITH RECURSIVE q AS (
  SELECT l_suppkey AS id, l_shipdate AS ts, l_orderkey, l_linenumber, l_partkey,
         l_extendedprice AS acid, CAST(l_quantity AS BIGINT) AS cons, l_tax AS water_rate,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS time,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS rn
  FROM lineitem),
l AS (
  SELECT *, lag(acid) OVER w AS a1, lag(cons) OVER w AS c1, lag(water_rate) OVER w AS w1, lag(time) OVER w AS t1,
         lag(acid, 2) OVER w AS a2, lag(cons, 2) OVER w AS c2, lag(water_rate, 2) OVER w AS w2
  FROM q WINDOW w AS (PARTITION BY id ORDER BY rn)),
b AS (SELECT *, coalesce(acid > a1 * 1.1::DOUBLE OR cons > c1 * 1.1::DOUBLE OR water_rate > w1 * 1.1::DOUBLE, false) AS breach FROM l),
st(id, rn, n) AS (
  SELECT id, rn, 1 FROM b WHERE rn = 1
  UNION ALL
  SELECT b.id, b.rn,
         CASE WHEN st.n = 0 THEN 1 WHEN st.n = 2 THEN 1 WHEN b.breach THEN 2 ELSE {no_breach} END
  FROM st JOIN b ON b.id = st.id AND b.rn = st.rn + 1),
ev AS (SELECT b.* FROM b JOIN st ON st.id = b.id AND st.rn = b.rn - 1 WHERE st.n = 2),
al AS (
  SELECT id, ts, l_orderkey, l_linenumber, l_partkey, 'acid' AS metric, t1 AS first_time, a1 AS first_value,
         time AS second_time, acid AS second_value FROM ev WHERE acid > a2 * 1.1::DOUBLE AND a1 > a2 * 1.1::DOUBLE
  UNION ALL
  SELECT id, ts, l_orderkey, l_linenumber, l_partkey, 'cons', t1, CAST(c1 AS DOUBLE), time, CAST(cons AS DOUBLE)
  FROM ev WHERE cons > c2 * 1.1::DOUBLE AND c1 > c2 * 1.1::DOUBLE
  UNION ALL
  SELECT id, ts, l_orderkey, l_linenumber, l_partkey, 'water_rate', t1, w1, time, water_rate
  FROM ev WHERE water_rate > w2 * 1.1::DOUBLE AND w1 > w2 * 1.1::DOUBLE)
SELECT * FROM al
"""


RUNNING_SUM = """
SELECT ('sensor_' || user_id) = 'sensor_6' AS key, event_id AS seq, 'sensor_' || user_id AS id, value AS temper,
       round(sum(CAST(value AS DECIMAL(28, 10))) OVER (PARTITION BY ('sensor_' || user_id) = 'sensor_6' ORDER BY ts, event_id
                              ROWS UNBOUNDED PRECEDING)::DOUBLE, 6) AS running_temper
FROM events
"""


def _round(df, *cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("daily_avg", DAILY_AVG)
def daily_avg(spark, sf_dir):
    """AGG2 + STR7: mean temperature per sensor and UTC day."""
    t = stand_ins.temperature_readings(spark, sf_dir)
    return _round(windows.window_mean(t, "id", "ts", "temp", "1 day"), "avg_value")


@query("daily_avg_incremental", DAILY_AVG_INC)
def daily_avg_incremental(spark, sf_dir):
    """AGG3 + UDF5: accumulator (sum, count) finished as sum / count."""
    t = stand_ins.temperature_readings(spark, sf_dir)
    return _round(windows.window_mean(t, "id", "ts", "temp", "1 day", incremental=True), "sum_value", "avg_value")


DAILY_REPORT = f"""
WITH {TEMP_CTE},
d AS (SELECT id, date_trunc('day', ts) AS window_start,
             CAST(sum(CAST(temp AS DECIMAL(28, 10))) AS DOUBLE) / count(*) AS mean FROM temp GROUP BY 1, 2)
SELECT id, window_start, chr(10) || '{messages.REPORT_TITLE}' || chr(10) || '{messages.REPORT_TEMP}'
       || strftime(window_start, '%Y-%m-%d') || ' ' || CAST(round(CAST(CAST(mean AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DECIMAL(28, 2)) || chr(10) AS report
FROM d
"""


@query("daily_report_text", DAILY_REPORT)
def daily_report_text(spark, sf_dir):
    """FN10-12: the printed report, day label and mean with two decimals
    (half up), from exact sums."""
    t = stand_ins.temperature_readings(spark, sf_dir).withColumn("temp", F.col("temp").cast(alerts.SUM_TYPE))
    m = windows.window_mean(t, "id", "ts", "temp", "1 day", incremental=True)
    m = m.withColumn("avg_value", F.col("sum_value").cast("double") / F.col("n"))
    return m.select("id", "window_start", messages.daily_report("window_start", "avg_value").alias("report"))


@query("running_mean_alerts", RUNNING_MEAN)
def running_mean_alerts(spark, sf_dir):
    """ALR1 + AGG4: deviation of more than 5 from the sensor's running mean,
    with an exact running sum."""
    t = stand_ins.temperature_readings(spark, sf_dir)
    return _round(alerts.running_mean_alerts(t, "id", "ts", "temp", order=["seq"], margin=5),
                  "sum_before")


@query("window_mean_alerts", WINDOW_MEAN)
def window_mean_alerts(spark, sf_dir):
    """ALR2 + AGG5 + STR16: above the day's running mean by more than 5."""
    t = stand_ins.temperature_readings(spark, sf_dir)
    return _round(alerts.window_mean_alerts(t, "id", "ts", "temp", order=["seq"]), "sum_before")


def _breach(spark, sf_dir, variant):
    q = stand_ins.quality_readings(spark, sf_dir)
    return alerts.breach_alerts(q, "id", "ts", order=["l_orderkey", "l_linenumber", "l_partkey"],
                                rate=0.1, variant=variant, slice_width="30 days")


@query("breach_alerts_keep", _breach_oracle("keep"))
def breach_alerts_keep(spark, sf_dir):
    """ALR3: two readings in a row over the baseline, keep variant."""
    return _breach(spark, sf_dir, "keep")


def _breach_text() -> str:
    label = "CASE metric " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in messages.METRIC_LABEL.items()) + " END"
    line = lambda t, v, nth: f"id || ',' || {t} || ',' || {label} || ':' || {v} || ' {nth}' || {label} || '{messages.TOO_HIGH}'"
    return line("first_time", "first_value", messages.FIRST_TIME) + " || chr(10) || " + line("second_time", "second_value", messages.SECOND_TIME)


@query("breach_alert_text", f"SELECT id, ts, l_orderkey, l_linenumber, l_partkey, metric, {_breach_text()} AS message FROM ({_breach_oracle('keep')}) x")
def breach_alert_text(spark, sf_dir):
    """FN12 + SNK3: the printed two-line breach alert."""
    q = stand_ins.quality_readings(spark, sf_dir)
    out = alerts.breach_alerts(q, "id", "ts", order=["l_orderkey", "l_linenumber", "l_partkey"], rate=0.1,
                               variant="keep", with_message=True, slice_width="30 days")
    return out.select("id", "ts", "l_orderkey", "l_linenumber", "l_partkey", "metric", "message")


@query("breach_alerts_drop", _breach_oracle("drop"))
def breach_alerts_drop(spark, sf_dir):
    """ALR4: two readings in a row over the baseline, drop variant."""
    return _breach(spark, sf_dir, "drop")


@query("running_sum", RUNNING_SUM)
def running_sum(spark, sf_dir):
    """AGG6: running sum of the temperature keyed by ``id == 'sensor_6'``
    (two keys, one of them holding almost every row)."""
    s = stand_ins.sensor_readings(spark, sf_dir).select("id", "temper", "seq", "event_ts")
    out = alerts.keyed_running_sum(s, F.col("id") == "sensor_6", "temper", "event_ts", order=["seq"])
    return _round(out.select("key", "seq", "id", "temper", "running_temper"), "running_temper")
