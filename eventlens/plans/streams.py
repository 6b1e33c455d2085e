"""Streaming forms, run to completion with ``availableNow`` into files under
the shared folder and read back.

Inputs are staged from the driver tables as files in event-time order.
Windowed operators in append mode return a window once the watermark passes
its end, and a bounded input never moves the watermark past its last window
(hazard H1): what is still open after the last trigger is read from the
stream's state store (``jobs.open_windows`` and the ``timers.open_...``
functions), as the reference's end of input ends all windows.  With these
rows the results equal the batch ones and share their oracles.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import functions as F

from .. import schemas
from ..functions import messages, parsing
from ..functions.timecols import add_seconds, to_ntz, to_stream_time
from ..operators import alerts, ranking, select
from ..session import scratch_path
from ..sources import files, stand_ins, tables
from ..streaming import jobs, timers
from . import hot, iot, tables_sql, udfs
from .registry import query

FILES = 2          # files per trigger


def _temps(spark, sf_dir):
    return stand_ins.temperature_readings(spark, sf_dir).withColumn("ts", to_stream_time("ts"))


def _ntz(df, *cols):
    return df.select(*[to_ntz(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def _daily_avg_stream(spark, sf_dir, late_row: bool):
    inp, sink, ck = jobs.fresh(spark, "daily_avg")
    t = _temps(spark, sf_dir)
    jobs.stage_in_order(t, inp, "ts", files=FILES)

    def writer():
        s = jobs.file_stream(spark, inp, t.schema, max_files_per_trigger=FILES)
        return jobs.to_parquet(jobs.window_mean(s, "id", "ts", "temp", "1 day", "1 second"), sink)()

    jobs.run_available_now(writer, ck)
    if late_row:
        # the earliest reading again, arriving after its day was closed
        jobs.stage(t.orderBy("ts", "seq").limit(1).withColumn("seq", F.lit(-2).cast("bigint")), inp)
        jobs.run_available_now(writer, ck)
    cols = ["id", "window_start", "window_end", "n", "avg_value"]
    still = jobs.open_windows(spark, ck).select("id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                                                F.col("count").alias("n"), (F.col("sum") / F.col("count")).alias("avg_value"))
    out = spark.read.parquet(sink).select(*cols).unionByName(still)
    return _ntz(out.withColumn("avg_value", F.round("avg_value", 6)), "window_start", "window_end")


@query("stream_daily_avg", iot.DAILY_AVG)
def stream_daily_avg(spark, sf_dir):
    """STR1/2/7 + AGG2 + STR17 on a stream: 1-day tumbling mean, 1 s
    watermark; the last days are flushed from the state."""
    return _daily_avg_stream(spark, sf_dir, late_row=False)


@query("stream_late_data", iot.DAILY_AVG)
def stream_late_data(spark, sf_dir):
    """STR15: a late copy of the first reading arrives after its window was
    emitted; the windowed mean drops it, so the result equals the batch one."""
    return _daily_avg_stream(spark, sf_dir, late_row=True)


def _with_open_top(spark, sink, ck, key, size, slide):
    """The top 3 written so far and those of the windows still open."""
    cols = ["window_end", "rk", key, "cnt"]
    still = ranking.top_n(jobs.open_window_counts(spark, ck, key, size, slide), "window_end", "cnt", 3, tie=key)
    return _ntz(spark.read.parquet(sink).select(*cols).unionByName(still.select(*cols)), "window_end")


def _staged_views(spark, sf_dir, inp):
    """User behaviour as CSV lines in event-time order, and the stream of
    counts per item and sliding window over them."""
    ub = stand_ins.user_behavior(spark, sf_dir)
    lines = ub.select(F.concat_ws(",", "user_id", "item_id", "category_id", "behavior",
                                  stand_ins.epoch_seconds("ts")).alias("value"), F.col("ts").cast("timestamp").alias("ts"))
    jobs.stage_in_order(lines, inp, "ts", files=FILES, fmt="text", columns=["value"])

    def counts():
        log = parsing.parse_user_behavior(files.read_lines(spark, inp, stream=True, max_files_per_trigger=FILES))
        log = log.withColumn("ts", to_stream_time("ts")).withWatermark("ts", "0 seconds")
        return jobs.window_counts_panes(log.filter(F.col("behavior") == "pv"), "item_id", "ts", "1 hour", "5 minutes")
    return counts


@query("stream_hot_items", hot.HOT_ITEMS)
def stream_hot_items(spark, sf_dir):
    """Entry point B on a stream, from CSV lines: parsed, the watermark moved
    by every row, page views counted per 1 h / 5 min window through panes,
    top 3 per window end ranked in ``foreachBatch``."""
    inp, sink, ck = jobs.fresh(spark, "hot_items")
    counts = _staged_views(spark, sf_dir, inp)

    def writer():
        return jobs.to_batches(counts(), jobs.rank_each_batch(sink, "window_end", "cnt", 3, "item_id",
                                                            ["window_end", "rk", "item_id", "cnt"]))()

    jobs.run_available_now(writer, ck)
    return _with_open_top(spark, sink, ck, "item_id", "1 hour", "5 minutes")


def _alert_stream(spark, kind, staged, ts, step, cols, ntz_cols, **clock):
    """Stage in event-time order, run one group of files per trigger with
    carried state, read the alerts back."""
    inp, sink, ck = jobs.fresh(spark, kind)
    jobs.stage_in_order(staged, inp, ts, files=FILES)

    def writer():
        s = jobs.file_stream(spark, inp, staged.schema, max_files_per_trigger=FILES)
        return jobs.to_batches(s, jobs.carried(step, sink, f"{ck}-state", ts, **clock))()

    jobs.run_available_now(writer, ck)
    return _ntz(spark.read.parquet(sink).drop("batch"), *ntz_cols).select(*cols)


@query("stream_running_mean", iot.RUNNING_MEAN)
def stream_running_mean(spark, sf_dir):
    """ALR1 on a stream: (n, sum) per sensor carried between triggers."""
    out = _alert_stream(spark, "running_mean", _temps(spark, sf_dir), "ts", alerts.running_mean_step,
                        ["id", "ts", "time", "temp", "n_before", "sum_before", "kind", "message"], ["ts"])
    return out.withColumn("sum_before", F.round("sum_before", 6))


WINDOW_COLS = ["id", "window_start", "ts", "time", "temp", "n_before", "sum_before", "kind", "message"]


@query("stream_window_mean", iot.WINDOW_MEAN)
def stream_window_mean(spark, sf_dir):
    """ALR2 on a stream: state per (sensor, day), cleared when the day ends."""
    out = _alert_stream(spark, "window_mean", _temps(spark, sf_dir), "ts", alerts.window_mean_step,
                        WINDOW_COLS, ["ts", "window_start"], delay="1 second", window="1 day")
    return out.withColumn("sum_before", F.round("sum_before", 6))


@query("stream_window_mean_late", iot.WINDOW_MEAN)
def stream_window_mean_late(spark, sf_dir):
    """ALR2 + STR15: the first day's readings arrive once more, far too hot,
    after all others; their day has ended, so they raise no alert."""
    t = _temps(spark, sf_dir)
    inp, sink, ck = jobs.fresh(spark, "window_mean_late")
    jobs.stage_in_order(t, inp, "ts", files=FILES)
    first_day = t.where(F.col("ts") < add_seconds(F.lit(t.agg(F.min("ts")).first()[0]), 3600))
    jobs.stage(first_day.withColumn("temp", F.lit(1e6)).withColumn("seq", F.col("seq") + (1 << 40)).repartition(FILES), inp)

    def writer():
        s = jobs.file_stream(spark, inp, t.schema, max_files_per_trigger=FILES)
        return jobs.to_batches(s, jobs.carried(alerts.window_mean_step, sink, f"{ck}-state", "ts",
                                               delay="1 second", window="1 day"))()

    jobs.run_available_now(writer, ck)
    out = _ntz(spark.read.parquet(sink).drop("batch"), "ts", "window_start").select(*WINDOW_COLS)
    return out.withColumn("sum_before", F.round("sum_before", 6))


def _quality(spark, sf_dir):
    q = stand_ins.quality_readings(spark, sf_dir)
    return q.withColumn("ts", F.col("ts").cast("timestamp")) \
            .withColumn("time", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


def _breach_stream(spark, sf_dir, variant):
    cols = ["id", "ts", "l_orderkey", "l_linenumber", "l_partkey", "metric", "first_time", "first_value",
            "second_time", "second_value"]
    step = lambda rows, state: alerts.breach_step(
        rows, state, order=["l_orderkey", "l_linenumber", "l_partkey"], rate=0.1, variant=variant, slice_width="30 days")
    return _alert_stream(spark, f"breach_{variant}", _quality(spark, sf_dir), "ts", step, cols, ["ts"])


@query("stream_breach_keep", iot._breach_oracle("keep"))
def stream_breach_keep(spark, sf_dir):
    """ALR3 on a stream: the last two readings and the last mark per key
    carried between triggers."""
    return _breach_stream(spark, sf_dir, "keep")


@query("stream_breach_drop", iot._breach_oracle("drop"))
def stream_breach_drop(spark, sf_dir):
    """ALR4 on a stream."""
    return _breach_stream(spark, sf_dir, "drop")


def _sensors(spark, sf_dir):
    return stand_ins.sensor_readings(spark, sf_dir).withColumn("event_ts", F.col("event_ts").cast("timestamp"))


@query("stream_running_sum", iot.RUNNING_SUM)
def stream_running_sum(spark, sf_dir):
    """AGG6 on a stream: running sum of the temperature keyed by
    ``id == 'sensor_6'``, one row per element."""
    step = lambda rows, state: alerts.running_sum_step(
        rows, state, F.col("id") == "sensor_6", "temper", "event_ts")
    s = _sensors(spark, sf_dir).select("id", "temper", "seq", "event_ts")
    out = _alert_stream(spark, "running_sum", s, "event_ts", step,
                        ["key", "seq", "id", "temper", "running_temper"], [])
    return out.withColumn("running_temper", F.round("running_temper", 6))


KEYED_SUM = """
SELECT event_id AS seq, 'sensor_' || user_id AS id, value AS temper,
       round(sum(CAST(value AS DECIMAL(28, 10))) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                                       ROWS UNBOUNDED PRECEDING)::DOUBLE, 6) AS running_temper
FROM events
"""


@query("stream_keyed_process", KEYED_SUM)
def stream_keyed_process(spark, sf_dir):
    """UDF6: a keyed function per sensor, here a running sum, with carried
    state; a hot sensor spreads over its slices.  (``jobs.keyed_process`` is
    the hook for functions that cannot be split.)"""
    step = lambda rows, state: alerts.running_sum_step(
        rows, state, F.col("id"), "temper", "event_ts")
    s = _sensors(spark, sf_dir).select("id", "temper", "seq", "event_ts")
    out = _alert_stream(spark, "keyed_process", s, "event_ts", step, ["seq", "id", "temper", "running_temper"], [])
    return out.withColumn("running_temper", F.round("running_temper", 6))


@query("stream_tagged_split", tables_sql.TAGGED)
def stream_tagged_split(spark, sf_dir):
    """SNK5/SNK6 on a stream: main output and one folder per tag, written
    per micro-batch by ``foreachBatch``."""
    inp, sink, ck = jobs.fresh(spark, "tagged")
    s = stand_ins.sensor_readings(spark, sf_dir).select("id", "ts", "temper", "seq")
    jobs.stage_in_order(s.withColumn("at", F.timestamp_seconds("ts")), inp, "at", files=FILES)
    i = F.col("id")
    routes = {messages.TAG_6: i == "sensor_6", messages.TAG_1: i == "sensor_1"}
    msgs = {messages.TAG_6: F.concat(F.lit(messages.SIDE_TAG_6), i),
            messages.TAG_1: F.concat(F.lit(messages.SIDE_TAG_1), i)}
    jobs.run_available_now(
        lambda: jobs.to_batches(jobs.file_stream(spark, inp, s.schema, max_files_per_trigger=FILES), jobs.tagged_sink(sink, routes, msgs))(), ck)
    out = spark.read.parquet(sink)
    return out.select("id", "ts", "temper", "seq", F.col("tag").cast("string").alias("tag"), "message")


@query("stream_udf_tagged_split", tables_sql.TAGGED)
def stream_udf_tagged_split(spark, sf_dir):
    """UDF7 + SNK5/6 on a stream: a user's process function emitting to tags."""
    inp, sink, ck = jobs.fresh(spark, "udf_tagged")
    s = stand_ins.sensor_readings(spark, sf_dir).select("id", "ts", "temper", "seq")
    jobs.stage_in_order(s.withColumn("at", F.timestamp_seconds("ts")), inp, "at", files=FILES, columns=s.columns)
    stream = jobs.file_stream(spark, inp, s.schema, max_files_per_trigger=FILES)
    jobs.run_available_now(jobs.to_tags(select.process(stream, udfs.alarm_function(), udfs.TAGGED_SCHEMA), sink), ck)
    return spark.read.schema(udfs.TAGGED_SCHEMA).parquet(sink)


EVENT_TIME_HOURS = """
SELECT 'sensor_' || CAST(user_id AS VARCHAR) AS id, date_trunc('hour', ts) AS window_start, count(*) AS n
FROM events GROUP BY 1, 2
"""


@query("stream_event_time_table", EVENT_TIME_HOURS)
def stream_event_time_table(spark, sf_dir):
    """SRC5 + PRJ11 + STR4/5 + FN16 on a stream: the CSV table declared with a
    computed row time and a 1-second watermark, counted per sensor and hour."""
    root = scratch_path(spark, "stream/event_time_table")
    inp, sink, ck = f"{root}/input", f"{root}/sink", f"{root}/checkpoint"
    lines = stand_ins.sensor_csv_lines(spark, sf_dir)
    at = F.timestamp_seconds(F.split("value", ",")[1].cast("bigint"))
    jobs.stage_in_order(lines.withColumn("at", at), inp, "at", files=FILES, fmt="text", columns=["value"])

    def writer():
        tables.create_csv_table_ddl(spark, "sensor_stream", inp, "id varchar(20) not null, ts bigint, temperature double",
                                    computed={"rt": "to_timestamp(from_unixtime(ts))"}, watermark=("rt", "1 second"),
                                    stream=True, max_files_per_trigger=FILES)
        counts = spark.sql("SELECT id, window(rt, '1 hour').start AS window_start, count(*) AS n "
                           "FROM sensor_stream GROUP BY id, window(rt, '1 hour')")
        return jobs.to_parquet(counts, sink)()

    jobs.run_available_now(writer, ck)
    still = jobs.open_windows(spark, ck).select("id", F.col("window.start").alias("window_start"), F.col("count").alias("n"))
    return _ntz(spark.read.parquet(sink).select("id", "window_start", "n").unionByName(still), "window_start")


@query("stream_hot_urls", hot.HOT_URLS)
def stream_hot_urls(spark, sf_dir):
    """STR9 + AGG14 + RNK2 on a stream, from access-log lines: parsed, counted
    per 1 min / 5 s window through panes, top 3 per window end."""
    inp, sink, ck = jobs.fresh(spark, "hot_urls")
    lines = stand_ins.access_log_lines(spark, sf_dir)
    parsed = parsing.parse_access_log(lines.withColumn("line", F.col("value")), keep=["line"])
    jobs.stage_in_order(parsed.withColumnRenamed("line", "value").withColumn("ts", to_stream_time("ts")), inp, "ts", files=FILES, fmt="text", columns=["value"])

    def writer():
        log = parsing.parse_access_log(files.read_lines(spark, inp, stream=True, max_files_per_trigger=FILES))
        log = log.withColumn("ts", to_stream_time("ts")).withWatermark("ts", "0 seconds")
        counts = jobs.window_counts_panes(log, "url", "ts", "1 minute", "5 seconds")
        return jobs.to_batches(counts, jobs.rank_each_batch(sink, "window_end", "cnt", 3, "url",
                                                            ["window_end", "rk", "url", "cnt"]))()

    jobs.run_available_now(writer, ck)
    return _with_open_top(spark, sink, ck, "url", "1 minute", "5 seconds")


def _counted(spark, sf_dir):
    """Counts per id of a CSV file stream, as changes and as a table."""
    root = scratch_path(spark, "stream/group_count")
    inp, sink, ck = f"{root}/input", f"{root}/sink", f"{root}/checkpoint"
    files.write_lines(stand_ins.sensor_csv_lines(spark, sf_dir).repartition(6), inp)

    def writer():
        s = spark.readStream.schema(schemas.SENSOR_CSV).option("maxFilesPerTrigger", 1).csv(inp)
        return jobs.to_batches(s.select("id"), jobs.changing_counts("id", sink, f"{ck}-state"))()

    jobs.run_available_now(writer, ck)
    return sink, f"{ck}-state"


@query("stream_group_count", tables_sql.GROUP_COUNT)
def stream_group_count(spark, sf_dir):
    """AGG7 + SRC3 + SNK2 on a stream: CSV file stream with the declared
    schema, unbounded count per id, upserted."""
    return jobs.current_counts(spark, _counted(spark, sf_dir)[1])


@query("stream_group_changes", tables_sql.GROUP_COUNT)
def stream_group_changes(spark, sf_dir):
    """AGG7 + SNK2: the log of retracted and added counts, folded: what was
    added less what was retracted is the count."""
    log = spark.read.parquet(_counted(spark, sf_dir)[0])
    return log.groupBy("id").agg(F.sum(F.when(F.col("add"), F.col("cnt")).otherwise(-F.col("cnt"))).alias("cnt"))


@query("stream_timer_topn", hot.HOT_ITEMS)
def stream_timer_topn(spark, sf_dir):
    """STR13 + UDF6: the reference's own form of the top-N.  Counts of a window
    end wait in list state (its best three, the rest is let go at once), an
    event-time timer at the window's end returns them and clears the state."""
    inp, sink, ck = jobs.fresh(spark, "timer_topn")
    counts = _staged_views(spark, sf_dir, inp)

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.sort_values(["cnt", "item_id"], ascending=[False, True]).head(3)

    def top(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = best(pd.concat(list(batches), ignore_index=True))
        yield pd.DataFrame({"window_end": key[-1], "rk": range(1, len(kept) + 1), "item_id": kept["item_id"].tolist(),
                            "cnt": kept["cnt"].tolist()})

    def writer():
        c = counts().select("window", "item_id", "cnt")
        return jobs.to_parquet(timers.collect_until(c, [], "window", top, TOPN, keep=best), sink)()

    jobs.run_available_now(writer, ck)
    waiting = timers.open_collected(spark, ck, [], top, TOPN)
    return _with_open_top(spark, sink, ck, "item_id", "1 hour", "5 minutes").unionByName(waiting)


TOPN = "window_end timestamp_ntz, rk int, item_id bigint, cnt bigint"
SPREAD = "id string, window_start timestamp_ntz, n bigint, spread double"


@query("stream_window_process", udfs.WINDOW_RANGE)
def stream_window_process(spark, sf_dir):
    """UDF3 on a stream: the elements of every (sensor, day) wait in list
    state and go to the user's function, in bounded batches, when a timer
    ends the day."""
    inp, sink, ck = jobs.fresh(spark, "window_process")
    t = _temps(spark, sf_dir)
    jobs.stage_in_order(t, inp, "ts", files=FILES)

    def spread(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from udfs.value_spread((key[0], key[1] - pd.Timedelta("1 day")), batches)

    def writer():
        s = jobs.file_stream(spark, inp, t.schema, max_files_per_trigger=FILES).withWatermark("ts", "1 second")
        s = s.select("id", F.window("ts", "1 day").alias("window"), "temp")
        return jobs.to_parquet(timers.collect_until(s, ["id"], "window", spread, SPREAD), sink)()

    jobs.run_available_now(writer, ck)
    return spark.read.parquet(sink).unionByName(timers.open_collected(spark, ck, ["id"], spread, SPREAD))


@query("stream_udf_sliding_mean", udfs.SLIDING_MEAN)
def stream_udf_sliding_mean(spark, sf_dir):
    """UDF2 + UDF5 on a stream: a user's (sum, count) accumulators as keyed
    state per 5-minute pane, merged into 1 h windows when these end."""
    inp, sink, ck = jobs.fresh(spark, "udf_sliding_mean")
    t = _temps(spark, sf_dir)
    jobs.stage_in_order(t, inp, "ts", files=FILES)
    mean = udfs.sliding_mean_functions()

    def writer():
        s = jobs.file_stream(spark, inp, t.schema, max_files_per_trigger=FILES).withWatermark("ts", "1 second")
        return jobs.to_parquet(timers.aggregate_windows(s.select("id", "ts", "temp"), ["id"], "ts", "1 hour", "5 minutes", **mean), sink)()

    jobs.run_available_now(writer, ck)
    still = timers.open_aggregates(spark, ck, ["id"], "1 hour", "5 minutes", mean["combine"], mean["finish"], mean["out_schema"])
    out = spark.read.parquet(sink).unionByName(still)
    return out.withColumn("avg_value", F.round("avg_value", 6))


PROCTIME_COUNTS = "SELECT event_type AS id, count(*) AS n, CAST(1 AS BIGINT) AS times FROM events GROUP BY event_type"


@query("stream_proctime_counts", PROCTIME_COUNTS)
def stream_proctime_counts(spark, sf_dir):
    """STR6 on a stream: readings per sensor type and second of processing
    time.  Which window a reading falls into is up to the clock, so the
    result is what does not depend on it: readings per type over all windows,
    those the clock ended and those still open, each of which came once."""
    inp, sink, ck = jobs.fresh(spark, "proctime_counts")
    t = _temps(spark, sf_dir)
    jobs.stage_in_order(t, inp, "ts", files=FILES)
    # the clock always goes on: without input a run to completion would never end
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")

    def writer():
        s = jobs.file_stream(spark, inp, t.schema, max_files_per_trigger=FILES)
        return jobs.to_parquet(timers.count_by_clock(s, ["id"], "1 second"), sink)()

    jobs.run_available_now(writer, ck)
    counted = spark.read.parquet(sink).unionByName(timers.open_clock_counts(spark, ck))
    once = counted.groupBy("id", "window_end").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("times"))
    return once.groupBy("id").agg(F.sum("n").alias("n"), F.max("times").alias("times"))
