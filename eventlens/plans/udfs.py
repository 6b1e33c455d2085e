"""User-function hook queries."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import functions as F

from ..functions import messages
from ..operators import select, udf
from ..session import scratch_path
from ..sources import stand_ins
from . import tables_sql
from .registry import query

GROUPED_MEAN = """
SELECT event_type AS id, date_trunc('day', ts) AS window_start, count(*) AS n, round(avg(value), 6) AS avg_value
FROM events GROUP BY event_type, date_trunc('day', ts)
"""


@query("udf_grouped_mean", GROUPED_MEAN)
def udf_grouped_mean(spark, sf_dir):
    """UDF2 + UDF3 + UDF5: the daily mean through a user accumulator
    (sum, count) with map-side combine, finished per (sensor, day)."""
    keys = ["id", "window_start"]
    t = stand_ins.temperature_readings(spark, sf_dir).select(
        "id", F.window("ts", "1 day").start.alias("window_start"), "temp")
    out = udf.user_aggregate(
        t, keys, udf.mean_partial(keys, "temp"), udf.mean_combine(keys), udf.mean_finish(keys),
        "id string, window_start timestamp_ntz, sum_value double, n bigint",
        "id string, window_start timestamp_ntz, n bigint, avg_value double")
    return out.select("id", "window_start", "n", F.round("avg_value", 6).alias("avg_value"))


SLIDING_MEAN = """
WITH panes AS (SELECT event_type AS id, time_bucket(INTERVAL 5 MINUTE, ts) AS pane, value FROM events),
w AS (SELECT id, pane + to_minutes(CAST(5 * k AS BIGINT)) AS window_end, value FROM panes CROSS JOIN range(1, 13) t(k))
SELECT id, window_end, count(*) AS n, round(avg(value), 6) AS avg_value FROM w GROUP BY id, window_end
"""


def sliding_mean_functions() -> dict:
    """The daily mean's accumulator, for panes and sliding windows."""
    return {"partial": udf.mean_partial(["id", "pane"], "temp"), "combine": udf.mean_combine(["id", "pane"]),
            "finish": udf.mean_finish(["id", "window_end"]),
            "partial_schema": "id string, pane timestamp_ntz, sum_value double, n bigint",
            "out_schema": "id string, window_end timestamp_ntz, n bigint, avg_value double"}


@query("udf_sliding_mean", SLIDING_MEAN)
def udf_sliding_mean(spark, sf_dir):
    """UDF2 + UDF5 over sliding windows: a user's mean per sensor and 1 h
    window sliding by 5 min, its accumulators merged pane by pane."""
    t = stand_ins.temperature_readings(spark, sf_dir).select("id", "ts", "temp")
    out = udf.user_aggregate_windows(t, ["id"], "ts", "1 hour", "5 minutes", **sliding_mean_functions())
    return out.withColumn("avg_value", F.round("avg_value", 6))


WINDOW_RANGE = """
SELECT event_type AS id, date_trunc('day', ts) AS window_start, count(*) AS n, max(value) - min(value) AS spread
FROM events GROUP BY event_type, date_trunc('day', ts)
"""


def value_spread(key: tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Count and range of a window's temperatures."""
    n, low, high = 0, float("inf"), float("-inf")
    for b in batches:
        n, low, high = n + len(b), min(low, b["temp"].min()), max(high, b["temp"].max())
    yield pd.DataFrame({"id": [key[0]], "window_start": [key[1]], "n": [n], "spread": [high - low]})


def spread_functions(keys: list[str]) -> dict:
    """The same as accumulators (count, least, greatest) of a user aggregate."""
    def partial(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby(keys, sort=False, dropna=False)["temp"].agg(n="size", low="min", high="max").reset_index()

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby(keys, sort=False, dropna=False).agg({"n": "sum", "low": "min", "high": "max"}).reset_index()

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf[keys].assign(n=pdf["n"].astype("int64"), spread=pdf["high"] - pdf["low"])
    return {"partial": partial, "combine": combine, "finish": finish}


@query("udf_window_process", WINDOW_RANGE)
def udf_window_process(spark, sf_dir):
    """UDF3: a user's function over the elements of every (sensor, day).  Count
    and range can be merged, so the days' elements are folded where they are
    (``udf.process_windows`` is the hook for functions that need them all)."""
    keys = ["id", "window_start"]
    t = stand_ins.temperature_readings(spark, sf_dir).select("id", F.window("ts", "1 day").start.alias("window_start"), "temp")
    return udf.user_aggregate(t, keys, **spread_functions(keys), partial_schema="id string, window_start timestamp_ntz, n bigint, low double, high double",
                              out_schema="id string, window_start timestamp_ntz, n bigint, spread double")


TAGGED_SCHEMA = "id string, ts int, temper double, seq bigint, message string, tag string"


def alarm_function():
    """The reference's process function: every element to the main output, two
    sensors also to a side output, with a message each."""
    sides = {"sensor_6": (messages.TAG_6, messages.SIDE_TAG_6), "sensor_1": (messages.TAG_1, messages.SIDE_TAG_1)}

    def alarm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(message=None, tag="main")
            for sensor, (tag, text) in sides.items():
                hit = b[b["id"] == sensor]
                if len(hit):
                    yield hit.assign(message=text + hit["id"], tag=tag)
    return alarm


@query("udf_tagged_split", tables_sql.TAGGED)
def udf_tagged_split(spark, sf_dir):
    """UDF7 + SNK5: the tagged split by a user's process function."""
    s = stand_ins.sensor_readings(spark, sf_dir).select("id", "ts", "temper", "seq")
    out = select.process(s, alarm_function(), TAGGED_SCHEMA)
    return select.write_tagged(out, scratch_path(spark, "tagged"))
