"""Entry point C: CSV tables, Table-API and SQL select/filter, DDL tables
with computed time columns, element sources and tagged outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..functions import messages
from ..functions.timecols import add_seconds, to_ntz
from ..operators import select, windows
from ..session import scratch_path
from ..sources import files, stand_ins, tables
from .registry import query

SENSOR_1 = """
SELECT 'sensor_' || CAST(user_id AS VARCHAR) AS id, value AS temperature FROM events WHERE user_id = 1
"""

EVENT_TIME = """
SELECT 'sensor_' || CAST(user_id AS VARCHAR) AS id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS ts,
       value AS temperature,
       TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT)) AS rt
FROM events
"""

ELEMENTS_6 = """
SELECT 'sensor_' || CAST(user_id AS VARCHAR) AS id, CAST(floor(epoch_us(ts) / 1000000) AS INTEGER) AS ts,
       value AS temper
FROM events WHERE user_id = 6
"""

TAGGED = """
WITH s AS (SELECT 'sensor_' || CAST(user_id AS VARCHAR) AS id, CAST(floor(epoch_us(ts) / 1000000) AS INTEGER) AS ts,
                  value AS temper, event_id AS seq FROM events)
SELECT id, ts, temper, seq, 'main' AS tag, CAST(NULL AS VARCHAR) AS message FROM s
UNION ALL
SELECT id, ts, temper, seq, 'tmp-output', '6传感器id：' || id FROM s WHERE id = 'sensor_6'
UNION ALL
SELECT id, ts, temper, seq, 'qa-output', '1传感器id：' || id FROM s WHERE id = 'sensor_1'
"""

GROUP_COUNT = """
SELECT 'sensor_' || CAST(user_id AS VARCHAR) AS id, count(*) AS cnt FROM events GROUP BY user_id
"""


def sensor_csv_table(spark, sf_dir, name: str = "sensors"):
    """SRC3 + SRC4: the sensor CSV written as a file, read back with the
    declared schema and registered under a name."""
    path = files.write_lines(stand_ins.sensor_csv_lines(spark, sf_dir), scratch_path(spark, "csv/sensor"))
    df = tables.read_csv_table(spark, path, schemas.SENSOR_CSV)
    return tables.register(df, name), path


@query("select_filter_df", SENSOR_1)
def select_filter_df(spark, sf_dir):
    """PRJ7 + FLT4: ``select("id, temperature").filter("id = 'sensor_1'")``."""
    t, _ = sensor_csv_table(spark, sf_dir)
    return select.select_filter(t, ["id", "temperature"], "id = 'sensor_1'")


@query("select_filter_sql", SENSOR_1)
def select_filter_sql(spark, sf_dir):
    """PRJ8: the same as SQL over the registered table."""
    sensor_csv_table(spark, sf_dir, "sensors")
    return spark.sql("SELECT id, temperature FROM sensors WHERE id = 'sensor_1'")


@query("event_time_table", EVENT_TIME)
def event_time_table(spark, sf_dir):
    """SRC5 + PRJ11 + STR4/5 + FN14/16: CSV table declared by DDL with the
    computed row-time column ``rt AS TO_TIMESTAMP(FROM_UNIXTIME(ts))`` and a
    1-second watermark (applied when the table is read as a stream)."""
    _, path = sensor_csv_table(spark, sf_dir, "sensor_src")
    df = tables.create_csv_table_ddl(
        spark, "sensors_rt", path, "id varchar(20) not null, ts bigint, temperature double",
        computed={"rt": "to_timestamp(from_unixtime(ts))"}, watermark=("rt", "1 second"))
    return df.select("id", "ts", "temperature", to_ntz("rt").alias("rt"))


PROC_TIME = """
SELECT 'sensor_' || CAST(user_id AS VARCHAR) AS id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS ts,
       value AS temperature, true AS pt_is_now
FROM events
"""


@query("proctime_table", PROC_TIME)
def proctime_table(spark, sf_dir):
    """STR6 + FN15: the DDL table with a processing-time column ``pt``; its
    value is the time of the query, so it is checked to lie between the call
    and an hour later."""
    _, path = sensor_csv_table(spark, sf_dir, "sensor_src")
    started = spark.sql("SELECT current_timestamp()").first()[0]
    df = tables.create_csv_table_ddl(spark, "sensors_pt", path, "id varchar(20) not null, ts bigint, temperature double",
                                     computed={"pt": "current_timestamp()"})
    in_time = F.col("pt").isNotNull() & (F.col("pt") >= F.lit(started)) & (F.col("pt") < add_seconds(F.lit(started), 3600))
    return df.select("id", "ts", "temperature", in_time.alias("pt_is_now"))


@query("elements_filter", ELEMENTS_6)
def elements_filter(spark, sf_dir):
    """SRC2 shape + FLT3: sensor elements (id, int seconds, temper) filtered
    on ``id == 'sensor_6'``.  The stand-in id is ``sensor_<user_id>``, so the
    same predicate is also put on the stored column (``user_id = 6``) where
    it reaches the parquet scan."""
    s = stand_ins.sensor_readings(spark, sf_dir, source_filter=F.col("user_id") == 6)
    return s.filter(F.col("id") == "sensor_6").select("id", "ts", "temper")


@query("tagged_split", TAGGED)
def tagged_split(spark, sf_dir):
    """FLT6 + SNK5/6 + ALR5: every element to main, ``sensor_6`` also to
    ``tmp-output`` and ``sensor_1`` to ``qa-output`` with their messages."""
    s = stand_ins.sensor_readings(spark, sf_dir).select("id", "ts", "temper", "seq")
    return select.sensor_alarm(s)


@query("group_count", GROUP_COUNT)
def group_count(spark, sf_dir):
    """AGG7: ``groupBy('id).select('id, 'id.count)`` over the sensor table."""
    t, _ = sensor_csv_table(spark, sf_dir)
    return windows.group_count(t, "id")
