"""Declared schemas of the records the reference programs work with.

Nothing is inferred from data: every reader is given one of these.
Timestamps are TIMESTAMP_NTZ in batch results (wall-clock values that do not
move with the session zone) and TIMESTAMP in streams, where watermarks need it.
"""

from pyspark.sql import types as T

TEMP_READING = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("time", T.StringType()),
    T.StructField("temp", T.DoubleType()),
])

QUALITY_READING = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("time", T.StringType()),
    T.StructField("acid", T.DoubleType()),
    T.StructField("cons", T.LongType()),
    T.StructField("water_rate", T.DoubleType()),
])

USER_BEHAVIOR_CSV = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("epoch_s", T.LongType()),
])

ACCESS_LOG = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("method", T.StringType()),
    T.StructField("url", T.StringType()),
])

# day7 SensorReading: id, epoch seconds, temperature
SENSOR_CSV = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("temperature", T.DoubleType()),
])

# project SensorReading: id, int seconds, temper
SENSOR_ELEMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("ts", T.IntegerType()),
    T.StructField("temper", T.DoubleType()),
])

COURSE = T.StructType([
    T.StructField("num", T.IntegerType()),
    T.StructField("course", T.StringType()),
])

STUDENT = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("sex", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("department", T.StringType()),
])

STUDENT_COURSE = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("num", T.IntegerType()),
    T.StructField("score", T.IntegerType()),
])

ITEM_VIEW_COUNT = "item_id bigint, window_end timestamp_ntz, cnt bigint"
URL_VIEW_COUNT = "url string, window_end timestamp_ntz, cnt bigint"
