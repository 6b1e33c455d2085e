"""Reference-shaped inputs derived from the driver tables.

The reference reads files that are not shipped (temperature and quality
lines, user behaviour CSV, access log) or tiny samples.  Each function here
derives the same shape from a driver table with column expressions, so the
work grows with the table:

==========================  =================================================
reference input             driver table
==========================  =================================================
temperature readings        events: id = event_type, temp = value
quality readings            lineitem: id = l_suppkey, acid = l_extendedprice,
                            cons = l_quantity, water_rate = l_tax
user behaviour              events: item = user_id, ``pv`` = ``view``
access log                  events + pages.url
sensor CSV / elements       events: id = ``sensor_<user_id>``, temp = value
course/student/score        supplier / customer / orders join lineitem
==========================  =================================================

Text forms are built with ``concat_ws`` / ``format_string`` and parsed back
by ``eventlens.functions.parsing`` (round trip).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import load

TIME_FMT = "yyyy-MM-dd HH:mm:ss"
LOG_TIME_FMT = "dd/MM/yyyy:HH:mm:ss"


def epoch_seconds(ts_col) -> F.Column:
    """Whole epoch seconds of a wall-clock (NTZ) timestamp; the session zone
    is pinned to UTC (``session.apply_sql_defaults``)."""
    return F.unix_seconds(F.col(ts_col).cast("timestamp"))


# ---------------------------------------------------------------- temperature
def temperature_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed IotTemp rows: id, ts, time, temp, plus ``seq`` (event_id) as the
    tie-break of the canonical (ts, seq) order."""
    ev = load(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("id"),
        F.col("ts"),
        F.date_format("ts", TIME_FMT).alias("time"),
        F.col("value").alias("temp"),
        F.col("event_id").alias("seq"),
    )


def temperature_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``T1_<type>,yyyy-MM-dd HH:mm:ss,<temp>;`` - one trailing character
    the parser strips, as in the reference's input."""
    ev = load(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.concat_ws(",", F.concat(F.lit("T1_"), "event_type"),
                             F.date_format("ts", TIME_FMT),
                             F.col("value").cast("string")),
                 F.lit(";")).alias("value"),
        F.col("event_id").alias("seq"),
    )


# -------------------------------------------------------------------- quality
QUALITY_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]


def quality_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("id"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
        F.col("l_extendedprice").alias("acid"),
        F.col("l_quantity").cast("bigint").alias("cons"),
        F.col("l_tax").alias("water_rate"),
    )


def quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``Q1_<supp>,<time>,<tagged fields>;`` with the tags in a rotating
    order, an unknown ``DV:`` field, ``AE:`` left out on line number 7
    (cons becomes 0) and a decoy ``AB:`` before the real one on line number 1
    (the last occurrence wins)."""
    li = load(spark, sf_dir, "lineitem")
    ab = F.concat(F.lit("AB:"), F.col("l_extendedprice").cast("string"))
    ae = F.when(F.col("l_linenumber") != 7,
                F.concat(F.lit("AE:"), F.col("l_quantity").cast("int").cast("string")))
    ce = F.concat(F.lit("CE:"), F.col("l_tax").cast("string"))
    dv = F.concat(F.lit("DV:"), F.col("l_partkey").cast("string"))
    decoy = F.when(F.col("l_linenumber") == 1, F.lit("AB:-1.0"))
    rot = F.col("l_linenumber") % 3
    fields = (F.when(rot == 0, F.concat_ws(",", decoy, ab, ae, dv, ce))
              .when(rot == 1, F.concat_ws(",", decoy, ce, ab, ae, dv))
              .otherwise(F.concat_ws(",", decoy, ae, dv, ce, ab)))
    return li.select(
        F.concat(F.concat_ws(",", F.concat(F.lit("Q1_"), F.col("l_suppkey").cast("string")),
                             F.date_format("l_shipdate", TIME_FMT), fields),
                 F.lit(";")).alias("value"),
        *QUALITY_ORDER,
    )


def iot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed IoT file: temperature and quality lines in one set."""
    return (temperature_lines(spark, sf_dir).select("value")
            .unionByName(quality_lines(spark, sf_dir).select("value")))


# -------------------------------------------------------------- user behaviour
def user_behavior(spark: SparkSession, sf_dir: str, source_filter=None) -> DataFrame:
    """Typed UserLog rows at full timestamp precision; ``source_filter`` is
    applied to the stored ``events`` columns."""
    ev = load(spark, sf_dir, "events")
    if source_filter is not None:
        ev = ev.filter(source_filter)
    return ev.select(
        F.col("event_id").alias("user_id"),
        F.col("user_id").alias("item_id"),
        (F.col("user_id") % 10).cast("int").alias("category_id"),
        F.when(F.col("event_type") == "view", F.lit("pv"))
         .otherwise(F.col("event_type")).alias("behavior"),
        F.col("ts"),
    )


def user_behavior_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ub = user_behavior(spark, sf_dir)
    return ub.select(F.concat_ws(",", "user_id", "item_id", "category_id", "behavior",
                                 epoch_seconds("ts")).alias("value"))


# ----------------------------------------------------------------- access log
def access_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ip - user dd/MM/yyyy:HH:mm:ss +0000 METHOD url``; the url is the
    page whose id equals the event's user id (every user has one)."""
    ev = load(spark, sf_dir, "events")
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    j = ev.join(pages, ev.user_id == pages.page_id, "left")
    eid = F.col("event_id")
    ip = F.concat_ws(".", F.lit("10"), F.shiftright(eid, 16) % 256,
                     F.shiftright(eid, 8) % 256, eid % 256)
    user = F.when(F.col("event_type") == "purchase",
                  F.concat(F.lit("u"), F.col("user_id").cast("string"))).otherwise(F.lit("-"))
    method = F.when(F.col("event_type") == "purchase", F.lit("POST")).otherwise(F.lit("GET"))
    url = F.coalesce(F.col("url"), F.concat(F.lit("/item/"), F.col("user_id").cast("string")))
    return j.select(F.concat_ws(" ", ip, F.lit("-"), user, F.date_format("ts", LOG_TIME_FMT),
                                F.lit("+0000"), method, url).alias("value"),
                    eid.alias("seq"))


# ---------------------------------------------------------------------- sensor
def sensor_readings(spark: SparkSession, sf_dir: str, source_filter=None) -> DataFrame:
    """Project SensorReading (id, int seconds, temper) plus ``seq``;
    ``source_filter`` is applied to the stored ``events`` columns."""
    ev = load(spark, sf_dir, "events")
    if source_filter is not None:
        ev = ev.filter(source_filter)
    return ev.select(
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
        epoch_seconds("ts").cast("int").alias("ts"),
        F.col("value").alias("temper"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("event_ts"),
    )


def sensor_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sensor_<user>,<epoch seconds>,<temperature>``."""
    ev = load(spark, sf_dir, "events")
    return ev.select(F.concat_ws(",", F.concat(F.lit("sensor_"), F.col("user_id").cast("string")),
                                 epoch_seconds("ts"), F.col("value").cast("string")).alias("value"))


# ------------------------------------------------------------- course tables
def course(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").cast("int").alias("num"), F.col("s_name").alias("course"))


def student(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("int").alias("id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("sex"),
        (F.col("c_nationkey") + 17).cast("int").alias("age"),
        F.col("c_mktsegment").alias("department"),
    )


def student_course(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").cast("int").alias("id"),
                    F.col("l_suppkey").cast("int").alias("num"),
                    F.col("l_quantity").cast("int").alias("score")))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(num, score) for queries that do not ask whose score it is: no join."""
    li = load(spark, sf_dir, "lineitem")
    return li.select(F.col("l_suppkey").cast("int").alias("num"), F.col("l_quantity").cast("int").alias("score"))


def course_tables(spark: SparkSession, sf_dir: str, delimited: bool = False) -> dict[str, DataFrame]:
    """``course``, ``student`` and ``studentcourse``.  With ``delimited`` each
    is first written as a comma-delimited text table and read back with its
    declared schema."""
    from .. import schemas
    from ..session import scratch_path
    from .tables import read_csv_table
    parts = {"course": (course, schemas.COURSE), "student": (student, schemas.STUDENT),
             "studentcourse": (student_course, schemas.STUDENT_COURSE)}
    out = {}
    for name, (make, schema) in parts.items():
        out[name] = make(spark, sf_dir)
        if delimited:
            path = scratch_path(spark, f"delimited/{name}")
            out[name].write.mode("overwrite").option("sep", ",").csv(path)
            out[name] = read_csv_table(spark, path, schema, sep=",")
    return out
