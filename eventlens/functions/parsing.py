"""Line parsers as column expressions (no Python per row).

Each parser takes a DataFrame with a ``value`` string column and returns the
typed record.  ``on_error``:

* ``"fail"`` (default, as the reference): ANSI casts raise on a bad number
  or time and the job fails;
* ``"null"``: ``try_`` forms, bad fields become NULL;
* ``"quarantine"``: returns ``(good, bad)``; ``bad`` keeps the raw line of
  every row whose required fields did not parse.

Differences to the JVM originals worth knowing: ``split`` is a regex split
that keeps trailing empty strings; ``substring`` is 1-based and never throws;
the time parser is strict unless ``lenient=True`` (:func:`lenient_time`).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .timecols import add_seconds, from_epoch_seconds


TIME_FMT = "yyyy-MM-dd HH:mm:ss"
LOG_TIME_FMT = "dd/MM/yyyy:HH:mm:ss"

# The tag prefixes of quality lines.
TAG_ACID = "AB:"
TAG_CONS = "AE:"
TAG_WATER = "CE:"

_MODES = ("fail", "null", "quarantine")


def _check(on_error: str) -> bool:
    if on_error not in _MODES:
        raise ValueError(f"on_error must be one of {_MODES}")
    return on_error != "fail"


def _num(c: Column, typ: str, safe: bool) -> Column:
    return c.try_cast(typ) if safe else c.cast(typ)


def _field(arr: Column, i: int, safe: bool) -> Column:
    return F.try_element_at(arr, F.lit(i + 1)) if safe else F.element_at(arr, i + 1)


def lenient_time(c: Column, fmt: str) -> Column:
    """FN8: the reference's date parser, which rolls fields over: month 13 is
    January of the next year, day 0 the last of the month before, second 200
    three minutes and twenty seconds; fields take any number of digits (up to
    six) and text behind the last one is ignored.  NULL where the text does
    not have the fields.  Dates are proleptic Gregorian."""
    letters = re.findall(r"([a-zA-Z])\1*", fmt)
    pattern = "^" + re.sub(r"([a-zA-Z])\1*", r"[ \\t]*(-?[0-9]{1,6})", re.sub(r"([^a-zA-Z ])", r"[\1]", fmt))
    part = lambda x: F.regexp_extract(c, pattern, letters.index(x) + 1).cast("bigint")
    months = part("y") * 12 + part("M") - 1
    first = F.make_date(F.floor(months / 12).cast("int"), (F.pmod(months, F.lit(12)) + 1).cast("int"), F.lit(1))
    seconds = ((part("d") - 1) * 24 + part("H")) * 3600 + part("m") * 60 + part("s")
    return F.when(c.rlike(pattern), add_seconds(first.cast("timestamp_ntz"), seconds))


def _ts(c: Column, fmt: str, safe: bool, lenient: bool = False) -> Column:
    if lenient:
        # most texts are regular, the others are taken apart
        parsed = F.coalesce(F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz"), lenient_time(c, fmt))
        bad = F.raise_error(F.concat(F.lit("not a time: "), c)).cast("timestamp_ntz")
        return parsed if safe else F.when(parsed.isNotNull() | c.isNull(), parsed).otherwise(bad)
    parsed = F.try_to_timestamp(c, F.lit(fmt)) if safe else F.to_timestamp(c, fmt)
    return parsed.cast("timestamp_ntz")


def drop_last_char(c: Column) -> Column:
    """``line.substring(0, line.length - 1)``."""
    return F.substring(c, F.lit(1), F.length(c) - 1)


def prefix_filter(lines: DataFrame, prefix: str, col: str = "value") -> DataFrame:
    """FLT1: keep lines whose first characters equal ``prefix``; short or
    empty lines are simply not selected (the reference's ``substring`` would
    throw on them)."""
    return lines.filter(F.col(col).startswith(prefix))


def _finish(df: DataFrame, required: list[str], on_error: str, raw: str = "value"):
    if on_error == "quarantine":
        ok = F.lit(True)
        for c in required:
            ok = ok & F.col(c).isNotNull()
        flagged = df.withColumn("_ok", ok)
        good = flagged.filter("_ok").drop("_ok", raw)
        bad = flagged.filter(~F.col("_ok")).select(raw)
        return good, bad
    return df.drop(raw)


def parse_temperature(lines: DataFrame, on_error: str = "fail", strip_last_char: bool = True,
                      keep: list[str] | None = None, lenient: bool = False):
    """PRJ1: ``id,yyyy-MM-dd HH:mm:ss,temp<one trailing char>``."""
    safe = _check(on_error)
    body = drop_last_char(F.col("value")) if strip_last_char else F.col("value")
    arr = F.split(body, ",")
    time = _field(arr, 1, safe)
    df = lines.select(
        "value", *(keep or []),
        _field(arr, 0, safe).alias("id"),
        _ts(time, TIME_FMT, safe, lenient).alias("ts"),
        time.alias("time"),
        _num(_field(arr, 2, safe), "double", safe).alias("temp"),
    )
    return _finish(df, ["id", "ts", "temp"], on_error)


def _last_tag(fields: Column, tag: str) -> Column:
    """Text after the last field starting with ``tag``; NULL if no field does."""
    hit = F.try_element_at(F.filter(fields, lambda x: x.startswith(tag)), F.lit(-1))
    return F.substring(hit, len(tag) + 1, 1 << 30)


def parse_quality(lines: DataFrame, on_error: str = "fail", strip_last_char: bool = True,
                  keep: list[str] | None = None, lenient: bool = False):
    """PRJ2: id and time as PRJ1, then every field is scanned for the tags
    ``AB:`` (acid, double), ``AE:`` (consistency, int widened to bigint) and
    ``CE:`` (water rate, double) in any position; the last occurrence wins
    and a missing tag gives 0."""
    safe = _check(on_error)
    body = drop_last_char(F.col("value")) if strip_last_char else F.col("value")
    # columns of their own: a line is split once and searched once for each tag
    kept = ["value", *(keep or [])]
    lines = lines.select(*kept, F.split(body, ",").alias("_fields"))
    arr = F.col("_fields")
    lines = lines.select(*kept, "_fields", _last_tag(arr, TAG_ACID).alias("_acid"), _last_tag(arr, TAG_CONS).alias("_cons"),
                         _last_tag(arr, TAG_WATER).alias("_water"))
    time = _field(arr, 1, safe)
    acid, cons, water = F.col("_acid"), F.col("_cons"), F.col("_water")

    def tagged(raw: Column, typ: str, zero) -> Column:
        # missing tag -> 0; present but malformed -> error / NULL by mode
        return F.when(raw.isNull(), F.lit(zero).cast(typ)).otherwise(_num(raw, typ, safe))

    df = lines.select(
        "value", *(keep or []),
        _field(arr, 0, safe).alias("id"),
        _ts(time, TIME_FMT, safe, lenient).alias("ts"),
        time.alias("time"),
        tagged(acid, "double", 0.0).alias("acid"),
        tagged(cons, "int", 0).cast("bigint").alias("cons"),
        tagged(water, "double", 0.0).alias("water_rate"),
    )
    return _finish(df, ["id", "ts", "acid", "cons", "water_rate"], on_error)


def parse_user_behavior(lines: DataFrame, on_error: str = "fail"):
    """PRJ3: ``userId,itemId,categoryId,behavior,epochSeconds``; ``ts`` is
    the epoch-second timestamp (``* 1000`` in the reference)."""
    safe = _check(on_error)
    arr = F.split(F.col("value"), ",")
    epoch = _num(_field(arr, 4, safe), "bigint", safe)
    df = lines.select(
        "value",
        _num(_field(arr, 0, safe), "bigint", safe).alias("user_id"),
        _num(_field(arr, 1, safe), "bigint", safe).alias("item_id"),
        _num(_field(arr, 2, safe), "int", safe).alias("category_id"),
        _field(arr, 3, safe).alias("behavior"),
        from_epoch_seconds(epoch).alias("ts"),
    )
    return _finish(df, ["user_id", "item_id", "category_id", "behavior", "ts"], on_error)


def parse_access_log(lines: DataFrame, on_error: str = "fail", keep: list[str] | None = None, lenient: bool = False):
    """PRJ4: split on one space; [0] ip, [2] user, [3] time
    ``dd/MM/yyyy:HH:mm:ss``, [5] method, [6] url; the zone field [4] is
    ignored (times are read as UTC)."""
    safe = _check(on_error)
    arr = F.split(F.col("value"), " ")
    df = lines.select(
        "value", *(keep or []),
        _field(arr, 0, safe).alias("ip"),
        _field(arr, 2, safe).alias("user_id"),
        _ts(_field(arr, 3, safe), LOG_TIME_FMT, safe, lenient).alias("ts"),
        _field(arr, 5, safe).alias("method"),
        _field(arr, 6, safe).alias("url"),
    )
    return _finish(df, ["ip", "ts", "method", "url"], on_error)


def parse_sensor_csv(lines: DataFrame, on_error: str = "fail"):
    """PRJ5: ``id,epochSeconds,temperature`` -> id string, ts bigint,
    temperature double."""
    safe = _check(on_error)
    arr = F.split(F.col("value"), ",")
    df = lines.select(
        "value",
        _field(arr, 0, safe).alias("id"),
        _num(_field(arr, 1, safe), "bigint", safe).alias("ts"),
        _num(_field(arr, 2, safe), "double", safe).alias("temperature"),
    )
    return _finish(df, ["id", "ts", "temperature"], on_error)
