"""Time-column helpers: durations, epoch conversions, window ends."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def duration_seconds(d: str) -> int:
    """``'5 minutes'`` -> 300.  Accepts the duration strings ``F.window`` takes
    (one number and one unit)."""
    num, unit = d.strip().split()
    unit = unit.lower().rstrip("s")
    if unit not in _UNIT_SECONDS:
        raise ValueError(f"unsupported duration unit in {d!r}")
    return int(num) * _UNIT_SECONDS[unit]


def add_seconds(ts: Column, seconds: Column | int) -> Column:
    """``ts + seconds`` keeping the timestamp type (NTZ stays NTZ)."""
    s = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), s.cast("decimal(18,6)"))


def from_epoch_seconds(c: Column) -> Column:
    """``FROM_UNIXTIME`` + ``TO_TIMESTAMP`` as one wall-clock (NTZ) value."""
    return F.timestamp_seconds(c).cast("timestamp_ntz")


def to_stream_time(c: str | Column) -> Column:
    """Streams need TIMESTAMP for watermarks; batch results use NTZ."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("timestamp")


def to_ntz(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("timestamp_ntz")
