"""Work that follows the order in which lines arrive.

The reference reads a file line by line: its keyed functions see rows in line
order, also where times tie, and its watermark follows the largest time of
the lines read so far.  With lines numbered (``files.number_lines``) both are
ordered scans over the numbers, in slices of consecutive lines, so no task
holds more than a slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import add_seconds, duration_seconds
from .ordered_scan import scan_with_state


def mark_late(df: DataFrame, *args, **options) -> DataFrame:
    """All of ``df``: see :func:`mark_late_step`."""
    return mark_late_step(df, None, *args, **options)[0]


def mark_late_step(df: DataFrame, state, ts: str = "ts", line: str = "line", size: str = "1 day",
                   delay: str = "1 second", slice_width: int | None = None) -> tuple[DataFrame, DataFrame]:
    """STR2 + STR15 line by line: adds ``window_start`` and ``late``, true for
    the rows that a watermark bounded by ``delay`` drops: the largest time of
    the earlier lines less ``delay`` has reached the end of their window of
    ``size``.  A line without a time is not late and moves nothing."""
    one = df.withColumn("_all", F.lit(1))        # all lines are one sequence
    s, after = scan_with_state(one, "_all", line, maxes=[ts], slice_width=slice_width, state=state)
    micros, width = F.unix_micros(F.col(ts).cast("timestamp")), F.lit(duration_seconds(size) * 1_000_000)
    start = F.timestamp_micros(micros - F.pmod(micros, width)).cast(df.schema[ts].dataType)     # keeps rows without a time
    mark = add_seconds(F.col(f"_mb_{ts}"), -duration_seconds(delay))
    late = F.coalesce(add_seconds(start, duration_seconds(size)) <= mark, F.lit(False))
    return s.withColumn("window_start", start).withColumn("late", late).drop("_all", f"_mb_{ts}"), after
