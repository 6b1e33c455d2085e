"""Event-time window aggregates: tumbling and sliding counts and means.

All of them are ``groupBy(window(...), key)`` aggregates, so Spark runs a
partial aggregate before the shuffle (the incremental ``AggregateFunction``
of the reference) and a final one after it.  A hot key therefore costs one
partial row per map task, not one shuffled row per input row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import add_seconds, duration_seconds


def _window_end(w: str = "window") -> Column:
    return F.col(f"{w}.end")


def window_counts(df: DataFrame, key: str, ts: str, size: str, slide: str | None = None,
                  out_key: str | None = None, count_name: str = "cnt") -> DataFrame:
    """AGG1 + PRJ12: count per (key, window), emitted as
    ``(key, window_end, cnt)`` (``ItemViewCount`` / ``UrlViewCount``).

    Direct form: each row is expanded into ``size / slide`` windows before the
    partial aggregate."""
    win = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (df.groupBy(win.alias("window"), F.col(key))
            .agg(F.count(F.lit(1)).alias(count_name))
            .select(F.col(key).alias(out_key or key), _window_end().alias("window_end"), count_name))


def window_counts_panes(df: DataFrame, key: str, ts: str, size: str, slide: str,
                        out_key: str | None = None, count_name: str = "cnt") -> DataFrame:
    """Same result as :func:`window_counts` for sliding windows, computed by
    first counting per (key, pane) where a pane is one slide long, then
    fanning each pane out to the ``size / slide`` windows that contain it and
    summing.  The fan-out happens after the partial aggregate, on at most one
    row per (key, pane, task) instead of per input row; decomposable
    aggregates only, and ``slide`` must divide ``size``.  It pays off when a
    pane holds many rows per key; for sparse panes (about one row per key
    and pane) the direct form is cheaper, since the pane step then adds a
    shuffle without reducing anything."""
    size_s, slide_s = duration_seconds(size), duration_seconds(slide)
    if size_s % slide_s:
        raise ValueError("pane form needs slide to divide size")
    n = size_s // slide_s
    panes = (df.groupBy(F.window(ts, slide).alias("pane"), F.col(key))
             .agg(F.count(F.lit(1)).alias("_pane_cnt")))
    fanned = panes.select(
        F.col(key),
        F.col("_pane_cnt"),
        # pane [p, p+slide) lies in the windows ending p+slide, ..., p+size
        F.explode(F.sequence(F.lit(1), F.lit(n))).alias("_k"),
        F.col("pane.start").alias("_pstart"),
    )
    return (fanned.groupBy(F.col(key), add_seconds(F.col("_pstart"), F.col("_k") * slide_s).alias("window_end"))
            .agg(F.sum("_pane_cnt").alias(count_name))
            .select(F.col(key).alias(out_key or key), "window_end", count_name))


def window_mean(df: DataFrame, key: str, ts: str, value: str, size: str = "1 day",
                slide: str | None = None, incremental: bool = False) -> DataFrame:
    """AGG2 / AGG3: mean of ``value`` per (key, window).

    ``incremental=False`` is the full-window form (``avg``); ``True`` is the
    accumulator form (sum, count) finished by ``sum / count``, exposing the
    accumulator columns.  Both run as partial + final aggregates."""
    win = (F.window(ts, size, slide) if slide else F.window(ts, size)).alias("window")
    if not incremental:
        return (df.groupBy(win, F.col(key))
                .agg(F.avg(value).alias("avg_value"), F.count(F.lit(1)).alias("n"))
                .select(F.col(key), F.col("window.start").alias("window_start"),
                        F.col("window.end").alias("window_end"), "n", "avg_value"))
    acc = (df.groupBy(win, F.col(key))
           .agg(F.sum(value).alias("sum_value"), F.count(F.lit(1)).alias("n")))
    return acc.select(F.col(key), F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), "sum_value", "n",
                      (F.col("sum_value") / F.col("n")).alias("avg_value"))


def group_count(df: DataFrame, key: str, count_name: str = "cnt") -> DataFrame:
    """AGG7: unbounded count per key."""
    return df.groupBy(key).agg(F.count(F.col(key)).alias(count_name))
