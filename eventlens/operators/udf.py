"""User-function hooks: the reference's ``AggregateFunction`` /
``ProcessWindowFunction`` pair for a user's own decomposable aggregate.

Built-in aggregates cover the reference's own functions (count, sum/count
mean).  For a user's own accumulator, ``user_aggregate`` keeps the
reference's create/add/merge/result split and Spark's two-phase plan:

1. ``partial`` runs inside each input partition (``mapInPandas``) on Arrow
   batches, vectorised over all keys of the batch, and ``combine`` folds the
   batch partials of the partition: at most one accumulator row per key per
   partition leaves the task (map-side combine);
2. the accumulator rows are hash-partitioned on the keys, ``combine`` folds
   them per key and ``finish`` turns each accumulator into the output row
   (the window function's role).

A key holding a third of the input sends one row per input partition to
phase 2, never its raw rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import add_seconds, duration_seconds

PandasFn = Callable[[pd.DataFrame], pd.DataFrame]

COMBINE_EVERY_ROWS = 1_000_000


def _folded(batches: Iterator[pd.DataFrame], partial: PandasFn, combine: PandasFn) -> Iterator[pd.DataFrame]:
    """The accumulators of one partition's batches."""
    pending, rows, limit = [], 0, COMBINE_EVERY_ROWS
    for b in batches:
        if len(b) == 0:
            continue
        p = partial(b)
        pending.append(p)
        rows += len(p)
        if rows > limit:        # fold only when partials pile up (amortised linear)
            pending = [combine(pd.concat(pending, ignore_index=True))]
            rows = len(pending[0])
            limit = max(COMBINE_EVERY_ROWS, 2 * rows)
    if pending:
        yield combine(pd.concat(pending, ignore_index=True))


def user_aggregate(df: DataFrame, keys: list[str], partial: PandasFn, combine: PandasFn,
                   finish: PandasFn, partial_schema: str, out_schema: str) -> DataFrame:
    keys = list(keys)

    def phase1(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _folded(batches, partial, combine)

    def phase2(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            yield finish(combine(pd.concat(parts, ignore_index=True)))

    partials = df.mapInPandas(phase1, partial_schema)
    return partials.repartition(*keys).mapInPandas(phase2, out_schema)


def pane_partials(df: DataFrame, keys: list[str], ts: str, slide: str, partial: PandasFn, combine: PandasFn,
                  partial_schema: str) -> DataFrame:
    """Accumulators per (keys, ``pane``) of every input partition."""
    paned = df.withColumn("pane", F.window(ts, slide).start.cast("timestamp_ntz"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _folded(batches, partial, combine)
    return paned.mapInPandas(run, partial_schema)


def user_aggregate_windows(df: DataFrame, keys: list[str], ts: str, size: str, slide: str, partial: PandasFn,
                           combine: PandasFn, finish: PandasFn, partial_schema: str, out_schema: str) -> DataFrame:
    """UDF2 + UDF5 over sliding windows: a user's accumulators per (keys,
    ``pane``), a pane being one slide long, are folded where the rows are,
    combined per pane, and only then merged into the ``size / slide`` windows
    that hold the pane.  ``partial`` and ``combine`` group by the keys and
    ``pane``; ``finish`` gets accumulators with ``window_end`` instead."""
    if duration_seconds(size) % duration_seconds(slide):
        raise ValueError("the slide must divide the size")
    partials = pane_partials(df, keys, ts, slide, partial, combine, partial_schema)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            yield combine(pd.concat(parts, ignore_index=True))

    def fold_and_finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in fold(batches):
            yield finish(b.rename(columns={"pane": "window_end"}))
    panes = partials.repartition(*keys, "pane").mapInPandas(fold, partial_schema)
    places = F.sequence(F.lit(duration_seconds(slide)), F.lit(duration_seconds(size)), F.lit(duration_seconds(slide)))
    fanned = (panes.withColumn("_k", F.explode(places)).withColumn("pane", add_seconds(F.col("pane"), F.col("_k"))).drop("_k"))
    return fanned.repartition(*keys, "pane").mapInPandas(fold_and_finish, out_schema)


def process_windows(df: DataFrame, keys: list[str], ts: str, size: str, fn, out_schema: str) -> DataFrame:
    """UDF3: a user function over the elements of every (keys, window).

    ``fn(key, batches)`` gets the key's values with the window's start last,
    and the elements as an iterator of bounded batches, and yields result
    frames; annotate both iterators as ``Iterator[pd.DataFrame]``.  A window
    of a key is one task's work, but never in memory as a whole; what can be
    merged should be a :func:`user_aggregate`."""
    windowed = df.withColumn("window_start", F.window(ts, size).start)
    return windowed.groupBy(*keys, "window_start").applyInPandas(fn, out_schema)


# ---- the reference's AvgTempFunction as a user aggregate (sum, count) -> mean
def mean_partial(keys: list[str], value: str) -> PandasFn:
    def f(pdf: pd.DataFrame) -> pd.DataFrame:
        g = pdf.groupby(keys, sort=False, dropna=False)[value]
        return pd.DataFrame({"sum_value": g.sum(), "n": g.count()}).reset_index()
    return f


def mean_combine(keys: list[str]) -> PandasFn:
    def f(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby(keys, sort=False, dropna=False)[["sum_value", "n"]].sum().reset_index()
    return f


def mean_finish(keys: list[str]) -> PandasFn:
    def f(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf[keys].copy()
        out["n"] = pdf["n"].astype("int64")
        out["avg_value"] = pdf["sum_value"] / pdf["n"]
        return out
    return f
