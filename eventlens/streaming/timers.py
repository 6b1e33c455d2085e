"""Keyed functions with timers: rows kept per key until a time has passed.

The reference's keyed process functions keep rows in list state, register a
timer and work when it fires.  Three forms, all ``transformWithStateInPandas``
with state in Spark's store:

* :func:`collect_until`: rows wait in list state until their key's time, then
  a user function gets them as an iterator of bounded batches (a window
  function, a top-N per window end);
* :func:`aggregate_windows`: a user's accumulators, one per (key, pane), merged
  into sliding windows when these end;
* :func:`count_by_clock`: windows of processing time, ended by the clock.

Times come from the watermark: a row is late, and dropped by Spark, once an
earlier trigger's watermark has passed its window's end.  What has not ended
when a bounded input is used up stays in the store; the ``open_...`` functions
read it from the checkpoint, so no row has to be planted to end it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.timecols import duration_seconds
from ..operators.udf import PandasFn

BATCH_ROWS = 10_000

#: a user function: the key's values and its rows in bounded batches -> result frames
Finish = Callable[[tuple, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def _millis(t) -> int:
    """Milliseconds of a wall-clock time, the unit of timers."""
    return int(pd.Timestamp(t).value // 1_000_000)


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    """Rows as the tuples list state takes."""
    plain = pdf.astype(object)
    return list(plain.where(pdf.notna(), None).itertuples(index=False, name=None))


def _batches(rows, columns: list[str], size: int = BATCH_ROWS) -> Iterator[pd.DataFrame]:
    """A state's rows as frames of at most ``size`` rows."""
    part = []
    for row in rows:
        part.append(tuple(row))
        if len(part) == size:
            yield pd.DataFrame(part, columns=columns)
            part = []
    if part:
        yield pd.DataFrame(part, columns=columns)


#: marks the fields of a state element that holds a list of values each
LIST = "_list_"


def _chunks(pdf: pd.DataFrame, size: int = BATCH_ROWS) -> Iterator[tuple]:
    """Elements of up to ``size`` rows, a list per column."""
    plain = pdf.astype(object)
    plain = plain.where(pdf.notna(), None)
    for at in range(0, len(plain), size):
        yield tuple(plain[c].iloc[at:at + size].tolist() for c in plain.columns)


class CollectUntil(StatefulProcessor):
    """List state per key, one timer at the key's last value (a time).  An
    element of the list is a batch of rows, a list per column: the store is
    called once per batch.  With ``keep`` the state is cut down to what
    ``keep`` returns after each trigger, an element per row."""

    def __init__(self, columns: list[str], schema: T.StructType, finish: Finish, keep: PandasFn | None = None):
        self.columns, self.schema, self.finish, self.keep = columns, schema, finish, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        chunk = T.StructType([T.StructField(LIST + f.name, T.ArrayType(f.dataType)) for f in self.schema.fields])
        self.kept = handle.getListState("rows", self.schema if self.keep else chunk)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if not self.kept.exists():
            self.handle.registerTimer(_millis(key[-1]))
        if self.keep is None:
            for b in rows:
                if len(b):
                    self.kept.appendList(list(_chunks(b[self.columns])))
        else:
            best = [pd.DataFrame(list(map(tuple, self.kept.get())), columns=self.columns)] if self.kept.exists() else []
            for b in rows:
                best = [self.keep(pd.concat([*best, b[self.columns]], ignore_index=True))]
            if best and len(best[0]):
                self.kept.put(_rows(best[0]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.keep is None:
            batches = (pd.DataFrame(dict(zip(self.columns, chunk))) for chunk in self.kept.get())
        else:
            batches = _batches(self.kept.get(), self.columns)
        yield from self.finish(key, batches)
        self.kept.clear()

    def close(self) -> None:
        pass


def _payload(df: DataFrame, drop: list[str]) -> tuple[list[str], T.StructType]:
    fields = [f for f in df.schema.fields if f.name not in drop]
    return [f.name for f in fields], T.StructType([T.StructField(f.name, f.dataType) for f in fields])


def collect_until(df: DataFrame, keys: list[str], window: str, finish: Finish, out_schema: str,
                  keep: PandasFn | None = None) -> DataFrame:
    """STR13 + UDF3 on a stream: every (keys, end of ``window``) keeps its rows
    until the watermark passes that end; ``finish(key, batches)`` then gets
    them once, with the end as the key's last value, and the state is cleared.
    ``window`` is a window column of a stream with a watermark.

    Memory is bounded by batches.  ``keep`` bounds the state too, where a
    trigger's rows can be reduced at once (a top-N keeps N rows)."""
    columns, schema = _payload(df, [*keys, window])
    # window_time carries the watermark: Spark drops rows whose window has ended
    marked = df.select(*keys, F.col(f"{window}.end").cast("timestamp_ntz").alias("window_end"), *columns,
                       F.window_time(window).alias("_until"))
    return marked.groupBy(*keys, "window_end").transformWithStateInPandas(
        CollectUntil(columns, schema, finish, keep), out_schema, "append", "EventTime")


def open_collected(spark: SparkSession, checkpoint: str, keys: list[str], finish: Finish, out_schema: str,
                   operator: int = 0) -> DataFrame:
    """What :func:`collect_until` would still return if the input ended: the
    rows in the store, through the same function."""
    state = (spark.read.format("statestore").option("operatorId", operator).option("stateVarName", "rows")
             .load(checkpoint))
    fields = state.schema["list_element"].dataType.names
    if all(f.startswith(LIST) for f in fields):
        names = [f[len(LIST):] for f in fields]
        state = state.select("key", *[F.col(f"list_element.{LIST}{c}").alias(c) for c in names])
        state = state.select("key.*", F.explode(F.arrays_zip(*names)).alias("_row")).select("*", "_row.*").drop("_row")
    else:
        state = state.select("key.*", "list_element.*")

    def run(key, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from finish(key, (b.drop(columns=[*keys, "window_end"]) for b in batches))
    run.__annotations__ = {"key": tuple, "batches": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    return state.groupBy(*keys, "window_end").applyInPandas(run, out_schema)


# ------------------------------------------------------------ user accumulators
class WindowAccumulators(StatefulProcessor):
    """Per key the accumulators of its open panes, merged into windows as
    these end.  ``done`` is the end up to which windows were returned."""

    def __init__(self, keys: list[str], columns: list[str], schema: T.StructType, size: int, slide: int,
                 combine: PandasFn, finish: PandasFn):
        self.keys, self.columns, self.schema, self.size, self.slide = keys, columns, schema, size, slide
        self.combine, self.finish = combine, finish

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getListState("panes", self.schema)
        self.done = handle.getValueState("done", "until long")

    def _load(self, key) -> pd.DataFrame:
        rows = list(map(tuple, self.panes.get())) if self.panes.exists() else []
        pdf = pd.DataFrame(rows, columns=self.columns)
        for name, value in zip(self.keys, key):
            pdf[name] = value
        return pdf

    def _wake(self, panes: pd.DataFrame, until: int) -> None:
        """A timer at the first window end after ``until``."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        ends = [max(p + self.slide, (until // self.slide + 1) * self.slide) for p in map(_millis, panes["pane"])]
        if ends:
            self.handle.registerTimer(min(ends))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        until = self.done.get()[0] if self.done.exists() else -(1 << 62)
        new = pd.concat(list(rows), ignore_index=True)          # accumulators: a row per pane and task
        new = new[new["pane"].map(_millis) + self.size > until]  # all windows of the others were returned
        if len(new):
            known = self._load(key)
            panes = self.combine(pd.concat([known, new], ignore_index=True) if len(known) else new)
            self.panes.put(_rows(panes[self.columns]))
            self._wake(panes, until)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        until = self.done.get()[0] if self.done.exists() else -(1 << 62)
        panes = self._load(key)
        out = merge_panes(panes, self.size, self.slide, self.combine, until, mark)
        if len(out):
            yield self.finish(out)
        self.done.update((mark,))
        panes = panes[panes["pane"].map(_millis) + self.size > mark]
        if len(panes):
            self.panes.put(_rows(panes[self.columns]))
        else:
            self.panes.clear()
        self._wake(panes, mark)

    def close(self) -> None:
        pass


def merge_panes(panes: pd.DataFrame, size: int, slide: int, combine: PandasFn, after: int | None = None,
                until: int | None = None) -> pd.DataFrame:
    """Accumulators of the windows (``window_end``) that hold the panes, with
    ends after ``after`` and not after ``until`` (milliseconds).  The panes'
    copies are combined pane by pane: one step per place in the window."""
    merged = None
    for k in range(slide, size + 1, slide):
        part = panes.rename(columns={"pane": "window_end"})
        part["window_end"] = part["window_end"] + pd.Timedelta(k, "ms")
        ends = part["window_end"].map(_millis)
        part = part[(ends > after if after is not None else True) & (ends <= until if until is not None else ends == ends)]
        if len(part):
            part = part.rename(columns={"window_end": "pane"})
            merged = combine(part if merged is None else pd.concat([merged, part], ignore_index=True))
    if merged is None:
        merged = panes.iloc[:0]
    return merged.rename(columns={"pane": "window_end"})


def aggregate_windows(df: DataFrame, keys: list[str], ts: str, size: str, slide: str, partial: PandasFn, combine: PandasFn,
                      finish: PandasFn, partial_schema: str, out_schema: str) -> DataFrame:
    """UDF2 + UDF5 on a stream with a watermark on ``ts``: the functions of
    :func:`..operators.udf.user_aggregate_windows`, over the same panes.

    A trigger's rows become accumulators in each input partition first, so a
    hot key sends one row per pane and task.  A key's state is the
    accumulators of its open panes.  A window is returned when the watermark
    passes its end; a late row still counts in its windows that are open."""
    from ..operators.udf import pane_partials
    panes = pane_partials(df, keys, ts, slide, partial, combine, partial_schema)
    columns, schema = _payload(panes, keys)
    processor = WindowAccumulators(keys, columns, schema, duration_seconds(size) * 1000, duration_seconds(slide) * 1000,
                                   combine, finish)
    return panes.groupBy(*keys).transformWithStateInPandas(processor, out_schema, "append", "EventTime")


def open_aggregates(spark: SparkSession, checkpoint: str, keys: list[str], size: str, slide: str, combine: PandasFn,
                    finish: PandasFn, out_schema: str) -> DataFrame:
    """The windows :func:`aggregate_windows` has not returned yet."""
    read = spark.read.format("statestore")
    panes = read.option("stateVarName", "panes").load(checkpoint).select("key.*", "list_element.*")
    done = read.option("stateVarName", "done").load(checkpoint).select("key.*", F.col("value.until").alias("_until"))
    size_ms, slide_ms = duration_seconds(size) * 1000, duration_seconds(slide) * 1000

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        after = pdf["_until"].iloc[0]
        out = merge_panes(pdf.drop(columns="_until"), size_ms, slide_ms, combine, None if pd.isna(after) else int(after))
        return finish(out)
    return panes.join(done, keys, "left").groupBy(*keys).applyInPandas(run, out_schema)


# ------------------------------------------------------------- processing time
class ClockCounts(StatefulProcessor):
    """Rows per key and stretch of processing time; a timer of the clock ends
    the stretch."""

    def __init__(self, keys: list[str], width_ms: int):
        self.keys, self.width = keys, width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "window_end long", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end = (timerValues.getCurrentProcessingTimeInMs() // self.width + 1) * self.width
        n = sum(len(b) for b in rows)
        if self.counts.containsKey((end,)):
            n += self.counts.getValue((end,))[0]
        else:
            self.handle.registerTimer(end)
        self.counts.updateValue((end,), (n,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        n = self.counts.getValue((end,))[0]
        self.counts.removeKey((end,))
        yield pd.DataFrame({**{k: [v] for k, v in zip(self.keys, key)}, "window_end": [end], "n": [n]})

    def close(self) -> None:
        pass


def count_by_clock(df: DataFrame, keys: list[str], width: str) -> DataFrame:
    """STR6 on a stream: counts per key and tumbling window of processing
    time (``window_end`` in milliseconds), each returned once by a timer of
    the clock; it fires in the first trigger after the window's end."""
    types = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*keys).groupBy(*keys).transformWithStateInPandas(
        ClockCounts(keys, duration_seconds(width) * 1000), f"{types}, window_end long, n long", "append", "ProcessingTime")


def open_clock_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows of :func:`count_by_clock` that have not ended."""
    state = spark.read.format("statestore").option("stateVarName", "counts").load(checkpoint)
    return state.select("key.*", F.col("user_map_key.window_end").alias("window_end"), F.col("user_map_value.n").alias("n"))
