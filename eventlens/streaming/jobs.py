"""Structured Streaming forms of the operators, plus the plumbing to run a
stream to completion (``availableNow``) into files under the shared folder.

Watermarks need ``TIMESTAMP`` (not ``TIMESTAMP_NTZ``) event-time columns:
inputs are staged with ``ts`` cast under the UTC session zone.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timecols import add_seconds, duration_seconds
from ..operators import ranking
from ..operators.ordered_scan import Earlier
from ..session import hadoop_path, scratch_path
from ..sources import files
from .state import KeyedState


# ----------------------------------------------------------------- plumbing
def stage(df: DataFrame, path: str, mode: str = "append") -> str:
    """Write rows as parquet files a file stream will pick up."""
    df.write.mode(mode).parquet(path)
    return path


#: groups of files a bounded input is staged in, one per trigger
PARTS = 6


def stage_in_order(df: DataFrame, path: str, ts: str | Column, parts: int | None = None, files: int = 2, fmt: str = "parquet",
                   columns: list[str] | None = None) -> str:
    """Write rows as ``parts * files`` files in event-time order, in one pass
    (a range exchange); with ``maxFilesPerTrigger=files`` a stream reads them
    in about ``parts`` triggers, in that order.  File sources go by
    modification time, so the files get theirs in the order of their names.
    With an expression as ``ts`` rows stand in its order inside the files too."""
    parts = parts or PARTS
    at = F.unix_micros(F.col(ts).cast("timestamp")) if isinstance(ts, str) else ts
    columns = columns or df.columns
    cut = df.repartitionByRange(parts * files, at)
    cut = cut if isinstance(ts, str) else cut.sortWithinPartitions(at)
    cut.select(*columns).write.mode("append").format(fmt).save(path)
    fs, folder = hadoop_path(df.sparkSession, path)
    staged = sorted((f for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")),
                    key=lambda f: f.getPath().getName())
    last = max((f.getModificationTime() for f in staged), default=0)
    for k, f in enumerate(staged):
        fs.setTimes(f.getPath(), last - 1000 * (len(staged) - k), -1)
    return path


def file_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def run_available_now(writer_factory, checkpoint: str, timeout_s: float | None = None) -> None:
    """Start, process everything available, stop; re-raise a failure.  With
    ``timeout_s`` a run that has not finished by then is stopped and reported
    (progress is kept in the checkpoint, a rerun resumes it)."""
    q: StreamingQuery = writer_factory().option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finished = q.awaitTermination(timeout_s) if timeout_s else (q.awaitTermination() or True)
    if not finished:
        q.stop()
        raise TimeoutError(f"stream {q.id} did not finish within {timeout_s} s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_until_caught_up(writer_factory, checkpoint: str, timeout_s: float) -> None:
    """Run a source that limits its triggers itself, trigger after trigger,
    until it has nothing new; then stop.  (``availableNow`` would take one
    trigger of such a source only.)"""
    q: StreamingQuery = writer_factory().option("checkpointLocation", checkpoint).start()
    try:
        seen = -1
        end = time.monotonic() + timeout_s
        while q.isActive and time.monotonic() < end:
            q.awaitTermination(0.5)
            last = q.lastProgress
            done = last is not None and last["numInputRows"] == 0 and not q.status["isTriggerActive"]
            if done and seen == last["batchId"]:
                break
            seen = last["batchId"] if done else -1
        else:
            if q.isActive:
                raise TimeoutError(f"stream {q.id} did not catch up within {timeout_s} s")
    finally:
        q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def to_parquet(df: DataFrame, sink: str, mode: str = "append"):
    return lambda: df.writeStream.format("parquet").option("path", sink).outputMode(mode)


def to_tags(df: DataFrame, sink: str):
    """UDF7 + SNK5: processed elements (``select.process``) to one folder per
    tag, exactly once."""
    return lambda: df.writeStream.partitionBy("tag").format("parquet").option("path", sink).outputMode("append")


def to_batches(df: DataFrame, fn, mode: str = "append"):
    return lambda: df.writeStream.foreachBatch(fn).outputMode(mode)


# -------------------------------------------------------- windowed aggregates
def window_mean(df: DataFrame, key: str, ts: str, value: str, size: str = "1 day",
                delay: str = "1 second") -> DataFrame:
    """STR2 + STR7 + AGG2/3: append-mode mean per (key, window); a window is
    emitted once the watermark passes its end, rows older than the
    watermark are dropped (STR15)."""
    return (df.withWatermark(ts, delay)
            .groupBy(F.window(ts, size).alias("window"), F.col(key))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("sum_value"))
            .select(F.col(key), F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), "n", "sum_value",
                    (F.col("sum_value") / F.col("n")).alias("avg_value")))


def window_counts_panes(df: DataFrame, key: str, ts: str, size: str, slide: str) -> DataFrame:
    """STR3 + STR8/9 + AGG1: append-mode counts per (key, sliding window) of a
    stream with a watermark.  Rows are counted per pane (one slide long)
    first, and a pane is counted into the windows that hold it by its window
    time, so the state holds panes instead of every row's windows."""
    panes = df.groupBy(F.window(ts, slide).alias("pane"), F.col(key)).agg(F.count(F.lit(1)).alias("n"))
    return (panes.groupBy(F.window(F.window_time("pane"), size, slide).alias("window"), F.col(key))
            .agg(F.sum("n").alias("cnt")).select(F.col(key), "window", F.col("window.end").alias("window_end"), "cnt"))


def open_windows(spark: SparkSession, checkpoint: str, buffer: str = "count") -> DataFrame:
    """STR17: what an append-mode aggregate over windows has not returned when
    its input ends: keys (``window`` among them) and buffers of the windows
    that are still open, from the store of the last trigger.  ``buffer`` names
    a buffer (``count``, ``sum``) that tells a stream's aggregates apart."""
    operators = spark.read.format("state-metadata").load(checkpoint).where("operatorName = 'stateStoreSave'")
    for r in operators.select("operatorId").distinct().collect():
        state = spark.read.format("statestore").option("operatorId", r["operatorId"]).load(checkpoint)
        if buffer in state.schema["value"].dataType.names:
            return state.select("key.*", "value.*")
    raise ValueError(f"no aggregate with a buffer {buffer} in {checkpoint}")


def open_window_counts(spark: SparkSession, checkpoint: str, key: str, size: str, slide: str) -> DataFrame:
    """The rows :func:`window_counts_panes` has not returned: its open windows
    and open panes, the latter counted into the windows that hold them."""
    size_s, slide_s = duration_seconds(size), duration_seconds(slide)
    counted = open_windows(spark, checkpoint, "sum").select(key, F.col("window.end").alias("window_end"), F.col("sum").alias("n"))
    places = F.explode(F.sequence(F.lit(slide_s), F.lit(size_s), F.lit(slide_s)))
    panes = open_windows(spark, checkpoint, "count").select(key, "window", F.col("count").alias("n"), places.alias("k"))
    panes = panes.select(key, add_seconds(F.col("window.start"), F.col("k")).alias("window_end"), "n")
    return counted.unionByName(panes).groupBy(key, "window_end").agg(F.sum("n").alias("cnt"))


def rank_each_batch(sink: str, group: str, score: str, n: int, tie: str, cols: list[str]):
    """H3: ``row_number`` is refused on streams, but in append mode every
    key of a window end is emitted in the same micro-batch, so ranking
    inside ``foreachBatch`` sees whole windows.  Each batch overwrites its
    own folder: a replayed batch is idempotent."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        ranked = ranking.top_n(batch, group, score, n, tie=tie).select(*cols)
        ranked.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
    return fn


# ------------------------------------------------------------- stateful alerts
def carried(step, sink: str, state_dir: str, ts: str, delay: str = "0 seconds", window: str | None = None,
            ttl: str | None = None, parse=None):
    """STR11/12/14-16: an ordered-scan operator on a stream.  Every
    micro-batch runs ``step(rows, state)``, the operator's batch form, so a
    hot key spreads over tasks as it does there.  The batch (bounded by the
    trigger) is read once and kept while it is used; the state of its keys is
    read from and written to a :class:`..streaming.state.KeyedState`.

    ``window``: the state is keyed by ``window_start`` too; rows of windows
    that the watermark (largest ``ts`` of earlier batches less ``delay``) has
    passed are late and dropped, and the windows' state is cleared.  ``ttl``:
    the state of keys without rows for that long is cleared.  ``parse``: the
    stream's rows are lines that know where they were read
    (``files.with_place``); they are numbered from where the last trigger ended
    (``line``) and parsed by this function.

    Outputs go to a folder per batch, so a replayed batch is idempotent.
    Rows should arrive in event-time order between triggers: a row is
    compared with what arrived before it.
    """
    def alive(latest) -> Column | None:
        if latest is None or not (window or ttl):
            return None
        mark = add_seconds(F.lit(latest), -duration_seconds(delay))
        rules = []
        if window:
            rules.append(add_seconds(F.col("key.window_start"), duration_seconds(window)) > mark)
        if ttl:
            rules.append(add_seconds(F.col(f"_max_{ts}"), duration_seconds(ttl)) > mark)
        return reduce(lambda a, b: a & b, rules)

    def fn(source: DataFrame, batch_id: int) -> None:
        batch, state = source, KeyedState(source.sparkSession, state_dir, batch_id)
        before, lines = state.latest, state.lines
        if parse:
            batch = files.number_lines(source.persist(), start=lines)
            lines, batch = lines + batch.count(), parse(batch)
        if window and before is not None:
            batch = batch.where(F.window(ts, window).end > add_seconds(F.lit(before), -duration_seconds(delay)))
        batch = batch.persist()
        earlier = Earlier(lambda keys: state.of(keys, alive(before)))
        try:
            newest = batch.agg(F.max(ts).cast("timestamp")).first()[0]
            latest = max((t for t in (before, newest) if t is not None), default=None)
            out, after = step(batch, earlier)
            out.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
            state.commit(after, latest, alive(latest), lines)
        finally:
            earlier.release()
            batch.unpersist()
            source.unpersist()
    return fn


def keyed_process(df: DataFrame, keys: list[str], processor, out_schema: str, time_mode: str = "None") -> DataFrame:
    """UDF6: any user ``StatefulProcessor`` per key.  A key's rows of a
    trigger go to one worker; operators that must split hot keys use
    :func:`carried`."""
    return df.groupBy(*keys).transformWithStateInPandas(processor, out_schema, "append", time_mode)


# --------------------------------------------------------------- split / count
def tagged_sink(sink: str, routes: dict[str, Column], messages: dict[str, Column]):
    """SNK5 on a stream: every micro-batch writes the main output and one
    folder per tag.  The batch (bounded by the trigger) is persisted while
    its outputs are written, so the source is read once per batch; each
    folder is overwritten per batch id, so a replayed batch is idempotent."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.withColumn("message", F.lit(None).cast("string")) \
                 .write.mode("overwrite").parquet(f"{sink}/tag=main/batch={batch_id}")
            for tag, cond in routes.items():
                batch.filter(cond).withColumn("message", messages[tag]) \
                     .write.mode("overwrite").parquet(f"{sink}/tag={tag}/batch={batch_id}")
        finally:
            batch.unpersist()
    return fn


def changing_counts(key: str, sink: str, state_dir: str, count_name: str = "cnt"):
    """AGG7 + SNK2 on a stream: the unbounded count per key as changes.  Every
    trigger writes, for each key it touched, the retraction of the old count
    (``add`` false, none for a new key) and the new count (``add`` true); the
    counts themselves are a :class:`..streaming.state.KeyedState`, of which
    only the touched keys are written (an upsert).  Keys are counted where
    the rows are; a hot key sends one row per task."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        state = KeyedState(batch.sparkSession, state_dir, batch_id)
        new = batch.groupBy(F.struct(key).alias("key")).agg(F.count(key).alias("n")).persist()
        try:
            old = state.of(new.select("key"))
            old = old.select(F.col("key").alias("of"), F.col("n").alias("before")) if old is not None else \
                new.select(F.col("key").alias("of"), F.lit(None).cast("bigint").alias("before")).limit(0)
            both = new.join(old, F.col("key") == F.col("of"), "left").select("key", "before", (F.coalesce("before", F.lit(0)) + F.col("n")).alias("n"))
            change = lambda add, n: F.when(F.col(n).isNotNull(), F.struct(F.lit(add).alias("add"), F.col(n).alias(count_name)))
            changes = both.select("key.*", F.explode(F.array_compact(F.array(change(False, "before"), change(True, "n")))).alias("c"))
            changes.select(key, "c.*").write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
            state.commit(both.select("key", "n"), None)
        finally:
            new.unpersist()
    return fn


def current_counts(spark: SparkSession, state_dir: str, count_name: str = "cnt") -> DataFrame:
    """The table that the changes of :func:`changing_counts` lead to."""
    return KeyedState.newest(spark, state_dir).table().select("key.*", F.col("n").alias(count_name))


def fresh(spark: SparkSession, kind: str) -> tuple[str, str, str]:
    """Input, sink and checkpoint folders for one stream run."""
    root = scratch_path(spark, f"stream/{kind}")
    return f"{root}/input", f"{root}/sink", f"{root}/checkpoint"
