"""State of keyed operators between triggers, one row per key, as runs.

A trigger writes the state of the keys it has touched as a new run of Parquet
files, merged with the newest older runs as long as these are at most twice
as large as what triggers write.  What a trigger writes therefore follows its
own keys (each row is rewritten a logarithmic number of times), and there are
logarithmically many runs.  A key's state is its row in the newest run that
holds it; a trigger reads the rows of its own keys.

The log of a trigger, a line of JSON, names its runs and its clock.  Logs
alternate between two files and are written last, so a trigger that is
replayed after a failure finds the runs it started from.  Runs that were merged away are deleted one
trigger later.  Dead rows (ended windows, keys past their time to live) are
left out when they are read and when their run is merged.
"""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_path

MERGE_UP_TO = 2


class KeyedState:
    """The state as trigger ``batch_id`` finds it; ``commit`` writes the next."""

    def __init__(self, spark: SparkSession, folder: str, batch_id: int):
        self.spark, self.folder, self.batch_id = spark, folder, batch_id
        log = _read(spark, self._log(batch_id - 1)) if batch_id else {}
        if batch_id and log.get("batch") != batch_id - 1:
            raise ValueError(f"no state after trigger {batch_id - 1} in {folder}")
        self.latest = _time(log["latest"]) if log.get("latest") else None
        self.runs, self.merged = [tuple(r) for r in log.get("runs", [])], log.get("merged", [])
        self.touched, self.lines = log.get("touched", 0), log.get("lines", 0)

    @classmethod
    def newest(cls, spark: SparkSession, folder: str) -> KeyedState:
        """The state after the last trigger that was committed."""
        logs = [_read(spark, f"{folder}/log-{k}.json") for k in (0, 1)]
        return cls(spark, folder, max(log.get("batch", -1) for log in logs) + 1)

    def _log(self, batch_id: int) -> str:
        return f"{self.folder}/log-{batch_id % 2}.json"

    def _run(self, batch: int) -> str:
        return f"{self.folder}/run={batch}"

    def _rows(self, runs: list[tuple[int, int]]) -> DataFrame:
        parts = [self.spark.read.parquet(self._run(b)).withColumn("_at", F.lit(b)) for b, _ in runs]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def table(self, alive: Column | None = None) -> DataFrame | None:
        """The newest row of every key."""
        return _newest(self._rows(self.runs), alive) if self.runs else None

    def of(self, keys: DataFrame, alive: Column | None = None) -> DataFrame | None:
        """The newest rows of the given keys (a ``key`` column)."""
        if not self.runs:
            return None
        return _newest(self._rows(self.runs).join(keys, "key", "left_semi"), alive)

    def commit(self, rows: DataFrame, latest, alive: Column | None = None, lines: int = 0) -> None:
        """``rows``: the new state of the keys this trigger touched;
        ``latest`` and ``lines`` go on in the log."""
        touched, kept = Observation(), Observation()
        rows = (rows if alive is None else rows.where(alive)).observe(touched, F.count(F.lit(1)).alias("n"))
        runs, merging = list(self.runs), []
        size = self.touched if len(runs) > 1 else 0      # the oldest run joins younger ones, never one trigger alone
        while runs and runs[-1][1] <= MERGE_UP_TO * size:
            merging.append(runs.pop())
            size = sum(r for _, r in merging) + (self.touched if len(runs) > 1 else 0)
        if merging:
            rows = _newest(rows.withColumn("_at", F.lit(self.batch_id)).unionByName(self._rows(merging), allowMissingColumns=True), alive)
        rows.observe(kept, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(self._run(self.batch_id))
        runs.append((self.batch_id, kept.get["n"]))
        _write(self.spark, self._log(self.batch_id), {
            "batch": self.batch_id, "latest": latest.isoformat() if latest else None, "runs": runs,
            "merged": [b for b, _ in merging], "touched": touched.get["n"],
            "lines": lines})
        for batch in self.merged:       # merged away by the trigger before this one, which cannot be replayed any more
            fs, path = hadoop_path(self.spark, self._run(batch))
            fs.delete(path, True)


def _newest(rows: DataFrame, alive: Column | None) -> DataFrame:
    fields = [c for c in rows.columns if c not in ("key", "_at")]
    newest = rows.groupBy("key").agg(F.max_by(F.struct(*fields), "_at").alias("s")).select("key", "s.*")
    return newest if alive is None else newest.where(alive)


def _time(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def _read(spark: SparkSession, path: str) -> dict:
    """A log, empty if there is none."""
    fs, where = hadoop_path(spark, path)
    if not fs.exists(where):
        return {}
    stream = fs.open(where)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, log: dict) -> None:
    """A log is small: a line, written whole when its file is closed."""
    fs, where = hadoop_path(spark, path)
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(json.dumps(log).encode()))
    finally:
        stream.close()
