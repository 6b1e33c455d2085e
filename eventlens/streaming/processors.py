"""Stateful processors for ``jobs.keyed_process``
(``transformWithStateInPandas``, RocksDB state store): the form for a user's
own keyed function.  Rows of a key inside one micro-batch arrive unordered,
so a handler sorts them first; the batch's size is bounded by the source's
``maxFilesPerTrigger``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class RunningSumProcessor(StatefulProcessor):
    """AGG6 as a keyed process function: every element with the running sum
    of its key; the state is the key's total so far.  Columns are arguments."""

    def __init__(self, value: str, order: list[str], out_cols: list[str]):
        self.value, self.order, self.out_cols = value, list(order), list(out_cols)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("sum", "total double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable")
        total = self.state.get()[0] if self.state.exists() else 0.0
        running = []
        for v in pdf[self.value].astype("float64"):
            total += v
            running.append(total)
        self.state.update((total,))
        out = pdf[self.out_cols].copy()
        out["running_" + self.value] = running
        yield out

    def close(self) -> None:
        pass
