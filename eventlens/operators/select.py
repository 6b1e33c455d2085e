"""Projection, filters and routing into tagged outputs (side outputs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import messages

MAIN = "main"


def select_filter(df: DataFrame, columns: list[str], predicate: str | Column) -> DataFrame:
    """Table API ``select(...).filter(...)``.  Catalyst reorders the two and
    pushes the predicate into the scan."""
    cond = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.select(*columns).filter(cond)


def route(df: DataFrame, routes: dict[str, Column], message: dict[str, Column] | None = None,
          keep_main: bool = True) -> DataFrame:
    """FLT6 / SNK5: one input, several labelled outputs, the main output
    unchanged.  Returns one DataFrame with a ``tag`` column (``main`` for the
    pass-through copy) and an optional ``message`` per tag.  One pass over
    the input: each row is exploded into the tags whose predicate it meets
    (no shuffle, one scan however many outputs)."""
    tags = ([F.lit(MAIN)] if keep_main else []) + [F.when(cond, F.lit(tag)) for tag, cond in routes.items()]
    out = df.withColumn("tag", F.explode(F.array_compact(F.array(*tags))))
    msg = F.lit(None).cast("string")
    for tag, m in (message or {}).items():
        msg = F.when(F.col("tag") == tag, m).otherwise(msg)
    return out.withColumn("message", msg)


def side_output(routed: DataFrame, tag: str) -> DataFrame:
    """SNK6: ``getSideOutput(tag)``."""
    return routed.filter(F.col("tag") == tag)


def split_outputs(df: DataFrame, routes: dict[str, Column]) -> dict[str, DataFrame]:
    """Dictionary form: ``{"main": df, tag: df.filter(cond), ...}``."""
    out = {MAIN: df}
    out.update({t: df.filter(c) for t, c in routes.items()})
    return out


def sensor_alarm(df: DataFrame, id_col: str = "id") -> DataFrame:
    """ALR5: the reference's ``tempAlarm``: ``sensor_6`` to ``tmp-output``,
    ``sensor_1`` to ``qa-output``, every element to main."""
    i = F.col(id_col)
    return route(df,
                 {messages.TAG_6: i == "sensor_6", messages.TAG_1: i == "sensor_1"},
                 {messages.TAG_6: F.concat(F.lit(messages.SIDE_TAG_6), i),
                  messages.TAG_1: F.concat(F.lit(messages.SIDE_TAG_1), i)})


def process(df: DataFrame, fn, schema: str) -> DataFrame:
    """UDF7: a user's process function over the elements, in one pass.  ``fn``
    gets an iterator of bounded batches and yields result frames with a
    ``tag`` column: ``main`` for its output, another tag for a side output;
    it may emit any number of rows to any tag per element.  Batch or stream,
    no shuffle; :func:`write_tagged` gives each tag a folder."""
    return df.mapInPandas(fn, schema)


def write_tagged(out: DataFrame, path: str) -> DataFrame:
    """The processed elements written to one folder per tag (SNK5), and read
    back; reading one tag reads its folder alone."""
    out.write.partitionBy("tag").parquet(path)
    return out.sparkSession.read.schema(out.schema).parquet(path)
