"""Helpers shared by the corpus operators.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]`` everywhere in this
subpackage.  Intermediate tables go below ``spark.checkpoint.dir`` (see
``session.scratch_root``): they cut lineage, survive lost executors and give
Catalyst their true size, so it picks broadcast joins only below its own
threshold.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, scratch_root

WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables as a DataFrame."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array (empty for a text without words)."""
    trimmed = F.btrim(text, F.lit(WHITE))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, WHITE_RUN))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also when the
    body uses it inside another lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written as Parquet into the shared scratch folder and reread."""
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint; Spark removes its files once nothing uses it."""
    scratch_root(df.sparkSession)
    return df.checkpoint()


def parts_for(total_bytes: int | None, target_bytes: int) -> int:
    """Number of partitions of about ``target_bytes`` each."""
    return max(1, math.ceil((total_bytes or 0) / target_bytes))


def with_defaults(df: DataFrame, **types: str) -> DataFrame:
    """``df`` cut down to the named columns with the given types; columns
    that are absent are null, others are dropped (extra columns never clash
    with an operator's own names)."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(t).alias(c)
                       for c, t in types.items()])


def bounded_sample(df: DataFrame, rows: int, total: int, *keys: str) -> DataFrame:
    """About ``rows`` rows of ``df`` (of ``total``), chosen by a hash of
    ``keys``, never over one and a half times as many: what reaches the
    driver does not grow with the input."""
    share = min(1.0, rows / max(total, 1))
    chosen = F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    return df.where(chosen).orderBy(F.xxhash64(*keys), *keys).limit(rows + rows // 2)
