"""Line and element sources, batch and stream.

``read_lines`` is ``readTextFile``: one row per line in a ``value`` column.
``with_place`` and ``number_lines`` give lines their numbers in reading order,
for operators that must follow it (``operators.arrival``, ``arrival=True``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str, stream: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    if not stream:
        return spark.read.text(path)
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def with_place(lines: DataFrame) -> DataFrame:
    """Where each line was read: file and start of the split.  To be put right
    on top of a text source, batch or stream."""
    return lines.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def with_seq(lines: DataFrame) -> DataFrame:
    """Arrival order of each line: (file path, split start, id within the
    split).  ``monotonically_increasing_id`` is increasing inside a task, so
    the triple orders lines of a file read in several splits."""
    return with_place(lines).withColumn("_pos", F.monotonically_increasing_id())


def number_lines(lines: DataFrame, start: int = 0, name: str = "line") -> DataFrame:
    """Numbers lines that know where they were read (:func:`with_place`) from
    ``start`` on: files in the order of their paths, lines as they stand.
    Lines are counted per split, one row each; the prefix over the splits is
    joined back, so no line moves and no task sees all lines."""
    # increasing inside a task, so inside a split; the same wherever the scan runs
    lines = lines.withColumn("_pos", F.monotonically_increasing_id())
    splits = lines.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    places = splits.select(F.col("_file").alias("_f"), F.col("_block").alias("_b"), "_first",
                           (F.coalesce(F.sum("_n").over(before), F.lit(0)) + start).alias("_before"))
    numbered = lines.join(places, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    return numbered.withColumn(name, F.col("_before") + F.col("_pos") - F.col("_first")) \
                   .drop("_file", "_block", "_pos", "_f", "_b", "_first", "_before")


def write_lines(lines: DataFrame, path: str, col: str = "value") -> str:
    """Write one string column as a text file set (one line per row)."""
    lines.select(F.col(col).alias("value")).write.mode("overwrite").text(path)
    return path


def elements(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """``fromElements``: a small fixed collection as a DataFrame."""
    return spark.createDataFrame(list(rows), schema)


def socket_lines(spark: SparkSession, host: str = "localhost", port: int = 9999) -> DataFrame:
    """``socketTextStream``: development line stream.  Declared only; it
    connects when the query starts."""
    return (spark.readStream.format("socket").option("host", host)
            .option("port", port).load())
