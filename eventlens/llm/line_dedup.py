"""Line dedup: later copies of repeated runs of lines go.

A run repeats when its lines, ``MIN_WORDS`` words or more in all, stand in
the same order at an earlier place: a smaller ``doc_id``, or further up in
the same document.  Lines without a word do not count and go with the run
around them.

1. Every line gets a 64-bit hash.  For every line there are two windows, the
   shortest run of ``MIN_WORDS`` words that starts with it and the shortest
   that ends with it.
2. Winnowing: each window selects its smallest line hash (leftmost of equal
   ones) as a fingerprint.  Equal windows select equal fingerprints, so any
   repeated run shares one with its earlier copy; windows whose fingerprint
   stands at one place only drop out.
3. The windows left extend to the left and right of their fingerprint.  They
   are compared by the hash of all their lines with their first place in
   the corpus; those at later places mark their lines.  A line in a repeated
   run lies in a window that starts or one that ends within the run, so the
   marked windows together are the runs' full extent.

Only DataFrame functions are used.  Texts are not shuffled to find runs, only
line hashes, by document; hot lines and passages are counted by partial
aggregation and joined back, which adaptive execution splits.

Defined cases: null texts have no lines and stay null; null ``doc_id`` sorts
first; rows equal in ``doc_id`` and text are one document (all lose the same
lines); extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of, with_defaults, words_of, written

MIN_WORDS = 50
DOC = ["doc_id", "h"]


def _rows(docs: DataFrame) -> DataFrame:
    return with_defaults(docs, doc_id="bigint", text="string").withColumn("h", F.xxhash64(text_of()))


def _windows(rows: DataFrame) -> DataFrame:
    """doc_id, h, first, last (line numbers), fingerprint, its line, and
    content hash of every window."""
    lines = (rows.select(*DOC, F.posexplode(F.split(text_of(), "\n")).alias("pos", "line"))
             .select(*DOC, "pos", F.size(words_of(F.col("line"))).alias("n"), F.xxhash64("line").alias("lh"))
             .where("n > 0").dropDuplicates([*DOC, "pos"]))
    doc = Window.partitionBy(*DOC)
    after = F.sum("n").over(doc.orderBy("pos"))
    lines = lines.withColumn("after", after).withColumn("before", F.col("after") - F.col("n"))

    def of(window):
        return F.struct(F.sum("n").over(window).alias("words"), F.min("pos").over(window).alias("first"),
                        F.max("pos").over(window).alias("last"), F.min(F.struct("lh", "pos")).over(window).alias("mark"),
                        F.xxhash64(F.collect_list("lh").over(window)).alias("content"))

    ahead = of(doc.orderBy("before").rangeBetween(0, MIN_WORDS - 1))
    behind = of(doc.orderBy("after").rangeBetween(1 - MIN_WORDS, 0))
    both = lines.select(*DOC, ahead.alias("ahead"), behind.alias("behind"))
    both = both.select(*DOC, F.explode(F.array("ahead", "behind")).alias("w")).where(F.col("w.words") >= MIN_WORDS)
    return both.select(*DOC, "w.first", "w.last", F.col("w.mark.lh").alias("mark"), F.col("w.mark.pos").alias("at"), "w.content")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), and ``runs``: the line ranges, first and
    last, that repeat earlier ones."""
    windows = written(_windows(_rows(docs)).distinct(), "lines-windows")
    place = F.struct(F.col("doc_id").isNotNull().alias("some"), *DOC, "first")
    shared = (windows.select(*DOC, "mark", "at").distinct().groupBy("mark").agg(F.count("*").alias("places"))
              .where("places > 1").select("mark"))
    extended = windows.join(shared, "mark").select(*DOC, "first", "last", "content")
    origin = (extended.groupBy("content").agg(F.min(place).alias("origin"), F.max(place).alias("latest"))
              .where("origin < latest").select("content", "origin"))
    later = extended.join(origin, "content").where(place > F.col("origin")).select(*DOC, "first", "last").distinct()
    # merge overlapping windows
    order = Window.partitionBy(*DOC).orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = later.withColumn("new", F.when(F.col("first") <= reach, 0).otherwise(1))
    merged = (starts.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy(*DOC, "run").agg(F.min("first").alias("first"), F.max("last").alias("last")))
    return merged.groupBy(*DOC).agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_lines (with a word), n_removed, the removed line
    ranges as ``first-last`` and the text that stays."""
    runs = written(repeated_runs(docs), "lines-runs").select(F.col("doc_id").alias("r_id"), F.col("h").alias("r_h"), "runs")
    rows = _rows(docs)
    # documents with runs grow with the corpus: always meet them by a shuffle, hashing the narrow side
    rows = rows.join(runs.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("h") == F.col("r_h")), "left")
    lines = F.split(text_of(), "\n")
    gone = lambda i: F.exists("runs", lambda r: (r["first"] <= i) & (r["last"] >= i))
    counted = lambda x: F.size(F.filter(x, lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))).cast("bigint")
    kept = F.when(F.col("runs").isNull(), lines).otherwise(F.filter(lines, lambda _, i: ~gone(i)))
    return (rows.select("doc_id", "text", lines.alias("lines"), kept.alias("kept"), "runs")
            .select("doc_id", counted("lines").alias("n_lines"), (counted("lines") - counted("kept")).alias("n_removed"),
                    F.coalesce(F.array_join(F.transform("runs", lambda r: F.concat_ws("-", r["first"], r["last"])), ","),
                               F.lit("")).alias("removed"),
                    F.when(F.col("text").isNotNull(), F.array_join("kept", "\n")).alias("text")))
