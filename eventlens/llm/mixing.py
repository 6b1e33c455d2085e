"""Mixing sources to target weights.

Sources (in code-point order, null last) weigh 5, 2, 1, repeating, and share
``BUDGET`` times all words; a target stops at ``MAX_EPOCHS`` times its
source's words and what it leaves is shared anew by weight.  Within a source
documents stand in a seeded random order; the stream of a source is that
order, epoch after epoch, and the mix takes the copies whose middle word
lies before the target, so each source ends within half a document of it.

The taken stream is cut into blocks of ``block_words``.  The exact numbers
of blocks per source go down a splitting tree: a node's shards are halved,
and the left half's blocks are one multivariate-hypergeometric draw from the
node's.  A shard walks from the root to its leaf on its own (a node's draw
depends on the seed and its place only), which gives it a range of each
source's blocks, disjoint from all other shards'.  A block's place in its
source is already random, so a range is a set of permuted blocks.  Each
shard orders its copies by a seeded hash.

One row per source reaches the driver (the mixing table); documents never
do.  A hot source is cut into hash buckets of about ``BUCKET_DOCS``
documents for its running totals.

Defined cases: null text has size 0 and is never drawn; null source is a
source; an empty source has target 0; repeated rows are separate documents
of equal rank, of which some may be drawn once more than others; extra
columns pass through ``draw_documents``; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import parts_for, text_of, words_of, written

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = 7
BUCKET_DOCS = 2000


def source_targets(sources: DataFrame) -> DataFrame:
    """Adds ``target`` to one row per source (source, source_size).

    Sources that stop at their cap are those with the smallest cap per
    weight: in that order, a source stops when its share of what the earlier
    ones leave, by weight, would exceed its cap.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    rows = (sources.withColumn("rank", rank - 1).withColumn("weight", weight)
            .withColumn("cap", (MAX_EPOCHS * F.col("source_size")).cast("double")))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    left = BUDGET * F.sum("source_size").over(everything) - (F.sum("cap").over(order) - F.col("cap"))
    weights = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", left / weights).withColumn("stops", F.col("level") * F.col("weight") >= F.col("cap"))
    level = F.max(F.when(~F.col("stops"), F.col("level"))).over(everything)  # the first that does not stop
    return (rows.withColumn("target", F.when(F.col("stops"), F.col("cap")).otherwise(level * F.col("weight")))
            .select("source", "source_size", "target"))


def _sized(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``row`` (these columns of the given row), source, size and random rank."""
    have = set(docs.columns)
    source = F.col("source").cast("string") if "source" in have else F.lit(None).cast("string")
    seeded = F.md5(F.concat_ws(":", F.lit(str(SEED)), F.col("doc_id").cast("string")))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), source.alias("source"),
        F.size(words_of(text_of())).cast("bigint").alias("size"),
        F.conv(F.substring(seeded, 1, 15), 16, 10).cast("bigint").alias("rank"))


def _streamed(rows: DataFrame, sizes: DataFrame, shards_of) -> tuple[DataFrame, DataFrame]:
    """Adds source_size, target and the words before each row in its source;
    also ``shards_of(sources)`` of the table of sources.  ``sizes`` holds
    source, size and rank of all rows."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    n_all = totals.groupBy().agg(F.sum("n")).first()[0] or 0
    buckets = parts_for(n_all, BUCKET_DOCS)
    # ranks are uniform in 60 bits: buckets are ranges of the rank
    bucket = F.floor(F.col("rank") / F.lit((1 << 60) / buckets))
    group = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (sizes.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
              .select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"),
                      F.coalesce(F.sum("words").over(group), F.lit(0)).alias("b_before")))
    own = Window.partitionBy("source", "bucket").orderBy("rank", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("bucket", bucket).withColumn("in_bucket", F.coalesce(F.sum("size").over(own), F.lit(0)))
    targets = written(source_targets(totals), "mix-targets")
    before = written(before, "mix-buckets")
    known = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    rows = (rows.join(before, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
            .join(known, F.col("source").eqNullSafe(F.col("t_source")))
            .withColumn("before", F.col("b_before") + F.col("in_bucket"))
            .drop("b_source", "b_bucket", "b_before", "in_bucket", "bucket", "t_source"))
    return rows, shards_of(targets)


class Tree:
    """Splits block quotas among ``shards`` leaves."""

    def __init__(self, quotas: list[int], shards: int, seed: int):
        self.quotas, self.shards, self.seed = np.array(quotas, "i8"), shards, seed
        self.memo: dict[tuple[int, int], np.ndarray] = {}

    def _left(self, low: int, high: int, have: np.ndarray) -> np.ndarray:
        """The left half's blocks of node [low, high)."""
        if (low, high) not in self.memo:
            mid, total = (low + high) // 2, int(have.sum())
            rng = np.random.default_rng([self.seed, low, high])
            take = total * (mid - low) // (high - low)
            out = np.zeros(len(have), "i8")
            for k, n in enumerate(have):  # conditional draws, one source after another
                out[k] = rng.hypergeometric(n, total - n, take) if 0 < take and n else 0
                total, take = total - int(n), take - int(out[k])
            if len(self.memo) > 4096:
                self.memo.clear()
            self.memo[low, high] = out
        return self.memo[low, high]

    def leaf(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        """First block and number of blocks of each source in a shard."""
        low, high, have, first = 0, self.shards, self.quotas, np.zeros(len(self.quotas), "i8")
        while high - low > 1:
            mid, left = (low + high) // 2, self._left(low, high, have)
            if shard < mid:
                high, have = mid, left
            else:
                low, have, first = mid, have - left, first + left
        return first, have


def _blocks(targets: DataFrame, block_words: int, shard_words: int) -> DataFrame:
    """(source, block, shard) of every block of the mix."""
    spark = targets.sparkSession
    sources = targets.orderBy(F.col("source").asc_nulls_last()).collect()
    # a stream's last taken copy may start beyond the target only by half a document
    quotas = [int(r["target"] // block_words) + 1 if r["source_size"] else 0 for r in sources]
    shards = parts_for(int(sum(r["target"] for r in sources)), shard_words)
    names = [r["source"] for r in sources]

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(quotas, shards, SEED)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                first, n = tree.leaf(shard)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(first), pa.array(n), pa.array([shard] * len(names), pa.int64())],
                    ["source", "first", "n", "shard"])

    ranges = spark.range(shards).mapInArrow(leaves, "source string, first bigint, n bigint, shard bigint").where("n > 0")
    return ranges.select("source", F.explode(F.expr("sequence(first, first + n - 1)")).alias("block"), "shard")


def mix(docs: DataFrame, columns: list[str] | None = None, block_words: int = 4096,
        shard_words: int = 1 << 22) -> DataFrame:
    """Per row of ``docs``: ``row`` (its ``columns``, by default all), size, source_size, target and ``shards``,
    the output shard of each copy that the mix takes (none, one or two)."""
    if columns is None:  # texts stay where they are; only their sizes are written
        rows = _sized(docs, docs.columns)
        sizes = written(rows.select("source", "size", "rank"), "mix-sizes")
    else:
        rows = sizes = written(_sized(docs, columns), "mix-sizes")
    out, blocks = _streamed(rows, sizes, lambda t: written(_blocks(t, block_words, shard_words), "mix-blocks"))
    for k in range(MAX_EPOCHS):
        place = F.col("before") + k * F.col("source_size")
        taken = (F.col("size") > 0) & (place + F.col("size") / 2 <= F.col("target"))
        b = blocks.select(F.col("source").alias(f"s{k}"), F.col("block").alias(f"b{k}"), F.col("shard").alias(f"shard{k}"))
        out = (out.withColumn(f"at{k}", F.when(taken, F.floor(place / block_words)))
               .join(b, F.col("source").eqNullSafe(F.col(f"s{k}")) & (F.col(f"at{k}") == F.col(f"b{k}")), "left"))
    shards = F.filter(F.array(*[F.col(f"shard{k}") for k in range(MAX_EPOCHS)]), lambda s: s.isNotNull())
    return out.select("row", "size", "source_size", "target", shards.alias("shards"))


def mixed_sizes(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target and the words taken."""
    rows = mix(docs, ["doc_id"])
    return rows.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"))


def draw_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: a row of ``docs`` per copy taken, shards side by side,
    each shuffled locally."""
    copies = mix(docs).select("row", F.posexplode("shards").alias("copy", "shard"))
    order = F.xxhash64(F.lit(SEED), "shard", "row.doc_id", "copy")
    return (copies.withColumn("order", order).repartition("shard").sortWithinPartitions("shard", "order")
            .select("row.*"))
