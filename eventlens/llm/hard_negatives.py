"""Hard negatives by exact inner-product search with coordinate pruning.

Anchors (a stated subset of the rows) are searched against all rows, twice:
for their best rows of the same label (positives), then, for each positive,
for the best rows of other labels whose score lies between a share of the
positive's score and that score.  Both searches work alike:

1. rows are dealt by a hash of their id into parts of about ``PART_ROWS``,
   anchors into groups of about ``PART_ROWS``; a task gets one part and one
   group, so nothing is broadcast and no task holds more;
2. in a task, rows are ordered by length and cut into length buckets, each
   with a sorted list of the unit vectors' values per coordinate;
3. an anchor's threshold is its weakest result so far (or the lowest score
   allowed).  A bucket whose length cannot reach it is skipped.  Otherwise the
   threshold over both lengths bounds the angle, and with the anchor's angle
   to an axis this gives the feasible range of that coordinate.  The ranges
   of the anchor's ``FOCUS`` largest coordinates are found in the sorted
   lists by binary search and their candidate sets intersected;
4. candidates are verified by their whole-number inner product.  Anchors
   whose ranges hardly narrow a bucket (the shares they span, multiplied, are
   over ``DENSE_SHARE``) verify that bucket together, as one matrix product;
5. each part's best rows are ranked again over all parts, in two steps.

Pruning only drops rows below the threshold (ranges are widened by more than
the rounding of doubles), so results are exact; ties go to the smaller id.

Defined cases: rows with a null label or id, or a vector that takes no part
(:mod:`.vectors`), are left out; rows of one id count once, the smallest
(label, vector) of them; an anchor without positives, or a positive with a
negative score (its share would exceed it), has no negatives; a zero vector
scores 0 everywhere; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts_for, written
from .vectors import integer_vectors, matrix

PART_ROWS = 1 << 18
SMALL_PART_ROWS = 1 << 12      # small tables are cut into up to LEAST_PARTS parts of this size
LEAST_PARTS = 64
BUCKET_ROWS = 4096
BLOCK_ANCHORS = 512
FOCUS = 5
DENSE_SHARE = 0.1
SLACK = 1e-7                   # on cosines and angles, far over the rounding of doubles

FOUND = "anchor_id bigint, slot int, id bigint, score bigint"
FOUND_ARROW = pa.schema([("anchor_id", pa.int64()), ("slot", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


class Bucket:
    """Rows of similar length with a sorted list per coordinate."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, labels: np.ndarray, lengths: np.ndarray):
        self.v, self.ids, self.labels = v, ids, labels
        self.longest, self.shortest = lengths.max(), lengths.min()
        self.unit = v / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable").T
        self.sorted = np.ascontiguousarray(np.take_along_axis(self.unit.T, self.order, axis=1))


def length_buckets(v, ids, labels, size: int = BUCKET_ROWS):
    """Buckets from the longest rows to the shortest."""
    lengths = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
    order = np.lexsort((ids, -lengths))
    for at in range(0, len(order), size):
        rows = order[at:at + size]
        yield Bucket(v[rows], ids[rows], labels[rows], lengths[rows])


class Anchors:
    """A block of anchors with their unit vectors and focus coordinates."""

    def __init__(self, v: np.ndarray, focus: int = FOCUS):
        self.v, self.length = v, np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
        unit = v / np.where(self.length > 0, self.length, 1.0)[:, None]
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :focus]
        self.angle = np.arccos(np.clip(np.take_along_axis(unit, self.focus, axis=1), -1.0, 1.0))


def feasible(bucket: Bucket, anchors: Anchors, at: np.ndarray, threshold: np.ndarray):
    """For the anchors ``at``: per focus coordinate the feasible values (low,
    high) and where they begin and end in the bucket's sorted list."""
    reach = np.where(threshold > 0, bucket.longest, bucket.shortest) * anchors.length[at]
    cosine = np.where(reach > 0, threshold / np.where(reach > 0, reach, 1.0), -1.0)
    beta = np.arccos(np.clip(cosine - SLACK, -1.0, 1.0))[:, None]
    alpha, focus = anchors.angle[at], anchors.focus[at]
    low = np.cos(np.minimum(np.pi, alpha + beta + SLACK)) - SLACK
    high = np.cos(np.maximum(0.0, alpha - beta - SLACK)) + SLACK
    begin, end = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
    for c in np.unique(focus):
        here = focus == c
        begin[here] = np.searchsorted(bucket.sorted[c], low[here], "left")
        end[here] = np.searchsorted(bucket.sorted[c], high[here], "right")
    return low, high, begin, end


def candidates(bucket: Bucket, anchors: Anchors, threshold: np.ndarray, exact: type):
    """Pairs (anchor, row, score) that hold every pair of the bucket whose
    score reaches the anchor's threshold, and the number of pairs verified."""
    v = bucket.v.astype(exact)
    at = np.nonzero(threshold <= np.floor(anchors.length * bucket.longest * (1 + SLACK) + 1))[0]
    none = np.empty(0, np.int64)
    if not len(at):
        return none, none, none, 0
    low, high, begin, end = feasible(bucket, anchors, at, threshold[at])
    sizes = end - begin
    narrow = sizes.argmin(axis=1)
    dense = (sizes / len(v)).prod(axis=1) > DENSE_SHARE
    found, checked = [], 0
    if dense.any():
        scores = anchors.v[at[dense]].astype(exact) @ v.T
        who, row = np.nonzero(scores >= threshold[at[dense]][:, None])
        found.append((at[dense][who], row, scores[who, row]))
        checked += scores.size
    for k in np.nonzero(~dense)[0]:
        first, a = narrow[k], at[k]
        rows = bucket.order[anchors.focus[a, first], begin[k, first]:end[k, first]]
        for j in range(sizes.shape[1]):
            if j != first and len(rows):
                values = bucket.unit[rows, anchors.focus[a, j]]
                rows = rows[(values >= low[k, j]) & (values <= high[k, j])]
        if len(rows):
            scores = v[rows] @ anchors.v[a].astype(exact)
            hit = scores >= threshold[a]
            found.append((np.full(hit.sum(), a), rows[hit], scores[hit]))
            checked += len(rows)
    if not found:
        return none, none, none, checked
    who, row, score = (np.concatenate(x) for x in zip(*found))
    return who, row, score.astype(np.int64), checked


class Best:
    """The ``k`` best (score, then smaller id) rows of every slot."""

    def __init__(self, slots: int, k: int, lowest: np.ndarray):
        self.k, self.threshold = k, lowest.astype(np.float64)
        self.slot = self.score = self.id = np.empty(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot, "left")
        last = place == self.k - 1
        self.threshold[slot[last]] = np.maximum(self.threshold[slot[last]], score[last])
        keep = place < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]


def _exact(v: np.ndarray, q: np.ndarray) -> type:
    """Doubles where they hold every inner product exactly, else longs."""
    most = (int(np.abs(v).max(initial=0)) * int(np.abs(q).max(initial=0)) * v.shape[1])
    return np.float64 if most < 1 << 53 else np.int64


def _columns(table: pa.Table, dims: int):
    return (matrix(table.column("v"), dims), table.column("vec_id").to_numpy(), table.column("label").to_numpy())


def _found(anchor_ids, slots: int, best: list[tuple[int, Best]]) -> pa.Table:
    slot = np.concatenate([np.empty(0, np.int64), *(b.slot + at * slots for at, b in best)])
    join = lambda name: np.concatenate([np.empty(0, np.int64), *(getattr(b, name) for _, b in best)])
    return pa.Table.from_arrays([pa.array(anchor_ids[slot // slots], pa.int64()), pa.array((slot % slots).astype(np.int32)),
                                 pa.array(join("id"), pa.int64()), pa.array(join("score"), pa.int64())], schema=FOUND_ARROW)


def _positives(dims: int, k: int, bucket_rows: int):
    """A task's best rows of an anchor's label: all rows and anchors given
    are of one label."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not len(rows) or not len(anchors):
            return FOUND_ARROW.empty_table()
        v, ids, labels = _columns(rows, dims)
        q, anchor_ids, _ = _columns(anchors, dims)
        exact = _exact(v, q)
        blocks = [(a, Anchors(q[a:a + BLOCK_ANCHORS])) for a in range(0, len(q), BLOCK_ANCHORS)]
        best = [(a, Best(len(b.v), k, np.full(len(b.v), -np.inf))) for a, b in blocks]
        for bucket in length_buckets(v, ids, labels, bucket_rows):
            for (a, block), (_, top) in zip(blocks, best):
                # before an anchor has k results: its best k rows of a first slice, itself aside
                open_ = np.isneginf(top.threshold)
                if open_.any():
                    n = min(len(bucket.v), 4 * (k + 1))
                    s = block.v[open_].astype(exact) @ bucket.v[:n].astype(exact).T
                    s = np.where(anchor_ids[a:a + len(block.v)][open_][:, None] == bucket.ids[None, :n], -np.inf, s)
                    if n > k:
                        top.threshold[open_] = np.sort(s, axis=1)[:, -k]
                who, row, score, _ = candidates(bucket, block, top.threshold, exact)
                other = anchor_ids[a + who] != bucket.ids[row]
                top.add(who[other], score[other], bucket.ids[row[other]])
        return _found(anchor_ids, 1, best)
    return run


def _negatives(dims: int, k: int, slots: int, share: tuple[int, int], bucket_rows: int):
    """A task's best rows of other labels for every positive of an anchor."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not len(rows) or not len(anchors):
            return FOUND_ARROW.empty_table()
        v, ids, labels = _columns(rows, dims)
        q, anchor_ids, anchor_labels = _columns(anchors, dims)
        high = np.full((len(q), slots), -1, np.int64)
        for a, scores in enumerate(anchors.column("scores").to_pylist()):
            high[a, :len(scores)] = scores
        exact = _exact(v, q)
        low = -((-high * share[0]) // share[1])                         # share of the score, rounded up
        blocks = [(a, Anchors(q[a:a + BLOCK_ANCHORS])) for a in range(0, len(q), BLOCK_ANCHORS)]
        best = [(a, Best(len(b.v) * slots, k, np.where(high[a:a + len(b.v)] >= 0, low[a:a + len(b.v)], np.inf).ravel()))
                for a, b in blocks]
        for bucket in length_buckets(v, ids, labels, bucket_rows):
            for (a, block), (_, top) in zip(blocks, best):
                weakest = top.threshold.reshape(-1, slots).min(axis=1)
                who, row, score, _ = candidates(bucket, block, weakest, exact)
                other = anchor_labels[a + who] != bucket.labels[row]
                who, row, score = who[other], row[other], score[other]
                fits = ((score[:, None] <= high[a + who]) & (score[:, None] >= low[a + who])
                        & (score[:, None] >= top.threshold.reshape(-1, slots)[who])).nonzero()
                top.add(who[fits[0]] * slots + fits[1], score[fits[0]], bucket.ids[row[fits[0]]])
        return _found(anchor_ids, slots, best)
    return run


def _first(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The ``k`` best of every group, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _dealt(df: DataFrame, parts: Column) -> Column:
    return F.pmod(F.xxhash64("vec_id"), parts).cast("int")


def _parts(n: int) -> int:
    return max(parts_for(n, PART_ROWS), min(LEAST_PARTS, parts_for(n, SMALL_PART_ROWS)))


def mined(df: DataFrame, anchors: Column, vector: str = "embedding", scale: int = 256, positives: int = 5,
          negatives: int = 5, share: tuple[int, int] = (4, 5), relabel: Column | None = None,
          bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score: per anchor and positive the ``negatives`` best rows of
    other labels that score at least ``share`` of the positive and at most as
    much.  ``anchors`` is a condition on vec_id, ``relabel`` an expression of
    vec_id and label that replaces the label."""
    vectors, dims = integer_vectors(df.where("vec_id IS NOT NULL AND label IS NOT NULL"), scale, vector)
    vectors = vectors.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("m")).select("vec_id", "m.label", "m.v")
    if relabel is not None:
        vectors = vectors.withColumn("label", relabel.cast("int"))
    rows = written(vectors, "mined-rows")
    picked = written(rows.where(anchors), "mined-anchors")
    n, n_anchors = rows.count(), picked.count()

    # positives: a label's rows and anchors meet in the label's own parts
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    small = F.least(F.lit(LEAST_PARTS), F.ceil(F.col("n") / SMALL_PART_ROWS))
    counts = written(counts.select("label", F.greatest(F.ceil(F.col("n") / PART_ROWS), small).alias("parts"))
                     .where("parts > 1"), "mined-labels")       # one row per SMALL_PART_ROWS rows at most
    sized = lambda side: side.join(counts, "label", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    mine = sized(rows).withColumn("part", _dealt(rows, F.col("parts"))).withColumn("pack", F.lit(0))
    packs = parts_for(n_anchors, PART_ROWS)
    pack = _dealt(picked, F.lit(packs))
    theirs = sized(picked).withColumn("part", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int")))).withColumn("pack", pack)
    if packs > 1:
        mine = mine.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))
    cells = ["label", "part", "pack"]
    found = (mine.select(*cells, "vec_id", "v").groupBy(*cells).cogroup(theirs.select(*cells, "vec_id", "v").groupBy(*cells))
             .applyInArrow(_positives(dims, positives, bucket_rows), FOUND))
    best = written(_first(found, positives, "anchor_id"), "mined-positives")

    # negatives: every part of all rows meets every group of anchors
    parts = _parts(n)
    scores = (best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("s"))
              .select(F.col("anchor_id").alias("vec_id"), F.col("s.score").alias("scores")))
    theirs = (picked.join(scores, "vec_id").withColumn("pack", pack)
              .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    mine = (rows.withColumn("part", _dealt(rows, F.lit(parts)))
            .withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1)))))
    cells = ["part", "pack"]
    found = (mine.select(*cells, "vec_id", "label", "v").groupBy(*cells)
             .cogroup(theirs.select(*cells, "vec_id", "label", "v", "scores").groupBy(*cells))
             .applyInArrow(_negatives(dims, negatives, positives, share, bucket_rows), FOUND))
    ranked = _first(found, negatives, "anchor_id", "slot")
    pairs = best.select(F.col("anchor_id").alias("of"), (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    return (ranked.join(pairs, (F.col("anchor_id") == F.col("of")) & (F.col("slot") == F.col("place")))
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
