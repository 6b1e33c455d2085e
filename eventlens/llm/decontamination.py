"""Benchmark decontamination: SimHash of item-sized windows, multi-index
Hamming search, exact weighted-shingle similarity.

Texts are lower-cased (A-Z) and cut into words.  An item of ``n`` words is
sought in windows of ``n`` words:

1. Anchors.  Shingles (five words, or the whole of a shorter item) weigh
   ``ln(1 + items / items with it)``.  An item's rarest shingles that
   together hold more than ``1 - SIMILAR`` of its weight are its anchors: a
   window that lacks them all cannot reach the similarity.  Wherever a
   document has an anchor, the window aligned to it is a candidate.
2. Every window and item gets a 64-bit SimHash of its words.  The bits are
   cut into ``RADIUS + 1`` blocks; fingerprints within ``RADIUS`` bits agree
   in at least one block, so joining on (length, block, value) finds every
   such pair; it is emitted at its first equal block only.  A window aligned to an
   item's own anchor is a pair at any distance: words lost at an edge cost
   few shingles but many bits.
3. The other windows that hold an anchor, however words between it and their
   start were added or lost, are scored where the whole document has enough
   of the item's shingles to reach the similarity: running sums over the
   places of its shingles give all windows of a document in time linear in its
   words.  As no similar window lacks all anchors, every similar window is seen.
4. Exact similarity: weight of shared shingles over the weight of the item
   plus that of the window's other shingles (which weigh as unseen ones).

A window at similarity 0.8 with one or two other words in the middle differs
from its item in about five of 64 bits; ``RADIUS`` is three standard
deviations beyond that.  It does not decide on an item's own windows.

Only DataFrame functions are used.  Documents are read twice, those with an
anchor are written once, and else only narrow rows are shuffled; benchmark tables are written first, so their file
size decides whether a join broadcasts them.

Defined cases: null or wordless texts and items match nothing; a null
``item_id`` is reported as null; repeated items and rows are found alike;
extra columns are ignored; empty tables give no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, text_of, with_defaults, words_of, written

SHINGLE_WORDS = 5
SIMILAR = 0.8
RADIUS = 11

#: (first bit, bits) of each block
BLOCKS = [(64 * b // (RADIUS + 1), 64 * (b + 1) // (RADIUS + 1) - 64 * b // (RADIUS + 1)) for b in range(RADIUS + 1)]


def _lower_words(text: Column) -> Column:
    return words_of(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def _shingles(w: Column, k: int) -> Column:
    """Hashes of the k-word shingles of ``w`` by position."""
    hashed = F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
    return F.when(F.size(w) >= k, hashed).otherwise(F.array().cast("array<bigint>"))


def _simhash(words: Column) -> Column:
    """64-bit SimHash of an array of words."""
    def bit(h: Column, b: Column) -> Column:
        sign = lambda a, x: a + F.when(F.getbit(x, b) == 1, 1).otherwise(-1)
        return F.aggregate(h, F.lit(0), sign)

    def folded(h: Column) -> Column:
        signs = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.when(
            bit(h, b) > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint")))
        return F.aggregate(signs, F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x))

    return let(F.transform(words, lambda w: F.xxhash64(w)), folded)


def _block(fp: Column, b: int) -> Column:
    low, bits = BLOCKS[b]
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))


def _blocks(df: DataFrame) -> DataFrame:
    """One row per block of ``fp``."""
    keys = F.array(*[F.struct(F.lit(b).alias("b"), _block(F.col("fp"), b).alias("v")) for b in range(len(BLOCKS))])
    return df.withColumn("key", F.explode(keys)).select("*", "key.b", "key.v").drop("key")


def _first_equal(x: Column) -> Column:
    """First block in which two fingerprints agree, from their difference."""
    return F.coalesce(*[F.when(_block(x, b) == 0, F.lit(b)) for b in range(len(BLOCKS))])


def benchmark_items(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, anchors): per item its length, SimHash, shingles and weights;
    per anchor its hash, place and item."""
    texts = with_defaults(benchmark, item_id="bigint", text="string")
    words = (texts.select("item_id", _lower_words(text_of()).alias("words")).where("size(words) > 0").distinct()
             .withColumn("item", F.xxhash64("item_id", "words")))
    by_size = F.coalesce(*[F.when(F.size("words") == k, _shingles(F.col("words"), k)) for k in range(1, SHINGLE_WORDS)],
                         _shingles(F.col("words"), SHINGLE_WORDS))
    words = words.withColumn("n", F.size("words")).withColumn("shingles", by_size)
    words = written(words.withColumn("fp", _simhash(F.col("words"))), "deco-words")
    n_items = words.count()
    spots = words.select("item", "n", F.posexplode("shingles").alias("at", "h"))
    df = spots.groupBy("h").agg(F.countDistinct("item").alias("df"))
    weighted = (spots.groupBy("item", "n", "h").agg(F.min("at").alias("at")).join(df, "h")
                .withColumn("weight", F.log(1 + n_items / F.col("df"))))
    weights = weighted.groupBy("item").agg(F.sum("weight").alias("weight"), F.map_from_entries(
        F.collect_list(F.struct("h", "weight"))).alias("weights")).withColumn("unseen", F.log(F.lit(1.0 + n_items)))
    items = written(words.join(weights, "item").select("item", "item_id", "n", "fp", "weight", "weights", "unseen"), "deco-items")
    rarest = Window.partitionBy("item").orderBy("df", "h")
    chosen = (weighted.withColumn("before", F.sum("weight").over(rarest) - F.col("weight"))
              .withColumn("all", F.sum("weight").over(Window.partitionBy("item")))
              .where(F.col("before") <= (1 - SIMILAR + 1e-8) * F.col("all")).select("item", "h"))
    # every place of an anchor in its item aligns a window
    anchors = spots.join(chosen, ["item", "h"]).select("h", "n", "at", "item").distinct()
    return items, written(anchors, "deco-anchors")


def _keyed(docs: DataFrame) -> DataFrame:
    return (with_defaults(docs, doc_id="bigint", text="string").select("doc_id", text_of().alias("text"))
            .withColumn("doc", F.xxhash64("doc_id", "text")))


def _windows(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc, start, n, item, low, high) of every window aligned to an item's
    anchor, and the first and last start of a window that holds the anchor."""
    sizes = [r[0] for r in anchors.select(F.least("n", F.lit(SHINGLE_WORDS)).alias("k")).distinct().collect()]
    words = docs.select("doc", _lower_words(F.col("text")).alias("words"))
    found = None
    for k in sorted(sizes):
        spots = words.select("doc", F.size("words").alias("size"), F.posexplode(_shingles(F.col("words"), k)).alias("pos", "h"))
        own = anchors.where(F.least("n", F.lit(SHINGLE_WORDS)) == k)
        start = lambda at: F.greatest(F.lit(0), F.least(at, F.col("size") - F.col("n")))
        hits = spots.join(own, "h").select(
            "doc", start(F.col("pos") - F.col("at")).alias("start"), "n", "item",
            start(F.col("pos") + k - F.col("n")).alias("low"), start(F.col("pos")).alias("high"))
        found = hits if found is None else found.union(hits)
    if found is None:
        return docs.select("doc", F.lit(0).alias("start"), F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("item"),
                           F.lit(0).alias("low"), F.lit(0).alias("high")).where(F.lit(False))
    return found.distinct()


def _by_size(words: Column) -> Column:
    """Shingles of ``words`` for an item of ``n`` words."""
    return F.coalesce(*[F.when(F.col("n") == k, _shingles(words, k)) for k in range(1, SHINGLE_WORDS)],
                      _shingles(words, SHINGLE_WORDS))


def _around_anchors(texts: DataFrame, windows: DataFrame, items: DataFrame) -> DataFrame:
    """doc, doc_id, item_id and the best window from the first to the last that
    holds an anchor.  A place counts in the windows that hold it and no earlier
    place of its shingle: it is added at the first of them and taken off after
    the last, so running sums score every window in one pass."""
    spans = windows.groupBy("doc", "item").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    own = F.map_keys("weights")
    held = lambda shingles: F.aggregate(
        F.array_intersect(own, shingles), F.lit(0.0), lambda a, h: a + F.element_at("weights", h))
    places = F.col("n") - F.least("n", F.lit(SHINGLE_WORDS)) + 1
    within = let(_by_size(F.col("words")), lambda w: F.when(
        held(w) >= (SIMILAR - 1e-6) * F.col("weight"), F.slice(w, F.col("low") + 1, F.col("high") - F.col("low") + F.col("places"))))
    keys = ["doc", "item", "doc_id", "item_id", "n", "weight", "unseen"]
    rows = (texts.join(spans, "doc").join(items, "item").withColumn("places", places)
            .select(*keys, "weights", "low", "high", "places", within.alias("within"))
            .repartition("doc", "item"))    # what follows groups by these, and more
    spots = (rows.select(*keys, "weights", "low", "high", "places", F.posexplode("within").alias("pos", "h"))
             .select(*keys, "low", "high", "places", "h", (F.col("low") + F.col("pos")).alias("at"),
                     F.try_element_at("weights", F.col("h")).alias("own")))
    # repeated rows of a document: the second of two equal places counts in no window
    earlier = F.lag("at").over(Window.partitionBy("doc", "item", "h").orderBy("at"))
    first = F.greatest(F.coalesce(earlier + 1, F.col("low")), F.col("at") - F.col("places") + 1, F.col("low"))
    shared, other = F.coalesce("own", F.lit(0.0)), F.col("own").isNull().cast("int")
    change = F.explode(F.array(F.struct(F.col("first").alias("start"), shared.alias("shared"), other.alias("other")),
                               F.struct((F.col("at") + 1).alias("start"), (-shared).alias("shared"), (-other).alias("other"))))
    changes = (spots.withColumn("first", first).select(*keys, "high", change.alias("c")).select(*keys, "high", "c.*").where("start <= high")
               .groupBy(*keys, "start").agg(F.sum("shared").alias("shared"), F.sum("other").alias("other")))
    so_far = Window.partitionBy("doc", "item").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    similarity = F.sum("shared").over(so_far) / (F.col("weight") + F.sum("other").over(so_far) * F.col("unseen"))
    return (changes.select(*keys, F.struct(F.round(similarity, 9).alias("similarity"), (-F.col("start")).alias("at"), "n").alias("found"))
            .groupBy("doc", "item", "doc_id", "item_id").agg(F.max("found").alias("found")).drop("item"))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc, doc_id, item_id, start, n_words and similarity of the best window
    of every document and item that reach ``SIMILAR``."""
    items, anchors = benchmark_items(benchmark)
    docs = _keyed(docs)
    hits = written(_windows(docs, anchors), "deco-windows")
    windows = hits.select("doc", "start", "n", "item").distinct()
    per_doc = windows.groupBy("doc").agg(F.collect_set(F.struct("start", "n")).alias("windows"))
    # texts with candidates grow with the corpus: always meet them by a shuffle, hashing the narrow side
    texts = docs.join(per_doc.hint("shuffle_hash"), "doc").select("doc", "doc_id", _lower_words(F.col("text")).alias("words"), "windows")
    texts = written(texts, "deco-texts")
    cutouts = F.transform("windows", lambda x: F.struct(
        x["start"].alias("start"), x["n"].alias("n"), F.slice("words", x["start"] + 1, x["n"]).alias("words")))
    cut = texts.select("doc", "doc_id", F.explode(cutouts).alias("w")).select("doc", "doc_id", "w.*").distinct()
    cut = written(cut.select("doc", "doc_id", "start", "n", _simhash(F.col("words")).alias("fp"),
                             F.array_distinct(_by_size(F.col("words"))).alias("shingles")), "deco-cutouts")

    sought = _blocks(items.select("item", F.col("n").alias("i_n"), "fp")).select(
        "item", "i_n", F.col("fp").alias("i_fp"), F.col("b").alias("i_b"), F.col("v").alias("i_v"))
    differ = F.col("fp").bitwiseXOR(F.col("i_fp"))
    pairs = (_blocks(cut.select("doc", "start", "n", "fp"))
             .join(sought, (F.col("n") == F.col("i_n")) & (F.col("b") == F.col("i_b")) & (F.col("v") == F.col("i_v"))
                   & (F.bit_count(differ) <= RADIUS) & (_first_equal(differ) == F.col("b")))
             .select("doc", "start", "n", "item"))
    pairs = written(pairs.union(windows.select("doc", "start", "n", "item")).distinct(), "deco-pairs")

    both = pairs.join(cut.select("doc", "doc_id", "start", "n", "shingles"), ["doc", "start", "n"]).join(
        items.select("item", "item_id", "weight", "weights", "unseen"), "item")
    own = F.map_keys("weights")
    shared = F.aggregate(F.map_entries("weights"), F.lit(0.0), lambda a, e: a + F.when(
        F.array_contains("shingles", e["key"]), e["value"]).otherwise(0.0))
    similarity = shared / (F.col("weight") + F.size(F.array_except("shingles", own)) * F.col("unseen"))
    found = F.struct(F.round(similarity, 9).alias("similarity"), (-F.col("start")).alias("at"), "n").alias("found")
    around = _around_anchors(texts.select("doc", "doc_id", "words"), hits, items.drop("fp"))
    return (both.select("doc", "doc_id", "item_id", found).unionByName(around).where(F.col("found.similarity") >= SIMILAR)
            .groupBy("doc", "doc_id", "item_id").agg(F.max("found").alias("best"))
            .select("doc", "doc_id", "item_id", (-F.col("best.at")).cast("bigint").alias("start_word"),
                    F.col("best.n").cast("bigint").alias("n_words"), F.col("best.similarity").alias("similarity")))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start_word, n_words, similarity of every match."""
    return matches(docs, benchmark).drop("doc")


def keep_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a match."""
    gone = written(matches(docs, benchmark).select(F.col("doc").alias("gone")).distinct(), "deco-gone")
    have = set(docs.columns)
    doc_id = F.col("doc_id").cast("bigint") if "doc_id" in have else F.lit(None).cast("bigint")
    return docs.join(gone, F.xxhash64(doc_id, text_of()) == gone.gone, "left_anti")
