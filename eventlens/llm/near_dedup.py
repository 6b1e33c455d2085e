"""MinHash near-duplicate detection with exact confirmation.

A document's set is its distinct five-word shingles (lower-cased A-Z, words
``[^\\x20\\x09-\\x0D]+``); a text of one to four words is one shingle, a text
without words (or null) has an empty set and is linked with nothing.  Two
documents are linked when ``100 * |A & B| >= 85 * |A | B|``.

1. Documents with equal sets form a class; only its representative goes on.
2. Each representative gets ``BANDS * ROWS`` universal hash minima
   ``min((a*x + b) mod 2^32)``.  A band's minima make one key; a pair at
   similarity 0.85 shares none of the keys with probability
   ``(1 - 0.85^ROWS)^BANDS`` (below 1e-6).
3. A key's members are paired with its smallest member only (a star): each
   member first with the smallest of all its keys, then, where the two are
   still apart, with the smallest of every key.  Pairs whose signatures
   allow the threshold are confirmed on the full sets; components are found
   by alternating large-star and small-star.
4. Keys that still hold several components are settled by their members'
   rare shingles, those that at most ``RARE`` of such members hold.  A linked
   pair with a rare shingle in common has its rarest common one among the
   first ``n - ceil(0.85 n) + 1`` of both sets in order of rarity, so these
   prefixes are joined: a row meets fewer than ``RARE`` others.  A linked pair
   without one consists of two sets whose frequent shingles alone allow the
   threshold: only those are joined by key, each member outside the smallest
   member's component with the members of other components.  No pair of
   different components that shares a key goes unconfirmed; pairs in one
   component need no link.  Components again.

Signature verification compares one bit of each minimum: equal minima give
equal bits, others agree half the time, so similarity J shows in
``(1 - J) / 2`` differing bits; ``MAX_BITS`` lies over six standard
deviations beyond what the threshold gives.

Rows with equal ``doc_id`` are one vertex, linked by any of their texts; a
null ``doc_id`` is no vertex (component null, kept).  Extra columns are
ignored; an empty table gives no row; a very long text is one row like any
other, its minima taken block by block.  Ties (equal sets) go to the smallest
``doc_id``.  No group is collected: keys and hubs are joined, which adaptive
execution splits, and their counts are pre-aggregated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, let, text_of, with_defaults, words_of, written

SHINGLE_WORDS = 5
PERCENT = 85
ROWS, BANDS = 8, 44
MAX_BITS = 56
RARE = 16
SEED = 20240229
SKETCH = (ROWS * BANDS + 63) // 64

FEATURES = "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>, sketch array<bigint>"


def shingles_of(text: Column) -> Column:
    """Distinct shingle hashes of a lower-cased text."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    none = F.array().cast("array<bigint>")

    def hashed(w: Column) -> Column:
        n = F.size(w)
        parts = lambda i: [F.get(w, i + k) for k in range(SHINGLE_WORDS)]
        many = F.transform(F.sequence(F.lit(0), n - SHINGLE_WORDS), lambda i: F.xxhash64(*parts(i)))
        return (F.when(n == 0, none)
                .when(n < SHINGLE_WORDS, F.array(F.xxhash64(F.concat_ws(" ", w), n)))
                .otherwise(F.array_distinct(many)))

    return let(words_of(lower), hashed)


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    n = ROWS * BANDS
    return rng.integers(0, 2**31, n, "u4") * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, n, "u4")


def _mix(x: np.ndarray) -> np.ndarray:
    # 64-bit shingle hashes to well mixed 32-bit keys of the universal family
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(32)).astype("u4")


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The universal hash minima of one set, in blocks that stay in cache."""
    x = _mix(shingles.view("u8"))
    best = np.full(len(a), 0xFFFFFFFF, "u4")
    for s in range(0, len(x), 256):
        h = np.multiply.outer(a, x[s:s + 256])
        h += b[:, None]
        np.minimum(best, h.min(axis=1), out=best)
    return best


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    rows = sig.reshape(BANDS, ROWS).astype("u8")
    key = np.arange(1, BANDS + 1, dtype="u8") * np.uint64(0xD6E8FEB86659FD93)
    for r in range(ROWS):
        key = (key ^ rows[:, r]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view("i8")


def sketch_bits(sig: np.ndarray) -> np.ndarray:
    """One mixed bit of each minimum, packed into 64-bit words."""
    bits = ((sig * np.uint32(0x85EBCA6B)) >> np.uint32(31)).astype("u1")
    packed = np.packbits(np.concatenate([bits, np.zeros(SKETCH * 64 - len(bits), "u1")]))
    return packed.view("i8")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib
    a, b = _coefficients()
    for batch in batches:
        sets = batch.column("shingles")
        values, offsets = sets.values.to_numpy(zero_copy_only=False), sets.offsets.to_numpy()
        keys, bands, sketches, counts = [], [], [], []
        for i in range(len(sets)):
            own = values[offsets[i]:offsets[i + 1]]
            counts.append(len(own))
            if not len(own):
                keys.append(None), bands.append(None), sketches.append(None)
                continue
            keys.append(hashlib.blake2b(np.sort(own).tobytes(), digest_size=16).digest())
            sig = minima(own, a, b)
            bands.append(band_keys(sig)), sketches.append(sketch_bits(sig))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "set_key", "bands", "sketch"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(v, root): the smallest vertex of each connected component, by
    alternating large-star and small-star over (u, v) edges."""
    def pairs(*uv: tuple[str, str]) -> Column:
        # several edges of one row, so that its plan stands once
        return F.inline(F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in uv]))

    def with_min(e: DataFrame) -> DataFrame:
        low = e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return e.join(low, "u")

    def large(e: DataFrame) -> DataFrame:
        star = with_min(e.select(pairs(("u", "v"), ("v", "u")))).where("v > u")
        return star.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()

    def small(e: DataFrame) -> DataFrame:
        # edges point from larger u to smaller v
        return with_min(e).select(pairs(("v", "m"), ("u", "m"))).where("u <> v").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum((F.xxhash64("u", "v") % 1000003).cast("bigint"))).first())

    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = state(edges)
    while before[0]:
        edges = cut(small(large(edges)))
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))


def _compatible() -> Column:
    """Sizes and signature bits allow the threshold."""
    bits = sum((F.bit_count(F.col("a_sketch")[i].bitwiseXOR(F.col("b_sketch")[i])) for i in range(1, SKETCH)),
               F.bit_count(F.col("a_sketch")[0].bitwiseXOR(F.col("b_sketch")[0])))
    return ((100 * F.least("a_n", "b_n") >= PERCENT * F.greatest("a_n", "b_n")) & (bits <= MAX_BITS))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (u, v) pairs whose full sets reach the threshold."""
    a = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    confirmed = (cut(pairs).join(a, "u").join(b, "v")
                 .where(100 * both >= PERCENT * (F.size("a") + F.size("b") - both)))
    return cut(confirmed.select("u", "v").distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    texts = with_defaults(docs, doc_id="bigint", text="string").select("doc_id", text_of().alias("text"))
    features = written(texts.select("doc_id", shingles_of(F.col("text")).alias("shingles"))
                       .mapInArrow(_features, FEATURES), "near-features")

    # classes of equal sets, represented by their smallest document
    known = features.where("doc_id is not null and set_key is not null")
    classes = known.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    member = written(known.select("set_key", "doc_id").join(classes, "set_key").select("doc_id", "rep"), "near-members")
    reps = known.join(classes, (known.set_key == classes.set_key) & (known.doc_id == classes.rep), "left_semi")
    reps = written(reps.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "bands", "sketch"), "near-reps")

    # keys with two members or more, and the full sets of their members
    keyed = reps.select("rep", F.explode("bands").alias("key"))
    low = (keyed.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
           .where("low < high").select("key", "low"))
    slots = written(keyed.join(low, "key"), "near-slots")
    ids = written(slots.select(F.col("rep").alias("doc_id")).distinct(), "near-ids")
    sets = written(texts.join(ids.hint("shuffle_hash"), "doc_id", "left_semi").select("doc_id", shingles_of(F.col("text")).alias("shingles")), "near-sets")

    # a document with several texts is one vertex
    links = (member.groupBy("doc_id").agg(F.min("rep").alias("v"), F.max("rep").alias("u"))
             .where("v < u").select("u", "v"))
    star = slots.where("rep <> low")
    # one pair per member first: most of a large group is linked by it
    first = star.groupBy("rep").agg(F.min("low").alias("low"))
    links = links.union(_confirmed(_signed(first, reps), sets))
    rooted = _rooted(star, connected_components(links))
    rest = rooted.where("root <> low_root").select("rep", "low").distinct()
    links = links.union(_confirmed(_signed(rest, reps), sets))
    links = links.union(_confirmed(_across(slots, connected_components(links), reps, sets), sets))

    same = member.where("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    final = connected_components(links.union(same))
    out = (features.select("doc_id", "n_shingles")
           .join(final.select(F.col("v").alias("doc_id"), "root"), "doc_id", "left"))
    component = F.coalesce("root", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _rooted(slots: DataFrame, components: DataFrame) -> DataFrame:
    """Adds the components of each slot's member and of its key's smallest."""
    of = lambda c, to: components.select(F.col("v").alias(f"{c}_v"), F.col("root").alias(to))
    return (slots.join(of("rep", "r"), F.col("rep") == F.col("rep_v"), "left")
            .join(of("low", "l"), F.col("low") == F.col("low_v"), "left")
            .select(*slots.columns, F.coalesce("r", "rep").alias("root"), F.coalesce("l", "low").alias("low_root")))


def _rare_shingles(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Per text of a member: rep, n, n_rare, and ``prefix``, the rare ones of
    the first ``n - ceil(0.85 n) + 1`` shingles in order of rarity that others
    hold too.  A shingle sends at most ``RARE + 1`` rows per task."""
    held = (sets.join(members.select(F.col("rep").alias("doc_id")).distinct().hint("shuffle_hash"), "doc_id")
            .select(F.col("doc_id").alias("rep"), F.size("shingles").alias("n"), F.xxhash64("shingles").alias("text"), "shingles"))
    first = F.row_number().over(Window.partitionBy("shingle").orderBy("rep"))
    rare = (held.withColumn("shingle", F.explode("shingles")).drop("shingles")
            .withColumn("nth", first).where(F.col("nth") <= RARE + 1)
            .withColumn("holders", F.count("*").over(Window.partitionBy("shingle"))).where(F.col("holders") <= RARE))
    least = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    # a set: repeated rows of a text hold each shingle once
    rare = (rare.groupBy("rep", "n", "text").agg(F.array_sort(F.collect_set(F.struct("holders", "shingle"))).alias("own"))
            .select("rep", "text", F.size("own").alias("n_rare"), F.transform(F.filter(
                F.slice("own", F.lit(1), least.cast("int")), lambda x: x["holders"] > 1), lambda x: x["shingle"]).alias("prefix")))
    return (held.select("rep", "n", "text").distinct().join(rare, ["rep", "text"], "left")
            .select("rep", "n", F.coalesce("n_rare", F.lit(0)).alias("n_rare"), "prefix"))


def _across(slots: DataFrame, components: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """Compatible pairs of different components that share a key and may
    reach the threshold: by a rare shingle, or by frequent ones alone."""
    marked = _rooted(slots, components).select("key", "rep", "root", "low_root")
    mixed = marked.where("root <> low_root").select("key").distinct()
    marked = written(marked.join(mixed, "key"), "near-mixed")
    members = marked.select("rep", "root").distinct()
    rare = _rare_shingles(members, sets)
    members = written(members.join(reps.select("rep", "sketch"), "rep").join(rare, "rep"), "near-across")
    apart = (F.col("a_root") != F.col("b_root")) & _compatible()

    def sided(df: DataFrame, to: str, *keep: str) -> DataFrame:
        return df.select(*keep, *[F.col(c).alias(f"{to}_{c}") for c in df.columns if c not in keep])

    by_shingle = members.select("rep", "root", "n", "sketch", F.explode("prefix").alias("shingle"))
    met = (sided(by_shingle, "a", "shingle").join(sided(by_shingle, "b", "shingle"), "shingle")
           .where((F.col("a_rep") > F.col("b_rep")) & apart))

    frequent = members.withColumn("frequent", F.col("n") - F.col("n_rare")).drop("n_rare", "prefix")
    frequent = frequent.where(100 * F.col("frequent") >= PERCENT * F.col("n"))
    by_key = marked.select("key", "rep", "low_root").join(frequent, "rep")
    once = (F.col("b_root") == F.col("b_low_root")) | (F.col("a_rep") > F.col("b_rep"))
    most = F.least("a_frequent", "b_frequent")
    alike = (sided(by_key.where("root <> low_root"), "a", "key").join(sided(by_key, "b", "key"), "key")
             .where(once & (100 * most >= PERCENT * (F.col("a_n") + F.col("b_n") - most)) & apart))

    pair = [F.greatest("a_rep", "b_rep").alias("u"), F.least("a_rep", "b_rep").alias("v")]
    return met.select(*pair).union(alike.select(*pair)).distinct()


def _signed(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """(u, v) of the (rep, low) pairs whose signatures allow the threshold."""
    a = reps.select("rep", F.col("n").alias("a_n"), F.col("sketch").alias("a_sketch"))
    b = reps.select(F.col("rep").alias("low"), F.col("n").alias("b_n"), F.col("sketch").alias("b_sketch"))
    return (pairs.join(a, "rep").join(b, "low").where(_compatible())
            .select(F.col("rep").alias("u"), F.col("low").alias("v")))


def keep_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component (rows of equal ``doc_id``
    stay together)."""
    gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    gone = written(gone, "near-gone")
    return docs.join(gone, docs.doc_id == gone.gone_id, "left_anti")
