"""Quality rules: base counts, and robust multivariate outliers per language
and source.

Each document gives a vector of six transformed statistics (see
``VECTOR``).  Per group a minimum-covariance-determinant estimate of centre
and scatter is found by concentration steps: take the ``SUBSET`` share of
the group's vectors that lie nearest under the present estimate, re-estimate
from them, repeat; each step lowers the determinant.  The search starts from
quartiles over the corpus and goes down the levels corpus, language,
(language, source), each starting from the level above, and ends with the
usual reweighting over all vectors within the 0.975 quantile.  Two
regularisations keep any group size and any constant statistic well defined:
a floor on every variance, and ``PRIOR_ROWS`` rows' worth of the level
above.  A document is rejected when its squared Mahalanobis distance exceeds
the ``1 - REJECT`` quantile of chi-square with six degrees of freedom.

Only DataFrame functions are used.  A step reads the narrow table of vectors
twice: a histogram of log distances per group gives the subset's radius
(1/32 in the logarithm), then partial sums give the moments; what is joined
back is one row per group.

Defined cases: a null text has no words; fewer than ``MIN_WORDS`` words fail
the base rule and take no part in the estimates; null language or source are
groups of their own; repeated rows are judged alike; extra columns pass
through ``keep_documents`` untouched; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, let, text_of, words_of, written

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS = 50
REPEAT_PERCENT = 50

#: share of a group's vectors that an estimate rests on: half, so that it holds
#: up to nearly half a group of junk
SUBSET = 0.5
STEPS = 3
PRIOR_ROWS = 50.0
REJECT = 1e-6
#: standard deviation below which no statistic counts as narrow: log mean
#: word length, then square roots of the symbol, repeated-line,
#: repeated-word, capital and digit shares
FLOORS = (0.08, 0.06, 0.12, 0.12, 0.06, 0.06)
P = len(FLOORS)
BUCKETS = 32

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VECTOR = [f"x{i}" for i in range(P)]
LEVELS = ([], ["k_lang"], ["k_lang", "k_source"])


def repeat_words(w: Column) -> Column:
    """Words in three-word windows that occur twice or more among ``w``."""
    def of_sorted(s: Column) -> Column:
        same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
        starts = F.filter(F.transform(s, lambda x, k: F.when(
            same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1)), x["i"]).otherwise(-1)), lambda i: i >= 0)
        # a window covers the words up to the next repeated window's start
        return let(F.sort_array(starts), lambda q: F.aggregate(
            F.transform(q, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(q, k + 1) - i, F.lit(3)))),
            F.lit(0).cast("bigint"), lambda a, c: a + c))

    def of_hashes(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return (F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint"))
                .otherwise(let(F.sort_array(pairs), of_sorted)))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                          lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 3, F.lit(0).cast("bigint")).otherwise(let(windows, of_hashes))


def _without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, "")).cast("bigint")


def _keyed(docs: DataFrame) -> DataFrame:
    """``row`` (the given row), its text and group keys."""
    have = set(docs.columns)
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) if c in have else F.lit("null")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_of().alias("text"),
                       key("lang").alias("k_lang"), key("source").alias("k_source"))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and key of every row, base counts, verdict of the base rules,
    group keys and the statistic vector."""
    base = _keyed(docs).withColumn("key", _key()).withColumn("doc_id", F.col("row.doc_id"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    counts = let(words_of(F.col("text")), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"), repeat_words(w).alias("n_repeat_words")))
    line_counts = let(lines, lambda x: F.struct(
        F.size(x).cast("bigint").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("dup")))
    n = F.char_length("text").cast("bigint")
    wide = base.select(
        "doc_id", "key", "k_lang", "k_source", counts.alias("c"), line_counts.alias("l"),
        _without(F.col("text"), WHITE).alias("word_chars"), (n - _without(F.col("text"), SYMBOLS)).alias("n_symbols"),
        (n - _without(F.col("text"), UPPER)).alias("n_upper"), (n - _without(F.col("text"), "0123456789")).alias("n_digits"))
    flat = wide.select("doc_id", "key", "k_lang", "k_source", F.col("c.n_words").alias("n_words"), "word_chars", "n_symbols",
                       F.col("l.dup").alias("n_dup_lines"), F.col("c.n_repeat_words").alias("n_repeat_words"),
                       F.col("l.n").alias("n_lines"), "n_upper", "n_digits")
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    vector = (F.log((F.col("word_chars") + 1) / (F.col("n_words") + 1)), share("n_symbols", "word_chars"),
              share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"),
              share("n_upper", "word_chars"), share("n_digits", "word_chars"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return flat.select("doc_id", "key", "k_lang", "k_source", *BASE, failed.alias("base_failed"),
                       *[v.alias(x) for v, x in zip(vector, VECTOR)])


def _chi2_cdf(x: float, p: int) -> float:
    """Chi-square distribution function for an even number of degrees."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(p // 2))


def _chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_cdf(mid, p) < q else (low, mid)
    return low


def _consistency(share: float) -> float:
    """Factor that makes the scatter of the nearest ``share`` unbiased."""
    return share / _chi2_cdf(_chi2_quantile(share, P), P + 2)


def _c(i: int, j: int) -> str:
    return f"c{max(i, j)}{min(i, j)}"


PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
ESTIMATE = [f"m{i}" for i in range(P)] + [_c(i, j) for i, j in PAIRS]
FACTOR = [f"m{i}" for i in range(P)] + [f"w{i}{j}" for i, j in PAIRS]


def _factored(estimates: DataFrame) -> DataFrame:
    """Adds the inverse w of the scatter's Cholesky factor l, column by column
    (one row per group)."""
    for j in range(P):
        rest = lambda i: sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))  # noqa: B023,E731
        estimates = estimates.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(_c(j, j)) - rest(j), F.lit(1e-12))))
        estimates = estimates.withColumns({f"l{i}{j}": (F.col(_c(i, j)) - rest(i)) / F.col(f"l{j}{j}")
                                           for i in range(j + 1, P)})
    for i in range(P):
        estimates = estimates.withColumns({f"w{i}{j}": 1 / F.col(f"l{i}{i}") if i == j else -sum(
            (F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j + 1, i)), F.col(f"l{i}{j}") * F.col(f"w{j}{j}")
        ) / F.col(f"l{i}{i}") for j in range(i + 1)})
    return estimates


def _distance2() -> Column:
    """Squared Mahalanobis distance, by the inverse factor."""
    y = [F.col(VECTOR[i]) - F.col(f"m{i}") for i in range(P)]
    z = [sum((F.col(f"w{i}{j}") * y[j] for j in range(1, i + 1)), F.col(f"w{i}0") * y[0]) for i in range(P)]
    return sum((F.pow(v, F.lit(2)) for v in z[1:]), F.pow(z[0], F.lit(2)))


def _with_distance(vectors: DataFrame, estimates: DataFrame, keys: list[str]) -> DataFrame:
    on = ["k_all", *keys]
    return vectors.join(estimates.select(*on, *FACTOR), on, "left").withColumn("d2", _distance2())


def _moments(near: DataFrame, keys: list[str], factor: float, parent: DataFrame | None, parent_keys: list[str]) -> DataFrame:
    """Group estimates from the chosen vectors, drawn to the level above."""
    on = ["k_all", *keys]
    sums = near.groupBy(*on).agg(
        F.count("*").cast("double").alias("n"), *[F.avg(x).alias(f"a{i}") for i, x in enumerate(VECTOR)],
        *[F.avg(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"q{i}{j}") for i, j in PAIRS])
    cov = {_c(i, j): factor * (F.col(f"q{i}{j}") - F.col(f"a{i}") * F.col(f"a{j}")) for i, j in PAIRS}
    floor = {_c(i, i): FLOORS[i] ** 2 for i in range(P)}
    if parent is None:
        out = sums.select(*on, *[F.col(f"a{i}").alias(f"m{i}") for i in range(P)],
                          *[(v + floor.get(c, 0.0)).alias(c) for c, v in cov.items()])
    else:
        up = parent.select("k_all", *parent_keys, *[F.col(c).alias(f"up_{c}") for c in ESTIMATE])
        w = F.col("n") / (F.col("n") + PRIOR_ROWS)
        own = {f"m{i}": F.col(f"a{i}") for i in range(P)} | {c: v + floor.get(c, 0.0) for c, v in cov.items()}
        out = (sums.join(up, ["k_all", *parent_keys])
               .select(*on, *[(w * own[c] + (1 - w) * F.col(f"up_{c}")).alias(c) for c in ESTIMATE]))
    return written(_factored(out), "quality-estimates")


def _subset(vectors: DataFrame, estimates: DataFrame, at: list[str], keys: list[str]) -> DataFrame:
    """The ``SUBSET`` share of each group's vectors nearest to its estimate
    (``at``: the keys of the estimates)."""
    on = ["k_all", *keys]
    far = (_with_distance(vectors, estimates, at)
           .withColumn("bucket", F.floor(F.log(F.greatest("d2", F.lit(1e-9))) * BUCKETS)))
    counts = far.groupBy(*on, "bucket").count()
    group = Window.partitionBy(*on)
    cum = F.sum("count").over(group.orderBy("bucket"))
    radius = (counts.select(*on, "bucket", cum.alias("cum"), F.sum("count").over(group).alias("all"))
              .where(F.col("cum") >= SUBSET * F.col("all")).groupBy(*on).agg(F.min("bucket").alias("radius")))
    return far.join(written(radius, "quality-radius"), on).where("bucket <= radius")


def estimates_of(vectors: DataFrame) -> DataFrame:
    """Centre and scatter of every (language, source) group."""
    quart = vectors.groupBy("k_all").agg(
        *[F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(f"p{i}") for i, x in enumerate(VECTOR)])
    zero = F.lit(0.0)
    start = quart.select("k_all", *[F.col(f"p{i}")[1].alias(f"m{i}") for i in range(P)], *[
        (F.pow((F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / 1.349, 2) + FLOORS[i] ** 2 if i == j else zero).alias(_c(i, j))
        for i, j in PAIRS])
    now, at = written(_factored(start), "quality-estimates"), []
    parent, parent_keys = None, []
    for keys in LEVELS:
        for _ in range(STEPS if not keys else STEPS - 1):
            now = _moments(_subset(vectors, now, at, keys), keys, _consistency(SUBSET), parent, parent_keys)
            at = keys
        near = _with_distance(vectors, now, keys).where(F.col("d2") <= _chi2_quantile(0.975, P))
        now = _moments(near, keys, _consistency(0.975), parent, parent_keys)
        parent, parent_keys = now, keys
    return now


def _key() -> Column:
    """A row's identity for the verdict: all that it depends on."""
    return F.xxhash64(F.col("row.doc_id"), "text", "k_lang", "k_source")


def judged(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, the base counts, base_failed and kept;
    also ``key`` (:func:`_key`) and the squared distance ``d2``."""
    rows = written(measured(docs).withColumn("k_all", F.lit(1)), "quality-vectors")
    vectors = rows.where("not base_failed").select("k_all", "k_lang", "k_source", *VECTOR)
    far = _with_distance(rows, estimates_of(vectors), LEVELS[-1])
    inside = F.coalesce(F.col("d2") <= _chi2_quantile(1 - REJECT, P), F.lit(True))
    return far.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & inside).alias("kept"), "key", "d2")


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed and kept of every row."""
    return judged(docs).drop("key", "d2")


def keep_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no rule rejects."""
    gone = written(judged(docs).where("not kept").select(F.col("key").alias("gone_key")).distinct(), "quality-gone")
    # rejected rows grow with the corpus: always meet the texts by a shuffle, hashing the narrow side
    rows = _keyed(docs)
    return rows.join(gone.hint("shuffle_hash"), _key() == F.col("gone_key"), "left_anti").select("row.*")
