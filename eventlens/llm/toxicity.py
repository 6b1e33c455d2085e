"""Toxicity scores by a factorization machine over hashed terms.

Terms of a text are its lower-cased words (``\\w+``), the first ``PREFIXES``
characters of longer ones (inflected forms share them), and these once more
where a word stands twice or oftener, hashed into ``2^HASH_BITS`` buckets; a
text has a bucket or not.  From a bounded sample of labelled rows (about
``train_docs``, chosen by hash) the buckets that are tied to the label are
chosen by their log-likelihood ratio, and a factorization machine is fitted
to them:

    logit = b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

with logistic loss, L2 penalty and full-batch Adam, from a fixed seed.  The
pairwise terms let two buckets together say more, or less, than their sum.

Only rows with ``crc32(doc_id as text) mod 4 <> 2`` train; the others are
held out.  Scoring streams every whole text past the fitted model, without a
shuffle; the model is a few thousand numbers.

Defined cases: a null text is empty and gets the score of no terms; labels
that are null are not used, of several for one document the largest counts;
repeated rows are scored alike; extra columns are ignored; without any label
all scores are 0, with one class they are its share.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, text_of, with_defaults, written

HASH_BITS = 20
PREFIXES = (4, 5)
FACTORS = 8
MIN_DOCS = 3
#: how many buckets without a tie may be chosen by chance, about: a bucket
#: needs a log-likelihood ratio (chi-square scale) of 2 ln(buckets / CHANCE)
CHANCE = 20
STEPS, RATE, L2 = 300, 0.05, 2e-4
THRESHOLD = 0.3
SCORES = "doc_id bigint, score double"


def held_out(doc_id):
    """crc32 of the id as text leaves 2 on division by four."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Terms:
    """Buckets of a text; words are hashed once and remembered."""

    def __init__(self, wanted: dict[int, int] | None = None, limit: int = 300_000):
        self.word, self.memo, self.wanted, self.limit = re.compile(r"\w+"), {}, wanted, limit

    def _of_word(self, w: str) -> tuple[int, ...]:
        word, mark = w.rstrip("+"), w[len(w.rstrip("+")):]
        terms = (w, *(f"{word[:k]}*{mark}" for k in PREFIXES if len(word) > k))
        buckets = (zlib.crc32(t.encode()) >> (32 - HASH_BITS) for t in terms)
        if self.wanted is None:
            return tuple(buckets)
        return tuple(self.wanted[b] for b in buckets if b in self.wanted)

    def __call__(self, text: str) -> set[int]:
        memo, out = self.memo, set()
        if len(memo) > self.limit:
            memo.clear()
        for w, n in Counter(self.word.findall(text.lower())).items():
            for term in (w,) if n == 1 else (w, w + "+"):  # a plus is no word character
                got = memo.get(term)
                if got is None:
                    got = memo[term] = self._of_word(term)
                if got:
                    out.update(got)
        return out


@dataclass
class Machine:
    """A fitted model: chosen buckets, intercept, weights and factors."""

    index: dict[int, int]
    b: float
    w: np.ndarray
    v: np.ndarray

    def score(self, chosen: set[int]) -> float:
        """Probability of label 1 for a text with these buckets' indexes."""
        logit = self.b
        if chosen:
            i = np.fromiter(sorted(chosen), "i8", len(chosen))
            v = self.v[i]
            logit += self.w[i].sum() + 0.5 * ((v.sum(axis=0) ** 2).sum() - (v * v).sum())
        return 1 / (1 + math.exp(-min(max(logit, -50.0), 50.0)))


def _tie(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """Log-likelihood ratio of each bucket's presence with the label."""
    n = n_pos + n_neg
    have = pos + neg
    total = np.zeros(len(pos))
    for seen, row, col in ((pos, have, n_pos), (neg, have, n_neg), (n_pos - pos, n - have, n_pos), (n_neg - neg, n - have, n_neg)):
        with np.errstate(divide="ignore", invalid="ignore"):
            total += np.where(seen > 0, seen * np.log(seen * n / (row * col)), 0.0)
    return 2 * total


def fit(rows: list[np.ndarray], labels: np.ndarray, factors: int = FACTORS, seed: int = 11) -> Machine:
    """Fit a machine to rows of buckets and 0/1 labels."""
    y = np.asarray(labels, "f8")
    share = float(y.mean()) if len(y) else 0.0
    base = -50.0 if share == 0 else 50.0 if share == 1 else math.log(share / (1 - share))
    if not 0 < share < 1:
        return Machine({}, base, np.zeros(0), np.zeros((0, factors)))
    count = lambda keep: np.bincount(np.concatenate([r for r, k in zip(rows, keep) if k] or [np.zeros(0, "i4")]), minlength=1 << HASH_BITS)
    pos, neg = count(y == 1), count(y == 0)
    seen = pos + neg >= MIN_DOCS
    least = max(8.0, 2 * math.log(max(int(seen.sum()), 1) / CHANCE))
    chosen = np.flatnonzero(seen & (_tie(pos, neg, int(y.sum()), int((1 - y).sum())) >= least))
    index = {int(c): i for i, c in enumerate(chosen)}
    m, n = len(chosen), len(y)
    place = np.full(1 << HASH_BITS, -1)
    place[chosen] = np.arange(m)
    cols = [place[r][place[r] >= 0] for r in rows]
    row = np.repeat(np.arange(n), [len(c) for c in cols])
    col = np.concatenate(cols).astype("i8") if n else np.zeros(0, "i8")
    rng = np.random.default_rng(seed)
    theta = [np.array([base]), np.zeros(m), rng.normal(0, 0.05, (m, factors))]
    moments = [(np.zeros_like(t), np.zeros_like(t)) for t in theta]
    summed = lambda at, x, size: np.stack([np.bincount(at, x[:, f], size) for f in range(x.shape[1])], 1)
    for step in range(1, STEPS + 1):
        b, w, v = theta
        s = summed(row, v[col], n)
        logit = b[0] + np.bincount(row, w[col], n) + 0.5 * ((s ** 2).sum(1) - np.bincount(row, (v[col] ** 2).sum(1), n))
        g = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - y) / n
        grads = [np.array([g.sum()]), np.bincount(col, g[row], m) + L2 * w,
                 summed(col, g[row][:, None] * (s[row] - v[col]), m) + L2 * v]
        for t, d, (m1, m2) in zip(theta, grads, moments):
            m1 += 0.1 * (d - m1)
            m2 += 0.001 * (d * d - m2)
            t -= RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
    return Machine(index, float(theta[0][0]), theta[1], theta[2])


def train(docs: DataFrame, labels: DataFrame, train_docs: int = 12_000) -> Machine:
    """Fit on about ``train_docs`` of the labelled rows that are not held out."""
    given = (with_defaults(labels, doc_id="bigint", toxic="int").where("doc_id is not null and toxic is not null")
             .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    given = written(given, "toxic-labels")
    sample = bounded_sample(given, train_docs, given.count(), "doc_id")
    texts = (with_defaults(docs, doc_id="bigint", text="string").select("doc_id", text_of().alias("text"))
             .join(written(sample, "toxic-sample"), "doc_id")
             .dropDuplicates(["doc_id"]))

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for b in batches:
            rows = [sorted(terms(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(rows, pa.list_(pa.int32()))],
                                             ["doc_id", "toxic", "buckets"])

    table = (texts.select("doc_id", "toxic", "text").mapInArrow(buckets, "doc_id bigint, toxic int, buckets array<int>")
             .toArrow().sort_by("doc_id").combine_chunks())
    rows = [np.array(r.values.to_numpy() if r.is_valid else [], "i4") for r in table.column("buckets")]
    return fit(rows, table.column("toxic").to_numpy())


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(machine.index)
        for b in batches:
            out = [machine.score(terms(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.float64())], ["doc_id", "score"])

    texts = with_defaults(docs, doc_id="bigint", text="string").select("doc_id", text_of().alias("text"))
    return (texts.mapInArrow(scores, SCORES)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
