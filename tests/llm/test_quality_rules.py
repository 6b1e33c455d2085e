import random

import brute
import numpy as np

from eventlens.llm import quality_rules as q


def _prose(g, n):
    return " ".join("".join(g.choice("abcdefgh") for _ in range(g.randint(2, 8))) for _ in range(n))


def test_base_counts_and_planted_outliers(spark):
    g = random.Random(1)
    rows = [(i, _prose(g, g.randint(60, 200)), "en" if i % 3 else "de", "s") for i in range(240)]
    junk = {240: " ".join(w + "***" for w in _prose(g, 90).split()), 241: _prose(g, 90).upper() + " ABC" * 9,
            242: " ".join(str(g.randint(10**6, 10**9)) for _ in range(80)), 243: " ".join("m" * 40 + str(i) for i in range(70))}
    rows += [(i, t, "en", "s") for i, t in junk.items()] + [(244, "short text", "en", "s"), (245, "a b c " * 60, "en", "s"), (246, None, None, None)]
    out = {r.doc_id: r for r in q.verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    for i, t, *_ in rows:
        r, e = out[i], brute.quality_base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == e
        failed = e[0] < 50 or 100 * e[4] > 50 * e[0]
        assert r.base_failed == failed and not (failed and r.kept)
    assert {i for i, r in out.items() if not r.kept} == {*junk, 244, 245, 246}


def test_estimates_match_concentration_steps_in_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal([1.5, 0, 0, .1, .2, 0], .1, (400, 6)), rng.normal(3, .1, (60, 6))])
    rows = [(1, "=en", "=s", *map(float, v)) for v in x]
    vectors = spark.createDataFrame(rows, "k_all int, k_lang string, k_source string, " + ", ".join(f"{c} double" for c in q.VECTOR))
    got = q.estimates_of(vectors).first()

    quart = np.quantile(x, [.25, .5, .75], axis=0, method="inverted_cdf")
    floor = np.diag(np.square(q.FLOORS))
    mean, cov = quart[1], np.diag(((quart[2] - quart[0]) / 1.349) ** 2) + floor
    parent = None
    distance = lambda: np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)

    def moments(near, factor):
        m, c = near.mean(0), factor * np.cov(near.T, bias=True) + floor
        if parent is None:
            return m, c
        w = len(near) / (len(near) + q.PRIOR_ROWS)
        return w * m + (1 - w) * parent[0], w * c + (1 - w) * parent[1]

    for level in range(3):
        for _ in range(q.STEPS if not level else q.STEPS - 1):
            bucket = np.floor(np.log(np.maximum(distance(), 1e-9)) * q.BUCKETS)
            radius = np.sort(bucket)[int(np.ceil(q.SUBSET * len(x))) - 1]
            mean, cov = moments(x[bucket <= radius], q._consistency(q.SUBSET))
        mean, cov = moments(x[distance() <= q._chi2_quantile(.975, 6)], q._consistency(.975))
        parent = (mean, cov)
    assert np.allclose([got[f"m{i}"] for i in range(6)], mean)
    assert np.allclose([[got[q._c(i, j)] for j in range(6)] for i in range(6)], cov)
    assert np.all(np.abs(mean - [1.5, 0, 0, .1, .2, 0]) < .05)  # the 60 far rows did not pull it


def test_messy_and_empty(messy, messy_rows, empty):
    out = q.verdicts(messy).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_words) for r in out) == sorted(
        ((i is None, i or 0), len(brute.words(t))) for i, t, *_ in messy_rows)
    kept = q.keep_documents(messy)
    assert kept.columns == messy.columns and kept.count() == sum(r.kept for r in out)
    assert q.keep_documents(empty).count() == 0


def test_a_third_of_one_source_is_junk(spark):
    g = random.Random(4)
    rows = [(i, _prose(g, g.randint(60, 200)), "en", "a" if i < 600 else "b") for i in range(1800)]
    junk = {i for i in range(600) if i % 3 == 0}
    rows = [(i, "".join(c + "*" * (g.random() < .56) for c in t) if i in junk else t, k, s) for i, t, k, s in rows]
    out = q.verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    kept = {r.doc_id for r in out if r.kept}
    assert not kept & junk
    assert len(kept) >= .99 * (len(rows) - len(junk))
