import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlens.llm import hard_negatives as h
from eventlens.llm import vector_codes as c
from eventlens.llm import vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, part int, v string, n int, slot int"
EXTRA = (1, "v", 2, 3)


def _unit(x):
    return [float(y) for y in np.asarray(x) / np.linalg.norm(x)]


@pytest.fixture(scope="module")
def rows():
    g = np.random.default_rng(5)
    centres = g.normal(size=(6, 16))
    out = [(k, _unit(centres[k % 6] + g.normal(size=16) * (0.2 if k % 3 else 1.0)), k % 4) for k in range(900)]
    hot = out[300][1]
    out += [(1000 + k, hot, k % 2) for k in range(400)]                      # copies: ties everywhere
    out += [(2000, None, 1), (2001, [None] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, [float("inf")] * 16, 2),
            (2004, [1.0] * 7, 0), (2005, [0.0] * 16, 3), (2100, [0.0] * 16, 0), (2006, [1e30] * 16, 1), (2007, [-1e30] * 16, 2),
            (2200, [3.0] * 16, None), (2300, hot, 0), (2300, hot, 0), (None, hot, 1)]
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(5).cache()


def _kept(rows, scale):
    dims, most = 16, vectors.bound(16)
    f32 = lambda x: np.asarray(x, np.float32).astype(float)
    return [(i, lab, [int(max(-most, min(most, math.floor(y * scale) if math.isfinite(y * scale) else y))) for y in f32(x).tolist()])
            for i, x, lab in rows
            if x is not None and None not in x and len(x) == dims and np.isfinite(f32(x)).all()]


def _mined_brute(rows, share=(4, 5)):
    kept = {}
    for i, lab, v in sorted((r for r in _kept(rows, 256) if r[0] is not None and r[1] is not None), key=lambda r: (r[1], r[2])):
        kept.setdefault(i, ((lab + 1) % 10 if i % 7 == 0 else lab, v))
    out = []
    for a, (lab, q) in kept.items():
        if a % 100:
            continue
        score = {i: sum(x * y for x, y in zip(q, v)) for i, (_, v) in kept.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if kept[i][0] == lab][:5]:
            fit = [i for i in order if kept[i][0] != lab and share[0] * score[p] <= share[1] * score[i] <= share[1] * score[p]]
            out += [(a, p, k, i, score[p], score[i]) for k, i in enumerate(fit[:5], 1)]
    return sorted(out)


RELABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


@pytest.mark.parametrize("bucket_rows, part_rows", [(4096, 1 << 18), (37, 150)])
def test_hard_negatives_against_brute_force(spark, table, rows, monkeypatch, bucket_rows, part_rows):
    monkeypatch.setattr(h, "PART_ROWS", part_rows)
    monkeypatch.setattr(h, "SMALL_PART_ROWS", min(part_rows, h.SMALL_PART_ROWS))
    got = h.mined(table, F.col("vec_id") % 100 == 0, relabel=F.expr(RELABEL), bucket_rows=bucket_rows)
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.select(*cols).collect())) == _mined_brute(rows)


def test_ranges_hold_every_row_that_reaches_the_threshold_and_prune():
    g = np.random.default_rng(9)
    centres = g.normal(size=(40, 24)) * 100
    centres *= 500 / np.linalg.norm(centres, axis=1)[:, None]
    v = (centres[g.integers(0, 40, 3000)] + g.normal(size=(3000, 24)) * 6).astype(np.int64)
    v[:5] = 0
    anchors, ids = h.Anchors(v[:60]), np.arange(len(v))
    scores = v[:60] @ v.T
    for share in (-0.5, 0.0, 0.7, 0.95):
        threshold = (share * scores.max(axis=1)).astype(float)
        threshold[:5] = 0.5                     # zero vectors score 0: no row reaches it
        seen, checked = set(), 0
        for bucket in h.length_buckets(v, ids, ids, 256):
            who, row, score, n = h.candidates(bucket, anchors, threshold, np.float64)
            seen |= set(zip(who.tolist(), bucket.ids[row].tolist()))
            assert (score == scores[who, bucket.ids[row]]).all()
            checked += n
        assert seen == set(zip(*(x.tolist() for x in np.nonzero(scores >= threshold[:, None]))))
        verified = checked / (55 * len(v))
    assert verified < 0.3                       # at 0.95 of the best score the lists leave little to verify


def _codes_brute(rows, parts=4, entries=256, rounds=4):
    kept = sorted(_kept(rows, 1024), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    size = 16 // parts
    cut = [[tuple(v[p * size:(p + 1) * size]) for p in range(parts)] for _, _, v in kept]
    books = [[x[p] for x in cut[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for x in cut:
                members.setdefault(near(p, x[p])[1], []).append(x[p])
            for k, m in members.items():
                books[p][k] = tuple(sum(col) // len(m) for col in zip(*m))
    sha = hashlib.sha256(",".join(str(y) for b in books for e in b for y in e).encode()).hexdigest()
    out = []
    for (i, lab, _), x in zip(kept, cut):
        best = [near(p, x[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    total = {}
    for _, lab, _, e in out:
        total[lab] = total.get(lab, 0) + e
    return sorted(((i, code, e, total[lab], sha) for i, lab, code, e in out), key=repr)


@pytest.mark.parametrize("entries, block_rows", [(256, 8192), (24, 60)])
def test_codes_against_brute_force(table, rows, entries, block_rows):
    got = c.digests(table, entries=entries, block_rows=block_rows)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == _codes_brute(rows, entries=entries)


def test_blocks_keep_rows_and_dictionaries(spark, table):
    v, dims = vectors.integer_vectors(table, 1024)
    packs = v.mapInArrow(c.pack(dims, 100), c.PACKED).collect()
    back = []
    for r in packs:
        b = c.Block(r.asDict())
        m = np.stack([b.values[d][b.codes[d]] for d in range(dims)], axis=1)
        assert all(len(x) == len(set(x.tolist())) for x in b.values)
        back += [(i, lab, x) for i, lab, x in zip(b.ids, b.labels, m.tolist())]
    assert sorted(back, key=repr) == sorted(((r.vec_id, r.label, list(r.v)) for r in v.collect()), key=repr)


def test_few_or_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert h.mined(empty, F.col("vec_id") % 100 == 0).count() == 0
    assert c.digests(empty).count() == 0
    few = spark.createDataFrame([(0, [0.5, 0.5, -0.5, 0.25], 1, *EXTRA), (1, [0.5, 0.5, -0.5, 0.2], None, *EXTRA)], SCHEMA)
    assert h.mined(few, F.col("vec_id") % 100 == 0).count() == 0
    assert [(r.code, r.error) for r in c.digests(few).orderBy("vec_id").collect()] == [("00000000", 0), ("00000001", 0)]
