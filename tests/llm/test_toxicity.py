import random
import zlib

import numpy as np

from eventlens.llm import toxicity as x


def test_pairs_say_more_than_their_sum():
    # label 1 only where both terms stand: no linear weights can reach it from balanced singles
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for _ in range(1500):
        a, b = rng.random(2) < .5
        rows.append(np.array([k for k, on in ((10, a), (20, b)) if on] + list(rng.integers(100, 160, 3))))
        labels.append(int(a == b))
    rows = [np.unique(r) for r in rows]
    machine = x.fit(rows, np.array(labels))
    assert not {10, 20} & set(machine.index)  # neither term alone is tied to the label
    labels = np.array([int(10 in r and 20 in r) for r in rows])
    machine = x.fit(rows, labels)
    score = lambda *b: machine.score({machine.index[k] for k in b if k in machine.index})
    assert score(10, 20) > .9 and score(10) < .1 and score(20) < .1 and score() < .1
    i, j = machine.index[10], machine.index[20]
    assert machine.v[i] @ machine.v[j] > 0.5


def test_held_out_accuracy(spark):
    g = random.Random(3)
    words = ["".join(g.choice("abcdefg") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(1200):
        w = [g.choice(words) for _ in range(g.randint(5, 60))]
        bad = i % 6 == 0
        if bad:
            w.insert(g.randrange(len(w)), g.choice(["wretch", "wretched", "scoundrel"]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    machine = x.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    out = x.scored(docs, machine).collect()
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    truth = {i: t for i, _, t in labels}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > .97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= .3) for r in out)


def test_held_out_labels_do_not_train(spark):
    rows = [(i, "plain words") for i in range(200)]
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in held)) for i, _ in rows], "doc_id long, toxic int")
    assert all(r.score < 1e-9 for r in x.scored(docs, x.train(docs, labels)).collect())


def test_messy_and_empty(spark, messy, messy_rows, empty):
    labels = spark.createDataFrame([(0, 1, 1), (1, 1, 0), (1, 0, None), (None, 1, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")
    machine = x.train(messy, labels)
    out = x.scored(messy, machine).collect()
    assert len(out) == len(messy_rows) and all(0 <= r.score <= 1 for r in out)
    assert x.scored(empty, machine).count() == 0
    x.train(empty, labels.limit(0))
