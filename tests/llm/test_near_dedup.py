import random

import brute

from eventlens.llm import near_dedup as near


def _components(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return near.near_duplicates(df).collect()


def test_groups_chains_and_copies(spark):
    g = random.Random(2)
    word = lambda: "".join(g.choice("abcdef") for _ in range(5))
    rows = []
    for k in range(6):  # chains: each copy changes a little more of the one before
        w = [word() for _ in range(220)]
        for c in range(8):
            rows.append((100 * k + c, " ".join(w)))
            for _ in range(2):
                w[g.randrange(len(w))] = word()
    rows += [(900 + i, rows[3][1]) for i in range(5)] + [(950, "A b c d"), (951, "a b\tc D"), (952, "a b c"), (953, ""), (954, None)]
    shared = " ".join(word() for _ in range(100))
    rows += [(1000 + i, shared + " " + " ".join(word() for _ in range(60))) for i in range(20)]
    got = {r.doc_id: r.component_id for r in _components(spark, rows)}
    assert got == brute.components(rows)


def test_templates_with_many_unlike_copies(spark):
    # copies of one text, most of them under the threshold with each other: links by rare shingles,
    # by frequent ones alone, and chains; none may be lost
    g = random.Random(11)
    word = lambda: "".join(g.choice("abcdefgh") for _ in range(6))
    template, rows = [word() for _ in range(120)], []
    few = [word() for _ in range(6)]
    for c in range(160):
        w = list(template)
        for _ in range(g.choice([1, 2, 3, 4, 5, 6, 9])):
            w[g.randrange(len(w))] = g.choice(few) if c % 2 else word()
        rows.append((c, " ".join(w)))
        if c % 10 == 0:
            w[g.randrange(len(w))] = word()
            rows.append((1000 + c, " ".join(w)))
    rows += rows[::9] + [(c, " ".join(word() for _ in range(90))) for c in (3, 4)]  # repeated rows, ids of two texts
    expected = brute.components(rows)
    assert 20 < len(set(expected.values())) < 150
    assert {r.doc_id: r.component_id for r in _components(spark, rows)} == expected


def test_no_pairs_of_unlike_copies(spark):
    # members that hold over 15 % shingles of their own meet nobody
    g = random.Random(12)
    word = lambda: "".join(g.choice("abcdefgh") for _ in range(6))
    template = [word() for _ in range(150)]

    rows = []
    for c in range(150):
        w = list(template)
        for at in g.sample(range(0, 150, 5), 5):
            w[at] = word()
        rows.append((c, " ".join(w)))
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    sets = near.written(texts.select("doc_id", near.shingles_of(near.F.col("text")).alias("shingles")), "near-sets")
    reps = near.written(sets.mapInArrow(near._features, near.FEATURES), "near-features")
    reps = reps.select(near.F.col("doc_id").alias("rep"), near.F.col("n_shingles").alias("n"), "bands", "sketch")
    slots = reps.select("rep", near.F.explode("bands").alias("key"))
    low = slots.groupBy("key").agg(near.F.min("rep").alias("low"))
    none = spark.createDataFrame([], "v long, root long")
    assert near._across(slots.join(low, "key"), none, reps, sets).count() == 0


def test_star_components(spark):
    g = random.Random(4)
    edges = [(g.randrange(300), g.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.v: r.root for r in near.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got.get(x, x) == find(x) for x in root)


def test_messy_and_empty(messy, messy_rows, empty):
    out = near.near_duplicates(messy).collect()
    assert len(out) == len(messy_rows)
    expected = brute.components([(i, t) for i, t, *_ in messy_rows])
    assert all(r.component_id == expected.get(r.doc_id) and r.kept == (r.doc_id is None or r.component_id == r.doc_id) for r in out)
    kept = near.keep_documents(messy)
    assert kept.columns == messy.columns and kept.count() == sum(r.kept for r in out)
    assert near.near_duplicates(empty).count() == 0


def test_a_round_of_components_reads_its_edges_few_times(spark, monkeypatch):
    leaves, real = [], near.cut

    def seen(df):
        leaves.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return real(df)

    monkeypatch.setattr(near, "cut", seen)
    edges = [(5, 4), (4, 3), (3, 2), (9, 8), (2, 1), (7, 8), (6, 6), (5, 4)]
    got = near.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted((r.v, r.root) for r in got) == [(2, 1), (3, 1), (4, 1), (5, 1), (8, 7), (9, 7)]
    assert len(leaves) > 2 and max(leaves) <= 4, leaves
