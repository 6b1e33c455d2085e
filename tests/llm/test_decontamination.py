import random

import brute

from eventlens.llm import decontamination as deco


def test_against_sliding_windows(spark):
    g = random.Random(5)
    word = lambda: "".join(g.choice("abcdef") for _ in range(4))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((40, 60, 25, 80, 4, 2, 90))] + [(7, None), (8, " "), (3, None)]
    docs = []
    for d in range(80):
        w = [word() for _ in range(g.randint(0, 150))]
        if d % 2:
            t = items[g.randrange(7)][1].split()
            for _ in range(d % 4):
                t[g.randrange(len(t))] = word()
            at = g.randint(0, len(w))
            w[at:at] = [x.upper() for x in t]
        docs.append((d, "\n".join(w)))
    docs += [(80, items[3][1]), (81, items[3][1] + " " + items[6][1]), (82, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in deco.contaminated(df, bench).collect()}
    expected = {(d, i): s for d, t in docs for i, s in brute.item_matches(t, items).items()}
    assert got.keys() == expected.keys() and all(abs(got[k] - expected[k]) < 1e-6 for k in got)
    kept = {r.doc_id for r in deco.keep_documents(df, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in expected}


def test_blocks_find_all_within_radius(spark):
    from pyspark.sql import functions as F
    g = random.Random(6)
    rows = []
    for _ in range(300):
        x, k = g.getrandbits(64), g.randint(0, 16)
        y = x
        for b in g.sample(range(64), k):
            y ^= 1 << b
        rows.append((x - (1 << 63), (y - (1 << 63)), k))
    df = spark.createDataFrame(rows, "a long, b long, k int")
    first = deco._first_equal(F.col("a").bitwiseXOR(F.col("b")))
    assert df.where((F.col("k") <= deco.RADIUS) & first.isNull()).count() == 0


def test_messy_and_empty(spark, messy, messy_rows, empty):
    bench = spark.createDataFrame([(1, messy_rows[0][1], 9), (1, messy_rows[0][1], 9), (None, messy_rows[1][1], 9)], "item_id long, text string, n int")
    got = {(r.doc_id, r.item_id) for r in deco.contaminated(messy, bench).collect()}
    assert got == {(0, 1), (4, 1), (16, 1), (None, 1), (1, None), (5, None), (3, None)}
    kept = deco.keep_documents(messy, bench)
    assert kept.columns == messy.columns and kept.count() == len(messy_rows) - 9
    assert deco.contaminated(empty, bench).count() == 0
    assert deco.keep_documents(messy, bench.limit(0)).count() == len(messy_rows)


def test_passages_cut_at_an_edge(spark):
    from pyspark.sql import functions as F
    g = random.Random(8)
    word = lambda: "".join(g.choice("abcdef") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(59 if k % 2 else 39))) for k in range(80)]
    docs, cut = [], []
    for k, t in items:
        w = t.split()
        lost = 6 if len(w) == 59 else 3
        front = [word() for _ in range(lost)]
        w = front + w[lost:] if k % 4 < 2 else w[:-lost] + front
        docs.append((k, " ".join([word() for _ in range(30)] + w + [word() for _ in range(30)])))
        cut.append((t.split(), w))
    differ = deco._simhash(F.col("a")).bitwiseXOR(deco._simhash(F.col("b")))
    far = spark.createDataFrame(cut, "a array<string>, b array<string>").where(F.bit_count(differ) > deco.RADIUS).count()
    assert far > 0
    print("beyond the radius:", far)
    got = deco.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                            spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = {(d, i): s for d, t in docs for i, s in brute.item_matches(t, items).items()}
    assert len(expected) == len(items)
    assert {(r.doc_id, r.item_id) for r in got} == expected.keys()
    assert all(abs(r.similarity - expected[r.doc_id, r.item_id]) < 1e-6 for r in got)


def test_passages_with_words_added_in_the_middle(spark):
    """Items share their first and last words, so a window that loses some of
    both is better than the ones aligned to an anchor, which are not enough."""
    import math
    g = random.Random(9)
    word = lambda: "".join(g.choice("abcdef") for _ in range(6))
    first, last = [word() for _ in range(6)], [word() for _ in range(6)]
    items = [first + [word() for _ in range(58)] + last for _ in range(12)]
    docs = [[word() for _ in range(9)] + t[:35] + [word() for _ in range(4)] + t[35:] + [word() for _ in range(9)] for t in items]
    cut = lambda w: {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    df = {}
    for t in items:
        for x in cut(t):
            df[x] = df.get(x, 0) + 1
    weight = lambda xs: sum(math.log(1 + 12 / df.get(x, 1)) for x in xs)
    expected = {}
    for d, w in enumerate(docs):
        for k, t in enumerate(items):
            at = [(round(weight(cut(t) & c) / (weight(cut(t)) + len(c - cut(t)) * math.log(13)), 6), -s)
                  for s in range(len(w) - 69) for c in [cut(w[s:s + 70])]]
            if max(at)[0] >= 0.8:
                expected[d, k] = max(at)
    assert set(expected) == {(k, k) for k in range(12)}
    got = deco.contaminated(spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(docs)], "doc_id long, text string"),
                            spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string"))
    assert {(r.doc_id, r.item_id): (round(r.similarity, 6), -r.start_word) for r in got.collect()} == expected


def test_long_items_in_a_long_document(spark):
    """Every window of a document is scored in time linear in its words, not
    one by one against the whole item; repeated shingles and rows count once."""
    import time
    g = random.Random(10)
    word = lambda: "".join(g.choice("abcdef") for _ in range(6))
    item = [word() for _ in range(1500)]
    again = item[:20] + item[:20] + item[40:1500]
    doc = [word() for _ in range(50)] + again + [word() for _ in range(700)] + item + item + [word() for _ in range(30)]
    cut = lambda w: {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    own = cut(item)
    best = lambda w: max((round(len(own & c) / len(own | c), 6), -s)
                         for s in range(len(w) - 1499) for c in [cut(w[s:s + 1500])])
    docs = [(1, " ".join(doc)), (1, " ".join(doc)), (2, " ".join(again[:1500] + doc[:40]))]
    began = time.time()
    got = deco.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                            spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    took = time.time() - began
    assert {r.doc_id: (round(r.similarity, 6), -r.start_word) for r in got} == {d: best(t.split()) for d, t in docs}
    assert len(got) == 2 and took < 60, took
