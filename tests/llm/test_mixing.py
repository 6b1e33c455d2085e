import brute
import duckdb
import numpy as np
from pyspark.sql import functions as F

from eventlens.llm import mixing as m
from eventlens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    res = con.execute(ORACLES["op7_mixing"])
    cols = [d[0] for d in res.description]
    got = QUERIES["op7_mixing"](spark, SF).select(*cols).collect()
    norm = lambda rows: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)
    assert norm(got) == norm(res.fetchall())


def test_targets_and_shards(spark):
    rows = [(i, "w " * (i % 40), f"s{i % 7 if i % 2 else 0}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies, target, total = brute.mix_copies([(i, s, t) for i, t, s in rows])
    out = m.mix(df, block_words=64, shard_words=1000).select("row.doc_id", "row.source", "size", "target", "shards").collect()
    assert {r.doc_id: len(r.shards) for r in out} == {k[0]: n for k, n in copies.items()}
    assert all(abs(r.target - target[r.source]) < 1e-6 for r in out)
    for s in target:
        taken = sum(r["size"] * len(r.shards) for r in out if r.source == s)
        assert abs(taken - target[s]) <= 40
    again = {r.doc_id: r.shards for r in m.mix(df, block_words=64, shard_words=1000).select("row.doc_id", "shards").collect()}
    assert again == {r.doc_id: r.shards for r in out}
    words = {}
    for r in out:
        for s in r.shards:
            words[s] = words.get(s, 0) + r["size"]
    n = -(-int(sum(target.values())) // 1000)
    assert set(words) == set(range(n)) and max(words.values()) < 2 * min(words.values())


def test_tree_splits_exact_quotas():
    quotas = [500, 3, 0, 77, 1]
    tree = m.Tree(quotas, 13, 5)
    leaves = [tree.leaf(s) for s in range(13)]
    assert np.array_equal(sum(n for _, n in leaves), quotas)
    sizes = [int(n.sum()) for _, n in leaves]
    assert max(sizes) - min(sizes) <= 4
    for k in range(len(quotas)):  # ranges of a source follow one another
        at = 0
        for first, n in leaves:
            assert first[k] == at
            at += n[k]
    assert all(np.array_equal(x, y) for a, b in zip(leaves, [m.Tree(quotas, 13, 5).leaf(s) for s in range(13)]) for x, y in zip(a, b))


def test_messy_and_empty(messy, messy_rows, empty):
    out = m.mixed_sizes(messy).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.size) for r in map(_sized, out)) == sorted(
        ((i is None, i or 0), len(brute.words(t))) for i, t, *_ in messy_rows)
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in out)
    drawn = m.draw_documents(messy)
    assert drawn.columns == messy.columns
    assert drawn.where(F.col("text").isNull()).count() == 0
    assert m.mixed_sizes(empty).count() == 0 and m.draw_documents(empty).count() == 0


def _sized(r):
    class Row:
        doc_id, size = r.doc_id, r["size"]
    return Row
