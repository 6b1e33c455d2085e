import random

import brute

from eventlens.llm import line_dedup as lines


def _check(rows, out):
    expected = {}
    for (i, t), gone in brute.line_runs([r[:2] for r in rows]).items():
        own = (t or "").split("\n")
        n = sum(bool(brute.words(x)) for p, x in enumerate(own) if p in gone)
        expected.setdefault(i, set()).add((n, None if t is None else "\n".join(x for p, x in enumerate(own) if p not in gone)))
    assert len(out) == len(rows) and all((r.n_removed, r.text) in expected[r.doc_id] for r in out)


def test_against_all_earlier_runs(spark):
    g = random.Random(5)
    vocabulary = [" ".join(g.choice("ab cd ef gh".split()) for _ in range(g.randint(0, 30))) for _ in range(12)]
    rows = [(i, "\n".join(g.choice(vocabulary) for _ in range(g.randint(0, 9)))) for i in range(300)]
    passage = "\n".join(f"{k} " * 26 + "end" for k in range(3))
    rows += [(1000 + i, f"own {i} start\n{passage}\nown {i} stop") for i in range(30)] + [(2000, "a\n\n" * 200), (None, "x " * 60), (5001, "x " * 60)]
    out = lines.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    _check(rows, out)
    by = {r.doc_id: r for r in out}
    assert by[1000].n_removed == 0 and by[1001].text == "own 1 start\nown 1 stop" and by[5001].text == ""


def test_messy_and_empty(messy, messy_rows, empty):
    _check(messy_rows, lines.without_repeats(messy).collect())
    assert lines.without_repeats(empty).count() == 0
