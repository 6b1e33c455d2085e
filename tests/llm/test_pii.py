import hashlib
import random

import brute

from eventlens.llm import pii


def _check(rows, out):
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, []).append(",".join(f"{k}:{a}:{e}" for k, a, e in brute.pii(t)))
    for r in out:
        base = next(s for s in texts[r.doc_id] if hashlib.sha256(s.encode()).hexdigest() == r.base_sha256)
        assert r.spans == base or r.spans.startswith(base + "," if base else "")
        kinds = [s.split(":")[0] for s in base.split(",")]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in ("email", "ip", "card", "phone")]


def test_base_spans_on_random_texts(spark):
    g = random.Random(3)
    letters = "0123456789" * 3 + "..--++@  ()abZ_%é\n"
    rows = [(i, "".join(g.choice(letters) for _ in range(g.randint(0, 120)))) for i in range(1500)]
    rows += [(2000, "1" * 30000 + " " + "4 " * 20000 + "a" * 30000 + "@b.c"), (2001, "1.2.3.4 " * 700), (2002, None),
             (2003, "é 4111 1111 1111 1111, +1 (456) 555-2186. ann@x.org ann@x.org_bob@y.net 300.1.1.1 0255.1.1.1")]
    out = pii.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    _check(rows, out)


def test_disclosing_terms(spark):
    g = random.Random(8)
    word = lambda: "w" + "".join(g.choice("abc") for _ in range(2))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, f"{prose(12)} Zelda near ann@x.org {prose(10)} and Zelda again {prose(3)}") for i in range(5)]
    rows += [(10 + i, f"{prose(20)} near bob@y.org half {prose(12)}") for i in range(4)]
    rows += [(20 + i, f"{prose(30)} near half") for i in range(2)] + [(30 + i, prose(40)) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(9)]  # copies say nothing new
    rows += [(200, prose(20) + " Zelda " + prose(9))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.found_spans(df)
    got = {(r.entity, r.term): r.disclosure for r in pii.disclosures(df, found).collect()}
    n = len({t for _, t in rows})
    from math import log
    zelda = log(5 * n / (5 * 6)) / log(n / 5)
    half = log(4 * n / (4 * 6)) / log(n / 4)
    assert abs(got["email:ann@x.org", "zelda"] - zelda) < 1e-9 and abs(got["email:bob@y.org", "half"] - half) < 1e-9
    near = log(5 * n / (5 * 11)) / log(n / 5)
    assert (("email:ann@x.org", "near") in got) == (near >= pii.GENERALISE)
    spans = {r.doc_id: r.spans for r in pii.digests(df).collect()}
    for i, t in rows:
        at = [k for k in range(len(t)) if t.startswith("Zelda", k)] if "ann@" in t else []
        kind = "remove" if zelda >= pii.REMOVE else "generalise"
        assert [s for s in spans[i].split(",") if s.startswith(kind) and any(s == f"{kind}:{k}:{k + 5}" for k in at)] == [
            f"{kind}:{k}:{k + 5}" for k in at]
    assert spans[200] == "" and spans[30] == ""
    clean = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert "[EMAIL]" in clean[0] and "Zelda" not in clean[0] and "@" not in clean[0]
    assert clean[200] == rows[-1][1]


def test_messy_and_empty(messy, messy_rows, empty):
    out = pii.digests(messy).collect()
    assert len(out) == len(messy_rows)
    _check(messy_rows, out)
    assert pii.sanitised(messy).count() == len(messy_rows)
    assert pii.digests(empty).count() == 0
