import zlib

import brute
import corpus_pipeline as pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from eventlens.llm.common import table, written

SF = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark, monkeypatch):
    docs = table(spark, SF, "documents")
    rows, columns = {"documents": docs.collect()}, docs.columns

    def kept(df, kind):
        out = written(df, kind)
        assert out.columns == columns
        rows[kind.removeprefix("pipeline-")] = out.collect()
        return out

    monkeypatch.setattr(pipeline, "written", kept)
    last = pipeline.run(spark, SF)
    assert last.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows[pipeline.STAGES[-1][0]] = last.collect()
    assert list(rows) == ["documents", *(name for name, _ in pipeline.STAGES)]
    ids = lambda name: sorted(r.doc_id for r in rows[name])

    base = {r.doc_id: brute.quality_base(r.text) for r in rows["documents"]}
    passing = {i for i, b in base.items() if b[0] >= 50 and 2 * b[4] <= b[0]}
    good = {r.doc_id for r in table(spark, SF, "labels").collect() if r.quality == 1}
    assert set(ids("quality_rules")) <= passing and passing & good <= set(ids("quality_rules"))

    groups = brute.components([(r.doc_id, r.text) for r in rows["quality_rules"]])
    assert ids("near_dedup") == sorted(set(groups.values()))

    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    assert ids("decontamination") == sorted(r.doc_id for r in rows["near_dedup"] if not brute.item_matches(r.text, items))

    copies, _, _ = brute.mix_copies([(r.doc_id, r.source, r.text) for r in rows["decontamination"]])
    assert ids("mixing") == sorted(k[0] for k, n in copies.items() for _ in range(n))

    tokenizer, at = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    want = []
    for r in sorted(rows["mixing"], key=lambda r: r.doc_id):
        tokens = tokenizer.encode(r.text, add_special_tokens=False).ids + [2]
        want.append((r.doc_id, at, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes())))
        at += len(tokens)
    assert sorted(map(tuple, rows["token_files"])) == want
