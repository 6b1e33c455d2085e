import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventlens.llm import token_counts as t

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = "<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _n(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def _odd_texts(g, n, length):
    letters = list("aabbccdeé日本 \n\t''''!?.,123") + ["'re", "'ll", "  ", "\n\n", " <|end", SPECIAL, " the", " ", "👍🏽"]
    return ["".join(g.choice(letters) for _ in range(g.randint(1, length))) for _ in range(n)]


def test_messy_rows(spark, messy, messy_rows, library):
    got = sorted(map(tuple, t.token_counts(messy, PATH, limit=50).collect()), key=repr)
    want = sorted(((r[0], len((r[1] or "").encode()), _n(library, r[1]), _n(library, r[1]) > 50) for r in messy_rows), key=repr)
    assert got == want


def test_empty_table(spark, empty):
    out = t.token_counts(empty, PATH)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and out.count() == 0


def test_chunks_of_any_place_count_as_the_whole(spark, library):
    """Small chunks put junctions inside contractions, white space, special
    tokens and many-byte characters."""
    texts = _odd_texts(random.Random(3), 120, 900)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for chunk, overlap in ((97, 40), (160, 64)):
        got = {r.doc_id: r.n_tokens for r in t.token_counts(df, PATH, chunk_chars=chunk, overlap_chars=overlap).collect()}
        assert got == {k: _n(library, x) for k, x in enumerate(texts)}


def test_overlaps_widen_until_they_align(spark, library):
    plain = "some words in a row " * 40
    texts = {"aligned": plain, "run": plain + "x" * 3000 + plain, "spaces": plain + " " * 900 + "a" + "\n" * 700 + plain,
             "one": "y" * 5000, "special": SPECIAL * 300}
    ahead = t.resumable(PATH)
    df = spark.createDataFrame(list(texts.items()), "digest string, text string")
    one, rounds = t.huge_counts(df.where("digest = 'aligned'"), PATH, ahead, 200, 50)
    assert rounds == 1 and one.first().n_tokens == _n(library, plain)
    counts, rounds = t.huge_counts(df, PATH, ahead, 200, 50)
    assert rounds > 1
    assert {r.digest: r.n_tokens for r in counts.collect()} == {k: _n(library, x) for k, x in texts.items()}


def test_copies_of_a_huge_text_are_encoded_once(spark, library):
    text = "many copies of one text, " * 60
    df = spark.createDataFrame([(k, text) for k in range(40)] + [(None, text)], "doc_id bigint, text string")
    out = t.token_counts(df, PATH, chunk_chars=400, overlap_chars=60).collect()
    assert len(out) == 41 and {r.n_tokens for r in out} == {_n(library, text)}


def test_only_proven_tokenizers_are_spliced(spark, messy, messy_rows):
    assert t.resumable(PATH) == len(SPECIAL) + 1
    for name in ("word_bpe_49k.json", "piece_bpe_32k.model"):
        path = public_tokenizers.path(name)
        assert t.resumable(path) is None
        got = sorted(((r.doc_id, r.n_tokens) for r in t.token_counts(messy, path, chunk_chars=100, overlap_chars=48).collect()), key=repr)
        if name.endswith(".json"):
            lib = Tokenizer.from_file(path)
            n = lambda x: len(lib.encode(x, add_special_tokens=False).ids)
        else:
            import sentencepiece
            lib = sentencepiece.SentencePieceProcessor(model_file=path)
            n = lambda x: len(lib.encode(x))
        assert got == sorted(((r[0], n(r[1] or "")) for r in messy_rows), key=repr)


def test_added_tokens_that_meet_are_not_resumable():
    assert t._meets_itself("<a<a", "<a<a") and t._meets_itself("xab", "abc") and not t._meets_itself(SPECIAL, SPECIAL)
