import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from eventlens.llm import token_files as t
from eventlens.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    return t.Encoder(PATH, 2)


def _ids(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_encoder_equals_the_tokenizer(encoder):
    g = random.Random(1)
    latin = [chr(c) for c in range(256)] + list("aaabbbcccAAEE''''sstdlmvree  \n\n..,,ßÀéü½²ªµ")
    odd = list("œ€“”Σς́  Ａ日本İǅ") + ["<|endoftext|>", "<|ENDOFTEXT|>"]
    for k in range(4000):
        text = "".join(g.choice(latin if k % 3 else latin + odd * 6) for _ in range(g.randint(0, 60)))
        assert np.frombuffer(encoder(text), "<u4").tolist() == _ids(encoder, text)


def test_other_tokenizers_encode_whole_texts(encoder):
    """Ids equal the tokenizer's whatever its normaliser and splitter."""
    other = t.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 7)
    assert encoder.alike and not other.alike
    g = random.Random(4)
    letters = list("abcABC  \n\t.,!'sdreé日") + ["<|endoftext|>", " The", "123"]
    for text in ["", " ", *("".join(g.choice(letters) for _ in range(g.randint(1, 80))) for _ in range(500))]:
        assert np.frombuffer(other(text), "<u4").tolist() == other.tokenizer.encode(text, add_special_tokens=False).ids + [7]


def test_memo_is_bounded():
    memo = t.Memo(lambda k: k.encode(), 10)
    for k in range(1000):
        assert memo[str(k % 37)] == str(k % 37).encode()
        memo.trim()
        assert len(memo) <= 11 and len(memo.old) <= 11


def _read(spark, df, **options):
    out = scratch_path(spark, "tokens")
    t.write_token_files(df, out, tokenizer_path=PATH, end_id=2, **options)
    return out, t.read_token_index(spark, out).collect()


def test_round_trip_in_order(spark, encoder):
    g = random.Random(2)
    rows = [(g.randrange(10**6), " ".join(g.choice(["the", "Ende", "été", "x1", "don't"]) for _ in range(g.randint(0, 300)))) for _ in range(300)]
    _, out = _read(spark, spark.createDataFrame(rows, "doc_id long, text string"), target_bytes=20_000, dictionary_bytes=1024)
    at, by = 0, {r.doc_id: r for r in out}
    for i, text in sorted(dict(rows).items()):
        ids = _ids(encoder, text)
        assert tuple(by[i]) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_single_document_access_and_dictionary_hash():
    docs = [(5, np.arange(k, dtype="<u4").tobytes()) for k in range(40)] + [(None, b"")]
    import zstandard
    dictionary = zstandard.train_dictionary(2048, [np.random.default_rng(k).integers(0, 99, 400, "u4").tobytes() for k in range(64)]).as_bytes()
    blob = t.pack_shard(3, iter(docs), dictionary) + b"\n"
    s = t.Shard(blob, dictionary)
    assert len(s) == 41 and s.shard == 3 and s.raw(17) == docs[17][1] and s.nulls[40] == 1 and s.n_ids == sum(range(40))
    with pytest.raises(ValueError):
        t.Shard(blob, b"other")


def test_messy_and_empty(spark, messy, messy_rows, empty, encoder):
    _, out = _read(spark, messy)
    want = sorted(zlib.crc32(np.array(_ids(encoder, x), "<u4").tobytes()) for _, x, *_ in messy_rows)
    assert sorted(r.ids_crc32 for r in out) == want
    ends = sorted((r.start, r.start + r.n_tokens) for r in out)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(out, key=lambda r: r.start)]
    assert order == sorted(order)
    assert _read(spark, empty)[1] == []
