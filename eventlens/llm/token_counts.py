"""Token counts of whole texts, huge ones by overlap resynchronisation.

A text of up to ``chunk_chars`` characters is encoded as it is.  A longer one
is cut into chunks that overlap, which are encoded on their own, in any task
and any order, with offsets:

1. a chunk tells the piece boundaries (starts of the tokenizer's pre-split
   pieces) in its first and its last ``overlap_chars`` characters, each with
   the number of tokens before it;
2. two neighbours are spliced at a position that is a boundary in both: what
   follows a boundary does not depend on what precedes it, so from there on
   both encodings are the same, and the left one is the whole text's by
   induction.  The left chunk's last characters are left out, as many as the
   tokenizer may look ahead: what they hold might be split otherwise if more
   text followed;
3. a text with neighbours that share no boundary (one run of letters or white
   space longer than the overlap) is cut anew with chunks and overlaps
   ``WIDER`` times as wide, until it aligns or is one chunk.

The proof needs a tokenizer without normalisation whose pieces depend on the
text after their start alone (:func:`resumable`); for any other, whole texts
are encoded in one go.

Copies of one huge text are encoded once.  Nulls and empty texts have 0 bytes
and 0 tokens; repeated rows, ties and null ids each keep their row; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of, with_defaults, written

CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 1 << 9
WIDER = 8
BATCH_CHARS = 1 << 20          # characters given to the tokenizer at once
CONTRACTION = 3                # fixed value: the splitter's longest look at the following text

COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint"
PIECES = "digest string, chunk int, last boolean, piece string"
ENCODED = ("digest string, chunk int, last boolean, n_tokens bigint, "
           "head_at array<bigint>, head_before array<bigint>, tail_at array<bigint>, tail_before array<bigint>")


class Counter:
    """Token counts by one tokenizer file: ``.json`` by the tokenizers
    library, ``.model`` by sentencepiece."""

    def __init__(self, path: str):
        import os
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.counts = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"     # Spark runs a task per core
            from tokenizers import Tokenizer
            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
            self.counts = lambda texts: [len(e) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def boundaries(self, text: str) -> tuple[int, list[int], list[int]]:
        """Number of tokens, and the pieces' starts with the tokens before."""
        e = self.tokenizer.encode(text, add_special_tokens=False)
        words, offsets = e.word_ids, e.offsets
        starts = [k for k in range(len(words)) if k == 0 or words[k] != words[k - 1]]
        return len(words), [offsets[k][0] for k in starts], starts


def worker_counter(path: str) -> Counter:
    """The counter of this worker process, kept between its tasks."""
    import sys
    import types
    home = sys.modules.setdefault("_eventlens_counter", types.ModuleType("_eventlens_counter"))
    kept = getattr(home, "counter", None)
    if kept is None or kept[0] != path:
        kept = home.counter = (path, Counter(path))
    return kept[1]


def resumable(path: str) -> int | None:
    """How many characters a piece may depend on beyond its end, or None for
    a tokenizer that is not known to resume at its piece boundaries."""
    if not path.endswith(".json"):
        return None
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    added = spec.get("added_tokens") or []
    plain = (spec.get("normalizer") is None and spec.get("post_processor") is None
             and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
             and model.get("type") == "BPE" and not model.get("dropout")
             and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
             and not any(_meets_itself(t["content"], u["content"]) for t in added for u in added))
    return max([CONTRACTION, *(len(t["content"]) for t in added)]) + 1 if plain else None


def _meets_itself(a: str, b: str) -> bool:
    """Whether ``b`` may start inside ``a`` (added tokens are matched from
    the left, so such a pair would depend on what precedes it)."""
    return any(a[k:].startswith(b) or b.startswith(a[k:]) for k in range(1, len(a)))


def _whole(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(path)
        for b in batches:
            texts, counts, at = b.column("text").to_pylist(), [], 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end]) <= BATCH_CHARS):
                    chars += len(texts[end])
                    end += 1
                counts += counter.counts(texts[at:end])
                at = end
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(counts, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])
    return count


def _cut(chunk: int, overlap: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for digest, text in zip(b.column("digest").to_pylist(), b.column("text")):
                text = text.as_py()
                n = max(1, -(-len(text) // chunk))
                yield pa.RecordBatch.from_pydict({
                    "digest": [digest] * n, "chunk": pa.array(range(n), pa.int32()), "last": [k == n - 1 for k in range(n)],
                    "piece": [text[k * chunk:(k + 1) * chunk + overlap] for k in range(n)]})
    return cut


def _encode(path: str, chunk: int, overlap: int, ahead: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(path)
        for b in batches:
            rows = []
            for row in b.to_pylist():
                piece = row.pop("piece")
                n, at, before = counter.boundaries(piece)
                sure = len(piece) - ahead
                head = [k for k, p in enumerate(at) if p <= overlap]
                tail = [] if row["last"] else [k for k, p in enumerate(at) if chunk <= p <= sure]
                rows.append(row | {"n_tokens": n, "head_at": [at[k] for k in head], "head_before": [before[k] for k in head],
                                   "tail_at": [at[k] - chunk for k in tail], "tail_before": [before[k] for k in tail]})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=ENCODED_ARROW)
    return encode


_longs = pa.list_(pa.int64())
ENCODED_ARROW = pa.schema([("digest", pa.string()), ("chunk", pa.int32()), ("last", pa.bool_()), ("n_tokens", pa.int64()),
                           ("head_at", _longs), ("head_before", _longs), ("tail_at", _longs), ("tail_before", _longs)])


def spliced(encoded: DataFrame) -> DataFrame:
    """(digest, n_tokens): the last chunk's tokens, and at every junction the
    left chunk's up to a common boundary less the right chunk's before it;
    null where a junction has no common boundary."""
    left = encoded.where(~F.col("last")).select("digest", (F.col("chunk") + 1).alias("chunk"), "tail_at", "tail_before")
    right = encoded.where(F.col("chunk") > 0).select("digest", "chunk", "head_at", "head_before")
    common = F.try_element_at(F.array_intersect("tail_at", "head_at"), F.lit(1))
    before = lambda side: F.expr(f"try_element_at({side}_before, CAST(array_position({side}_at, at) AS INT))")
    parts = (left.join(right, ["digest", "chunk"]).withColumn("at", common)
             .select("digest", F.when(F.col("at").isNotNull(), before("tail") - before("head")).alias("n"))
             .unionByName(encoded.where("last").select("digest", F.col("n_tokens").alias("n"))))
    return (parts.groupBy("digest").agg(F.sum("n").alias("n"), F.bool_and(F.col("n").isNotNull()).alias("whole"))
            .select("digest", F.when(F.col("whole"), F.col("n")).alias("n_tokens")))


def huge_counts(texts: DataFrame, path: str, ahead: int, chunk: int, overlap: int) -> tuple[DataFrame, int]:
    """(digest, n_tokens) of the distinct ``texts`` (digest, text), and the
    number of rounds it took."""
    if overlap <= 2 * ahead or chunk <= 2 * overlap:
        raise ValueError("chunks must be longer than two overlaps, and overlaps than what the tokenizer looks ahead")
    done, rounds, todo = None, 0, texts
    while True:
        rounds += 1
        # copies of a text meet chunk by chunk, so no task holds a whole group or a whole text's chunks
        pieces = todo.mapInArrow(_cut(chunk, overlap), PIECES).dropDuplicates(["digest", "chunk"])
        encoded = written(pieces.mapInArrow(_encode(path, chunk, overlap, ahead), ENCODED), "token-chunks")
        counts = written(spliced(encoded), "token-splices")
        found = counts.where("n_tokens IS NOT NULL")
        done = found if done is None else done.unionByName(found)
        failed = counts.where("n_tokens IS NULL").select("digest")
        if failed.isEmpty():
            return done, rounds
        todo, chunk, overlap = texts.join(failed, "digest", "left_semi"), chunk * WIDER, overlap * WIDER


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024, chunk_chars: int = CHUNK_CHARS,
                 overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit of every row."""
    rows = (with_defaults(docs, doc_id="bigint", text="string").withColumn("text", text_of())
            .withColumn("n_bytes", F.octet_length("text").cast("bigint")))
    ahead = resumable(tokenizer_path)
    if ahead is None:
        out = rows.mapInArrow(_whole(tokenizer_path), COUNTS)
    else:
        huge = rows.where(F.char_length("text") > chunk_chars).withColumn("digest", F.sha2("text", 256))
        counts, _ = huge_counts(huge.select("digest", "text"), tokenizer_path, ahead, chunk_chars, overlap_chars)
        out = (rows.where(F.char_length("text") <= chunk_chars).mapInArrow(_whole(tokenizer_path), COUNTS)
               .unionByName(huge.select("doc_id", "n_bytes", "digest").join(counts, "digest").drop("digest")))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
