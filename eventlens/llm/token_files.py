"""Token-ID files: every document encoded, compressed on its own with one
shared zstandard dictionary, and found through an offset index.

File layout (one file per shard, little endian)::

    MAGIC                                8 bytes
    frames                               one zstd frame per document, back to back
    doc ids                              int64 per document (0 where null)
    nulls                                uint8 per document, 1 where doc_id is null
    offsets                              uint64 per document + 1, into the file
    counts                               uint64 per document, ids with the end id
    footer                               shard, documents, ids, index offset (uint64 each),
                                         sha256 of the dictionary (32 bytes), MAGIC

A frame holds the document's ids as unsigned 32-bit integers.  Shards are in
ascending ``doc_id`` order (nulls first; rows with equal ids by a hash of
their text), so a shard's number orders its documents after those of all
lower numbers.  One document is read with two range requests: footer plus
index, then its frame.

The dictionary is trained on the serialized ids of a bounded sample
(about ``sample_docs`` documents, the first ``sample_chars`` characters of each);
it affects file size only.  Files are committed by Spark's writer, one row
per shard, so a lost executor leaves no partial file and any store works.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, parts_for, text_of, with_defaults

MAGIC = b"EVTOK01\n"
FOOTER = "<QQQQ32s8s"
LEVEL = 1
MEMO_PARTS = 250_000

# fixed values: the tokenizer's splitter, its classes written out for Latin-1
LETTER, NUMBER, SPACE = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\t-\r \u0085\u00a0"
SPLIT = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+"

# fixed values: the normaliser and the splitter that this cutting equals
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITTER = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed", "invert": True}

INDEX_SCHEMA = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("seq", T.LongType()),
    T.StructField("doc_id", T.LongType()), T.StructField("shard_start", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
SHARD_SCHEMA = T.StructType([T.StructField("shard", T.LongType()), T.StructField("ids", T.LongType())])


class Memo(dict):
    """A bounded memo in two generations: when the young one is full it
    becomes the old one; what is asked for again moves back."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


def _byte_letters() -> dict[int, str]:
    """How byte-level BPE writes the UTF-8 bytes of each Latin-1 character:
    printable bytes as themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    letters |= {b: chr(0x100 + k) for k, b in enumerate(b for b in range(256) if b not in letters)}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(256)}


def cut_alike(path: str) -> bool:
    """Whether a tokenizer file normalises and splits as :class:`Encoder`
    does on its own."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    normalizer, split, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    steps = split.get("pretokenizers") or [{}]
    return (normalizer.get("normalizers") == NORMALIZER and len(steps) == 2 and steps[0] == SPLITTER
            and steps[1].get("type") == "ByteLevel" and not steps[1].get("use_regex", True) and not steps[1].get("add_prefix_space")
            and model.get("type") == "BPE" and not model.get("dropout") and not spec.get("post_processor")
            and all(t["content"].startswith("<|") and not (t.get("lstrip") or t.get("rstrip") or t.get("normalized"))
                    for t in spec.get("added_tokens") or []))


class Encoder:
    """Ids of a text as little-endian uint32 bytes.

    A tokenizer that cuts otherwise than the one described here
    (:func:`cut_alike`) encodes whole texts.  The known one lower-cases, cuts a text by ``SPLIT`` and runs its byte-pair
    model on each part.  A text within Latin-1 is cut here (there, normal
    form and lower case are the same in every library), its parts go to the
    tokenizer's model once and are remembered.  Other texts, and those with a
    special token's opening, go through the whole tokenizer, cut at spaces
    and newlines, which it never joins across.
    """

    def __init__(self, path: str, end_id: int):
        import re
        from tokenizers import Tokenizer
        self.tokenizer, self.alike = Tokenizer.from_file(path), cut_alike(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.letters, self.split = self.tokenizer.model, _byte_letters(), re.compile(SPLIT).findall
        self.end = np.array([end_id], "<u4").tobytes()
        self.parts = Memo(lambda p: np.array([t.id for t in self.model.tokenize(p.translate(self.letters))], "<u4").tobytes(),
                          MEMO_PARTS)
        self.pieces = Memo(lambda p: np.array(self.tokenizer.encode(p, add_special_tokens=False).ids, "<u4").tobytes(),
                           MEMO_PARTS // 4)

    def __call__(self, text: str) -> bytes:
        if not self.alike:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() + self.end
        if "<|" not in text and _is_latin1(text):
            memo, cut = self.parts, self.split(text.lower())
        else:
            memo, cut = self.pieces, text.replace("\n", " ").split(" ")
        out = b"".join(map(memo.__getitem__, cut)) + self.end
        memo.trim()
        return out


def _is_latin1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def worker_encoder(path: str, end_id: int) -> Encoder:
    """The encoder of this worker process, kept between its tasks."""
    import sys
    import types
    home = sys.modules.setdefault("_eventlens_worker", types.ModuleType("_eventlens_worker"))
    kept = getattr(home, "encoder", None)
    if kept is None or kept[0] != (path, end_id):
        kept = home.encoder = ((path, end_id), Encoder(path, end_id))
    return kept[1]


def train_dictionary(docs: DataFrame, n_docs: int, tokenizer_path: str, end_id: int,
                     sample_docs: int, sample_chars: int, size: int) -> bytes:
    """The shared dictionary; empty when the sample is too small to train on.
    One task encodes the bounded sample and trains, so the driver holds
    neither the sample nor a tokenizer."""
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder(tokenizer_path, end_id)
        parts = [encode(text) for b in batches for text in b.column("text").to_pylist()]
        # the trainer wants several samples and more data than dictionary
        total = sum(map(len, parts))
        if len(parts) >= 16 and total >= 8 * size:
            out = zstandard.train_dictionary(size, parts).as_bytes()
            yield pa.RecordBatch.from_pydict({"dictionary": pa.array([out], pa.binary())})

    sample = (bounded_sample(docs, sample_docs, n_docs, "doc_id", "text")
              .select(F.substring("text", 1, sample_chars).alias("text")).coalesce(1))
    trained = sample.mapInArrow(train, "dictionary binary").collect()
    return bytes(trained[0]["dictionary"]) if trained else b""


def _compression(dictionary: bytes):
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def pack_shard(shard: int, rows: Iterator[tuple[int | None, bytes]], dictionary: bytes) -> bytes:
    """One shard's bytes from (doc_id, ids) in order."""
    zd = _compression(dictionary)
    comp = zstandard.ZstdCompressor(level=LEVEL, dict_data=zd) if zd else zstandard.ZstdCompressor(level=LEVEL)
    body, ids, nulls, offsets, counts = [MAGIC], [], [], [len(MAGIC)], []
    for doc_id, raw in rows:
        frame = comp.compress(raw)
        body.append(frame)
        ids.append(doc_id or 0)
        nulls.append(doc_id is None)
        offsets.append(offsets[-1] + len(frame))
        counts.append(len(raw) // 4)
    index = (np.array(ids, "<i8").tobytes() + np.array(nulls, "u1").tobytes()
             + np.array(offsets, "<u8").tobytes() + np.array(counts, "<u8").tobytes())
    footer = struct.pack(FOOTER, shard, len(ids), sum(counts), offsets[-1],
                         hashlib.sha256(dictionary).digest(), MAGIC)
    return b"".join(body) + index + footer


class Shard:
    """Reads a shard's bytes: index first, single documents on demand."""

    def __init__(self, blob: bytes, dictionary: bytes):
        end = len(blob) - 1 if blob[-1:] == b"\n" and blob[-len(MAGIC):] != MAGIC else len(blob)
        self.blob = blob
        self.shard, n, self.n_ids, at, sha, magic = struct.unpack(FOOTER, blob[end - struct.calcsize(FOOTER):end])
        if magic != MAGIC or blob[:len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        if sha != hashlib.sha256(dictionary).digest():
            raise ValueError("token file was written with another dictionary")
        self.doc_ids = np.frombuffer(blob, "<i8", n, at)
        self.nulls = np.frombuffer(blob, "u1", n, at + 8 * n)
        self.offsets = np.frombuffer(blob, "<u8", n + 1, at + 9 * n)
        self.counts = np.frombuffer(blob, "<u8", n, at + 9 * n + 8 * (n + 1))
        zd = _compression(dictionary)
        self._decomp = zstandard.ZstdDecompressor(dict_data=zd) if zd else zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.doc_ids)

    def raw(self, i: int) -> bytes:
        """Ids of the i-th document as little-endian uint32 bytes."""
        return self._decomp.decompress(self.blob[int(self.offsets[i]):int(self.offsets[i + 1])])


def write_token_files(docs: DataFrame, out_dir: str, *, tokenizer_path: str, end_id: int,
                      target_bytes: int = 16 << 20, sample_docs: int = 1000,
                      sample_chars: int = 4000, dictionary_bytes: int = 64 << 10) -> None:
    """Write ``docs`` (doc_id, text) as token files below ``out_dir``.

    Null texts are empty (only the end id); rows with the same ``doc_id`` are
    all written; other columns are ignored; an empty table gives no shard.
    """
    spark = docs.sparkSession
    docs = with_defaults(docs, doc_id="bigint", text="string").select("doc_id", text_of().alias("text"))
    total, n_docs = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    dictionary = train_dictionary(docs, n_docs, tokenizer_path, end_id, sample_docs, sample_chars, dictionary_bytes)
    blob = spark.createDataFrame([(bytearray(dictionary),)], "value binary")
    _write_rows(blob, f"{out_dir}/dictionary")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder(tokenizer_path, end_id)
        rows = ((d, encode(t)) for b in batches
                for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()))
        first = next(rows, None)
        if first is None:
            return

        def all_rows():
            yield first
            yield from rows

        packed = pack_shard(TaskContext.get().partitionId(), all_rows(), dictionary)
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["value"])

    # the text itself is the second key: rows of one hot id spread over shards
    ordered = (docs.withColumn("h", F.xxhash64("text"))
               .repartitionByRange(parts_for(total, target_bytes), F.col("doc_id").asc_nulls_first(), "h")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h", "text"))
    _write_rows(ordered.select("doc_id", "text").mapInArrow(shards, "value binary"), f"{out_dir}/shards")


def _write_rows(df: DataFrame, path: str) -> None:
    # a row per file; the text writer stores the bytes as they are, plus a newline
    df.select(F.col("value").cast("string")).write.text(path)


def _load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def _dictionary(spark: SparkSession, out_dir: str) -> bytes:
    parts = [bytes(r["content"]) for r in _load(spark, f"{out_dir}/dictionary").where(F.length("content") > 0).collect()]
    return parts[0][:-1] if parts else b""


def read_token_index(spark: SparkSession, out_dir: str) -> DataFrame:
    """Read the files back: ``doc_id, start, n_tokens, ids_crc32`` of every
    document, from its decompressed ids (``start``: ids of all before it)."""
    dictionary = _dictionary(spark, out_dir)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                s = Shard(content.as_py(), dictionary)
                n, start = len(s), 0
                raw_n, crc, starts = np.empty(n, "i8"), np.empty(n, "i8"), np.empty(n, "i8")
                for i in range(n):
                    raw = s.raw(i)
                    raw_n[i], crc[i], starts[i] = len(raw) // 4, zlib.crc32(raw), start
                    start += len(raw) // 4
                if start != s.n_ids or (raw_n != s.counts.astype("i8")).any():
                    raise ValueError(f"token file {s.shard}: index and frames disagree")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, s.shard, "i8")), pa.array(np.arange(n)),
                     pa.array(s.doc_ids, mask=s.nulls.astype(bool)), pa.array(starts), pa.array(raw_n), pa.array(crc)],
                    INDEX_SCHEMA.names)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shards = [Shard(c.as_py(), dictionary) for c in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([s.shard for s in shards], pa.int64()),
                                              pa.array([s.n_ids for s in shards], pa.int64())], SHARD_SCHEMA.names)

    files = _load(spark, f"{out_dir}/shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = (files.mapInArrow(totals, SHARD_SCHEMA)  # a row per file
              .select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before")))
    rows = files.mapInArrow(documents, INDEX_SCHEMA)
    return (rows.join(starts, "shard")
            .select("doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32"))
