"""Product codes of integer vectors through per-dimension value dictionaries.

Vectors are cut into equal consecutive parts, each part position has a
codebook of up to 256 entries, refined by Lloyd rounds in whole numbers.

Rows are packed once into blocks (one Arrow batch each).  A block keeps, for
every dimension, the dictionary of its distinct values and the rows' codes in
it.  To find nearest entries, the squared differences of every distinct value
to all entries are tabulated per dimension; a part's distances are then
gathers from these tables by code, added up.  A dictionary is bounded by its
block's rows, so memory does not grow with the data or its range of values.

Each round is one pass over the blocks: tasks add up members and counts per
(part, entry, position), Spark sums these, and the driver gets one row per
codebook component (256 entries of one vector, whatever the input's size).

Defined cases: see :mod:`.vectors` for rows that take part.  Rows with a null
id take part, after all others where entries are chosen; equal ids go by
their vectors.  With fewer than 256 rows there are as many entries as rows;
equal entries are allowed, the lowest index wins.  A vector whose length is
not a multiple of the parts leaves the first parts one longer.  No rows, no
result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .vectors import integer_vectors, matrix

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK_ROWS = 8192              # at most 65536: codes are two bytes
STEP_ROWS = 2048               # rows whose distances are in memory at once

PACKED = "ids array<bigint>, labels array<int>, values binary, sizes array<int>, codes binary"
PACKED_ARROW = pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int32())), ("values", pa.binary()),
                          ("sizes", pa.list_(pa.int32())), ("codes", pa.binary())])


def pack(dims: int, block_rows: int = BLOCK_ROWS):
    """Blocks of rows as dictionaries and codes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), block_rows):
                b = whole.slice(at, block_rows)
                m = matrix(b.column("v"), dims)
                values, codes = zip(*(np.unique(m[:, d], return_inverse=True) for d in range(dims))) if dims else ((), ())
                yield pa.RecordBatch.from_pylist([{
                    "ids": b.column("vec_id").to_pylist(), "labels": b.column("label").to_pylist(),
                    "values": b"".join(v.astype("<i8").tobytes() for v in values), "sizes": [len(v) for v in values],
                    "codes": b"".join(c.astype("<u2").tobytes() for c in codes)}], schema=PACKED_ARROW)
    return run


class Block:
    """A packed block: ``values[d]`` the dictionary of dimension ``d``,
    ``codes[d]`` the rows' codes in it."""

    def __init__(self, row: dict):
        self.ids, self.labels = row["ids"], row["labels"]
        ends = np.cumsum([0, *row["sizes"]])
        values = np.frombuffer(row["values"], "<i8")
        self.values = [values[a:b] for a, b in zip(ends, ends[1:])]
        self.codes = np.frombuffer(row["codes"], "<u2").reshape(len(self.values), len(self.ids))

    def nearest(self, books: list[np.ndarray], bounds: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of every part's nearest entry."""
        n = len(self.ids)
        index, error = np.empty((len(books), n), np.int64), np.empty((len(books), n), np.int64)
        for p, book in enumerate(books):
            dims = range(bounds[p], bounds[p + 1])
            tables = [(self.values[d][:, None] - book[None, :, d - bounds[p]]) ** 2 for d in dims]
            if sum(int(t.max()) for t in tables) < 1 << 31:      # the same sums, half as wide
                tables = [t.astype(np.int32) for t in tables]
            kind = tables[0].dtype if tables else np.int64
            for at in range(0, n, STEP_ROWS):
                rows = slice(at, min(n, at + STEP_ROWS))
                total = np.zeros((rows.stop - at, len(book)), kind)
                part = np.empty_like(total)
                for t, d in zip(tables, dims):
                    np.take(t, self.codes[d, rows], axis=0, out=part, mode="clip")
                    total += part
                index[p, rows] = total.argmin(axis=1)            # the first of equals
                error[p, rows] = total[np.arange(len(total)), index[p, rows]]
        return index, error


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for b in batches:
        for k in range(len(b)):
            yield Block({c: b.column(c)[k].as_py() for c in b.schema.names})


def _members(books: list[np.ndarray], bounds: list[int]):
    """Per task: sum and count of every (part, entry, position)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(b.shape, np.int64) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for block in _blocks(batches):
            index, _ = block.nearest(books, bounds)
            for p, book in enumerate(books):
                counts[p] += np.bincount(index[p], minlength=len(book))
                for d in range(bounds[p], bounds[p + 1]):
                    # how often an entry has each distinct value: whole numbers, so sums stay exact
                    values = block.values[d]
                    often = np.bincount(index[p] * len(values) + block.codes[d], minlength=len(book) * len(values))
                    sums[p][:, d - bounds[p]] += often.reshape(len(book), -1) @ values
        for p, book in enumerate(books):
            entry, place = np.nonzero(np.repeat(counts[p][:, None] > 0, book.shape[1], axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(entry), p), pa.int32()), pa.array(entry, pa.int32()), pa.array(place, pa.int32()),
                 pa.array(sums[p][entry, place]), pa.array(counts[p][entry])], ["part", "entry", "place", "total", "n"])
    return run


def _codes(books: list[np.ndarray], bounds: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hexes = np.array([f"{k:02x}" for k in range(max([1, *map(len, books)]))])
        for block in _blocks(batches):
            index, error = block.nearest(books, bounds)
            code = hexes[index[0]]
            for row in index[1:]:
                code = np.char.add(code, hexes[row])
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids, pa.int64()), pa.array(block.labels, pa.int32()), pa.array(code.astype(object), pa.string()),
                 pa.array(error.sum(axis=0), pa.int64())], ["vec_id", "label", "code", "error"])
    return run


def train(packs: DataFrame, books: list[np.ndarray], bounds: list[int], rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks after ``rounds`` assignments; an unused entry stays."""
    for _ in range(rounds):
        sums = (packs.mapInArrow(_members(books, bounds), "part int, entry int, place int, total bigint, n bigint")
                .groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
        books = [b.copy() for b in books]
        for r in sums.collect():           # at most entries * dimensions rows
            books[r["part"]][r["entry"], r["place"]] = r["total"] // r["n"]
    return books


def first_books(vectors: DataFrame, dims: int, parts: int, entries: int) -> tuple[list[np.ndarray], list[int]]:
    """The parts of the ``entries`` smallest ids, and where parts begin."""
    start = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    m = np.array([r["v"] for r in start], np.int64).reshape(len(start), dims)
    bounds = [0, *np.cumsum([len(x) for x in np.array_split(np.arange(dims), parts)]).tolist()]
    return [m[:, a:b].copy() for a, b in zip(bounds, bounds[1:])], bounds


def digest(books: list[np.ndarray]) -> str:
    """Hash of all entries, by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def encoded(df: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
            scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of every row that takes part, and the
    codebooks."""
    if not 1 <= entries <= 256 or not 1 <= block_rows <= 65536:
        raise ValueError("codes have two hex digits, blocks at most 65536 rows")
    vectors, dims = integer_vectors(df, scale, vector)
    books, bounds = first_books(vectors, dims, parts, entries)
    packs = written(vectors.mapInArrow(pack(dims, block_rows), PACKED), "vector-blocks")
    books = train(packs, books, bounds, rounds) if len(books[0]) else books
    return packs.mapInArrow(_codes(books, bounds), "vec_id bigint, label int, code string, error bigint"), books


def digests(df: DataFrame, **options) -> DataFrame:
    """The codes with each label's total error and the codebooks' hash."""
    codes, books = encoded(df, **options)
    codes = written(codes, "vector-codes")
    totals = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return (codes.join(totals, codes["label"].eqNullSafe(totals["of"]))
            .select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))
