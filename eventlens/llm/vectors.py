"""Integer vectors: what the vector operators share.

A row takes part if its vector is not null, holds no null and no non-finite
component, and is as long as the vector of the smallest id.  A component
becomes ``floor(scale * x)``, ``x`` as double, kept within bounds
(:func:`bound`) in which every sum the operators build fits a long: at 64
components these are beyond 2**27, far outside what embeddings hold.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bound(dims: int) -> int:
    """Components stay within ``+-bound``: (2 * bound)**2 * dims < 2**62."""
    return math.isqrt((1 << 60) // max(dims, 1))


def integer_vectors(df: DataFrame, scale: int, vector: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, label, v) of the rows that take part, and their length."""
    x = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"),
                  F.col(vector).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    x = x.where(F.col("x").isNotNull() & finite)
    first = x.agg(F.min(F.struct(F.col("vec_id").isNull(), F.col("vec_id"), F.size("x").alias("dims")))["dims"]).first()[0]
    dims, most = first or 0, float(bound(first or 0))
    whole = F.transform("x", lambda c: F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), c * scale))))
    return x.where(F.size("x") == dims).select("vec_id", "label", whole.alias("v")), dims


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """A list column as rows of an int64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), dims)
