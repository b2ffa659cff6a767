"""Helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(col: str = "embedding") -> Column:
    """True where a vector is there, has only finite components, and is not zero."""
    ok = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(col).isNotNull() & F.coalesce(ok, F.lit(False)) & F.exists(col, lambda x: x != 0)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """List column without nulls -> rows of doubles; all vectors must be of one length."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    values = np.asarray(flat.flatten(), np.float64)
    if n and len(values) % n or len(set(np.diff(np.asarray(flat.offsets)).tolist())) > 1:
        raise ValueError("vectors of different lengths")
    return values.reshape(n, -1) if n else np.empty((0, 0))


def one_per_id(vectors: DataFrame, *more: str) -> DataFrame:
    """Usable vectors as (vec_id, embedding, *more): rows that repeat an id are one
    vector, the least of them; null ids are left out."""
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable()).withColumn("_row", F.struct("embedding", *more))
    return rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("_row").alias("r")).select(
        "vec_id", "r.embedding", *[f"r.{m}" for m in more])
