"""Helpers shared by the operators: words, folds, Arrow batches, staged tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.session import scratch_path, shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words are runs of anything but the ASCII white space 0x20 and 0x09-0x0D.
SPACE_RUN = r"[\x20\x09-\x0D]+"


def text_or_empty(col: str | Column = "text") -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    return F.translate(col, UPPER, LOWER)


def words(col: Column) -> Column:
    """Array of words of a text (empty array for a text without any)."""
    return F.filter(F.split(col, SPACE_RUN), lambda w: w != "")


def fold(col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; -1 for a null id."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % F.lit(n), F.lit(-1))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that what a task holds
    beside its input batch stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


class Words(dict):
    """word -> 64-bit hash, computed when first met."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        h = self[word] = xxh64_intdigest(word)
        return h


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back: cuts lineage
    and survives lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


__all__ = ["Words", "ascii_lower", "fold", "shared_dir", "slices", "staged", "text_or_empty", "words"]
