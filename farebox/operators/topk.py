"""Sorts, limits and top-k.

``orderBy(..).limit(n)`` is planned as TakeOrderedAndProject: every task
keeps its own n best rows and only those reach the final merge, so the sort
never gathers the table.  Ties are broken by the extra ``tie`` columns so the
answer is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(cols, desc: bool, nulls_first: bool) -> list[Column]:
    out = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        if desc:
            out.append(col.desc_nulls_first() if nulls_first else col.desc_nulls_last())
        else:
            out.append(col.asc_nulls_first() if nulls_first else col.asc_nulls_last())
    return out


def top_n(df: DataFrame, by: Sequence, n: int = 1, tie: Sequence = (),
          nulls_first: bool = False) -> DataFrame:
    """O2: descending top-n. ``nulls_first=True`` mimics engines that sort
    NULL first on DESC."""
    return df.orderBy(*_cols(by, True, nulls_first), *_cols(tie, False, True)).limit(n)


def bottom_n(df: DataFrame, by: Sequence, n: int = 1, tie: Sequence = ()) -> DataFrame:
    """O1: ascending top-n."""
    return df.orderBy(*_cols(by, False, True), *_cols(tie, False, True)).limit(n)


def ordered(df: DataFrame, *cols: Column | str) -> DataFrame:
    """O3: mixed multi-key order (pass ``F.desc(..)`` for descending keys)."""
    return df.orderBy(*cols)


def longest_streak(sessions: DataFrame, metric: str = "longest_streak",
                   keys: Sequence[str] = ("PULocationID", "DOLocationID"),
                   n: int = 1) -> DataFrame:
    """The pair(s) with the longest streak in the sink table."""
    return top_n(sessions, [metric], n, tie=list(keys))
