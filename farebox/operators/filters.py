"""Filters and predicates.

All are plain Catalyst predicates, so they reach the Parquet scan as pushed
filters (and as partition filters when they name a partition column).
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions.columns import days_ago, text_in


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """F1."""
    cond = None
    for c in cols:
        p = F.col(c).isNotNull()
        cond = p if cond is None else cond & p
    return df.filter(cond)


def on_day(df: DataFrame, ts: str, day: str) -> DataFrame:
    """``date(ts) = day``."""
    return df.filter(F.to_date(ts) == F.lit(day).cast("date"))


def in_period(df: DataFrame, ts: str, lo: str, hi: str, end_ts: str | None = None) -> DataFrame:
    """half-open ``lo <= date(ts) < hi``.  With ``end_ts`` the upper bound
    is tested on that column instead (pickup >= lo and dropoff < hi)."""
    upper = end_ts or ts
    return df.filter((F.to_date(ts) >= F.lit(lo).cast("date"))
                     & (F.to_date(upper) < F.lit(hi).cast("date")))


def between_days(df: DataFrame, ts: str, lo: str, hi: str) -> DataFrame:
    """inclusive day range on ``date(ts)``."""
    return df.filter(F.to_date(ts).between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))


def from_files(df: DataFrame, pattern: str, col: str = "filename") -> DataFrame:
    """SQL LIKE on the file-name column (``_`` and ``%`` are wildcards)."""
    return df.filter(F.col(col).like(pattern))


def text_filter(df: DataFrame, col: str, values: Iterable[str]) -> DataFrame:
    """``lower(trim(col)) IN values``."""
    return df.filter(text_in(col, values))


def resolve_days_back(days: int | None = None, env: str = "DAYS_BACK",
                      default: int = 30) -> int:
    """F9 precedence: explicit argument, then environment variable, then default."""
    if days is not None:
        return int(days)
    v = os.environ.get(env)
    return int(v) if v not in (None, "") else default


def recent_trips(df: DataFrame, ts: str = "pickup_datetime", days: int | None = None,
                 today: str | None = None) -> DataFrame:
    """rows with ``ts >= today - N days``; ``today`` is injectable for tests."""
    n = resolve_days_back(days)
    today_col = None if today is None else F.lit(today)
    return df.filter(F.col(ts) >= days_ago(n, today_col).cast("timestamp_ntz"))


def scan_between(spark: SparkSession, path: str, part_col: str, lo: str, hi: str,
                 ts: str | None = None, fmt: str = "parquet") -> DataFrame:
    """read a date-partitioned table for an inclusive day range.

    The predicate is put on the *partition column* so the planner prunes
    directories (PartitionFilters); when ``ts`` is given the same bounds are
    repeated on the timestamp as a row-group data filter.
    """
    df = spark.read.format(fmt).load(path)
    cond = F.col(part_col).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
    if ts:
        cond = cond & F.to_date(ts).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
    return df.filter(cond)
