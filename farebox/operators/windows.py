"""Window operators: dedupe, n-th per group, row-based lag, group percentiles
kept on every row (W1-W5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.operators.percentiles import group_percentile_values


def _order_cols(cols) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c).asc_nulls_first() for c in cols]


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence | None = None) -> DataFrame:
    """Keep one row per key, the first under a total order.

    The reference leaves the pick unordered; here the order is total (the
    given columns, then every other column, ascending, NULLs first), so the
    result is deterministic.

    With ascending column names (the default) this is ``min(struct(...))``
    per key: a partial aggregate that sorts on the key only and cuts a hot key
    to one row per map task before the shuffle.  An order with Column
    expressions (e.g. descending) uses ``row_number() = 1``, which Spark also
    pre-limits per task (partial WindowGroupLimit).
    """
    order = list(order_by or [])
    if all(isinstance(c, str) for c in order):
        rest = [c for c in df.columns if c not in keys and c not in order]
        first = (df.groupBy(*keys)
                 .agg(F.min(F.struct(*order, *rest)).alias("__first")))
        return first.select(*[F.col(c) if c in keys else F.col(f"__first.{c}")
                              for c in df.columns])
    named = {c for c in order if isinstance(c, str)}
    rest = [c for c in df.columns if c not in keys and c not in named]
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order + rest))
    return (df.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).drop("__rn"))


def nth_in_group(df: DataFrame, group: Sequence[str], order_by: Sequence[Column],
                 n: int, rank_col: str | None = None) -> DataFrame:
    """W2 + F10: the n-th row per group under ``order_by`` (row_number = n)."""
    w = Window.partitionBy(*group).orderBy(*order_by)
    name = rank_col or "__rn"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) == n)
    return out if rank_col else out.drop(name)


def lag_rows(df: DataFrame, col: str, offset: int, partition: Sequence[str],
             order: Sequence[str], alias: str) -> DataFrame:
    """``lag(col, offset)`` counted in rows (a missing period shifts it)."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(alias, F.lag(col, offset).over(w))


def lag_calendar(df: DataFrame, col: str, keys: Sequence[str], year: str,
                 alias: str) -> DataFrame:
    """W3 variant: value of the same period one year earlier, NULL when that period
    is missing: a window over the period's years, framed to exactly the year before."""
    w = Window.partitionBy(*[k for k in keys if k != year]).orderBy(year).rangeBetween(-1, -1)
    return df.withColumn(alias, F.max(col).over(w))


def group_percentiles_on_rows(df: DataFrame, value: str, group: Sequence[str],
                              percentages: dict[str, float]) -> DataFrame:
    """``percentile_cont(value, p) OVER (PARTITION BY group)`` on every row.

    The percentiles of the groups are found without holding a group's values
    anywhere (``percentiles``), from a scan of the group and value columns alone, and
    joined back on the group key with a NULL-safe equality, as PARTITION BY groups NULLs together.  The
    per-group side carries no broadcast hint: AQE turns the join into a broadcast if it is
    small, and otherwise keeps the sort-merge join and splits skewed partitions.
    """
    per_group = group_percentile_values(df, value, group, percentages)
    keys = [f"__g{i}" for i in range(len(group))]
    per_group = per_group.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], *percentages)
    cond = [df[g].eqNullSafe(per_group[k]) for g, k in zip(group, keys)]
    return df.join(per_group, cond, "left").drop(*keys)
