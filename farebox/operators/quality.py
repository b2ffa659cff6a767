"""Declarative data-quality checks.

A check is a name, a DataFrame of failing rows and a severity, together with what
it asks of a row or of a key.  ``run_checks`` folds all checks on one DataFrame into
one pass: what is asked of a row (not null, accepted values, foreign keys) becomes a
conditional sum, a dimension is joined once for each column as a flag, and the first
uniqueness check groups the same pass by its key.  The report (check, failures,
severity, status) is one job with nothing collected on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.operators.joins import bounded_broadcast, orphans


@dataclass
class Check:
    """``failing`` has a row for each failure; ``on`` with one of ``cond`` (failing rows),
    ``unique`` (a column) or ``refers`` (column, dimension, key) says the same for folding."""

    name: str
    failing: DataFrame
    severity: str = "error"
    on: DataFrame | None = None
    cond: Column | None = None
    unique: str | None = None
    refers: tuple[str, DataFrame, str] | None = None


def _name(model: str, test: str) -> str:
    return f"{model}.{test}" if model else test


def check_unique(df: DataFrame, col: str, severity: str = "error", model: str = "") -> Check:
    """Values of ``col`` that occur more than once (one failing row per value)."""
    dup = (df.filter(F.col(col).isNotNull()).groupBy(col)
           .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
    return Check(_name(model, f"unique_{col}"), dup, severity, df, unique=col)


def check_not_null(df: DataFrame, col: str, severity: str = "error", model: str = "") -> Check:
    """D2."""
    return Check(_name(model, f"not_null_{col}"), df.filter(F.col(col).isNull()), severity, df, F.col(col).isNull())


def check_relationship(df: DataFrame, col: str, dim: DataFrame, key: str,
                       severity: str = "error", model: str = "") -> Check:
    """D3: non-null ``col`` values without a match in ``dim[key]`` (anti join)."""
    return Check(_name(model, f"relationships_{col}"), orphans(df, col, dim, key), severity, df, refers=(col, dim, key))


def check_accepted(df: DataFrame, col: str, values: Iterable, severity: str = "error",
                   model: str = "") -> Check:
    """Non-null values outside the accepted list."""
    outside = F.col(col).isNotNull() & ~F.col(col).isin(list(values))
    return Check(_name(model, f"accepted_values_{col}"), df.filter(outside), severity, df, outside)


def _folded(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row with a column ``f<i>`` for each check, in one pass over ``df``."""
    fails, rows = {}, df
    flags: dict[tuple, str] = {}
    for i, c in enumerate(checks):
        if c.cond is not None:
            fails[f"f{i}"] = c.cond
        elif c.refers is not None:
            col, dim, key = c.refers
            flag = flags.get((col, id(dim), key))
            if flag is None:
                flag = flags[col, id(dim), key] = f"__known{i}"
                keys = dim.select(F.col(key).alias(f"__key{i}"), F.lit(True).alias(flag)).filter(F.col(f"__key{i}").isNotNull()).distinct()
                rows = rows.join(bounded_broadcast(keys), F.col(col) == F.col(f"__key{i}"), "left")
            fails[f"f{i}"] = F.col(col).isNotNull() & F.col(flag).isNull()
    sums = [F.count_if(c).alias(f) for f, c in fails.items()]
    unique = [i for i, c in enumerate(checks) if c.unique is not None]
    if not unique:
        return rows.agg(*sums)
    first, key = unique[0], checks[unique[0]].unique
    by_key = rows.groupBy(F.col(key).alias("__unique")).agg(F.count(F.lit(1)).alias("__n"), *sums)
    return by_key.agg(F.count_if(F.col("__unique").isNotNull() & (F.col("__n") > 1)).alias(f"f{first}"),
                      *[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in fails])


def run_checks(checks: Iterable[Check]) -> DataFrame:
    """Report with one row per check; status pass / warn / error.

    Checks on one DataFrame (the same object) are one pass; a further uniqueness check on
    it, and a check that only has failing rows, is a pass of its own.
    """
    groups: dict[int, list[Check]] = {}
    alone: list[Check] = []
    for c in checks:
        if c.on is None or c.unique is not None and any(o.unique is not None for o in groups.get(id(c.on), [])):
            alone.append(c)
        else:
            groups.setdefault(id(c.on), []).append(c)
    parts = []
    for folded in groups.values():
        rows = F.array(*[F.struct(F.lit(c.name).alias("check"), F.col(f"f{i}").cast("bigint").alias("failures"),
                                  F.lit(c.severity).alias("severity")) for i, c in enumerate(folded)])
        parts.append(_folded(folded[0].on, folded).select(F.inline(rows)))
    for c in alone:
        parts.append(c.failing.agg(F.lit(c.name).alias("check"), F.count(F.lit(1)).cast("bigint").alias("failures"),
                                   F.lit(c.severity).alias("severity")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity")))


def failed(report: DataFrame, level: str = "error") -> DataFrame:
    """Rows of a report whose status is ``level``."""
    return report.filter(F.col("status") == level)


def reconcile(source: DataFrame, loaded: DataFrame) -> DataFrame:
    """One row with both counts and whether they agree.

    Both sides are tagged and counted in a single aggregate over their union
    (no join); each side is scanned with an empty projection.
    """
    tagged = (source.select(F.lit(1).alias("__s"), F.lit(0).alias("__l"))
              .unionByName(loaded.select(F.lit(0).alias("__s"), F.lit(1).alias("__l"))))
    counts = tagged.agg(F.sum("__s").cast("bigint").alias("source_rows"),
                        F.sum("__l").cast("bigint").alias("loaded_rows"))
    return counts.select(
        F.coalesce("source_rows", F.lit(0).cast("bigint")).alias("source_rows"),
        F.coalesce("loaded_rows", F.lit(0).cast("bigint")).alias("loaded_rows"),
        F.when(F.coalesce("source_rows", F.lit(0)) == F.coalesce("loaded_rows", F.lit(0)),
               "match").otherwise("mismatch").alias("status"))
