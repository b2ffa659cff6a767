"""Exact continuous percentiles by group, by selecting digits of the values' order.

A double becomes a 64-bit number that sorts as it does (its IEEE bits, built from exact
powers of two).  Values are counted by (group, value) in one shuffle that spreads a hot group
over its values.  Then the number is read from the left in ``DIGITS`` steps: counts by
(group, digit) and a prefix sum tell which digits hold a wanted rank, and only values below
those digits are looked at in the next step.  After the last digit they are single values.

No task sees more of a group than the counts of one step's digits, at most two digits for
each percentage stay open a group, and nothing runs or is written while the plan is built:
all steps read the same exchange of the counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits read in each step, from the left.  They fix the size of a step, not the result.
DIGITS = (24, 20, 20)

_MANTISSA = 2.0 ** 52


def order_key(value: Column) -> Column:
    """A bigint that sorts as the double does: -0 with 0, NaN after infinity; null for null."""
    size = F.abs(value)
    two = F.lit(2.0)
    guess = F.floor(F.log2(size))
    # the logarithm may be off by one next to a power of two; powers of two are exact
    exponent = (guess + F.when(F.pow(two, guess + 1) <= size, 1).when(F.pow(two, guess) > size, -1).otherwise(0))
    whole = (exponent + 1022).cast("bigint") * F.lit(2 ** 52) + (size / F.pow(two, exponent) * F.lit(_MANTISSA)).cast("bigint")
    bits = (F.when(size == 0, F.lit(0))
            .when(size < 2.0 ** -1022, (size * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("bigint"))
            .when(size == float("inf"), F.lit(0x7FF << 52)).otherwise(whole))
    return F.when(F.isnan(value), F.lit(0x7FF8 << 48)).when(value < 0, -bits).otherwise(bits)


def _joined(rows: DataFrame, opened: DataFrame, keys: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """``rows`` whose ``keys`` are open, with the opened cells' ``extra`` columns."""
    named = opened.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(keys)], *extra)
    same = [rows[k].eqNullSafe(named[f"__r{i}"]) for i, k in enumerate(keys)]
    return rows.join(named, same).drop(*[f"__r{i}" for i in range(len(keys))])


def group_percentile_values(df: DataFrame, value: str, group: Sequence[str],
                            percentages: dict[str, float]) -> DataFrame:
    """One row for each group (NULLs are one group): the group columns and a column for
    each percentage, linearly interpolated; NULL for a group without values."""
    group = list(group)
    counts = df.groupBy(*group, F.col(value).cast("double").alias("__v")).agg(F.count(value).alias("__c"))
    key, left = order_key(F.col("__v")), 64
    digits = {}
    for i, bits in enumerate(DIGITS):
        left -= bits
        digits[f"__d{i}"] = F.shiftright(key, left) if i == 0 else F.shiftright(key, left).bitwiseAND(F.lit(2 ** bits - 1))
    rows = counts.withColumns(digits)
    at = {name: F.lit(float(p)) * (F.col("__n") - 1) for name, p in percentages.items()}

    def holds(rank: Column) -> Column:
        return (F.col("__from") <= rank) & (rank < F.col("__from") + F.col("__size"))

    # a group without values has no rank: its one cell, of size 0, is carried along
    kept = F.col("__n") == 0
    for c in at.values():
        kept = kept | holds(F.floor(c)) | holds(F.ceil(c))
    opened, prefix = None, []
    for i, d in enumerate(digits):
        inside = rows if opened is None else _joined(rows, opened, [*group, *prefix], ["__n", "__from"])
        above = [] if opened is None else ["__n", "__from"]
        cells = inside.groupBy(*group, *prefix, d, *above).agg(F.sum("__c").alias("__size"), F.max("__v").alias("__v"))
        peers = Window.partitionBy(*group, *prefix)
        upto = F.sum("__size").over(peers.orderBy(F.col(d).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
        base = F.lit(0) if opened is None else F.col("__from")
        new = {"__from": base + upto - F.col("__size")}
        if opened is None:
            new["__n"] = F.sum("__size").over(peers)
        prefix.append(d)
        opened = cells.withColumns(new).filter(kept)

    def value_at(rank: Column) -> Column:
        return F.max(F.when(holds(rank), F.col("__v")))

    picked = opened.groupBy(*group).agg(F.max("__n").alias("__n"), *[
        value_at(f(c)).alias(f"__{end}_{name}") for name, c in at.items() for f, end in ((F.floor, "lo"), (F.ceil, "hi"))])
    return picked.select(*group, *[
        F.when(F.floor(c) == F.ceil(c), F.col(f"__lo_{name}")).otherwise(
            (F.ceil(c) - c) * F.col(f"__lo_{name}") + (c - F.floor(c)) * F.col(f"__hi_{name}")).alias(name)
        for name, c in at.items()])
