"""Equi joins: lookups to the zone dimension, anti and orphan joins.

A side is broadcast only while its estimated size is within a bound in bytes;
past the bound the join is left to the planner (sort-merge, AQE skew split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup whose estimated size exceeds this is joined as the planner decides.
BROADCAST_MAX_BYTES = 64 * 1024 ** 2


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` if the planner's size estimate is within ``max_bytes``.

    The estimate comes from the current file sizes each time, so a side that has
    grown loses the hint; no job is run for it.  Beyond the bound, or where the size is
    unknown (JDBC, aggregates), the join is left to the planner, which measures the
    side at run time.
    """
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001  remote session: no access to the plan
        return df
    return F.broadcast(df) if size <= max_bytes else df


def known_zones(zones: DataFrame, exclude=("Unknown",), col: str = "borough") -> DataFrame:
    """Drop zones whose borough is in ``exclude`` (``<>`` drops NULL boroughs too)."""
    cond = None
    for v in exclude:
        c = F.col(col) != v
        cond = c if cond is None else cond & c
    return zones if cond is None else zones.filter(cond)


def name_zone(df: DataFrame, zones: DataFrame, key: str, how: str = "left",
              name_col: str = "zone", alias: str = "zone_name") -> DataFrame:
    """Attach a zone name to ``df`` by its location id column ``key``."""
    z = bounded_broadcast(zones.select(F.col("locationid").alias("__zid"),
                                       F.col(name_col).alias(alias)))
    return (df.join(z, df[key].try_cast("int") == F.col("__zid"), how)
            .drop("__zid"))


def with_zone_names(trips: DataFrame, zones: DataFrame, how: str = "left",
                    pickup_key: str = "pickup_locationid",
                    dropoff_key: str = "dropoff_locationid",
                    exclude_borough=None) -> DataFrame:
    """Role-playing joins to the zone dimension for pickup and dropoff.

    Adds pickup_borough, pickup_zone, dropoff_borough, dropoff_zone.  With
    ``exclude_borough`` the dimension is filtered first (J3 with ``inner``).
    """
    if exclude_borough:
        zones = known_zones(zones, exclude=exclude_borough)
    z = bounded_broadcast(zones.select("locationid", "borough", "zone"))
    pu = z.select(F.col("locationid").alias("__pu_id"),
                  F.col("borough").alias("pickup_borough"),
                  F.col("zone").alias("pickup_zone"))
    do = z.select(F.col("locationid").alias("__do_id"),
                  F.col("borough").alias("dropoff_borough"),
                  F.col("zone").alias("dropoff_zone"))
    return (trips
            .join(pu, trips[pickup_key].try_cast("int") == F.col("__pu_id"), how)
            .join(do, F.col(dropoff_key).try_cast("int") == F.col("__do_id"), how)
            .drop("__pu_id", "__do_id"))


def anti_join(source: DataFrame, target: DataFrame, keys) -> DataFrame:
    """Rows of ``source`` whose key is absent from ``target``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return source.join(target.select(*keys), keys, "left_anti")


def orphans(df: DataFrame, col: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null ``col`` has no match in ``dim[key]``."""
    d = dim.select(F.col(key).alias("__k"))
    return (df.filter(F.col(col).isNotNull())
            .join(d, F.col(col) == F.col("__k"), "left_anti"))
