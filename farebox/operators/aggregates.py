"""Aggregations.

Every grouped aggregate here is algebraic or has a mergeable buffer, so Spark
runs a partial aggregate before the shuffle and a hot key costs one row per
map task, not a third of the table in one task.  Exact percentiles select the
digits of the wanted ranks (``operators.percentiles``) and buffer no values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.functions.columns import (distance_bucket, hours_between,
                                       minute_boundaries, truncate_ts)
from farebox.operators.joins import name_zone


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """A1: ``count(*)``; needs no column, so the scan reads an empty schema."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def count_where(df: DataFrame, cond: Column, alias: str = "row_count") -> DataFrame:
    """A2: filtered count."""
    return df.filter(cond).agg(F.count(F.lit(1)).alias(alias))


def trips_by_distance(df: DataFrame, distance: str = "trip_distance",
                      label: str = "trip_distance", alias: str = "trips") -> DataFrame:
    """A3: trip count per distance bucket."""
    return (df.groupBy(distance_bucket(distance).alias(label))
            .agg(F.count(F.lit(1)).alias(alias)))


def distinct_count(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """A4: exact ``count(distinct col)``.  Planned as two aggregations (distinct
    keys first, partial on both sides), not one task holding every value."""
    return df.agg(F.count_distinct(F.col(col)).alias(alias or f"distinct_{col}"))


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5: min and max of each column in one row (``min_<c>``, ``max_<c>``)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def longest_trip_by_day(df: DataFrame, ts: str = "pickup_datetime",
                        distance: str = "trip_distance") -> DataFrame:
    """Max distance per pickup day."""
    return (df.groupBy(F.to_date(ts).alias("pickup_day"))
            .agg(F.max(distance).alias("max_trip_distance")))


def top_revenue_zones(df: DataFrame, zones: DataFrame, day: str, min_amount: float,
                      ts: str = "pickup_datetime", key: str = "PULocationID",
                      amount: str = "total_amount") -> DataFrame:
    """Per pickup zone sum of ``amount`` on one day above a threshold,
    aggregated before the (left) lookup join, as in the reference."""
    per_zone = (df.filter(F.to_date(ts) == F.lit(day).cast("date"))
                .groupBy(F.col(key).alias("pickup_location_id"))
                .agg(F.sum(amount).alias("total_amount"))
                .filter(F.col("total_amount") > min_amount))
    return (name_zone(per_zone, zones, "pickup_location_id", how="left")
            .select("zone_name", "total_amount"))


def monthly_zone_revenue(fact: DataFrame) -> DataFrame:
    """Revenue by pickup zone x month x service."""
    return (fact.groupBy(F.col("pickup_zone").alias("revenue_zone"),
                         truncate_ts("month", "pickup_datetime").alias("revenue_month"),
                         "service_type")
            .agg(F.sum("fare_amount").alias("revenue_monthly_fare"),
                 F.sum("extra").alias("revenue_monthly_extra"),
                 F.sum("mta_tax").alias("revenue_monthly_mta_tax"),
                 F.sum("tip_amount").alias("revenue_monthly_tip_amount"),
                 F.sum("tolls_amount").alias("revenue_monthly_tolls_amount"),
                 F.sum("ehail_fee").alias("revenue_monthly_ehail_fee"),
                 F.sum("improvement_surcharge").alias("revenue_monthly_improvement_surcharge"),
                 F.sum("total_amount").alias("revenue_monthly_total_amount"),
                 F.count("tripid").alias("total_monthly_trips"),
                 F.avg("passenger_count").alias("avg_monthly_passenger_count"),
                 F.avg("trip_distance").alias("avg_monthly_trip_distance")))


def quarterly_revenue(fact: DataFrame, ts: str = "pickup_datetime",
                      amount: str = "total_amount") -> DataFrame:
    """Sum of ``amount`` per service x year x quarter (GROUP BY ALL)."""
    return (fact.groupBy("service_type", F.year(ts).alias("year"),
                         F.quarter(ts).alias("quarter"))
            .agg(F.sum(amount).alias("total_amount")))


def avg_minutes(df: DataFrame, start: str, end: str, alias: str = "avg_minutes") -> DataFrame:
    """A10: average duration in minutes, counted as minute boundaries."""
    return df.agg(F.avg(minute_boundaries(start, end)).alias(alias))


def longest_hours(df: DataFrame, start: str, end: str,
                  alias: str = "longest_trip_hours") -> DataFrame:
    """Longest duration in whole hours (TIMESTAMPDIFF HOUR)."""
    return df.agg(F.max(hours_between(start, end)).alias(alias))


def best_worst_quarter(q: DataFrame, year: int | None = None,
                       metric: str = "yoy_growth") -> DataFrame:
    """Per service and year, the quarter with max and min ``metric``
    (``max_by`` / ``min_by``; NULL metrics are ignored)."""
    if year is not None:
        q = q.filter(F.col("year") == year)
    return (q.groupBy("service_type", "year")
            .agg(F.max_by("quarter", metric).alias("max_growth_quarter"),
                 F.min_by("quarter", metric).alias("min_growth_quarter")))


def least_frequent_zone(df: DataFrame, zones: DataFrame, key: str = "PULocationID",
                        n: int = 1) -> DataFrame:
    """A15 + O1: trip count per pickup zone, named, fewest first (tie: id)."""
    counts = df.groupBy(F.col(key).alias(key)).agg(F.count(F.lit(1)).alias("trips_count"))
    named = name_zone(counts, zones, key, how="left", alias="Zone")
    return named.orderBy(F.col("trips_count").asc(), F.col(key).asc()).limit(n)


def group_percentiles(df: DataFrame, value: str, group: Sequence,
                      percentages: dict[str, float]) -> DataFrame:
    """Exact (continuous) percentiles, one row per group; no task holds a
    group's values (see ``percentiles``)."""
    from farebox.operators.percentiles import group_percentile_values
    named = {g: F.col(g) for g in group if isinstance(g, str)}
    if len(named) < len(group):
        raise ValueError("name computed group columns first")
    return group_percentile_values(df, value, list(named), percentages)


def rollup(df: DataFrame, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Precomputed aggregate (e.g. customer -> sum)."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])
