"""Warehouse models M1-M12: staging views, dimensions, fact table, marts.

Each model is a function DataFrame -> DataFrame; calling them in order is
the dependency graph.  ``build`` (sinks) materialises one as a view or table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions.columns import (payment_description, pct_growth, safe_int,
                                       seconds_between, surrogate_key, text_in,
                                       to_num, to_ts)
from farebox.operators import aggregates as agg
from farebox.operators.filters import in_period
from farebox.operators.joins import with_zone_names
from farebox.operators.topk import top_n
from farebox.operators.windows import (dedupe, group_percentiles_on_rows,
                                       lag_calendar, lag_rows, nth_in_group)

FACT_COLUMNS = [
    "tripid", "vendorid", "service_type", "ratecodeid", "pickup_locationid",
    "pickup_borough", "pickup_zone", "dropoff_locationid", "dropoff_borough",
    "dropoff_zone", "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag",
    "passenger_count", "trip_distance", "trip_type", "fare_amount", "extra",
    "mta_tax", "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge",
    "total_amount", "payment_type", "payment_type_description",
]

STAGING_COLUMNS = [c for c in FACT_COLUMNS if c not in (
    "service_type", "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")]


def _stg_trips(raw: DataFrame, prefix: str, yellow: bool) -> DataFrame:
    pickup, dropoff = f"{prefix}_pickup_datetime", f"{prefix}_dropoff_datetime"
    keyed = raw.filter(F.col("VendorID").isNotNull())
    rows = dedupe(keyed, ["VendorID", pickup])
    return rows.select(
        surrogate_key("VendorID", pickup).alias("tripid"),
        safe_int("VendorID").alias("vendorid"),
        safe_int("RatecodeID").alias("ratecodeid"),
        safe_int("PULocationID").alias("pickup_locationid"),
        safe_int("DOLocationID").alias("dropoff_locationid"),
        to_ts(pickup).alias("pickup_datetime"),
        to_ts(dropoff).alias("dropoff_datetime"),
        F.col("store_and_fwd_flag"),
        safe_int("passenger_count").alias("passenger_count"),
        to_num("trip_distance").alias("trip_distance"),
        (F.lit(1) if yellow else safe_int("trip_type")).alias("trip_type"),
        to_num("fare_amount").alias("fare_amount"),
        to_num("extra").alias("extra"),
        to_num("mta_tax").alias("mta_tax"),
        to_num("tip_amount").alias("tip_amount"),
        to_num("tolls_amount").alias("tolls_amount"),
        to_num(F.lit(0) if yellow else F.col("ehail_fee")).alias("ehail_fee"),
        to_num("improvement_surcharge").alias("improvement_surcharge"),
        to_num("total_amount").alias("total_amount"),
        F.coalesce(safe_int("payment_type"), F.lit(0)).alias("payment_type"),
        payment_description("payment_type").alias("payment_type_description"),
    )


def stg_green(raw: DataFrame) -> DataFrame:
    """M1: non-null vendor, one row per (vendor, pickup), typed and renamed."""
    return _stg_trips(raw, "lpep", yellow=False)


def stg_yellow(raw: DataFrame) -> DataFrame:
    """M2: as M1; yellow trips are street-hail (trip_type 1) with no e-hail fee."""
    return _stg_trips(raw, "tpep", yellow=True)


def stg_fhv(raw: DataFrame) -> DataFrame:
    """M3: non-null dispatching base, typed; no dedupe."""
    return (raw.filter(F.col("dispatching_base_num").isNotNull())
            .select("dispatching_base_num",
                    F.col("Affiliated_base_number").alias("affiliated_base_number"),
                    surrogate_key("dispatching_base_num", "pickup_datetime").alias("tripid"),
                    safe_int("PUlocationID").alias("pickup_locationid"),
                    safe_int("DOlocationID").alias("dropoff_locationid"),
                    F.col("SR_Flag").alias("sr_flag"),
                    to_ts("pickup_datetime").alias("pickup_datetime"),
                    to_ts("dropOff_datetime").alias("dropoff_datetime")))


def dim_zones(zones: DataFrame) -> DataFrame:
    """M4: zone dimension with 'Boro' service zones renamed to 'Green'."""
    return zones.select("locationid", "borough", "zone",
                        F.replace(F.col("service_zone"), F.lit("Boro"), F.lit("Green"))
                        .alias("service_zone"))


def with_service(df: DataFrame, name: str, col: str = "service_type") -> DataFrame:
    """Constant service column."""
    return df.withColumn(col, F.lit(name))


def union_services(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """UNION ALL of staged green and yellow trips (same names and order)."""
    return with_service(green, "Green").unionByName(with_service(yellow, "Yellow"))


def fact_trips(green: DataFrame, yellow: DataFrame, zones: DataFrame,
               exclude_borough: Iterable[str] = ("Unknown",)) -> DataFrame:
    """M5: union of staged green and yellow trips, inner-joined to the known
    zones for pickup and dropoff (zones are a size-checked broadcast)."""
    trips = union_services(green, yellow)
    joined = with_zone_names(trips, dim_zones(zones), how="inner",
                             exclude_borough=list(exclude_borough))
    return joined.select(*FACT_COLUMNS)


def dim_fhv_trips(fhv: DataFrame, zones: DataFrame,
                  exclude_borough: Iterable[str] = ("Unknown",)) -> DataFrame:
    """M6: staged FHV trips with calendar columns and known zones."""
    t = fhv.withColumns({"pickup_year": F.year("pickup_datetime"),
                         "pickup_month": F.month("pickup_datetime")})
    joined = with_zone_names(t, dim_zones(zones), how="inner",
                             exclude_borough=list(exclude_borough))
    return joined.select("tripid", "dispatching_base_num", "affiliated_base_number",
                         "sr_flag", "pickup_year", "pickup_month", "pickup_datetime",
                         "dropoff_datetime", "pickup_locationid", "pickup_borough",
                         "pickup_zone", "dropoff_locationid", "dropoff_borough",
                         "dropoff_zone")


def dm_monthly_zone_revenue(fact: DataFrame) -> DataFrame:
    """M7."""
    return agg.monthly_zone_revenue(fact)


def fct_quarterly_revenue(fact: DataFrame, calendar: bool = False) -> DataFrame:
    """M8: quarterly revenue with year-over-year growth in percent.

    Parity default: ``lag(total, 4)`` over rows, so a missing quarter shifts
    the base; ``calendar=True`` compares with the same quarter a year earlier.
    """
    q = agg.quarterly_revenue(fact)
    if calendar:
        q = lag_calendar(q, "total_amount", ["service_type", "year", "quarter"], "year",
                         "total_amount_prev_year")
    else:
        q = lag_rows(q, "total_amount", 4, ["service_type"], ["year", "quarter"],
                     "total_amount_prev_year")
    return q.withColumn("yoy_growth", pct_growth("total_amount", "total_amount_prev_year"))


FARE_PERCENTILES = {"p97": 0.97, "p95": 0.95, "p90": 0.90}


def fct_monthly_fare_percentiles(fact: DataFrame,
                                 payments: Iterable[str] = ("Cash", "Credit card"),
                                 percentages: dict | None = None) -> DataFrame:
    """M9: continuous fare percentiles per service x year x month, for paid
    trips (fare > 0, distance > 0) by cash or card."""
    prep = (fact.filter((F.col("fare_amount") > 0) & (F.col("trip_distance") > 0)
                        & text_in("payment_type_description", payments))
            .withColumns({"pickup_year": F.year("pickup_datetime"),
                          "pickup_month": F.month("pickup_datetime")}))
    return agg.group_percentiles(prep, "fare_amount",
                                 ["service_type", "pickup_year", "pickup_month"],
                                 percentages or FARE_PERCENTILES)


def fct_fhv_traveltime_p90(dim_fhv: DataFrame) -> DataFrame:
    """Every FHV trip with its duration in seconds and the p90 duration of
    its (year, month, pickup zone, dropoff zone) group."""
    t = dim_fhv.withColumn("trip_duration",
                           seconds_between("pickup_datetime", "dropoff_datetime"))
    return group_percentiles_on_rows(
        t, "trip_duration",
        ["pickup_year", "pickup_month", "pickup_locationid", "dropoff_locationid"],
        {"p90": 0.90})


def second_longest_dropoff(p90: DataFrame, pickup_zones: Iterable[str] | None,
                           year: int | None, month: int | None, n: int = 2) -> DataFrame:
    """Per pickup zone, the dropoff zone with the n-th largest p90
    (distinct rows first; ties on p90 broken by dropoff zone)."""
    f = p90
    if pickup_zones is not None:
        f = f.filter(text_in("pickup_zone", pickup_zones))
    if year is not None:
        f = f.filter(F.col("pickup_year") == year)
    if month is not None:
        f = f.filter(F.col("pickup_month") == month)
    f = f.select("pickup_year", "pickup_month", "pickup_zone", "dropoff_zone", "p90").distinct()
    return nth_in_group(f, ["pickup_year", "pickup_month", "pickup_zone"],
                        [F.col("p90").desc_nulls_last(), F.col("dropoff_zone").asc_nulls_first()],
                        n, rank_col="p90_rank")


def largest_tip_dropoff(trips: DataFrame, zones: DataFrame, pickup_zone: str | None,
                        lo: str, hi: str, ts: str = "pickup_datetime", n: int = 1) -> DataFrame:
    """Dropoff zone(s) with the largest tip for pickups in a zone within
    [lo, hi) (two left lookups, then a top-n)."""
    t = in_period(trips, ts, lo, hi)
    named = with_zone_names(t, zones, how="left", pickup_key="PULocationID",
                            dropoff_key="DOLocationID")
    if pickup_zone is not None:
        named = named.filter(F.col("pickup_zone") == pickup_zone)
    return top_n(named.select("pickup_zone", "dropoff_zone", "tip_amount"),
                 ["tip_amount"], n, tie=["pickup_zone", "dropoff_zone"])


def staged_fact(green_raw: DataFrame, yellow_raw: DataFrame, zones: DataFrame) -> DataFrame:
    """Raw green + yellow + zones -> fact_trips (M1, M2, M4, M5)."""
    return fact_trips(stg_green(green_raw), stg_yellow(yellow_raw), zones)


def build_all(green_raw: DataFrame, yellow_raw: DataFrame, fhv_raw: DataFrame,
              zones: DataFrame, as_: str = "table", prefix: str = "") -> dict[str, DataFrame]:
    """Materialise every model in dependency order: staging as views, core and
    marts as tables (``as_='view'`` keeps everything lazy).  Returns them by name.

    A later model reads the table its parent was written to, so each model is
    computed once and lineage is cut at every table.
    """
    from farebox.sinks.files import build

    def make(name, df, kind):
        return build(df, prefix + name, as_=kind if as_ == "table" else "view")

    out = {}
    out["dim_zones"] = make("dim_zones", dim_zones(zones), "table")
    out["stg_green_tripdata"] = make("stg_green_tripdata", stg_green(green_raw), "view")
    out["stg_yellow_tripdata"] = make("stg_yellow_tripdata", stg_yellow(yellow_raw), "view")
    out["stg_fhv_tripdata"] = make("stg_fhv_tripdata", stg_fhv(fhv_raw), "view")
    # Dimension already renamed: join the fact to the known zones directly.
    fact = fact_trips(out["stg_green_tripdata"], out["stg_yellow_tripdata"], zones)
    out["fact_trips"] = make("fact_trips", fact, "table")
    out["dim_fhv_trips"] = make("dim_fhv_trips", dim_fhv_trips(out["stg_fhv_tripdata"], zones),
                                "table")
    f = out["fact_trips"]
    out["dm_monthly_zone_revenue"] = make("dm_monthly_zone_revenue",
                                          dm_monthly_zone_revenue(f), "table")
    out["fct_taxi_trips_quarterly_revenue"] = make(
        "fct_taxi_trips_quarterly_revenue", fct_quarterly_revenue(f), "table")
    out["fct_taxi_trips_monthly_fare_p95"] = make(
        "fct_taxi_trips_monthly_fare_p95", fct_monthly_fare_percentiles(f), "table")
    out["fct_fhv_monthly_zone_traveltime_p90"] = make(
        "fct_fhv_monthly_zone_traveltime_p90", fct_fhv_traveltime_p90(out["dim_fhv_trips"]),
        "table")
    return out

