"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each builds its inputs from the given tables (fixtures), runs the package
operator and normalises the output for comparison: money rounded to 2 digits
and averages/percentiles to 4, as double; counts and ids as bigint.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox import fixtures as fx
from farebox.functions import columns as X
from farebox.operators import aggregates as A
from farebox.operators import filters as FL
from farebox.operators import quality as Q
from farebox.operators.topk import top_n
from farebox.plans import models as M
from farebox.sinks.files import stage

# Query parameters (fixed so the oracle SQL can use the same values).
DAY = "1996-03-15"
DAY_MIN_AMOUNT = 20000.0
PERIOD = ("1996-01-01", "1999-01-01")
TIP_PERIOD = ("1996-10-01", "1996-11-01")
TIP_ZONE = "NATION_13"
RANGE_DAYS = ("1997-06-01", "1997-06-15")
BEST_YEAR = 1997
RECENT_TODAY = "2001-08-01"
RECENT_DAYS = 400
LIKE_PATTERN = "green_tripdata_1996-%"


def money(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 2).cast("double")


def ratio(c, digits: int = 4) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits)


def big(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("bigint")


_MONEY_COLS = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
               "ehail_fee", "improvement_surcharge", "total_amount"]
_INT_COLS = ["vendorid", "ratecodeid", "pickup_locationid", "dropoff_locationid",
             "passenger_count", "trip_type", "payment_type"]


def _norm_trip_cols(df: DataFrame) -> DataFrame:
    out = []
    for c in df.columns:
        if c in _MONEY_COLS:
            out.append(money(c).alias(c))
        elif c == "trip_distance":
            out.append(F.col(c).cast("double").alias(c))
        elif c in _INT_COLS:
            out.append(big(c).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


# ----------------------------------------------------------------- staging, core

def _fact(spark, d) -> DataFrame:
    t = fx.trips(spark, d)
    return M.staged_fact(fx.raw_service(t, "Green"), fx.raw_service(t, "Yellow"),
                         fx.zones(spark, d))


def q_stg_green(spark, d):
    """M1 (W1 P3-P7 X14 X20): staged green trips."""
    return _norm_trip_cols(M.stg_green(fx.green(spark, d)))


def q_stg_yellow(spark, d):
    """M2: staged yellow trips."""
    return _norm_trip_cols(M.stg_yellow(fx.yellow(spark, d)))


def q_stg_fhv(spark, d):
    """M3 (F1 P4 P5 X20): staged for-hire trips."""
    return _norm_trip_cols(M.stg_fhv(fx.fhv(spark, d)))


def q_dim_zones(spark, d):
    """M4 (P11 X12): zone dimension."""
    return M.dim_zones(fx.zones(spark, d)).withColumn("locationid", big("locationid"))


def q_fact_trips(spark, d):
    """M5 (U1 P6 J3 F8): fact table of green and yellow trips."""
    return _norm_trip_cols(_fact(spark, d))


def _dim_fhv(spark, d):
    return M.dim_fhv_trips(M.stg_fhv(fx.fhv(spark, d)), fx.zones(spark, d))


def q_dim_fhv_trips(spark, d):
    """M6 (P10 J3 F8): for-hire trips with zones."""
    return _norm_trip_cols(_dim_fhv(spark, d)).withColumns(
        {"pickup_year": big("pickup_year"), "pickup_month": big("pickup_month")})


def q_monthly_zone_revenue(spark, d):
    """M7 (A8 A14 X3): monthly revenue per zone and service."""
    r = M.dm_monthly_zone_revenue(_fact(spark, d))
    return r.select(
        "revenue_zone", "revenue_month", "service_type",
        *[money(c).alias(c) for c in r.columns if c.startswith("revenue_monthly")],
        big("total_monthly_trips").alias("total_monthly_trips"),
        ratio("avg_monthly_passenger_count").alias("avg_monthly_passenger_count"),
        ratio("avg_monthly_trip_distance").alias("avg_monthly_trip_distance"))


def _quarterly(spark, d):
    return M.fct_quarterly_revenue(_fact(spark, d))


def q_quarterly_revenue_yoy(spark, d):
    """M8 (A9 W3 X18 X19): quarterly revenue, row-based YoY."""
    q = _quarterly(spark, d)
    return q.select("service_type", big("year").alias("year"), big("quarter").alias("quarter"),
                    money("total_amount").alias("total_amount"),
                    money("total_amount_prev_year").alias("total_amount_prev_year"),
                    ratio("yoy_growth").alias("yoy_growth"))


def q_best_worst_quarter(spark, d):
    """Quarter of max and min growth per service in one year."""
    r = A.best_worst_quarter(_quarterly(spark, d), BEST_YEAR)
    return r.select("service_type", big("year").alias("year"),
                    big("max_growth_quarter").alias("max_growth_quarter"),
                    big("min_growth_quarter").alias("min_growth_quarter"))


def q_monthly_fare_percentiles(spark, d):
    """M9 (A16 F5 F6 X2): fare p97/p95/p90 per month."""
    r = M.fct_monthly_fare_percentiles(_fact(spark, d))
    return r.select("service_type", big("pickup_year").alias("pickup_year"),
                    big("pickup_month").alias("pickup_month"),
                    *[ratio(p).alias(p) for p in M.FARE_PERCENTILES])


def _p90(spark, d):
    return M.fct_fhv_traveltime_p90(_dim_fhv(spark, d))


def q_fhv_traveltime_p90(spark, d):
    """M10 (W4 X5): p90 trip duration on every FHV trip."""
    r = _p90(spark, d)
    return r.select("tripid", "pickup_datetime", "dropoff_datetime",
                    big("pickup_year").alias("pickup_year"),
                    big("pickup_month").alias("pickup_month"),
                    big("pickup_locationid").alias("pickup_locationid"),
                    big("dropoff_locationid").alias("dropoff_locationid"),
                    big("trip_duration").alias("trip_duration"), ratio("p90").alias("p90"))


def q_second_longest_dropoff(spark, d):
    """M11 (W2 F10 A13): dropoff zone with the 2nd largest p90."""
    r = M.second_longest_dropoff(_p90(spark, d), None, None, None, n=2)
    return r.select(big("pickup_year").alias("pickup_year"),
                    big("pickup_month").alias("pickup_month"), "pickup_zone",
                    "dropoff_zone", ratio("p90").alias("p90"), big("p90_rank").alias("p90_rank"))


# ----------------------------------------------------------------- homework queries

def q_trips_by_distance(spark, d):
    """A3 (P8 F3): trips per distance bucket in a period."""
    t = FL.in_period(fx.trips(spark, d), "pickup_datetime", *PERIOD, end_ts="dropoff_datetime")
    return A.trips_by_distance(t).withColumn("trips", big("trips"))


def q_longest_trip_by_day(spark, d):
    """A6 + O2: pickup day with the longest trip."""
    r = A.longest_trip_by_day(fx.trips(spark, d))
    return top_n(r, ["max_trip_distance"], 1, tie=["pickup_day"])


def q_top_revenue_zones(spark, d):
    """A7 (J1 F2 F5): zones above a revenue threshold on one day."""
    r = A.top_revenue_zones(fx.trips(spark, d), fx.zones(spark, d), DAY, DAY_MIN_AMOUNT)
    return r.withColumn("total_amount", money("total_amount"))


def q_largest_tip_dropoff(spark, d):
    """M12 (J2 F3 O2): dropoff zone of the largest tip."""
    return M.largest_tip_dropoff(fx.trips(spark, d), fx.zones(spark, d), TIP_ZONE, *TIP_PERIOD)


def q_least_frequent_zone(spark, d):
    """A15 + O1: least frequent pickup zone."""
    r = A.least_frequent_zone(fx.trips(spark, d), fx.zones(spark, d))
    return r.select("PULocationID", big("trips_count").alias("trips_count"), "Zone")


def q_count_one_day(spark, d):
    """A1 + F2: trips on one day."""
    return A.row_count(FL.on_day(fx.trips(spark, d), "pickup_datetime", DAY))


def q_zero_fare_count(spark, d):
    """A2 + F5: trips with a zero fare."""
    return A.count_where(fx.trips(spark, d), F.col("fare_amount") == 0)


def q_row_count(spark, d):
    """A1: row count (footer-only scan)."""
    return A.row_count(fx.table(spark, d, "lineitem"))


_DISTINCT: dict[tuple[str, str], object] = {}


def _distinct_table(spark, d):
    """The bitmaps of vendors and pickup zones by day, made once and asked many times."""
    from farebox.sinks.rollups import scratch_distinct
    key = (fx.session_key(spark), d.rstrip("/"))
    if key not in _DISTINCT:
        _DISTINCT[key] = scratch_distinct(fx.trips(spark, d), F.col("pickup_datetime"),
                                          {"vendor": F.col("VendorID"), "pickup": F.col("PULocationID")})
    return _DISTINCT[key]


def q_distinct_pickups(spark, d):
    """A4: distinct pickup zones, from the bitmaps of all days."""
    return _distinct_table(spark, d).count(spark, "pickup", alias="distinct_pickups")


def q_distinct_vendors_range(spark, d):
    """A4 + F4: distinct vendors in an inclusive day range, from the days' bitmaps."""
    return _distinct_table(spark, d).count(spark, "vendor", *RANGE_DAYS, alias="distinct_vendors")


def q_distinct_vendors_scan(spark, d):
    """A4 + F4: the same count from the rows."""
    t = FL.between_days(fx.trips(spark, d), "pickup_datetime", *RANGE_DAYS)
    return A.distinct_count(t, "VendorID", "distinct_vendors")


PROFILE_COLS = ["pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
                "fare_amount", "tip_amount", "total_amount", "payment_type", "PULocationID"]


def q_profile_ranges(spark, d):
    """A5 (X22): min / max profile of nine columns."""
    return A.profile(fx.trips(spark, d), PROFILE_COLS)


def q_avg_minutes(spark, d):
    """A10 (X4): average duration in minute boundaries."""
    r = A.avg_minutes(fx.trips(spark, d, dropoff="shipdate"), "pickup_datetime",
                      "dropoff_datetime")
    return r.withColumn("avg_minutes", ratio("avg_minutes"))


def q_longest_hours(spark, d):
    """A11 (X6): longest duration in whole hours."""
    r = A.longest_hours(fx.trips(spark, d, dropoff="shipdate"), "pickup_datetime",
                        "dropoff_datetime")
    return r.withColumn("longest_trip_hours", big("longest_trip_hours"))


def q_recent_trips(spark, d):
    """F9 (X9): trips in the last N days before a fixed today."""
    r = FL.recent_trips(fx.trips(spark, d), "pickup_datetime", days=RECENT_DAYS,
                        today=RECENT_TODAY)
    return r.groupBy("service").agg(F.count(F.lit(1)).alias("trips"))


def _row_key_query(spark, d, width):
    t, out = fx.trips(spark, d), None
    for service in ("Green", "Yellow"):
        raw = fx.raw_service(t, service, keep_filename=True)
        key = X.row_key(X.row_key_fields(service, width))
        part = raw.select(key.alias("unique_row_id"), "filename")
        out = part if out is None else out.unionByName(part)
    return out


def q_row_key_7(spark, d):
    """K6 (X13-X16): 7-field row key."""
    return _row_key_query(spark, d, 7)


def q_row_key_5(spark, d):
    """K6: 5-field row key."""
    return _row_key_query(spark, d, 5)


def q_filename_like(spark, d):
    """rows of files matching a LIKE pattern."""
    return A.row_count(FL.from_files(fx.trips(spark, d), LIKE_PATTERN))


# ----------------------------------------------------------------- quality

# The accepted payment type codes of the staging tests.
PAYMENT_TYPE_VALUES = [1, 2, 3, 4, 5, 6]


def q_quality_report(spark, d):
    """D1-D5 + J5: the declared tests of the staging models and the revenue
    mart, with their severities, as one report."""
    t = fx.trips(spark, d)
    zones = fx.zones(spark, d)
    # each staged model is built once; the checks read the result
    green = stage(M.stg_green(fx.raw_service(t, "Green")), "stg_green")
    yellow = stage(M.stg_yellow(fx.raw_service(t, "Yellow")), "stg_yellow")
    checks = []
    for model, stg, dropoff_severity in (("stg_green_tripdata", green, "error"),
                                         ("stg_yellow_tripdata", yellow, "warn")):
        checks += [
            Q.check_unique(stg, "tripid", "warn", model),
            Q.check_not_null(stg, "tripid", "warn", model),
            Q.check_relationship(stg, "pickup_locationid", zones, "locationid", "warn", model),
            Q.check_relationship(stg, "dropoff_locationid", zones, "locationid",
                                 dropoff_severity, model),
            Q.check_accepted(stg, "payment_type", PAYMENT_TYPE_VALUES, "warn", model),
        ]
    mart = M.dm_monthly_zone_revenue(M.fact_trips(green, yellow, zones))
    checks.append(Q.check_not_null(mart, "revenue_monthly_total_amount", "error",
                                   "dm_monthly_zone_revenue"))
    return Q.run_checks(checks)


def q_reconcile_counts(spark, d):
    """Source and loaded row counts."""
    t = fx.trips(spark, d)
    return Q.reconcile(fx.table(spark, d, "lineitem"), t)


def q_customer_rollup(spark, d):
    """K12 + A17: precomputed sum per customer."""
    o = fx.table(spark, d, "orders")
    r = A.rollup(o, ["o_custkey"], {"total_price": F.sum("o_totalprice"),
                                    "orders": F.count(F.lit(1))})
    return r.select("o_custkey", money("total_price").alias("total_price"),
                    big("orders").alias("orders"))


def q_rollup_incremental(spark, d):
    """A rollup over yearly files of trips that is refreshed as they arrive: the files
    before 1998 first, then the others, then nothing new; states of all files are merged."""
    from farebox.session import scratch_path
    from farebox.sinks.rollups import Rollup
    root = scratch_path(spark, "rollup-incremental")
    t = fx.trips(spark, d).select("PULocationID", "pickup_datetime", "total_amount", "trip_distance")
    t.withColumn("year", F.year("pickup_datetime")).write.partitionBy("year").parquet(f"{root}/landing")
    amount = F.col("total_amount").cast("decimal(18,2)")
    rollup = Rollup(
        f"{root}/state", lambda s, paths: s.read.schema("PULocationID string, pickup_datetime timestamp_ntz, "
                                                        "total_amount double, trip_distance double").parquet(*paths),
        {"zone": F.col("PULocationID"), "month": F.date_format("pickup_datetime", "yyyy-MM")},
        {"trips": ("count", F.lit(1)), "total_amount": ("sum", amount), "shortest": ("min", F.col("trip_distance")),
         "longest": ("max", F.col("trip_distance")), "avg_distance": ("avg", F.col("trip_distance"))})
    early = [f"{root}/landing/year={y}" for y in range(1995, 1998)]
    every = f"{root}/landing"
    rollup.refresh(spark, early)
    rollup.refresh(spark, every)
    again = rollup.refresh(spark, every)
    if again.files:
        raise AssertionError(f"nothing was new, yet {again.files} files were read")
    r = rollup.read(spark, every)
    return r.select("zone", "month", big("trips").alias("trips"), money("total_amount").alias("total_amount"),
                    F.col("shortest").cast("double").alias("shortest"), F.col("longest").cast("double").alias("longest"),
                    ratio("avg_distance").alias("avg_distance"))


def q_scalar_text(spark, d):
    """Text functions and safe casts."""
    c = fx.table(spark, d, "customer")
    return c.select(
        "c_custkey",
        X.norm_text(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "))).alias("segment"),
        F.replace(F.col("c_name"), F.lit("Customer"), F.lit("Client")).alias("client_name"),
        X.safe_int(F.substring("c_name", 10, 9)).alias("name_number"),
        X.safe_int("c_mktsegment").alias("segment_number"),
        X.text_in(F.concat(F.lit(" "), F.upper("c_mktsegment")), ["building", "machinery"])
        .alias("is_listed"))


def q_scalar_datetime(spark, d):
    """Date parts, parsing, epoch ms, intervals."""
    o = fx.table(spark, d, "orders")
    ts = F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, F.col("o_orderdate"))
    text = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    ms = (F.unix_seconds(ts.cast("timestamp")) * 1000 + F.col("o_orderkey") % 1000)
    return o.select(
        "o_orderkey",
        F.to_date(ts).alias("order_date"),
        big(F.year(ts)).alias("order_year"),
        big(F.quarter(ts)).alias("order_quarter"),
        big(F.month(ts)).alias("order_month"),
        X.to_ts(text, "yyyy-MM-dd HH:mm:ss").alias("parsed_ts"),
        X.epoch_ms_to_ts(ms).cast("timestamp_ntz").alias("from_epoch_ms"),
        X.days_ago(30, F.to_date(ts)).alias("minus_30_days"),
        X.truncate_ts("month", ts).alias("month_start"))


def q_event_subset(spark, d):
    """P1 + P2: the listed event columns that exist."""
    from farebox.streaming.jobs import select_existing
    g = fx.green(spark, d)
    cols = ["lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID", "DOLocationID",
            "passenger_count", "trip_distance", "tip_amount", "not_a_column"]
    return select_existing(g, cols).withColumns(
        {"PULocationID": X.safe_int("PULocationID").cast("bigint"),
         "DOLocationID": X.safe_int("DOLocationID").cast("bigint"),
         "passenger_count": big("passenger_count")})


# ----------------------------------------------------------------- loads, layouts, pages

def q_monthly_load_idempotent(spark, d):
    """K8/K9: land every green and yellow month as CSV, backfill each service
    into an empty target, run the same backfill again (must insert nothing);
    per file the rows kept and their distinct keys."""
    from farebox.plans import loads as L
    from farebox.session import at_once, scratch_path
    root = scratch_path(spark, "monthly-load")
    t = fx.trips(spark, d, by_month=True)

    def loaded(service):
        raw = fx.raw_service(t, service.capitalize(), keep_filename=True)
        glob = L.write_monthly_files(raw, f"{root}/landing-{service}", service, arranged=True)
        target = f"{root}/{service}_tripdata"
        L.load_months(spark, service, glob, target)
        again = L.load_months(spark, service, glob, target)
        if again != 0:
            raise AssertionError(f"reload of {service} inserted {again} rows")
        return L.file_counts(spark.read.parquet(target))

    # one service's jobs take the slots that the last tasks of the other's leave
    green, yellow = at_once(spark, [lambda: loaded("green"), lambda: loaded("yellow")])
    return green.unionByName(yellow)


MERGE_TARGET_BEFORE = "1997-01-01"


def q_merge_insert_rows(spark, d):
    """All stamped rows of both services merged into targets that hold
    everything before 1997: the rows the MERGE would insert."""
    from farebox.plans import loads as L
    t, out = fx.trips(spark, d), None
    for service, pickup in (("Green", "lpep_pickup_datetime"), ("Yellow", "tpep_pickup_datetime")):
        raw = fx.raw_service(t, service, keep_filename=True)
        stamped = raw.withColumn("unique_row_id", X.row_key(X.row_key_fields(service, 7)))
        target = stamped.filter(F.col(pickup) < F.lit(MERGE_TARGET_BEFORE).cast("timestamp_ntz"))
        part = L.merge_insert(target, stamped).select("unique_row_id", "filename")
        out = part if out is None else out.unionByName(part)
    return out


def q_partitioned_day_range(spark, d):
    """Write trips partitioned by pickup day, clustered by zone, and
    scan a day range through partition pruning."""
    from farebox.session import scratch_path
    from farebox.sinks.files import write_partitioned
    path = scratch_path(spark, "trips-by-day")
    write_partitioned(fx.trips(spark, d).drop("l_suppkey", "l_partkey"), path,
                      "pickup_datetime", ["PULocationID"])
    r = FL.scan_between(spark, path, "pickup_date", *RANGE_DAYS, ts="pickup_datetime")
    return r.groupBy("pickup_date").agg(F.count(F.lit(1)).alias("trips"),
                                        money(F.sum("total_amount")).alias("total_amount"))


PAGE_SIZE_ORDERS = 1000


def rides(spark, d) -> DataFrame:
    """API rides derived from trips: page = 1 + orderkey div 1000."""
    t = fx.trip_rows(spark, d)
    pickup = F.timestamp_add("SECOND", F.col("l_orderkey") % 86400, F.col("o_orderdate"))
    return t.select(
        (F.lit(1) + F.floor(F.col("l_orderkey") / PAGE_SIZE_ORDERS)).cast("bigint")
        .alias("page_no"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ride_id"),
        pickup.alias("trip_pickup_date_time"),
        F.col("l_shipdate").alias("trip_dropoff_date_time"),
        F.col("l_extendedprice").alias("total_amt"))


def q_paged_rides(spark, d):
    """S9 + A10: rides landed as API pages, the last page empty, loaded up to the
    first empty page; ride count and average duration in minutes."""
    from farebox.session import scratch_path
    from farebox.sources.pages import land_pages, load_pages
    landing = scratch_path(spark, "pages")
    r = rides(spark, d)
    land_pages(r, landing, empty_pages=[r.agg(F.max("page_no")).first()[0]])
    loaded = load_pages(spark, landing)
    return loaded.agg(
        F.count(F.lit(1)).cast("bigint").alias("rides"),
        ratio(F.avg(X.minute_boundaries("trip_pickup_date_time", "trip_dropoff_date_time")))
        .alias("avg_minutes"))


# ----------------------------------------------------------------- files and tables

def _orders(spark, d):
    return fx.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


ORDER_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                             T.StructField("o_totalprice", T.DoubleType()),
                             T.StructField("o_orderdate", T.TimestampNTZType())])


def _landed_orders(spark, d, name, extra=False):
    """Orders as a CSV with header, optionally with one more field a row."""
    from farebox.session import scratch_path
    path = scratch_path(spark, name)
    o = _orders(spark, d).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    (o.withColumn("extra", F.lit("x")) if extra else o).write.option("header", True).csv(path)
    return path


def q_write_n_files(spark, d):
    """K1 + S1: orders written in four files and read back: files and rows."""
    from farebox.session import scratch_path
    from farebox.sinks.files import write_parquet
    from farebox.sources.files import read_parquet
    path = scratch_path(spark, "n-files")
    write_parquet(_orders(spark, d), path, 4)
    back = read_parquet(spark, path, ORDER_SCHEMA).withColumn("f", F.col("_metadata.file_path"))
    return back.agg(F.count_distinct("f").alias("files"), F.count(F.lit(1)).alias("rows"),
                    money(F.sum("o_totalprice")).alias("total_price"))


def q_create_if_missing(spark, d):
    """K3: create a table twice (the second time nothing happens) and fill it."""
    from farebox.session import scratch_path
    from farebox.sinks.files import ensure_table
    name = f"farebox_orders_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, "orders-once")
    ensure_table(spark, name, ORDER_SCHEMA, path=path)
    _orders(spark, d).write.insertInto(name)
    ensure_table(spark, name, ORDER_SCHEMA, path=path)
    out = spark.read.schema(ORDER_SCHEMA).parquet(path)
    spark.sql(f"DROP TABLE {name}")
    return out.select("o_orderkey", "o_custkey", money("o_totalprice").alias("o_totalprice"), "o_orderdate")


def q_replace_table(spark, d):
    """K4 + K10 + K12: a rollup built as a table over an older one, then a view on it."""
    from farebox.sinks.files import build, refresh_rollup, replace_table
    name = f"farebox_rollup_{uuid.uuid4().hex[:12]}"
    o = _orders(spark, d)
    replace_table(o.select("o_custkey").limit(1), name)
    refresh_rollup(o, ["o_custkey"], {"total_price": F.sum("o_totalprice"), "orders": F.count(F.lit(1))}, name)
    view = build(spark.table(name), f"{name}_view")
    return view.select("o_custkey", money("total_price").alias("total_price"), big("orders").alias("orders"))


def q_csv_all_text(spark, d):
    """A CSV whose columns stay text."""
    from farebox.sources.files import read_csv
    return read_csv(spark, _landed_orders(spark, d, "orders-text"), None).select("o_orderkey", "o_custkey", "o_orderdate")


def q_external_table(spark, d):
    """A table over a glob of files that stay where they are."""
    from farebox.session import scratch_path
    from farebox.sources.files import external_table
    path = scratch_path(spark, "orders-external")
    _orders(spark, d).repartition(3).write.parquet(path)
    t = external_table(spark, "farebox_orders_external", f"{path}/*.parquet")
    return t.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))


def q_csv_extra_fields(spark, d):
    """S5 + S6: typed CSV with one field too many a row, and a column list."""
    from farebox.sources.files import read_csv
    path = _landed_orders(spark, d, "orders-extra", extra=True)
    r = read_csv(spark, path, ORDER_SCHEMA, columns=["o_orderkey", "o_totalprice", "o_orderdate"])
    return r.select("o_orderkey", money("o_totalprice").alias("o_totalprice"), "o_orderdate")


def q_load_month(spark, d):
    """K8: one month of each service loaded twice (the second time nothing is
    inserted): rows and distinct keys by file."""
    from farebox.plans import loads as L
    from farebox.session import scratch_path
    root, t, out = scratch_path(spark, "load-month"), fx.trips(spark, d), None
    for service in ("green", "yellow"):
        raw = fx.raw_service(t, service.capitalize(), keep_filename=True)
        name = L.file_name(service, *LOAD_MONTH)
        L.write_monthly_files(raw.filter(F.col("filename") == name), f"{root}/{service}", service)
        src, target = f"{root}/{service}/filename={name}/*.csv*", f"{root}/{service}_tripdata"
        n = L.load_month(spark, service, *LOAD_MONTH, src, target)
        again = L.load_month(spark, service, *LOAD_MONTH, src, target)
        part = spark.read.parquet(target).groupBy("filename").agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("unique_row_id").alias("distinct_keys"))
        part = part.withColumns({"inserted": F.lit(n).cast("bigint"), "inserted_again": F.lit(again).cast("bigint")})
        out = part if out is None else out.unionByName(part)
    return out


LOAD_MONTH = (1996, 3)


def q_load_reconciliation(spark, d):
    """D6 + K8: one month of each service loaded twice; what each load read, staged,
    inserted and rejected, counted while it ran."""
    from farebox.plans import loads as L
    from farebox.session import scratch_path
    root, t, out = scratch_path(spark, "load-reconciliation"), fx.trips(spark, d), []
    for service in ("green", "yellow"):
        raw = fx.raw_service(t, service.capitalize(), keep_filename=True)
        name = L.file_name(service, *LOAD_MONTH)
        L.write_monthly_files(raw.filter(F.col("filename") == name), f"{root}/{service}", service)
        for run in (1, 2):
            r = L.load_month_report(spark, service, *LOAD_MONTH, f"{root}/{service}/filename={name}/*.csv*", f"{root}/{service}_tripdata")
            out.append((service, run, r.source, r.staged, r.inserted, r.rejected, r.status))
    return spark.createDataFrame(out, "service string, run int, source_rows bigint, staged_rows bigint, inserted_rows bigint, "
                                      "rejected_rows bigint, status string")


LOAD_BUCKETS = 8


def q_bucketed_load(spark, d):
    """K7 + K9: every green month backfilled twice into a target bucketed by the row key
    (the second time nothing is inserted): rows and distinct keys by file."""
    from farebox.plans import loads as L
    from farebox.session import scratch_path
    root = scratch_path(spark, "bucketed-load")
    raw = fx.raw_service(fx.trips(spark, d, by_month=True), "Green", keep_filename=True)
    glob = L.write_monthly_files(raw, f"{root}/landing", "green", arranged=True)
    table = f"green_tripdata_{uuid.uuid4().hex[:12]}"
    for run in (1, 2):
        r = L.load_months_bucketed(spark, "green", glob, table, f"{root}/target", LOAD_BUCKETS)
        if run == 2 and r.inserted:
            raise AssertionError(f"reload inserted {r.inserted} rows")
    return L.file_counts(spark.table(table))


def q_clustered_scan(spark, d):
    """K11 + F11: trips clustered by pickup and dropoff zone in turns; a scan of one dropoff
    zone, the second key, by pickup zone."""
    from farebox.session import scratch_path
    from farebox.sinks.files import write_clustered
    path = scratch_path(spark, "trips-clustered")
    t = fx.trips(spark, d).select("PULocationID", "DOLocationID", "total_amount")
    write_clustered(t, path, ["PULocationID", "DOLocationID"], files=16)
    r = spark.read.schema(t.schema).parquet(path).filter(F.col("DOLocationID") == CLUSTER_ZONE)
    return r.groupBy("PULocationID").agg(F.count(F.lit(1)).alias("trips"), money(F.sum("total_amount")).alias("total_amount"))


CLUSTER_ZONE = "7"


def q_quarter_label(spark, d):
    """P10: trips by calendar columns and the year/quarter label."""
    t = X.with_calendar(fx.trips(spark, d), "pickup_datetime")
    return t.groupBy(F.col("year_quarter").alias("year_quarter")).agg(F.count(F.lit(1)).alias("trips"))


def q_ordered_limit(spark, d):
    """O3 + O4 + O1: customers by balance descending and name ascending, the first
    hundred, and of those the lowest by name."""
    from farebox.operators.topk import bottom_n, ordered
    c = fx.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    first = ordered(c, F.desc("c_nationkey"), F.asc("c_name"), F.asc("c_custkey")).limit(100)
    return bottom_n(first, ["c_name"], 40, tie=["c_custkey"]).select("c_custkey", "c_name", big("c_nationkey").alias("c_nationkey"))


# ----------------------------------------------------------------- streaming

EVENT_MSG = T.StructType([T.StructField("test_data", T.LongType()),
                          T.StructField("event_type", T.StringType()),
                          T.StructField("event_timestamp", T.DoubleType())])


def _event_messages(spark, d) -> DataFrame:
    """events as the producer sends them: id, type, epoch ms as a float."""
    ev = fx.events(spark, d)
    return ev.select(F.col("event_id").alias("test_data"), "event_type",
                     (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1000.0))
                     .alias("event_timestamp"))


def _green_messages(spark, d, full: bool = False) -> DataFrame:
    """green trips as JSON-ready rows with text timestamps (7 or 20 fields)."""
    g = fx.green(spark, d)
    fmt = "yyyy-MM-dd HH:mm:ss"
    g = g.withColumns({"lpep_pickup_datetime": F.date_format("lpep_pickup_datetime", fmt),
                       "lpep_dropoff_datetime": F.date_format("lpep_dropoff_datetime", fmt)})
    if full:
        return g
    return g.select("lpep_pickup_datetime", "lpep_dropoff_datetime",
                    X.safe_int("PULocationID").alias("PULocationID"),
                    X.safe_int("DOLocationID").alias("DOLocationID"),
                    F.col("passenger_count").cast("string").alias("passenger_count"),
                    "trip_distance", "tip_amount")


def _stream_through(spark, name, messages: DataFrame, schema, build, sink_factory,
                    time_col: str | None = None, slices: int = 3, late: bool = False, closing_state: bool = False):
    """Publish ``messages`` as JSON lines, run ``build(decoded stream)`` into
    the sink until everything available is processed, return the sink.

    With ``time_col`` they are published in ``slices`` of event time and the stream is
    drained, stopped and restarted from its checkpoint after each, so that the sink
    merges into what it already holds; ``late`` publishes the first slice once more at
    the end, when all of it is behind the watermark.  ``closing_state`` keeps state in RocksDB,
    compacted by every batch."""
    from farebox.session import scratch_path
    from farebox.streaming import jobs as S
    root = scratch_path(spark, name)
    sink = sink_factory(f"{root}/sink")
    parts = [messages]
    if time_col:
        at = F.col(time_col) if messages.schema[time_col].dataType == T.DoubleType() else \
            F.unix_seconds(F.to_timestamp(time_col, "yyyy-MM-dd HH:mm:ss")).cast("double")
        # made once: the bounds and every slice read the staged messages
        messages.withColumn("__at", at).write.option("compression", "zstd").parquet(f"{root}/messages")
        timed = spark.read.parquet(f"{root}/messages")
        lo, hi = timed.agg(F.min("__at"), F.max("__at")).first()
        bounds = [] if lo is None else [lo + (hi - lo) * k / slices for k in range(1, slices)]
        slot = F.lit(0)
        for bound in bounds:
            slot = slot + F.when(F.col("__at") > bound, 1).otherwise(0)
        timed = timed.withColumn("__slot", slot)
        order = [*range(slices), *([0] if late else [])]
        parts = [timed.filter(F.col("__slot") == k).drop("__at", "__slot") for k in order]
    own = S.stream_session(spark, _parallelism(spark), closing_state=closing_state)
    for part in parts:
        S.publish_json(part, {"path": f"{root}/topic"})
        stream = S.read_json_stream(own, {"path": f"{root}/topic"}, schema)
        S.run_available(build(stream), sink, f"{root}/checkpoint", batches_path=f"{root}/batches")
    sink.batches_path = f"{root}/batches"
    return sink


def _parallelism(spark) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def q_passthrough_events(spark, d):
    """Events -> JSON messages -> stream -> append sink."""
    from farebox.streaming import jobs as S
    sink = _stream_through(spark, "passthrough-events", _event_messages(spark, d), EVENT_MSG,
                           S.passthrough_events, lambda p: S.AppendSink(p))
    return sink.read(spark)


def q_tumbling_counts(spark, d):
    """1-minute tumbling counts per event type, 1 s lateness."""
    from farebox.streaming import jobs as S

    def build(stream):
        return S.tumbling_counts(S.decode_test_events(stream), "event_watermark",
                                 "event_type", "1 minute", "1 second")
    sink = _stream_through(spark, "tumbling", _event_messages(spark, d), EVENT_MSG, build,
                           lambda p: S.AppendSink(p))
    return sink.read(spark).withColumn("num_hits", big("num_hits"))


def q_tumbling_late_rows(spark, d):
    """The same counts from three slices with a restart after each; the
    first slice comes again at the end and is dropped as late (``late_groups``: its windows
    by key, counted from the query's progress).  State is kept in RocksDB."""
    from farebox.streaming import jobs as S

    def build(stream):
        return S.tumbling_counts(S.decode_test_events(stream), "event_watermark",
                                 "event_type", "1 minute", "1 second")
    sink = _stream_through(spark, "tumbling-late", _event_messages(spark, d), EVENT_MSG, build,
                           lambda p: S.AppendSink(p), time_col="event_timestamp", late=True, closing_state=True)
    dropped = S.late_rows(spark, sink.batches_path).agg(F.sum("late_rows")).first()[0]
    return sink.read(spark).withColumns({"num_hits": big("num_hits"), "late_groups": F.lit(dropped).cast("bigint")})


GAP, DELAY = "5 minutes", "5 seconds"


def _sessions(spark, d, name, sink_factory, time_col=None):
    from farebox import schemas
    from farebox.streaming import jobs as S

    def build(stream):
        return S.session_counts(S.decode_green_trips(stream), "lpep_dropoff_datetime",
                                ["PULocationID", "DOLocationID"], GAP, DELAY)
    return _stream_through(spark, name, _green_messages(spark, d), schemas.GREEN_EVENT, build,
                           sink_factory, time_col, closing_state=time_col is not None)


def q_session_counts(spark, d):
    """5-minute session counts per (pickup, dropoff) zone pair on
    dropoff time, 5 s lateness; every closed session."""
    from farebox.streaming import jobs as S
    sink = _sessions(spark, d, "sessions", lambda p: S.AppendSink(p))
    return sink.read(spark).withColumns({"PULocationID": big("PULocationID"),
                                         "DOLocationID": big("DOLocationID"),
                                         "longest_streak": big("longest_streak")})


def q_session_upsert_last(spark, d):
    """Upsert sink keyed by zone pair, last session wins."""
    from farebox.streaming import jobs as S
    sink = _sessions(spark, d, "sessions-upsert",
                     lambda p: S.UpsertSink(p, ["PULocationID", "DOLocationID"], keep="last",
                                            order_col="session_end"), "lpep_dropoff_datetime")
    return sink.read(spark).select(big("PULocationID").alias("PULocationID"),
                                   big("DOLocationID").alias("DOLocationID"),
                                   big("longest_streak").alias("longest_streak"))


def q_longest_streak(spark, d):
    """Upsert sink keeping the longest session per pair, then the
    pair with the longest streak."""
    from farebox.operators.topk import longest_streak
    from farebox.streaming import jobs as S
    sink = _sessions(spark, d, "sessions-max",
                     lambda p: S.UpsertSink(p, ["PULocationID", "DOLocationID"], keep="max",
                                            value_col="longest_streak"), "lpep_dropoff_datetime")
    best = longest_streak(sink.read(spark))
    return best.select(big("PULocationID").alias("PULocationID"),
                       big("DOLocationID").alias("DOLocationID"),
                       big("longest_streak").alias("longest_streak"))


def q_passthrough_trips(spark, d):
    """20-column green-trip messages passed through a stream."""
    from farebox import schemas
    from farebox.streaming import jobs as S
    text_ts = T.StructType([T.StructField(f.name, T.StringType()) if "datetime" in f.name
                            else f for f in schemas.GREEN_RAW])

    def build(stream):
        return S.passthrough_trips(S.decode_green_trips(stream))
    sink = _stream_through(spark, "passthrough-trips", _green_messages(spark, d, full=True),
                           text_ts, build, lambda p: S.AppendSink(p))
    return sink.read(spark).withColumn("passenger_count", big("passenger_count")) \
        .withColumn("payment_type", big("payment_type")).withColumn("trip_type", big("trip_type"))


def q_json_round_trip(spark, d):
    """Trips encoded as JSON messages and decoded again (batch)."""
    from farebox.session import scratch_path
    from farebox.streaming import jobs as S
    path = scratch_path(spark, "json")
    t = fx.trips(spark, d).drop("l_suppkey", "l_partkey")
    S.publish_json(t, {"path": path})
    back = S.decode_json(spark.read.text(path), t.schema)
    return back.withColumns({"passenger_count": big("passenger_count"),
                             "payment_type": big("payment_type"),
                             "trip_type": big("trip_type")})



USER_EVENT = T.StructType([T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()),
                           T.StructField("event_timestamp", T.DoubleType())])
USER_GAP, USER_DELAY = "30 minutes", "5 seconds"


def q_event_sessions(spark, d):
    """T1/T5/T10 on events: sessions per user with a 30-minute gap."""
    from farebox.streaming import jobs as S
    ev = fx.events(spark, d)
    msgs = ev.select("user_id", "event_type",
                     (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1000.0))
                     .alias("event_timestamp"))

    def build(stream):
        return S.session_counts(S.decode_test_events(stream), "event_watermark", ["user_id"],
                                USER_GAP, USER_DELAY, count_col="events")
    sink = _stream_through(spark, "event-sessions", msgs, USER_EVENT, build,
                           lambda p: S.AppendSink(p))
    return sink.read(spark).withColumn("events", big("events"))


def q_quarterly_revenue_calendar(spark, d):
    """W3 calendar variant: growth against the same quarter one year earlier."""
    q = M.fct_quarterly_revenue(_fact(spark, d), calendar=True)
    return q.select("service_type", big("year").alias("year"), big("quarter").alias("quarter"),
                    money("total_amount").alias("total_amount"),
                    money("total_amount_prev_year").alias("total_amount_prev_year"),
                    ratio("yoy_growth").alias("yoy_growth"))


def q_zones_seed(spark, d):
    """S10 + M4: the zone lookup landed as a seed CSV (capitalised header),
    read back with the declared schema and turned into the dimension."""
    from farebox.session import scratch_path
    from farebox.sources.files import read_zones
    path = scratch_path(spark, "zones-seed")
    z = fx.zones(spark, d).select(F.col("locationid").alias("LocationID"),
                                  F.col("borough").alias("Borough"),
                                  F.col("zone").alias("Zone"), "service_zone")
    z.write.option("header", True).csv(path)
    return M.dim_zones(read_zones(spark, path)).withColumn("locationid", big("locationid"))


QUERIES = {
    "stg_green": q_stg_green,
    "stg_yellow": q_stg_yellow,
    "stg_fhv": q_stg_fhv,
    "dim_zones": q_dim_zones,
    "fact_trips": q_fact_trips,
    "dim_fhv_trips": q_dim_fhv_trips,
    "monthly_zone_revenue": q_monthly_zone_revenue,
    "quarterly_revenue_yoy": q_quarterly_revenue_yoy,
    "best_worst_quarter": q_best_worst_quarter,
    "monthly_fare_percentiles": q_monthly_fare_percentiles,
    "fhv_traveltime_p90": q_fhv_traveltime_p90,
    "second_longest_dropoff": q_second_longest_dropoff,
    "trips_by_distance": q_trips_by_distance,
    "longest_trip_by_day": q_longest_trip_by_day,
    "top_revenue_zones": q_top_revenue_zones,
    "largest_tip_dropoff": q_largest_tip_dropoff,
    "least_frequent_zone": q_least_frequent_zone,
    "count_one_day": q_count_one_day,
    "zero_fare_count": q_zero_fare_count,
    "row_count": q_row_count,
    "distinct_pickups": q_distinct_pickups,
    "distinct_vendors_range": q_distinct_vendors_range,
    "profile_ranges": q_profile_ranges,
    "avg_minutes": q_avg_minutes,
    "longest_hours": q_longest_hours,
    "recent_trips": q_recent_trips,
    "row_key_7": q_row_key_7,
    "row_key_5": q_row_key_5,
    "filename_like": q_filename_like,
    "quality_report": q_quality_report,
    "reconcile_counts": q_reconcile_counts,
    "customer_rollup": q_customer_rollup,
    "scalar_text": q_scalar_text,
    "scalar_datetime": q_scalar_datetime,
    "event_subset": q_event_subset,
    "monthly_load_idempotent": q_monthly_load_idempotent,
    "merge_insert_rows": q_merge_insert_rows,
    "partitioned_day_range": q_partitioned_day_range,
    "paged_rides": q_paged_rides,
    "passthrough_events": q_passthrough_events,
    "tumbling_counts": q_tumbling_counts,
    "tumbling_late_rows": q_tumbling_late_rows,
    "session_counts": q_session_counts,
    "session_upsert_last": q_session_upsert_last,
    "longest_streak": q_longest_streak,
    "passthrough_trips": q_passthrough_trips,
    "json_round_trip": q_json_round_trip,
    "event_sessions": q_event_sessions,
    "quarterly_revenue_calendar": q_quarterly_revenue_calendar,
    "zones_seed": q_zones_seed,
    "write_n_files": q_write_n_files,
    "create_if_missing": q_create_if_missing,
    "replace_table": q_replace_table,
    "csv_all_text": q_csv_all_text,
    "external_table": q_external_table,
    "csv_extra_fields": q_csv_extra_fields,
    "load_month": q_load_month,
    "quarter_label": q_quarter_label,
    "ordered_limit": q_ordered_limit,
    "rollup_incremental": q_rollup_incremental,
    "distinct_vendors_scan": q_distinct_vendors_scan,
    "load_reconciliation": q_load_reconciliation,
    "bucketed_load": q_bucketed_load,
    "clustered_scan": q_clustered_scan,
}


def queries() -> dict:
    return dict(QUERIES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_monthly_zone_revenue(spark, sf_dir)
