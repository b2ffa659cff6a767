"""Taxi-shaped views over the TPC-H-like test tables (see FIXTURES.md, part B).

``trips`` is lineitem joined with orders, customer and supplier; ``zones`` is
nation joined with region; ``fhv`` is the same rows in the for-hire layout;
``events`` feeds the streaming jobs.  Each view is built by Spark from the
given parquet files, so the work grows with the tables.  ``FIXTURE_SQL`` holds
the same definitions as DuckDB CTE text for the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.operators.joins import bounded_broadcast
from farebox.sources.files import spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events")
# Tables that grow with the data; their scans are spread over the cluster.
FACT_TABLES = ("lineitem", "orders", "customer", "events")


_TABLES: dict[tuple[str, str], DataFrame] = {}


def session_key(spark: SparkSession) -> str:
    """A name of the application that no later session of this process gets again."""
    return spark.sparkContext.applicationId


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; the DataFrame (file listing, footer schema) is made
    once per session and path and reused, as a registered table would be."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (session_key(spark), path)
    if key not in _TABLES:
        df = spark.read.parquet(path)
        _TABLES[key] = spread(df) if name in FACT_TABLES else df
    return _TABLES[key]


_VIEWS: dict[tuple, DataFrame] = {}


def _memo(fn):
    """Build a fixture view once per session and arguments (DataFrames are
    immutable plans, so sharing one is safe and saves re-planning)."""
    def wrapper(spark, sf_dir, *args, **kw):
        key = (fn.__name__, session_key(spark), sf_dir.rstrip("/"), args, tuple(sorted(kw.items())))
        if key not in _VIEWS:
            _VIEWS[key] = fn(spark, sf_dir, *args, **kw)
        return _VIEWS[key]
    wrapper.__name__, wrapper.__doc__ = fn.__name__, fn.__doc__
    return wrapper


@_memo
def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """locationid, borough, zone, service_zone (25 rows per nation table)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(bounded_broadcast(r), n.n_regionkey == r.r_regionkey)
            .select(n.n_nationkey.cast("int").alias("locationid"),
                    F.when(r.r_name == "AFRICA", "Unknown").otherwise(r.r_name)
                    .alias("borough"),
                    n.n_name.alias("zone"),
                    F.when(n.n_nationkey % 2 == 0, "Boro Zone")
                    .otherwise("Yellow Zone").alias("service_zone")))


def trip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem rows with the order, customer and supplier fields they need.

    Orders is joined with customer first (both smaller than lineitem), so the
    lineitem side is shuffled once; supplier is a size-checked broadcast.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    oc = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_orderdate",
                                                       "c_nationkey")
    return (li.join(oc, li.l_orderkey == oc.o_orderkey)
            .join(bounded_broadcast(s), li.l_suppkey == s.s_suppkey))


@_memo
def trips(spark: SparkSession, sf_dir: str, dropoff: str = "quantity", by_month: bool = False) -> DataFrame:
    """Generic trip rows (service, pickup/dropoff, zones as text ids, money).

    ``by_month`` deals the rows by pickup month, before the wide columns are derived.

    ``dropoff='shipdate'`` gives the variant whose dropoff is ``l_shipdate``
    (about half the trips end before they start; such rows are kept).
    """
    t = trip_rows(spark, sf_dir)
    pickup = F.timestamp_add("SECOND", F.col("l_orderkey") % 86400, F.col("o_orderdate"))
    if by_month:
        t = t.withColumn("__month", F.year(pickup) * 12 + F.month(pickup)).hint("rebalance", "__month")
    if dropoff == "shipdate":
        drop = F.col("l_shipdate")
    else:
        drop = F.timestamp_add(
            "SECOND",
            F.col("l_orderkey") % 86400 + F.col("l_quantity").cast("bigint") * 60
            + F.col("l_suppkey") % 60,
            F.col("o_orderdate"))
    service = F.when(F.col("l_linestatus") == "F", "Green").otherwise("Yellow")
    # Money is derived in decimal so both engines round the same way.
    cents = "decimal(18,2)"
    tip_d = F.round(F.col("l_extendedprice").cast(cents) * F.col("l_discount").cast(cents), 2)
    tip = tip_d.cast("double")
    total = (F.col("l_extendedprice").cast(cents) + F.col("l_discount").cast(cents)
             + F.col("l_tax").cast(cents) + tip_d + F.lit(0.3).cast(cents)).cast("double")
    return t.select(
        service.alias("service"),
        F.col("l_linenumber").cast("string").alias("VendorID"),
        pickup.alias("pickup_datetime"),
        drop.alias("dropoff_datetime"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_linenumber").cast("string").alias("RatecodeID"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        F.col("c_nationkey").cast("string").alias("PULocationID"),
        F.col("s_nationkey").cast("string").alias("DOLocationID"),
        F.col("l_linenumber").alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        tip.alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.0).alias("ehail_fee"),
        F.lit(0.3).alias("improvement_surcharge"),
        total.alias("total_amount"),
        F.lit(1).alias("trip_type"),
        F.lit(0.0).alias("congestion_surcharge"),
        F.concat(F.lower(service), F.lit("_tripdata_"),
                 F.date_format(pickup, "yyyy-MM"), F.lit(".csv")).alias("filename"),
        F.col("l_suppkey"), F.col("l_partkey"),
    )


_GREEN_ORDER = ["VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime",
                "store_and_fwd_flag", "RatecodeID", "PULocationID", "DOLocationID",
                "passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax",
                "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge",
                "total_amount", "payment_type", "trip_type", "congestion_surcharge"]
_YELLOW_ORDER = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
                 "passenger_count", "trip_distance", "RatecodeID", "store_and_fwd_flag",
                 "PULocationID", "DOLocationID", "payment_type", "fare_amount", "extra",
                 "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
                 "total_amount", "congestion_surcharge"]


def raw_service(t: DataFrame, service: str, keep_filename: bool = False) -> DataFrame:
    """Raw green or yellow file layout from generic trips."""
    p = "lpep" if service == "Green" else "tpep"
    cols = _GREEN_ORDER if service == "Green" else _YELLOW_ORDER
    if keep_filename:
        cols = cols + ["filename"]
    return (t.filter(F.col("service") == service)
            .withColumnsRenamed({"pickup_datetime": f"{p}_pickup_datetime",
                                 "dropoff_datetime": f"{p}_dropoff_datetime"})
            .select(*cols))


def green(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_service(trips(spark, sf_dir), "Green")


def yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_service(trips(spark, sf_dir), "Yellow")


def fhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For-hire layout of the same rows (base number NULL for every tenth supplier)."""
    t = trips(spark, sf_dir)
    return t.select(
        F.when(F.col("l_suppkey") % 10 != 0,
               F.concat(F.lit("B"), F.col("l_suppkey").cast("string")))
        .alias("dispatching_base_num"),
        "pickup_datetime",
        F.col("dropoff_datetime").alias("dropOff_datetime"),
        F.col("PULocationID").alias("PUlocationID"),
        F.col("DOLocationID").alias("DOlocationID"),
        F.col("store_and_fwd_flag").alias("SR_Flag"),
        F.concat(F.lit("A"), F.col("l_partkey").cast("string"))
        .alias("Affiliated_base_number"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# ---------------------------------------------------------------------------
# The same views as DuckDB CTEs, for the oracle SQL (tables are pre-registered
# views there).  Prefix with "WITH " and append the query's own CTEs.

FIXTURE_SQL = {
    "zones": """zones AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS locationid,
         CASE WHEN r.r_name = 'AFRICA' THEN 'Unknown' ELSE r.r_name END AS borough,
         n.n_name AS zone,
         CASE WHEN n.n_nationkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)""",
    "trips": """trips AS (
  SELECT CASE WHEN l.l_linestatus = 'F' THEN 'Green' ELSE 'Yellow' END AS service,
         CAST(l.l_linenumber AS VARCHAR) AS VendorID,
         o.o_orderdate + to_seconds(l.l_orderkey % 86400) AS pickup_datetime,
         o.o_orderdate + to_seconds(l.l_orderkey % 86400 + CAST(l.l_quantity AS BIGINT) * 60
                                    + l.l_suppkey % 60) AS dropoff_datetime,
         l.l_shipdate AS ship_datetime,
         l.l_linenumber AS passenger_count,
         l.l_quantity AS trip_distance,
         CAST(l.l_linenumber AS VARCHAR) AS RatecodeID,
         l.l_returnflag AS store_and_fwd_flag,
         CAST(c.c_nationkey AS VARCHAR) AS PULocationID,
         CAST(s.s_nationkey AS VARCHAR) AS DOLocationID,
         l.l_linenumber AS payment_type,
         l.l_extendedprice AS fare_amount,
         l.l_discount AS extra,
         l.l_tax AS mta_tax,
         CAST(round(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(18,2)), 2)
              AS DOUBLE) AS tip_amount,
         0.0::DOUBLE AS tolls_amount,
         0.0::DOUBLE AS ehail_fee,
         0.3::DOUBLE AS improvement_surcharge,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) + CAST(l.l_discount AS DECIMAL(18,2))
              + CAST(l.l_tax AS DECIMAL(18,2))
              + round(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(18,2)), 2)
              + CAST(0.3 AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
         1 AS trip_type,
         0.0::DOUBLE AS congestion_surcharge,
         lower(CASE WHEN l.l_linestatus = 'F' THEN 'Green' ELSE 'Yellow' END) || '_tripdata_'
           || strftime(o.o_orderdate + to_seconds(l.l_orderkey % 86400), '%Y-%m') || '.csv' AS filename,
         l.l_suppkey, l.l_partkey
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey)""",
    "green": """green AS (
  SELECT VendorID, pickup_datetime AS lpep_pickup_datetime,
         dropoff_datetime AS lpep_dropoff_datetime, store_and_fwd_flag, RatecodeID,
         PULocationID, DOLocationID, passenger_count, trip_distance, fare_amount, extra,
         mta_tax, tip_amount, tolls_amount, ehail_fee, improvement_surcharge, total_amount,
         payment_type, trip_type, congestion_surcharge, filename
  FROM trips WHERE service = 'Green')""",
    "yellow": """yellow AS (
  SELECT VendorID, pickup_datetime AS tpep_pickup_datetime,
         dropoff_datetime AS tpep_dropoff_datetime, passenger_count, trip_distance,
         RatecodeID, store_and_fwd_flag, PULocationID, DOLocationID, payment_type,
         fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
         total_amount, congestion_surcharge, filename
  FROM trips WHERE service = 'Yellow')""",
    "fhv": """fhv AS (
  SELECT CASE WHEN l_suppkey % 10 <> 0 THEN 'B' || CAST(l_suppkey AS VARCHAR) END
           AS dispatching_base_num,
         pickup_datetime, dropoff_datetime AS dropOff_datetime,
         PULocationID AS PUlocationID, DOLocationID AS DOlocationID,
         store_and_fwd_flag AS SR_Flag,
         'A' || CAST(l_partkey AS VARCHAR) AS Affiliated_base_number
  FROM trips)""",
}

# Dependencies between the CTEs above, in definition order.
_DEPS = {"zones": [], "trips": [], "green": ["trips"], "yellow": ["trips"],
         "fhv": ["trips"]}


def fixture_ctes(*names: str) -> list[str]:
    """CTE texts for the named fixtures plus what they depend on, in order."""
    need: list[str] = []

    def add(n):
        for d in _DEPS[n]:
            add(d)
        if n not in need:
            need.append(n)

    for n in names:
        add(n)
    order = list(FIXTURE_SQL)
    return [FIXTURE_SQL[n] for n in sorted(need, key=order.index)]
