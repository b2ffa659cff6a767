"""DuckDB SQL for every registered query: the independent oracle.

The fixture views are spelled out as CTEs (``farebox.fixtures.FIXTURE_SQL``)
and the query is written directly in SQL, without the package's code.
"""

from __future__ import annotations

from farebox import catalog as C
from farebox.fixtures import _GREEN_ORDER, _YELLOW_ORDER, fixture_ctes


def _with(fixtures, *ctes: str) -> str:
    parts = fixture_ctes(*fixtures) + list(ctes)
    return "WITH " + ",\n".join(parts) + "\n"


def _money(x, alias=None):
    return f"CAST(round({x}, 2) AS DOUBLE) AS {alias or x}"


def _ratio(x, alias=None):
    return f"round(CAST({x} AS DOUBLE), 4) AS {alias or x}"


# Fixed values, written out here so that a wrong constant in the package can't match itself.
_PAY_CASE = """CASE TRY_CAST(payment_type AS INTEGER) WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash'
  WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip'
  ELSE 'EMPTY' END"""


def row_key_fields(service: str, width: int) -> list[str]:
    p = "lpep" if service == "Green" else "tpep"
    fields = ["VendorID", f"{p}_pickup_datetime", f"{p}_dropoff_datetime", "PULocationID", "DOLocationID"]
    return fields + (["fare_amount", "trip_distance"] if width == 7 else [])


def _skey(a, b):
    return (f"md5(coalesce(CAST({a} AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' || "
            f"coalesce(CAST({b} AS VARCHAR), '_dbt_utils_surrogate_key_null_'))")


def _stg_sql(service: str) -> tuple[str, str]:
    """CTE text of the staged trips for one service, and its name."""
    p = "lpep" if service == "Green" else "tpep"
    raw = "green" if service == "Green" else "yellow"
    order = _GREEN_ORDER if service == "Green" else _YELLOW_ORDER
    keys = ["VendorID", f"{p}_pickup_datetime"]
    rest = ", ".join(f"{c} ASC NULLS FIRST" for c in order if c not in keys)
    yellow = service == "Yellow"
    cte = f"""stg_{raw}_rn AS (
  SELECT *, row_number() OVER (PARTITION BY VendorID, {p}_pickup_datetime ORDER BY {rest}) AS rn
  FROM {raw} WHERE VendorID IS NOT NULL),
stg_{raw} AS (
  SELECT {_skey('VendorID', p + '_pickup_datetime')} AS tripid,
         TRY_CAST(VendorID AS INTEGER) AS vendorid,
         TRY_CAST(RatecodeID AS INTEGER) AS ratecodeid,
         TRY_CAST(PULocationID AS INTEGER) AS pickup_locationid,
         TRY_CAST(DOLocationID AS INTEGER) AS dropoff_locationid,
         CAST({p}_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
         CAST({p}_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
         store_and_fwd_flag,
         TRY_CAST(passenger_count AS INTEGER) AS passenger_count,
         CAST(trip_distance AS DECIMAL(38,9)) AS trip_distance,
         {'1' if yellow else 'TRY_CAST(trip_type AS INTEGER)'} AS trip_type,
         CAST(fare_amount AS DECIMAL(38,9)) AS fare_amount,
         CAST(extra AS DECIMAL(38,9)) AS extra,
         CAST(mta_tax AS DECIMAL(38,9)) AS mta_tax,
         CAST(tip_amount AS DECIMAL(38,9)) AS tip_amount,
         CAST(tolls_amount AS DECIMAL(38,9)) AS tolls_amount,
         CAST({'0' if yellow else 'ehail_fee'} AS DECIMAL(38,9)) AS ehail_fee,
         CAST(improvement_surcharge AS DECIMAL(38,9)) AS improvement_surcharge,
         CAST(total_amount AS DECIMAL(38,9)) AS total_amount,
         coalesce(TRY_CAST(payment_type AS INTEGER), 0) AS payment_type,
         {_PAY_CASE} AS payment_type_description
  FROM stg_{raw}_rn WHERE rn = 1)"""
    return cte, f"stg_{raw}"


_TRIP_SELECT = """tripid, CAST(vendorid AS BIGINT) AS vendorid,
  CAST(ratecodeid AS BIGINT) AS ratecodeid,
  CAST(pickup_locationid AS BIGINT) AS pickup_locationid,
  CAST(dropoff_locationid AS BIGINT) AS dropoff_locationid,
  pickup_datetime, dropoff_datetime, store_and_fwd_flag,
  CAST(passenger_count AS BIGINT) AS passenger_count,
  CAST(trip_distance AS DOUBLE) AS trip_distance,
  CAST(trip_type AS BIGINT) AS trip_type,
  CAST(round(fare_amount, 2) AS DOUBLE) AS fare_amount,
  CAST(round(extra, 2) AS DOUBLE) AS extra,
  CAST(round(mta_tax, 2) AS DOUBLE) AS mta_tax,
  CAST(round(tip_amount, 2) AS DOUBLE) AS tip_amount,
  CAST(round(tolls_amount, 2) AS DOUBLE) AS tolls_amount,
  CAST(round(ehail_fee, 2) AS DOUBLE) AS ehail_fee,
  CAST(round(improvement_surcharge, 2) AS DOUBLE) AS improvement_surcharge,
  CAST(round(total_amount, 2) AS DOUBLE) AS total_amount,
  CAST(payment_type AS BIGINT) AS payment_type, payment_type_description"""

_DIM_ZONES = """dim_zones AS (
  SELECT locationid, borough, zone, replace(service_zone, 'Boro', 'Green') AS service_zone
  FROM zones)"""

_STG_G, _ = _stg_sql("Green")
_STG_Y, _ = _stg_sql("Yellow")

_FACT = f"""{_STG_G},
{_STG_Y},
{_DIM_ZONES},
known_zones AS (SELECT * FROM dim_zones WHERE borough <> 'Unknown'),
trips_unioned AS (
  SELECT *, 'Green' AS service_type FROM stg_green
  UNION ALL
  SELECT *, 'Yellow' AS service_type FROM stg_yellow),
fact_trips AS (
  SELECT u.tripid, u.vendorid, u.service_type, u.ratecodeid, u.pickup_locationid,
         pz.borough AS pickup_borough, pz.zone AS pickup_zone, u.dropoff_locationid,
         dz.borough AS dropoff_borough, dz.zone AS dropoff_zone, u.pickup_datetime,
         u.dropoff_datetime, u.store_and_fwd_flag, u.passenger_count, u.trip_distance,
         u.trip_type, u.fare_amount, u.extra, u.mta_tax, u.tip_amount, u.tolls_amount,
         u.ehail_fee, u.improvement_surcharge, u.total_amount, u.payment_type,
         u.payment_type_description
  FROM trips_unioned u
  JOIN known_zones pz ON u.pickup_locationid = pz.locationid
  JOIN known_zones dz ON u.dropoff_locationid = dz.locationid)"""

_STG_FHV = f"""stg_fhv AS (
  SELECT dispatching_base_num, Affiliated_base_number AS affiliated_base_number,
         {_skey('dispatching_base_num', 'pickup_datetime')} AS tripid,
         TRY_CAST(PUlocationID AS INTEGER) AS pickup_locationid,
         TRY_CAST(DOlocationID AS INTEGER) AS dropoff_locationid,
         SR_Flag AS sr_flag,
         CAST(pickup_datetime AS TIMESTAMP) AS pickup_datetime,
         CAST(dropOff_datetime AS TIMESTAMP) AS dropoff_datetime
  FROM fhv WHERE dispatching_base_num IS NOT NULL)"""

_DIM_FHV = f"""{_STG_FHV},
{_DIM_ZONES},
known_zones AS (SELECT * FROM dim_zones WHERE borough <> 'Unknown'),
dim_fhv_trips AS (
  SELECT f.tripid, f.dispatching_base_num, f.affiliated_base_number, f.sr_flag,
         extract(year FROM f.pickup_datetime) AS pickup_year,
         extract(month FROM f.pickup_datetime) AS pickup_month,
         f.pickup_datetime, f.dropoff_datetime, f.pickup_locationid,
         pz.borough AS pickup_borough, pz.zone AS pickup_zone, f.dropoff_locationid,
         dz.borough AS dropoff_borough, dz.zone AS dropoff_zone
  FROM stg_fhv f
  JOIN known_zones pz ON f.pickup_locationid = pz.locationid
  JOIN known_zones dz ON f.dropoff_locationid = dz.locationid)"""

_P90 = f"""{_DIM_FHV},
fhv_p90 AS (
  SELECT *, quantile_cont(trip_duration, 0.90) OVER (
           PARTITION BY pickup_year, pickup_month, pickup_locationid, dropoff_locationid) AS p90
  FROM (SELECT *, date_diff('second', pickup_datetime, dropoff_datetime) AS trip_duration
        FROM dim_fhv_trips))"""

_QUARTERLY = f"""{_FACT},
q AS (
  SELECT service_type, extract(year FROM pickup_datetime) AS year,
         extract(quarter FROM pickup_datetime) AS quarter, sum(total_amount) AS total_amount
  FROM fact_trips GROUP BY ALL),
qy AS (
  SELECT *, lag(total_amount, 4) OVER (PARTITION BY service_type ORDER BY year, quarter)
           AS total_amount_prev_year
  FROM q),
quarterly AS (
  SELECT *, (CASE WHEN total_amount_prev_year = 0 THEN NULL
                  ELSE CAST(total_amount AS DOUBLE) / CAST(total_amount_prev_year AS DOUBLE)
             END - 1) * 100 AS yoy_growth
  FROM qy)"""

_BUCKET_CASE = """CASE WHEN trip_distance <= 1 THEN '< 1' WHEN trip_distance <= 3 THEN '1-3'
  WHEN trip_distance <= 7 THEN '3-7' WHEN trip_distance <= 10 THEN '7-10'
  WHEN trip_distance > 10 THEN '10+' END"""

_MZR_SUMS = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
             "improvement_surcharge", "total_amount"]

_PROFILE = ", ".join(f"min({c}) AS min_{c}, max({c}) AS max_{c}" for c in C.PROFILE_COLS)


def _row_key_sql(width: int) -> str:
    parts = []
    for service, table in (("Green", "green"), ("Yellow", "yellow")):
        text = " || ".join(f"coalesce(CAST({f} AS VARCHAR), '')" for f in row_key_fields(service, width))
        parts.append(f"SELECT md5({text}) AS unique_row_id, filename FROM {table}")
    return _with(["green", "yellow"]) + " UNION ALL ".join(parts)


def _checks_sql(model: str, table: str, dropoff_severity: str) -> list[str]:
    def row(test, severity, where):
        return (f"SELECT '{model}.{test}' AS \"check\", CAST(count(*) AS BIGINT) AS failures, "
                f"'{severity}' AS severity, CASE WHEN count(*) = 0 THEN 'pass' "
                f"ELSE '{severity}' END AS status FROM {where}")
    zone_ids = "(SELECT locationid FROM zones WHERE locationid IS NOT NULL)"
    return [
        row("unique_tripid", "warn", f"(SELECT tripid FROM {table} WHERE tripid IS NOT NULL "
                                     "GROUP BY 1 HAVING count(*) > 1)"),
        row("not_null_tripid", "warn", f"{table} WHERE tripid IS NULL"),
        row("relationships_pickup_locationid", "warn",
            f"{table} WHERE pickup_locationid IS NOT NULL AND pickup_locationid NOT IN {zone_ids}"),
        row("relationships_dropoff_locationid", dropoff_severity,
            f"{table} WHERE dropoff_locationid IS NOT NULL AND dropoff_locationid NOT IN {zone_ids}"),
        row("accepted_values_payment_type", "warn",
            f"{table} WHERE payment_type IS NOT NULL AND payment_type NOT IN "
            f"({', '.join(str(v) for v in C.PAYMENT_TYPE_VALUES)})"),
    ]


def _quality_sql() -> str:
    rows = (_checks_sql("stg_green_tripdata", "stg_green", "error")
            + _checks_sql("stg_yellow_tripdata", "stg_yellow", "warn"))
    mart = ("SELECT 'dm_monthly_zone_revenue.not_null_revenue_monthly_total_amount' AS \"check\", "
            "CAST(count(*) AS BIGINT) AS failures, 'error' AS severity, "
            "CASE WHEN count(*) = 0 THEN 'pass' ELSE 'error' END AS status FROM ("
            "SELECT sum(total_amount) AS revenue_monthly_total_amount FROM fact_trips "
            "GROUP BY pickup_zone, date_trunc('month', pickup_datetime), service_type) "
            "WHERE revenue_monthly_total_amount IS NULL")
    return _with(["zones", "green", "yellow"], _FACT) + "\nUNION ALL\n".join(rows + [mart])


ORACLE = {
    "stg_green": _with(["green"], _STG_G) + f"SELECT {_TRIP_SELECT} FROM stg_green",
    "stg_yellow": _with(["yellow"], _STG_Y) + f"SELECT {_TRIP_SELECT} FROM stg_yellow",
    "stg_fhv": _with(["fhv"], _STG_FHV) + """SELECT dispatching_base_num,
  affiliated_base_number, tripid, CAST(pickup_locationid AS BIGINT) AS pickup_locationid,
  CAST(dropoff_locationid AS BIGINT) AS dropoff_locationid, sr_flag, pickup_datetime,
  dropoff_datetime FROM stg_fhv""",
    "dim_zones": _with(["zones"], _DIM_ZONES)
    + "SELECT CAST(locationid AS BIGINT) AS locationid, borough, zone, service_zone FROM dim_zones",
    "fact_trips": _with(["zones", "green", "yellow"], _FACT)
    + f"""SELECT {_TRIP_SELECT}, service_type, pickup_borough, pickup_zone, dropoff_borough,
  dropoff_zone FROM fact_trips""",
    "dim_fhv_trips": _with(["zones", "fhv"], _DIM_FHV) + """SELECT tripid, dispatching_base_num,
  affiliated_base_number, sr_flag, CAST(pickup_year AS BIGINT) AS pickup_year,
  CAST(pickup_month AS BIGINT) AS pickup_month, pickup_datetime, dropoff_datetime,
  CAST(pickup_locationid AS BIGINT) AS pickup_locationid, pickup_borough, pickup_zone,
  CAST(dropoff_locationid AS BIGINT) AS dropoff_locationid, dropoff_borough, dropoff_zone
  FROM dim_fhv_trips""",
    "monthly_zone_revenue": _with(["zones", "green", "yellow"], _FACT)
    + "SELECT pickup_zone AS revenue_zone, date_trunc('month', pickup_datetime) AS revenue_month,"
    + " service_type, "
    + ", ".join(_money(f"sum({c})", "revenue_monthly_" + ("fare" if c == "fare_amount" else c))
                for c in _MZR_SUMS)
    + """, CAST(count(tripid) AS BIGINT) AS total_monthly_trips,
  round(avg(passenger_count), 4) AS avg_monthly_passenger_count,
  round(CAST(avg(trip_distance) AS DOUBLE), 4) AS avg_monthly_trip_distance
  FROM fact_trips GROUP BY 1, 2, 3""",
    "quarterly_revenue_yoy": _with(["zones", "green", "yellow"], _QUARTERLY)
    + """SELECT service_type, CAST(year AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter,
  CAST(round(total_amount, 2) AS DOUBLE) AS total_amount,
  CAST(round(total_amount_prev_year, 2) AS DOUBLE) AS total_amount_prev_year,
  round(yoy_growth, 4) AS yoy_growth FROM quarterly""",
    "best_worst_quarter": _with(["zones", "green", "yellow"], _QUARTERLY)
    + f"""SELECT service_type, CAST(year AS BIGINT) AS year,
  CAST(arg_max(quarter, yoy_growth) AS BIGINT) AS max_growth_quarter,
  CAST(arg_min(quarter, yoy_growth) AS BIGINT) AS min_growth_quarter
  FROM quarterly WHERE year = {C.BEST_YEAR} GROUP BY ALL""",
    "monthly_fare_percentiles": _with(["zones", "green", "yellow"], _FACT)
    + """SELECT service_type, CAST(extract(year FROM pickup_datetime) AS BIGINT) AS pickup_year,
  CAST(extract(month FROM pickup_datetime) AS BIGINT) AS pickup_month,
  round(quantile_cont(CAST(fare_amount AS DOUBLE), 0.97), 4) AS p97,
  round(quantile_cont(CAST(fare_amount AS DOUBLE), 0.95), 4) AS p95,
  round(quantile_cont(CAST(fare_amount AS DOUBLE), 0.90), 4) AS p90
  FROM fact_trips
  WHERE fare_amount > 0 AND trip_distance > 0
    AND lower(trim(payment_type_description)) IN ('cash', 'credit card')
  GROUP BY ALL""",
    "fhv_traveltime_p90": _with(["zones", "fhv"], _P90) + """SELECT tripid, pickup_datetime,
  dropoff_datetime, CAST(pickup_year AS BIGINT) AS pickup_year,
  CAST(pickup_month AS BIGINT) AS pickup_month,
  CAST(pickup_locationid AS BIGINT) AS pickup_locationid,
  CAST(dropoff_locationid AS BIGINT) AS dropoff_locationid,
  CAST(trip_duration AS BIGINT) AS trip_duration, round(p90, 4) AS p90 FROM fhv_p90""",
    "second_longest_dropoff": _with(["zones", "fhv"], _P90) + """,
filtered AS (SELECT DISTINCT pickup_year, pickup_month, pickup_zone, dropoff_zone, p90
             FROM fhv_p90),
ranked AS (SELECT *, row_number() OVER (PARTITION BY pickup_year, pickup_month, pickup_zone
                                        ORDER BY p90 DESC NULLS LAST, dropoff_zone ASC NULLS FIRST)
                     AS p90_rank FROM filtered)
SELECT CAST(pickup_year AS BIGINT) AS pickup_year, CAST(pickup_month AS BIGINT) AS pickup_month,
  pickup_zone, dropoff_zone, round(p90, 4) AS p90, CAST(p90_rank AS BIGINT) AS p90_rank
FROM ranked WHERE p90_rank = 2""",
    "trips_by_distance": _with(["trips"]) + f"""SELECT {_BUCKET_CASE} AS trip_distance,
  CAST(count(*) AS BIGINT) AS trips FROM trips
  WHERE CAST(pickup_datetime AS DATE) >= DATE '{C.PERIOD[0]}'
    AND CAST(dropoff_datetime AS DATE) < DATE '{C.PERIOD[1]}'
  GROUP BY 1""",
    "longest_trip_by_day": _with(["trips"]) + """SELECT CAST(pickup_datetime AS DATE) AS pickup_day,
  max(trip_distance) AS max_trip_distance FROM trips GROUP BY 1
  ORDER BY 2 DESC NULLS LAST, 1 ASC NULLS FIRST LIMIT 1""",
    "top_revenue_zones": _with(["trips", "zones"]) + f""", per_zone AS (
  SELECT PULocationID AS pickup_location_id, sum(total_amount) AS amount FROM trips
  WHERE CAST(pickup_datetime AS DATE) = DATE '{C.DAY}' GROUP BY 1)
SELECT z.zone AS zone_name, CAST(round(p.amount, 2) AS DOUBLE) AS total_amount
FROM per_zone p LEFT JOIN zones z ON CAST(p.pickup_location_id AS INTEGER) = z.locationid
WHERE p.amount > {C.DAY_MIN_AMOUNT}""",
    "largest_tip_dropoff": _with(["trips", "zones"]) + f"""SELECT pz.zone AS pickup_zone,
  dz.zone AS dropoff_zone, t.tip_amount
FROM trips t
LEFT JOIN zones pz ON CAST(t.PULocationID AS INTEGER) = pz.locationid
LEFT JOIN zones dz ON CAST(t.DOLocationID AS INTEGER) = dz.locationid
WHERE CAST(t.pickup_datetime AS DATE) >= DATE '{C.TIP_PERIOD[0]}'
  AND CAST(t.pickup_datetime AS DATE) < DATE '{C.TIP_PERIOD[1]}'
  AND pz.zone = '{C.TIP_ZONE}'
ORDER BY t.tip_amount DESC NULLS LAST, 1 ASC NULLS FIRST, 2 ASC NULLS FIRST LIMIT 1""",
    "least_frequent_zone": _with(["trips", "zones"]) + """, pickup_zones AS (
  SELECT PULocationID, count(*) AS trips_count FROM trips GROUP BY 1)
SELECT p.PULocationID, CAST(p.trips_count AS BIGINT) AS trips_count, z.zone AS Zone
FROM pickup_zones p LEFT JOIN zones z ON CAST(p.PULocationID AS INTEGER) = z.locationid
ORDER BY p.trips_count ASC, p.PULocationID ASC LIMIT 1""",
    "count_one_day": _with(["trips"]) + f"""SELECT CAST(count(*) AS BIGINT) AS row_count
  FROM trips WHERE CAST(pickup_datetime AS DATE) = DATE '{C.DAY}'""",
    "zero_fare_count": _with(["trips"])
    + "SELECT CAST(count(*) AS BIGINT) AS row_count FROM trips WHERE fare_amount = 0",
    "row_count": "SELECT CAST(count(*) AS BIGINT) AS row_count FROM lineitem",
    "distinct_pickups": _with(["trips"])
    + "SELECT CAST(count(DISTINCT PULocationID) AS BIGINT) AS distinct_pickups FROM trips",
    "distinct_vendors_range": _with(["trips"])
    + f"""SELECT CAST(count(DISTINCT VendorID) AS BIGINT) AS distinct_vendors FROM trips
  WHERE CAST(pickup_datetime AS DATE) BETWEEN DATE '{C.RANGE_DAYS[0]}' AND DATE '{C.RANGE_DAYS[1]}'""",
    "profile_ranges": _with(["trips"]) + f"SELECT {_PROFILE} FROM trips",
    "avg_minutes": _with(["trips"]) + """SELECT round(avg(date_diff('minute', pickup_datetime,
  ship_datetime)), 4) AS avg_minutes FROM trips""",
    "longest_hours": _with(["trips"]) + """SELECT CAST(max(date_sub('hour', pickup_datetime,
  ship_datetime)) AS BIGINT) AS longest_trip_hours FROM trips""",
    "recent_trips": _with(["trips"]) + f"""SELECT service, CAST(count(*) AS BIGINT) AS trips
  FROM trips WHERE pickup_datetime >= CAST(DATE '{C.RECENT_TODAY}' - INTERVAL '{C.RECENT_DAYS}' DAY
                                           AS TIMESTAMP)
  GROUP BY 1""",
    "row_key_7": _row_key_sql(7),
    "row_key_5": _row_key_sql(5),
    "filename_like": _with(["trips"]) + f"""SELECT CAST(count(*) AS BIGINT) AS row_count
  FROM trips WHERE filename LIKE '{C.LIKE_PATTERN}'""",
    "quality_report": _quality_sql(),
    "reconcile_counts": _with(["trips"]) + """SELECT s.source_rows, l.loaded_rows,
  CASE WHEN s.source_rows = l.loaded_rows THEN 'match' ELSE 'mismatch' END AS status
FROM (SELECT CAST(count(*) AS BIGINT) AS source_rows FROM lineitem) s,
     (SELECT CAST(count(*) AS BIGINT) AS loaded_rows FROM trips) l""",
    "customer_rollup": """SELECT o_custkey, CAST(round(sum(o_totalprice), 2) AS DOUBLE) AS total_price,
  CAST(count(*) AS BIGINT) AS orders FROM orders GROUP BY 1""",
    "scalar_text": """SELECT c_custkey, lower(trim('  ' || c_mktsegment || ' ')) AS segment,
  replace(c_name, 'Customer', 'Client') AS client_name,
  TRY_CAST(substring(c_name, 10, 9) AS INTEGER) AS name_number,
  TRY_CAST(c_mktsegment AS INTEGER) AS segment_number,
  lower(trim(' ' || upper(c_mktsegment))) IN ('building', 'machinery') AS is_listed
FROM customer""",
    "scalar_datetime": """SELECT o_orderkey, CAST(ts AS DATE) AS order_date,
  CAST(extract(year FROM ts) AS BIGINT) AS order_year,
  CAST(extract(quarter FROM ts) AS BIGINT) AS order_quarter,
  CAST(extract(month FROM ts) AS BIGINT) AS order_month,
  strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed_ts,
  make_timestamp(CAST((epoch(ts) * 1000 + o_orderkey % 1000) * 1000 AS BIGINT)) AS from_epoch_ms,
  CAST(CAST(ts AS DATE) - INTERVAL 30 DAY AS DATE) AS minus_30_days,
  date_trunc('month', ts) AS month_start
FROM (SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) AS ts FROM orders)""",
    "event_subset": _with(["green"]) + """SELECT lpep_pickup_datetime, lpep_dropoff_datetime,
  CAST(TRY_CAST(PULocationID AS INTEGER) AS BIGINT) AS PULocationID,
  CAST(TRY_CAST(DOLocationID AS INTEGER) AS BIGINT) AS DOLocationID,
  CAST(passenger_count AS BIGINT) AS passenger_count, trip_distance, tip_amount FROM green""",
}

_KEY7_Y = " || ".join(f"coalesce(CAST({f} AS VARCHAR), '')" for f in row_key_fields("Yellow", 7))
_KEY7_G = " || ".join(f"coalesce(CAST({f} AS VARCHAR), '')" for f in row_key_fields("Green", 7))

ORACLE.update({
    "monthly_load_idempotent": _with(["green", "yellow"]) + f""", stamped AS (
  SELECT md5({_KEY7_G}) AS unique_row_id, filename FROM green
  UNION ALL
  SELECT md5({_KEY7_Y}) AS unique_row_id, filename FROM yellow),
kept AS (
  SELECT * FROM (SELECT *, min(filename) OVER (
                   PARTITION BY substr(filename, 1, 5), unique_row_id) AS first_file
                 FROM stamped) WHERE filename = first_file)
SELECT filename, CAST(count(*) AS BIGINT) AS rows,
       CAST(count(DISTINCT unique_row_id) AS BIGINT) AS distinct_keys
FROM kept GROUP BY 1""",
    "merge_insert_rows": _with(["green", "yellow"]) + f""", stamped AS (
  SELECT 'g' AS service, md5({_KEY7_G}) AS unique_row_id, filename, lpep_pickup_datetime AS pickup FROM green
  UNION ALL
  SELECT 'y' AS service, md5({_KEY7_Y}) AS unique_row_id, filename, tpep_pickup_datetime AS pickup FROM yellow),
target AS (SELECT * FROM stamped WHERE pickup < TIMESTAMP '{C.MERGE_TARGET_BEFORE}')
SELECT s.unique_row_id, s.filename FROM stamped s
WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.unique_row_id = s.unique_row_id AND t.service = s.service)""",
    "partitioned_day_range": _with(["trips"]) + f"""SELECT CAST(pickup_datetime AS DATE) AS pickup_date,
  CAST(count(*) AS BIGINT) AS trips, CAST(round(sum(total_amount), 2) AS DOUBLE) AS total_amount
FROM trips
WHERE CAST(pickup_datetime AS DATE) BETWEEN DATE '{C.RANGE_DAYS[0]}' AND DATE '{C.RANGE_DAYS[1]}'
GROUP BY 1""",
    "paged_rides": f"""SELECT CAST(count(*) AS BIGINT) AS rides,
  round(avg(date_diff('minute', o.o_orderdate + to_seconds(l.l_orderkey % 86400), l.l_shipdate)), 4)
    AS avg_minutes
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE floor(l.l_orderkey / {C.PAGE_SIZE_ORDERS}) < (
  SELECT max(floor(l.l_orderkey / {C.PAGE_SIZE_ORDERS}))
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey)""",
    "write_n_files": """SELECT CAST(4 AS BIGINT) AS files, CAST(count(*) AS BIGINT) AS rows,
  CAST(round(sum(o_totalprice), 2) AS DOUBLE) AS total_price FROM orders""",
    "create_if_missing": """SELECT o_orderkey, o_custkey, CAST(round(o_totalprice, 2) AS DOUBLE) AS o_totalprice,
  o_orderdate FROM orders""",
    "replace_table": """SELECT o_custkey, CAST(round(sum(o_totalprice), 2) AS DOUBLE) AS total_price,
  CAST(count(*) AS BIGINT) AS orders FROM orders GROUP BY 1""",
    "csv_all_text": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders""",
    "external_table": "SELECT o_custkey, CAST(count(*) AS BIGINT) AS orders FROM orders GROUP BY 1",
    "csv_extra_fields": """SELECT o_orderkey, CAST(round(o_totalprice, 2) AS DOUBLE) AS o_totalprice, o_orderdate
FROM orders""",
    "load_month": _with(["green", "yellow"]) + f""", stamped AS (
  SELECT md5({_KEY7_G}) AS unique_row_id, filename FROM green
  UNION ALL
  SELECT md5({_KEY7_Y}) AS unique_row_id, filename FROM yellow)
SELECT filename, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT unique_row_id) AS BIGINT) AS distinct_keys,
  CAST(count(*) AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS inserted_again
FROM stamped WHERE filename IN ('green_tripdata_1996-03.csv', 'yellow_tripdata_1996-03.csv') GROUP BY 1""",
    "quarter_label": _with(["trips"]) + """SELECT CAST(extract(year FROM pickup_datetime) AS VARCHAR) || '/Q'
  || CAST(extract(quarter FROM pickup_datetime) AS VARCHAR) AS year_quarter, CAST(count(*) AS BIGINT) AS trips
FROM trips GROUP BY 1""",
    "ordered_limit": """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM (
  SELECT * FROM customer ORDER BY c_nationkey DESC, c_name ASC, c_custkey ASC LIMIT 100)
ORDER BY c_name, c_custkey LIMIT 40""",
})

_EVENTS_MS = ("(SELECT event_id, event_type, make_timestamp(epoch_us(ts) // 1000 * 1000) AS t "
              "FROM events)")

_SESSIONS = _with(["green"]) + """, g AS (
  SELECT CAST(TRY_CAST(PULocationID AS INTEGER) AS BIGINT) AS PULocationID,
         CAST(TRY_CAST(DOLocationID AS INTEGER) AS BIGINT) AS DOLocationID,
         lpep_dropoff_datetime AS t FROM green),
marked AS (
  SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY PULocationID, DOLocationID ORDER BY t)
                      <= INTERVAL 5 MINUTE THEN 0 ELSE 1 END AS new_session FROM g),
numbered AS (
  SELECT *, sum(new_session) OVER (PARTITION BY PULocationID, DOLocationID ORDER BY t
                                   ROWS UNBOUNDED PRECEDING) AS sid FROM marked),
sessions AS (
  SELECT PULocationID, DOLocationID, min(t) AS session_start,
         max(t) + INTERVAL 5 MINUTE AS session_end, CAST(count(*) AS BIGINT) AS longest_streak
  FROM numbered GROUP BY PULocationID, DOLocationID, sid),
closed AS (
  SELECT s.* FROM sessions s
  WHERE s.session_end <= (SELECT max(t) FROM g) - INTERVAL 5 SECOND)
"""

ORACLE.update({
    "passthrough_events": f"""SELECT event_id AS test_data, t AS event_timestamp FROM {_EVENTS_MS}""",
    "tumbling_counts": f"""WITH e AS {_EVENTS_MS}
SELECT date_trunc('minute', t) AS event_hour, event_type, CAST(count(*) AS BIGINT) AS num_hits
FROM e GROUP BY 1, 2
HAVING date_trunc('minute', t) + INTERVAL 1 MINUTE <= (SELECT max(t) FROM e) - INTERVAL 1 SECOND""",
    "session_counts": _SESSIONS + "SELECT * FROM closed",
    "session_upsert_last": _SESSIONS + """SELECT PULocationID, DOLocationID, longest_streak FROM (
  SELECT *, row_number() OVER (PARTITION BY PULocationID, DOLocationID
                               ORDER BY session_end DESC) AS rn FROM closed) WHERE rn = 1""",
    "longest_streak": _SESSIONS + """SELECT PULocationID, DOLocationID, longest_streak FROM closed
ORDER BY longest_streak DESC, PULocationID, DOLocationID LIMIT 1""",
    "passthrough_trips": _with(["green"]) + """SELECT VendorID, lpep_pickup_datetime,
  lpep_dropoff_datetime, store_and_fwd_flag, RatecodeID, PULocationID, DOLocationID,
  CAST(passenger_count AS BIGINT) AS passenger_count, trip_distance, fare_amount, extra, mta_tax,
  tip_amount, tolls_amount, ehail_fee, improvement_surcharge, total_amount,
  CAST(payment_type AS BIGINT) AS payment_type, CAST(trip_type AS BIGINT) AS trip_type,
  congestion_surcharge FROM green""",
    "json_round_trip": _with(["trips"]) + """SELECT service, VendorID, pickup_datetime,
  dropoff_datetime, CAST(passenger_count AS BIGINT) AS passenger_count, trip_distance, RatecodeID,
  store_and_fwd_flag, PULocationID, DOLocationID, CAST(payment_type AS BIGINT) AS payment_type,
  fare_amount, extra, mta_tax, tip_amount, tolls_amount, ehail_fee, improvement_surcharge,
  total_amount, CAST(trip_type AS BIGINT) AS trip_type, congestion_surcharge, filename FROM trips""",
})

ORACLE.update({
    "event_sessions": """WITH e AS (
  SELECT user_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS t FROM events),
marked AS (
  SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) <= INTERVAL 30 MINUTE
                 THEN 0 ELSE 1 END AS new_session FROM e),
numbered AS (
  SELECT *, sum(new_session) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING)
           AS sid FROM marked),
sessions AS (
  SELECT user_id, min(t) AS session_start, max(t) + INTERVAL 30 MINUTE AS session_end,
         CAST(count(*) AS BIGINT) AS events FROM numbered GROUP BY user_id, sid)
SELECT * FROM sessions WHERE session_end <= (SELECT max(t) FROM e) - INTERVAL 5 SECOND""",
    "quarterly_revenue_calendar": _with(["zones", "green", "yellow"], _QUARTERLY)
    + """SELECT a.service_type, CAST(a.year AS BIGINT) AS year, CAST(a.quarter AS BIGINT) AS quarter,
  CAST(round(a.total_amount, 2) AS DOUBLE) AS total_amount,
  CAST(round(b.total_amount, 2) AS DOUBLE) AS total_amount_prev_year,
  round((CASE WHEN b.total_amount = 0 THEN NULL
              ELSE CAST(a.total_amount AS DOUBLE) / CAST(b.total_amount AS DOUBLE) END - 1) * 100, 4)
    AS yoy_growth
FROM q a LEFT JOIN q b
  ON a.service_type = b.service_type AND a.quarter = b.quarter AND a.year = b.year + 1""",
    "zones_seed": _with(["zones"], _DIM_ZONES)
    + "SELECT CAST(locationid AS BIGINT) AS locationid, borough, zone, service_zone FROM dim_zones",
})


# late rows change nothing; the first third of the time range comes twice and its windows drop
ORACLE["tumbling_late_rows"] = f"""WITH e AS {_EVENTS_MS},
ms AS (SELECT epoch_us(t) / 1000.0 AS ms, date_trunc('minute', t) AS w, event_type FROM e),
late AS (SELECT count(DISTINCT (w, event_type)) AS n FROM ms
         WHERE ms <= (SELECT min(ms) + (max(ms) - min(ms)) * 1 / 3 FROM ms))
SELECT date_trunc('minute', t) AS event_hour, event_type, CAST(count(*) AS BIGINT) AS num_hits,
  CAST((SELECT n FROM late) AS BIGINT) AS late_groups
FROM e GROUP BY 1, 2
HAVING date_trunc('minute', t) + INTERVAL 1 MINUTE <= (SELECT max(t) FROM e) - INTERVAL 1 SECOND"""

ORACLE.update({
    "rollup_incremental": _with(["trips"]) + """SELECT PULocationID AS zone, strftime(pickup_datetime, '%Y-%m') AS month,
  CAST(count(*) AS BIGINT) AS trips, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
  CAST(min(trip_distance) AS DOUBLE) AS shortest, CAST(max(trip_distance) AS DOUBLE) AS longest,
  round(avg(trip_distance), 4) AS avg_distance FROM trips GROUP BY 1, 2""",
    "distinct_vendors_scan": ORACLE["distinct_vendors_range"],
    "load_reconciliation": _with(["green", "yellow"]) + """, files AS (
  SELECT 'green' AS service, count(*) AS n FROM green WHERE filename = 'green_tripdata_1996-03.csv'
  UNION ALL SELECT 'yellow', count(*) FROM yellow WHERE filename = 'yellow_tripdata_1996-03.csv')
SELECT service, CAST(run AS INTEGER) AS run, CAST(n AS BIGINT) AS source_rows, CAST(n AS BIGINT) AS staged_rows,
  CAST(CASE run WHEN 1 THEN n ELSE 0 END AS BIGINT) AS inserted_rows,
  CAST(CASE run WHEN 1 THEN 0 ELSE n END AS BIGINT) AS rejected_rows, 'match' AS status
FROM files, (VALUES (1), (2)) runs(run)""",
    "bucketed_load": _with(["green"]) + f""", stamped AS (SELECT md5({_KEY7_G}) AS unique_row_id, filename FROM green),
first AS (SELECT unique_row_id, min(filename) AS filename FROM stamped GROUP BY 1)
SELECT filename, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT unique_row_id) AS BIGINT) AS distinct_keys
FROM stamped SEMI JOIN first USING (unique_row_id, filename) GROUP BY 1""",
    "clustered_scan": _with(["trips"]) + """SELECT PULocationID, CAST(count(*) AS BIGINT) AS trips,
  CAST(round(sum(total_amount), 2) AS DOUBLE) AS total_amount FROM trips WHERE DOLocationID = '7' GROUP BY 1""",
})


def oracle_sql() -> dict:
    return dict(ORACLE)
