"""Declared schemas of every source and sink (explicit StructTypes).

Timestamps of trip records are local wall-clock times without a zone, so
batch schemas use ``TIMESTAMP_NTZ``; streaming jobs convert to ``TIMESTAMP``
(session zone UTC) where a watermark needs it.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _f(name, dtype, comment=None, nullable=True):
    meta = {"comment": comment} if comment else {}
    return T.StructField(name, dtype, nullable, metadata=meta)


S, I, L, D, TS = (T.StringType(), T.IntegerType(), T.LongType(),
                  T.DoubleType(), T.TimestampNTZType())
MONEY = T.DecimalType(38, 9)

# Columns shared by yellow and green raw trip files, in file order.
_TRIP_TAIL = [
    _f("passenger_count", I, "Number of passengers, entered by the driver"),
    _f("trip_distance", D, "Elapsed trip distance in miles"),
    _f("RatecodeID", S, "Final rate code in effect at the end of the trip"),
    _f("store_and_fwd_flag", S, "Y = held in vehicle memory before sending"),
    _f("PULocationID", S, "Zone in which the meter was engaged"),
    _f("DOLocationID", S, "Zone in which the meter was disengaged"),
    _f("payment_type", I, "How the passenger paid"),
    _f("fare_amount", D, "Time-and-distance fare from the meter"),
    _f("extra", D, "Miscellaneous extras and surcharges"),
    _f("mta_tax", D, "MTA tax triggered by the metered rate"),
    _f("tip_amount", D, "Tip amount (credit card tips only)"),
    _f("tolls_amount", D, "Total tolls paid in trip"),
    _f("improvement_surcharge", D, "Improvement surcharge at flag drop"),
    _f("total_amount", D, "Total charged to passengers, cash tips excluded"),
]

YELLOW_RAW = T.StructType([
    _f("VendorID", S, "Provider of the record"),
    _f("tpep_pickup_datetime", TS, "Meter engaged"),
    _f("tpep_dropoff_datetime", TS, "Meter disengaged"),
    *_TRIP_TAIL,
    _f("congestion_surcharge", D, "Congestion surcharge"),
])

GREEN_RAW = T.StructType([
    _f("VendorID", S, "Provider of the record"),
    _f("lpep_pickup_datetime", TS, "Meter engaged"),
    _f("lpep_dropoff_datetime", TS, "Meter disengaged"),
    _f("store_and_fwd_flag", S),
    _f("RatecodeID", S),
    _f("PULocationID", S),
    _f("DOLocationID", S),
    _f("passenger_count", I),
    _f("trip_distance", D),
    _f("fare_amount", D),
    _f("extra", D),
    _f("mta_tax", D),
    _f("tip_amount", D),
    _f("tolls_amount", D),
    _f("ehail_fee", D),
    _f("improvement_surcharge", D),
    _f("total_amount", D),
    _f("payment_type", I),
    _f("trip_type", I, "1 = street-hail, 2 = dispatch"),
    _f("congestion_surcharge", D),
])

FHV_RAW = T.StructType([
    _f("dispatching_base_num", S, "TLC base licence of the dispatching base"),
    _f("pickup_datetime", TS),
    _f("dropOff_datetime", TS),
    _f("PUlocationID", S),
    _f("DOlocationID", S),
    _f("SR_Flag", S, "Shared ride flag"),
    _f("Affiliated_base_number", S),
])

ZONES = T.StructType([
    _f("locationid", I, "Taxi zone id"),
    _f("borough", S),
    _f("zone", S),
    _f("service_zone", S),
])

# Green-trip JSON events (session job) and test events (tumbling job).
GREEN_EVENT = T.StructType([
    _f("lpep_pickup_datetime", S),
    _f("lpep_dropoff_datetime", S),
    _f("PULocationID", I),
    _f("DOLocationID", I),
    _f("passenger_count", S),
    _f("trip_distance", D),
    _f("tip_amount", D),
])

# The producer sends a float epoch in ms, so read it as double and cast.
TEST_EVENT = T.StructType([
    _f("test_data", L),
    _f("event_timestamp", D, "Epoch milliseconds (float on the wire)"),
])

# Paged API: one landed file per page, records as an array.
RIDE = T.StructType([
    _f("ride_id", L),
    _f("trip_pickup_date_time", TS),
    _f("trip_dropoff_date_time", TS),
    _f("total_amt", D),
])
PAGE = T.StructType([
    _f("page_no", L),
    _f("records", T.ArrayType(RIDE)),
])

# Sinks.
PROCESSED_EVENTS = T.StructType([_f("test_data", L),
                                 _f("event_timestamp", T.TimestampType())])
EVENTS_AGGREGATED = T.StructType([_f("event_hour", T.TimestampType()),
                                  _f("test_data", L), _f("num_hits", L)])
GREEN_AGGREGATED = T.StructType([_f("PULocationID", I), _f("DOLocationID", I),
                                 _f("longest_streak", L)])


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def text_times(schema: T.StructType) -> T.StructType:
    """The schema of messages that carry their timestamps as text."""
    return T.StructType([T.StructField(f.name, T.StringType()) if "datetime" in f.name else f for f in schema])
