"""Column -> Column helpers (the reference's SQL macros and scalar idioms).

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColLike = Column | str


def _c(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- casts

def safe_int(c: ColLike) -> Column:
    """Safe cast to int: NULL instead of an error ('1.0' -> NULL, 2.5 -> 2)."""
    return _c(c).try_cast("int")


def to_num(c: ColLike, precision: int = 38, scale: int = 9) -> Column:
    """Cast to the warehouse NUMERIC type."""
    return _c(c).cast(f"decimal({precision},{scale})")


def to_ts(c: ColLike, fmt: str | None = None) -> Column:
    """Wall-clock timestamp (TIMESTAMP_NTZ). Text is parsed leniently (NULL on
    a bad value); with ``fmt`` the pattern is applied as in TO_TIMESTAMP."""
    col = _c(c)
    if fmt is None:
        return col.try_cast("timestamp_ntz")
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def to_text(c: ColLike) -> Column:
    return _c(c).cast("string")


# ---------------------------------------------------------------- CASE expressions

# Payment type codes and their descriptions, code 1 to 6.
PAYMENT_TYPES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_OTHER = "EMPTY"


def payment_description(c: ColLike) -> Column:
    """Simple CASE on the safe-cast code; anything else (NULL too) is EMPTY."""
    code = safe_int(c)
    expr = None
    for k, v in PAYMENT_TYPES.items():
        expr = (F.when(code == k, v) if expr is None
                else expr.when(code == k, v))
    return expr.otherwise(PAYMENT_OTHER)


# Distance bucket labels and upper bounds in miles.
DISTANCE_BUCKETS = [("< 1", 1), ("1-3", 3), ("3-7", 7), ("7-10", 10)]
DISTANCE_OVER = "10+"


def distance_bucket(c: ColLike) -> Column:
    """Searched CASE: <=1, (1,3], (3,7], (7,10], >10; NULL stays NULL."""
    d = _c(c)
    expr = None
    for label, hi in DISTANCE_BUCKETS:
        expr = F.when(d <= hi, label) if expr is None else expr.when(d <= hi, label)
    return expr.when(d > DISTANCE_BUCKETS[-1][1], DISTANCE_OVER)


# ---------------------------------------------------------------- dates

def with_calendar(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """Adds year, quarter, 'YYYY/Qn', month of ``ts`` (all ints but the label)."""
    t = F.col(ts)
    return df.withColumns({
        f"{prefix}year": F.year(t),
        f"{prefix}quarter": F.quarter(t),
        f"{prefix}year_quarter": F.concat(F.year(t).cast("string"), F.lit("/Q"),
                                          F.quarter(t).cast("string")),
        f"{prefix}month": F.month(t),
    })


def truncate_ts(unit: str, c: ColLike) -> Column:
    """``date_trunc(unit, ts)`` that stays a wall-clock TIMESTAMP_NTZ
    (Spark's date_trunc returns a zoned TIMESTAMP)."""
    return F.date_trunc(unit, _c(c)).cast("timestamp_ntz")


def minute_boundaries(start: ColLike, end: ColLike) -> Column:
    """Minutes between two timestamps counted as crossed minute boundaries
    (00:00:59 -> 00:01:01 is 1), the DATE_DIFF('minute', ..) convention."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", _c(start)),
                            F.date_trunc("minute", _c(end)))


def whole_units_between(unit: str, start: ColLike, end: ColLike) -> Column:
    """TIMESTAMPDIFF(unit, start, end): whole elapsed units, truncated."""
    return F.timestamp_diff(unit, _c(start), _c(end))


def seconds_between(start: ColLike, end: ColLike) -> Column:
    return whole_units_between("SECOND", start, end)


def hours_between(start: ColLike, end: ColLike) -> Column:
    return whole_units_between("HOUR", start, end)


def epoch_ms_to_ts(c: ColLike) -> Column:
    """TO_TIMESTAMP_LTZ(ms, 3); float input is truncated to whole ms first."""
    return F.timestamp_millis(_c(c).cast("bigint"))


def days_ago(days: int, today: ColLike | None = None) -> Column:
    """``today - interval N day`` (today defaults to current_date())."""
    base = F.current_date() if today is None else _c(today).cast("date")
    return F.date_sub(base, days)


# ---------------------------------------------------------------- text

def norm_text(c: ColLike) -> Column:
    return F.lower(F.trim(_c(c)))


def text_in(c: ColLike, values: Iterable[str]) -> Column:
    """``lower(trim(c)) IN (...)`` with the list normalised the same way."""
    return norm_text(c).isin([v.strip().lower() for v in values])


# ---------------------------------------------------------------- arithmetic

def safe_divide(a: ColLike, b: ColLike) -> Column:
    """NULL on division by zero; computed in double so no digits are lost."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def pct_growth(cur: ColLike, prev: ColLike) -> Column:
    return (safe_divide(cur, prev) - F.lit(1)) * F.lit(100)


# ---------------------------------------------------------------- keys

# Fixed value: the marker that stands for NULL inside a surrogate key.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: ColLike) -> Column:
    """md5 of the text of each value (NULL marked) joined with '-'."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("-"))
        parts.append(F.coalesce(to_text(c), F.lit(SURROGATE_NULL)))
    return F.md5(F.concat(*parts))


def row_key(cols: Iterable[ColLike], binary: bool = False, sep: str = "") -> Column:
    """Row fingerprint: md5 over coalesce(text(c), '') of each column.

    ``sep=''`` concatenates without separator (so ('1','23') == ('12','3'));
    ``binary=True`` returns the 16 raw bytes instead of 32 hex characters.
    """
    parts = [F.coalesce(to_text(c), F.lit("")) for c in cols]
    text = F.concat_ws(sep, *parts) if sep else F.concat(*parts)
    h = F.md5(text)
    return F.unhex(h) if binary else h


# Row-key field lists: 7 fields (row store flow) and 5 fields (warehouse flow).
ROW_KEY_7 = ["VendorID", "{pickup}", "{dropoff}", "PULocationID", "DOLocationID",
             "fare_amount", "trip_distance"]
ROW_KEY_5 = ["VendorID", "{pickup}", "{dropoff}", "PULocationID", "DOLocationID"]


def row_key_fields(service: str, width: int = 7) -> list[str]:
    prefix = "lpep" if service.lower() == "green" else "tpep"
    fields = ROW_KEY_7 if width == 7 else ROW_KEY_5
    return [f.format(pickup=f"{prefix}_pickup_datetime",
                     dropoff=f"{prefix}_dropoff_datetime") for f in fields]
