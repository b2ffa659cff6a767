import datetime as dt

from pyspark.sql import functions as F

from farebox.functions import columns as X


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_safe_int_traps(spark):
    got = one(spark, X.safe_int("s"), [("7",), ("1.0",), ("abc",), (None,)], "s string")
    assert got == [7, None, None, None]
    assert one(spark, X.safe_int("d"), [(2.5,)], "d double") == [2]


def test_payment_description_else_empty(spark):
    got = one(spark, X.payment_description("p"), [(1,), (2,), (6,), (7,), (None,)], "p int")
    assert got == ["Credit card", "Cash", "Voided trip", "EMPTY", "EMPTY"]
    got = one(spark, X.payment_description("p"), [("3",), ("x",)], "p string")
    assert got == ["No charge", "EMPTY"]


def test_distance_bucket_boundaries(spark):
    data = [(0.0,), (1.0,), (1.01,), (3.0,), (7.0,), (7.5,), (10.0,), (10.01,), (None,)]
    got = one(spark, X.distance_bucket("d"), data, "d double")
    assert got == ["< 1", "< 1", "1-3", "1-3", "3-7", "7-10", "7-10", "10+", None]


def test_minute_boundaries_vs_whole_minutes(spark):
    a, b = dt.datetime(2020, 1, 1, 0, 0, 59), dt.datetime(2020, 1, 1, 0, 1, 1)
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(X.minute_boundaries("a", "b").alias("m"),
                  X.whole_units_between("MINUTE", "a", "b").alias("w")).first()
    assert (r.m, r.w) == (1, 0)


def test_hours_and_seconds_between(spark):
    a, b = dt.datetime(2020, 1, 1, 0, 0, 0), dt.datetime(2020, 1, 1, 2, 59, 59)
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(X.hours_between("a", "b").alias("h"), X.seconds_between("a", "b").alias("s")).first()
    assert (r.h, r.s) == (2, 2 * 3600 + 59 * 60 + 59)


def test_surrogate_key_marks_nulls(spark):
    df = spark.createDataFrame([("1", None), (None, "1")], "a string, b string")
    k = [r[0] for r in df.select(X.surrogate_key("a", "b")).collect()]
    assert k[0] != k[1] and all(len(x) == 32 for x in k)
    import hashlib
    expect = hashlib.md5(("1-" + X.SURROGATE_NULL).encode()).hexdigest()
    assert k[0] == expect


def test_row_key_without_separator_collides(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3")], "a string, b string")
    plain = [r[0] for r in df.select(X.row_key(["a", "b"])).collect()]
    sep = [r[0] for r in df.select(X.row_key(["a", "b"], sep="|")).collect()]
    assert plain[0] == plain[1] and sep[0] != sep[1]
    raw = df.select(X.row_key(["a", "b"], binary=True)).first()[0]
    assert len(raw) == 16


def test_safe_divide_and_growth(spark):
    df = spark.createDataFrame([(110.0, 100.0), (5.0, 0.0), (5.0, None)], "a double, b double")
    got = [r[0] for r in df.select(X.pct_growth("a", "b")).collect()]
    assert abs(got[0] - 10.0) < 1e-9 and got[1] is None and got[2] is None


def test_calendar_and_text(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 5, 17, 3, 0), " Cash ")],
                               "ts timestamp_ntz, p string")
    r = X.with_calendar(df, "ts").select("year", "quarter", "year_quarter", "month",
                                         X.text_in("p", ["cash", "credit card"]).alias("in")).first()
    assert (r.year, r.quarter, r.year_quarter, r.month, r["in"]) == (2020, 2, "2020/Q2", 5, True)


def test_to_ts_with_pattern_is_lenient(spark):
    df = spark.createDataFrame([("2019-10-01 12:00:01",), ("not a time",)], "s string")
    got = [r[0] for r in df.select(X.to_ts("s", "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == [dt.datetime(2019, 10, 1, 12, 0, 1), None]


def test_epoch_ms_float(spark):
    df = spark.createDataFrame([(1704067207179.575,)], "ms double")
    got = df.select(X.epoch_ms_to_ts("ms").cast("timestamp_ntz")).first()[0]
    assert got == dt.datetime(2024, 1, 1, 0, 0, 7, 179000)


def test_days_ago(spark):
    df = spark.createDataFrame([("2024-03-01",)], "d string")
    assert df.select(X.days_ago(30, F.col("d"))).first()[0] == dt.date(2024, 1, 31)


def test_scale_conf_sizes_partitions():
    from farebox.session import scale_conf
    c = scale_conf(100 * 1024 ** 4, 1000, 8)
    assert int(c["spark.sql.shuffle.partitions"]) % 8000 == 0
    assert int(c["spark.sql.shuffle.partitions"]) * 256 * 1024 ** 2 >= 100 * 1024 ** 4
    assert scale_conf(10 * 1024 ** 2, 1, 8)["spark.sql.shuffle.partitions"] == "8"
