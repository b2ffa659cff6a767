import datetime as dt

import pytest

from conftest import plan_text
from pyspark.sql import functions as F

from farebox.operators import aggregates as A
from farebox.operators import filters as FL
from farebox.operators import joins as J
from farebox.operators import topk as O
from farebox.operators import windows as W

ZONES = [(1, "EWR", "Newark Airport", "EWR"), (2, "Queens", "Jamaica Bay", "Boro Zone"),
         (3, "Unknown", "NV", "N/A"), (4, None, "Nowhere", "N/A")]
ZSCHEMA = "locationid int, borough string, zone string, service_zone string"


def zones(spark):
    return spark.createDataFrame(ZONES, ZSCHEMA)


def test_dedupe_total_order_nulls_first(spark):
    df = spark.createDataFrame(
        [(1, "a", 5.0), (1, "a", None), (1, "b", 1.0), (2, "a", 3.0), (2, "a", 2.0)],
        "k int, s string, v double")
    got = sorted(tuple(r) for r in W.dedupe(df, ["k"]).collect())
    assert got == [(1, "a", None), (2, "a", 2.0)]
    got = sorted(tuple(r) for r in W.dedupe(df, ["k"], [F.col("v").desc_nulls_last()]).collect())
    assert got == [(1, "a", 5.0), (2, "a", 3.0)]


def test_dedupe_is_partial_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    assert "partial_min" in plan_text(W.dedupe(df, ["k"]))
    assert "WindowGroupLimit" in plan_text(W.dedupe(df, ["k"], [F.col("v").desc()]))


def test_lag_rows_shifts_on_missing_quarter(spark):
    rows = [("G", 2019, q, 100.0 * q) for q in (1, 2, 3, 4)] + \
           [("G", 2020, q, 200.0 * q) for q in (1, 3, 4)]  # 2020 Q2 missing
    df = spark.createDataFrame(rows, "service_type string, year int, quarter int, total double")
    by_rows = {(r.year, r.quarter): r.prev for r in W.lag_rows(
        df, "total", 4, ["service_type"], ["year", "quarter"], "prev").collect()}
    # Row-based: four rows back from 2020 Q3 is 2019 Q2 because 2020 Q2 is missing.
    assert by_rows[(2020, 1)] == 100.0
    assert by_rows[(2020, 3)] == 200.0 and by_rows[(2020, 4)] == 300.0
    cal = {(r.year, r.quarter): r.prev for r in W.lag_calendar(
        df, "total", ["service_type", "year", "quarter"], "year", "prev").collect()}
    assert cal[(2020, 3)] == 300.0 and cal[(2020, 4)] == 400.0 and cal[(2019, 1)] is None


def test_group_percentiles_on_rows_keeps_rows_and_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), (None, 10.0), (None, 20.0)],
                               "g string, x double")
    out = W.group_percentiles_on_rows(df, "x", ["g"], {"p50": 0.5, "p90": 0.9})
    rows = sorted((r.g or "", r.x, r.p50, round(r.p90, 6)) for r in out.collect())
    assert rows == [("", 10.0, 15.0, 19.0), ("", 20.0, 15.0, 19.0),
                    ("a", 1.0, 2.0, 2.8), ("a", 2.0, 2.0, 2.8), ("a", 3.0, 2.0, 2.8)]


def test_group_percentiles_one_row_per_group(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(1, 101)], "g string, x double")
    r = A.group_percentiles(df, "x", ["g"], {"p97": 0.97, "p95": 0.95, "p90": 0.9}).collect()
    assert len(r) == 1 and abs(r[0].p97 - 97.03) < 1e-9 and abs(r[0].p90 - 90.1) < 1e-9


def test_nth_in_group_ties_broken(spark):
    df = spark.createDataFrame([("z", "b", 5.0), ("z", "a", 5.0), ("z", "c", 9.0)],
                               "pz string, dz string, p90 double")
    r = W.nth_in_group(df, ["pz"], [F.col("p90").desc(), F.col("dz")], 2, rank_col="rk").collect()
    assert [(x.dz, x.rk) for x in r] == [("a", 2)]


def test_top_n_nulls_and_ties(spark):
    df = spark.createDataFrame([("a", None), ("b", 3.0), ("c", 3.0)], "k string, v double")
    assert [r.k for r in O.top_n(df, ["v"], 1, tie=["k"]).collect()] == ["b"]
    assert [r.k for r in O.top_n(df, ["v"], 1, nulls_first=True).collect()] == ["a"]
    assert [r.k for r in O.bottom_n(df, ["v"], 1, tie=["k"]).collect()] == ["a"]


def test_known_zones_drops_null_borough_too(spark):
    got = sorted(r.locationid for r in J.known_zones(zones(spark)).collect())
    assert got == [1, 2]


def test_with_zone_names_left_and_inner(spark):
    trips = spark.createDataFrame([("1", "2", 5.0), ("3", "9", 1.0)],
                                  "PULocationID string, DOLocationID string, tip double")
    left = J.with_zone_names(trips, zones(spark), "left", "PULocationID", "DOLocationID")
    rows = sorted((r.pickup_zone, r.dropoff_zone) for r in left.collect())
    assert rows == [("NV", None), ("Newark Airport", "Jamaica Bay")]
    inner = J.with_zone_names(trips, zones(spark), "inner", "PULocationID", "DOLocationID",
                              exclude_borough=["Unknown"])
    assert inner.count() == 1


def test_bounded_broadcast_follows_the_size_of_the_files(spark, tmp_path):
    small, big, path = spark.range(10), spark.range(100000).withColumnRenamed("id", "k"), str(tmp_path / "side")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for rows, fits in ((small, True), (spark.range(200_000), False)):  # grown under the same name
            rows.withColumnRenamed("id", "k").coalesce(1).write.mode("overwrite").parquet(path)
            side = J.bounded_broadcast(spark.read.parquet(path), 50_000)
            assert ("BroadcastHashJoin" in plan_text(big.join(side, "k"))) == fits
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_orphans_and_anti_join(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "z int")
    assert [r.z for r in J.orphans(df, "z", zones(spark), "locationid").collect()] == [9]
    src = spark.createDataFrame([("k1", 1), ("k2", 2), ("k2", 3)], "key string, v int")
    tgt = spark.createDataFrame([("k1",)], "key string")
    assert sorted(r.v for r in J.anti_join(src, tgt, "key").collect()) == [2, 3]


def test_filters(spark, monkeypatch):
    ts = [dt.datetime(2019, 9, 30, 23, 0), dt.datetime(2019, 10, 1, 0, 0),
          dt.datetime(2019, 10, 31, 23, 59), dt.datetime(2019, 11, 1, 0, 0)]
    df = spark.createDataFrame([(t, t, f"green_tripdata_2019-1{i}.csv") for i, t in enumerate(ts)],
                               "p timestamp_ntz, d timestamp_ntz, filename string")
    assert FL.in_period(df, "p", "2019-10-01", "2019-11-01").count() == 2
    assert FL.on_day(df, "p", "2019-10-01").count() == 1
    assert FL.between_days(df, "p", "2019-10-01", "2019-11-01").count() == 3
    assert FL.from_files(df, "green_tripdata_2019-1_.csv").count() == 4
    assert FL.from_files(df, "green\\_tripdata%").count() == 4
    assert FL.resolve_days_back(7) == 7
    monkeypatch.setenv("DAYS_BACK", "12")
    assert FL.resolve_days_back() == 12
    monkeypatch.delenv("DAYS_BACK")
    assert FL.resolve_days_back() == 30
    assert FL.recent_trips(df, "p", days=31, today="2019-11-01").count() == 3


@pytest.mark.parametrize("n", [1, 2])
def test_least_frequent_zone(spark, n):
    trips = spark.createDataFrame([("1",), ("1",), ("2",), ("3",)], "PULocationID string")
    r = A.least_frequent_zone(trips, zones(spark), n=n).collect()
    assert [(x.PULocationID, x.trips_count, x.Zone) for x in r][:1] == [("2", 1, "Jamaica Bay")]


def test_best_worst_quarter_ignores_nulls(spark):
    q = spark.createDataFrame([("G", 2020, 1, None), ("G", 2020, 2, 5.0), ("G", 2020, 3, -3.0)],
                              "service_type string, year int, quarter int, yoy_growth double")
    r = A.best_worst_quarter(q, 2020).first()
    assert (r.max_growth_quarter, r.min_growth_quarter) == (2, 3)


def test_counts_profile_distinct(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 5.0), (2, None)], "v int, d double")
    assert A.row_count(df).first()[0] == 3
    assert A.count_where(df, F.col("d") > 1).first()[0] == 2
    assert A.distinct_count(df, "v").first()[0] == 2
    r = A.profile(df, ["v", "d"]).first()
    assert (r.min_v, r.max_v, r.min_d, r.max_d) == (1, 2, 2.0, 5.0)


def test_avg_minutes_and_longest_hours(spark):
    rows = [(dt.datetime(2020, 1, 1, 0, 0, 59), dt.datetime(2020, 1, 1, 0, 1, 1)),
            (dt.datetime(2020, 1, 1, 0, 0, 0), dt.datetime(2020, 1, 1, 3, 59, 0)),
            (dt.datetime(2020, 1, 2, 0, 0, 0), dt.datetime(2020, 1, 1, 0, 0, 0))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert A.avg_minutes(df, "a", "b").first()[0] == (1 + 239 - 1440) / 3
    assert A.longest_hours(df, "a", "b").first()[0] == 3
