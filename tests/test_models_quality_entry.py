import datetime as dt

import duckdb
from conftest import SF_SMALL, plan_text
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from farebox import fixtures as fx
from farebox.operators import quality as Q
from farebox.plans import models as M
from tools.check_oracle import digest


def green_raw(spark, rows):
    base = {c: None for c in fx._GREEN_ORDER}
    data = []
    for r in rows:
        d = dict(base)
        d.update(r)
        data.append(tuple(d[c] for c in fx._GREEN_ORDER))
    from farebox.schemas import GREEN_RAW
    return spark.createDataFrame(data, GREEN_RAW)


def test_stg_green_dedupes_and_types(spark):
    t = dt.datetime(2019, 10, 1, 8, 0)
    raw = green_raw(spark, [
        {"VendorID": "2", "lpep_pickup_datetime": t, "fare_amount": 9.0, "payment_type": 2,
         "PULocationID": "7", "trip_type": 1},
        {"VendorID": "2", "lpep_pickup_datetime": t, "fare_amount": 5.0, "payment_type": 9},
        {"VendorID": None, "lpep_pickup_datetime": t, "fare_amount": 1.0},
        {"VendorID": "1", "lpep_pickup_datetime": t, "payment_type": None},
    ])
    rows = sorted(M.stg_green(raw).collect(), key=lambda r: r.vendorid)
    assert [r.vendorid for r in rows] == [1, 2]
    assert rows[0].payment_type == 0 and rows[0].payment_type_description == "EMPTY"
    assert float(rows[1].fare_amount) == 5.0            # total order: smallest fare first
    assert rows[1].payment_type_description == "EMPTY"  # code 9
    assert str(M.stg_green(raw).schema["fare_amount"].dataType) == "DecimalType(38,9)"


def test_fact_trips_joins_known_zones_by_broadcast(spark):
    fact = M.staged_fact(fx.green(spark, SF_SMALL), fx.yellow(spark, SF_SMALL),
                         fx.zones(spark, SF_SMALL))
    plan = plan_text(fact)
    assert plan.count("BroadcastHashJoin") >= 2
    boroughs = {r[0] for r in fact.select("pickup_borough").distinct().collect()}
    assert "Unknown" not in boroughs and None not in boroughs
    assert set(fact.columns) == set(M.FACT_COLUMNS)


def test_fare_percentiles_hold_no_group_buffer(spark):
    fact = M.staged_fact(fx.green(spark, SF_SMALL), fx.yellow(spark, SF_SMALL),
                         fx.zones(spark, SF_SMALL))
    assert "percentile(" not in plan_text(M.fct_monthly_fare_percentiles(fact))


def test_dim_zones_renames_boro(spark):
    z = spark.createDataFrame([(1, "Queens", "X", "Boro Zone"), (2, "EWR", "Y", "EWR")],
                              "locationid int, borough string, zone string, service_zone string")
    assert sorted(r.service_zone for r in M.dim_zones(z).collect()) == ["EWR", "Green Zone"]


def test_quarterly_yoy_and_calendar_variant(spark):
    fact = spark.createDataFrame(
        [("Green", dt.datetime(2019, m, 1), 100.0) for m in (1, 4, 7, 10)] +
        [("Green", dt.datetime(2020, m, 1), 110.0) for m in (1, 7, 10)],
        "service_type string, pickup_datetime timestamp_ntz, total_amount double")
    rows = {(r.year, r.quarter): r.yoy_growth for r in M.fct_quarterly_revenue(fact).collect()}
    cal = {(r.year, r.quarter): r.yoy_growth
           for r in M.fct_quarterly_revenue(fact, calendar=True).collect()}
    assert rows[(2019, 1)] is None and abs(cal[(2020, 3)] - 10.0) < 1e-9
    assert abs(rows[(2020, 3)] - 10.0) < 1e-9  # row-based base is 2019 Q2 (missing 2020 Q2)


def test_quality_checks_find_seeded_violations(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 9), (None, 7, None)],
                               "tripid string, payment_type int, zone int")
    dim = spark.createDataFrame([(1,), (2,)], "locationid int")
    rep = {r.check: (r.failures, r.status) for r in Q.run_checks([
        Q.check_unique(df, "tripid", "warn"),
        Q.check_not_null(df, "tripid"),
        Q.check_relationship(df, "zone", dim, "locationid"),
        Q.check_accepted(df, "payment_type", [1, 2, 3, 4, 5, 6], "warn"),
        Q.check_not_null(df, "payment_type"),
    ]).collect()}
    assert rep == {"unique_tripid": (1, "warn"), "not_null_tripid": (1, "error"),
                   "relationships_zone": (1, "error"),
                   "accepted_values_payment_type": (1, "warn"),
                   "not_null_payment_type": (0, "pass")}
    r = Q.reconcile(df, df.limit(2)).first()
    assert (r.source_rows, r.loaded_rows, r.status) == (3, 2, "mismatch")


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "revenue_monthly_total_amount" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_sample_queries_match_oracle_on_smoke_data(spark):
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    qs, sql = entry.queries(), entry.oracle_sql()
    for name in ["monthly_zone_revenue", "second_longest_dropoff", "top_revenue_zones",
                 "quality_report", "monthly_fare_percentiles", "tumbling_counts"]:
        df = qs[name](spark, SF_SMALL)
        cur = con.execute(sql[name])
        ocols = [d[0] for d in cur.description]
        assert sorted(df.columns) == sorted(ocols), name
        assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == \
            digest(ocols, cur.fetchall())[0], name


def test_percentiles_of_a_hot_group_of_distinct_values(spark):
    """A third of the rows in one group, all values distinct: exact, and its values
    are dealt over several partitions."""
    from farebox.operators.percentiles import group_percentile_values
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("k"),
                                   (F.col("id") * 1.37 % 1000).alias("x"))
    p = {"p10": 0.1, "p90": 0.9, "p97": 0.97}
    want = {r["k"]: r["v"] for r in df.groupBy("k").agg(F.percentile("x", F.array(*map(F.lit, p.values()))).alias("v")).collect()}
    got = group_percentile_values(df, "x", ["k"], p).collect()
    assert len(got) == len(want)
    for r in got:
        assert [r["p10"], r["p90"], r["p97"]] == pytest.approx(want[r["k"]], rel=1e-12)
    hot = df.filter("k = 0").repartitionByRange(4, "k", "x").select(F.spark_partition_id().alias("p")).groupBy("p").count()
    assert hot.filter("count > 0").count() == 4


def test_cli_build_all_and_backfill(spark, tmp):
    from farebox.__main__ import main
    t = fx.trips(spark, SF_SMALL)
    fx.raw_service(t, "Green").write.parquet(f"{tmp}/g")
    fx.raw_service(t, "Yellow").write.parquet(f"{tmp}/y")
    fx.fhv(spark, SF_SMALL).write.parquet(f"{tmp}/f")
    fx.zones(spark, SF_SMALL).write.option("header", True).csv(f"{tmp}/zones")
    assert main(["build", "--green", f"{tmp}/g", "--yellow", f"{tmp}/y", "--fhv", f"{tmp}/f",
                 "--zones", f"{tmp}/zones", "--prefix", "cli_"]) == 0
    direct = M.dm_monthly_zone_revenue(M.staged_fact(fx.green(spark, SF_SMALL),
                                                      fx.yellow(spark, SF_SMALL),
                                                      fx.zones(spark, SF_SMALL)))
    built = spark.table("cli_dm_monthly_zone_revenue")
    assert built.count() == direct.count() > 0
    assert spark.table("cli_fct_fhv_monthly_zone_traveltime_p90").count() == \
        spark.table("cli_dim_fhv_trips").count()
    from farebox.plans import loads as L
    y = fx.raw_service(t, "Yellow", keep_filename=True)
    glob_ = L.write_monthly_files(y, f"{tmp}/landing", "yellow")
    assert main(["backfill", "--service", "yellow", "--src", glob_, "--target",
                 f"{tmp}/yt"]) == 0
    assert spark.read.parquet(f"{tmp}/yt").count() > 0


def test_fixture_views_load_at_every_scale(spark):
    for sf in ("0.001", "0.01", "0.1"):
        d = f"/root/testdata/sf{sf}"
        n_li = fx.table(spark, d, "lineitem").count()
        assert fx.trips(spark, d).count() == n_li  # every lineitem becomes one trip
        assert fx.zones(spark, d).count() == fx.table(spark, d, "nation").count()
        assert fx.fhv(spark, d).count() == n_li
        assert fx.green(spark, d).count() + fx.yellow(spark, d).count() == n_li
