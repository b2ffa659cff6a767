import datetime as dt
import glob
import gzip
import os

import pytest

from conftest import SF_SMALL, plan_text
from pyspark.sql import functions as F

from farebox import fixtures as fx
from farebox import schemas
from farebox.functions.columns import row_key_fields
from farebox.operators.filters import scan_between
from farebox.plans import loads as L
from farebox.sinks import files as K
from farebox.sources import files as S
from farebox.sources import jdbc as JD
from farebox.sources.pages import land_pages, load_pages

YELLOW_HEADER = ",".join(f.name for f in schemas.YELLOW_RAW)


def yellow_line(vendor, pickup, fare, extra_fields=""):
    vals = [vendor, pickup, pickup, "1", "2.5", "1", "N", "10", "20", "1", fare,
            "0.5", "0.5", "1.0", "0", "0.3", "12.3", "2.5"]
    return ",".join(vals) + extra_fields


def write_csv(path, lines, header=YELLOW_HEADER, gz=False):
    text = "\n".join([header, *lines]) + "\n"
    if gz:
        with gzip.open(path, "wt") as fh:
            fh.write(text)
    else:
        with open(path, "w") as fh:
            fh.write(text)
    return path


def test_read_csv_extra_and_short_rows(spark, tmp):
    p = write_csv(f"{tmp}/y.csv", [yellow_line("1", "2021-01-01 00:00:00", "10.0", ",X,Y"),
                                   "2,2021-01-01 00:05:00"])
    rows = S.read_csv(spark, p, schemas.YELLOW_RAW).orderBy("VendorID").collect()
    assert len(rows) == 2 and rows[0].fare_amount == 10.0 and rows[1].fare_amount is None
    cols = S.read_csv(spark, p, schemas.YELLOW_RAW, columns=["VendorID", "fare_amount"]).columns
    assert cols == ["VendorID", "fare_amount"]


def test_read_csv_all_strings_without_schema(spark, tmp):
    p = write_csv(f"{tmp}/y.csv", [yellow_line("1", "2021-01-01 00:00:00", "10.0")])
    df = S.read_csv(spark, p, None)
    assert df.columns[:2] == ["VendorID", "tpep_pickup_datetime"]
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}


def test_read_gzip_csv(spark, tmp):
    p = write_csv(f"{tmp}/y.csv.gz", [yellow_line("1", "2021-01-01 00:00:00", "10.0")], gz=True)
    df = S.read_csv(spark, p, schemas.YELLOW_RAW, repartition=4)
    assert df.count() == 1 and df.rdd.getNumPartitions() == 4


def test_read_zones_any_header(spark, tmp):
    p = f"{tmp}/zones.csv"
    with open(p, "w") as fh:
        fh.write('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n'
                 '264,"Unknown","N/A","N/A"\n')
    z = S.read_zones(spark, p)
    assert z.schema["locationid"].dataType.simpleString() == "int"
    assert sorted(r.locationid for r in z.collect()) == [1, 264]


def test_external_table_and_parquet(spark, tmp):
    spark.range(5).write.parquet(f"{tmp}/t")
    assert S.external_table(spark, "ext_t", f"{tmp}/t").count() == 5
    assert spark.table("ext_t").count() == 5
    assert S.read_parquet(spark, f"{tmp}/t").count() == 5


def test_write_parquet_exactly_n_files(spark, tmp):
    K.write_parquet(spark.range(1000), f"{tmp}/out", 4)
    assert len(glob.glob(f"{tmp}/out/*.parquet")) == 4


def test_tables_build_and_rollup(spark, tmp):
    K.ensure_table(spark, "yellow_target", schemas.YELLOW_RAW)
    K.ensure_table(spark, "yellow_target", schemas.YELLOW_RAW)  # idempotent
    assert spark.table("yellow_target").columns[0] == "VendorID"
    df = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 1.0)], "c int, amt double")
    r = K.refresh_rollup(df, ["c"], {"total": F.sum("amt")}, "cust_rollup")
    assert sorted((x.c, x.total) for x in r.collect()) == [(1, 5.0), (2, 1.0)]
    assert K.build(df, "model_v").count() == 3
    assert K.stage(df, "stage_v").count() == 3


def test_partitioned_write_prunes(spark, tmp):
    t = fx.trips(spark, SF_SMALL).drop("l_suppkey", "l_partkey")
    K.write_partitioned(t, f"{tmp}/p", "pickup_datetime", ["PULocationID"])
    r = scan_between(spark, f"{tmp}/p", "pickup_date", "1997-06-01", "1997-06-15",
                     ts="pickup_datetime")
    plan = plan_text(r.groupBy().count())
    assert "PartitionFilters: [isnotnull(pickup_date" in plan
    files = {row[0] for row in r.select(F.col("_metadata.file_path")).distinct().collect()}
    days = {p.split("pickup_date=")[1].split("/")[0] for p in files}
    assert days and all("1997-06-01" <= d <= "1997-06-15" for d in days)
    expect = t.filter(F.to_date("pickup_datetime").between("1997-06-01", "1997-06-15")).count()
    assert r.count() == expect


def test_column_pruning_reaches_scan(spark):
    df = fx.table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_quantity") \
        .filter(F.col("l_quantity") > 10)
    plan = plan_text(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan


def _yellow_month_files(tmp):
    os.makedirs(f"{tmp}/landing", exist_ok=True)
    jan = write_csv(f"{tmp}/landing/yellow_tripdata_2021-01.csv", [
        yellow_line("1", "2021-01-01 00:00:00", "10.0"),
        yellow_line("1", "2021-01-01 00:00:00", "10.0"),   # in-file duplicate: both inserted
        yellow_line("2", "2021-01-02 00:00:00", "11.0")])
    feb = write_csv(f"{tmp}/landing/yellow_tripdata_2021-02.csv", [
        yellow_line("2", "2021-01-02 00:00:00", "11.0"),   # already loaded in January
        yellow_line("3", "2021-02-01 00:00:00", "12.0")])
    return jan, feb


def test_monthly_merge_is_idempotent(spark, tmp):
    jan, feb = _yellow_month_files(tmp)
    target = f"{tmp}/yellow_tripdata"
    assert L.load_month(spark, "yellow", 2021, 1, jan, target) == 3
    assert L.load_month(spark, "yellow", 2021, 1, jan, target) == 0
    assert L.load_month(spark, "yellow", 2021, 2, feb, target) == 1
    t = spark.read.parquet(target)
    assert t.count() == 4
    assert {r.filename for r in t.collect()} == {"yellow_tripdata_2021-01.csv",
                                                 "yellow_tripdata_2021-02.csv"}


def test_backfill_equals_sequential_merges(spark, tmp):
    _yellow_month_files(tmp)
    seq, one = f"{tmp}/seq", f"{tmp}/one"
    for m in (1, 2):
        L.load_month(spark, "yellow", 2021, m,
                     f"{tmp}/landing/yellow_tripdata_2021-0{m}.csv", seq)
    assert L.load_months(spark, "yellow", f"{tmp}/landing/*.csv", one) == 4
    assert L.load_months(spark, "yellow", f"{tmp}/landing/*.csv", one) == 0
    cols = ["unique_row_id", "filename", "VendorID"]
    a = sorted(tuple(r) for r in spark.read.parquet(seq).select(*cols).collect())
    b = sorted(tuple(r) for r in spark.read.parquet(one).select(*cols).collect())
    assert a == b


def test_stamp_key_widths(spark):
    df = spark.createDataFrame([("1", dt.datetime(2021, 1, 1), dt.datetime(2021, 1, 1, 0, 5),
                                 "10", "20", 5.0, 1.5)],
                               "VendorID string, tpep_pickup_datetime timestamp_ntz, "
                               "tpep_dropoff_datetime timestamp_ntz, PULocationID string, "
                               "DOLocationID string, fare_amount double, trip_distance double")
    k7 = L.stamp(df, row_key_fields("yellow", 7), "f.csv").first()
    k5 = L.stamp(df, row_key_fields("yellow", 5), "f.csv", binary=True).first()
    import hashlib
    text = "1" + "2021-01-01 00:00:00" + "2021-01-01 00:05:00" + "10" + "20" + "5.0" + "1.5"
    assert k7.unique_row_id == hashlib.md5(text.encode()).hexdigest()
    assert len(k5.unique_row_id) == 16 and k7.filename == "f.csv"


def test_pages_stop_at_first_empty(spark, tmp):
    recs = spark.createDataFrame(
        [(p, p * 10 + i, dt.datetime(2009, 6, 1), dt.datetime(2009, 6, 1, 0, 12), 1.0)
         for p in (1, 2, 4) for i in range(3)],
        "page_no long, ride_id long, trip_pickup_date_time timestamp_ntz, "
        "trip_dropoff_date_time timestamp_ntz, total_amt double")
    land_pages(recs, f"{tmp}/pages", empty_pages=[3])
    got = load_pages(spark, f"{tmp}/pages")
    assert sorted(r.ride_id for r in got.collect()) == [10, 11, 12, 20, 21, 22]
    land_pages(recs, f"{tmp}/pages2")
    assert load_pages(spark, f"{tmp}/pages2").count() == 9


def test_jdbc_round_trip_embedded_derby(spark, tmp):
    # Embedded, in-process Derby: no server and no port.
    url = f"jdbc:derby:{tmp}/derby;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([(i, f"z{i}") for i in range(100)], "id int, zone string")
    JD.write_jdbc(df, url, "ZONES", mode="replace", props=props, batchsize=10)
    JD.write_jdbc(df.limit(5), url, "ZONES", mode="append", props=props)
    back = JD.read_jdbc(spark, url, "ZONES", props=props,
                        partition={"column": "ID", "lower": 0, "upper": 100, "num": 4})
    assert back.count() == 105 and back.rdd.getNumPartitions() == 4
    q = JD.read_jdbc(spark, url, query="SELECT COUNT(*) AS N FROM ZONES", props=props)
    assert q.first()[0] == 105


def test_count_star_reads_no_columns(spark):
    from farebox.operators.aggregates import row_count
    plan = plan_text(row_count(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")))
    assert "ReadSchema: struct<>" in plan


def test_merge_reads_only_touched_months(spark, tmp):
    _yellow_month_files(tmp)
    target = f"{tmp}/t"
    L.load_months(spark, "yellow", f"{tmp}/landing/*.csv", target)
    months = sorted(n for n in os.listdir(target) if n.startswith("pickup_month="))
    assert months == ["pickup_month=2021-01", "pickup_month=2021-02"]
    src = spark.read.parquet(target + "_staging") \
        .filter(F.col("filename") == "yellow_tripdata_2021-02.csv")
    m = L.merge_insert(spark.read.parquet(target), src, part_col="pickup_month")
    plan = plan_text(m)
    assert "dynamicpruningexpression(pickup_month" in plan
    assert m.count() == 0  # both February rows' keys are already loaded


def test_cli_ingest_to_embedded_derby(spark, tmp):
    from farebox.__main__ import main
    spark.range(50).selectExpr("id", "cast(id * 1.5 as double) AS fare").write.parquet(f"{tmp}/p")
    url = f"jdbc:derby:{tmp}/derby2;create=true"
    drv = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    assert main(["ingest", "--src", f"{tmp}/p", "--url", url, "--table", "TRIPS",
                 "--driver", drv, "--batchsize", "7"]) == 0
    assert main(["ingest", "--src", f"{tmp}/p", "--url", url, "--table", "TRIPS",
                 "--driver", drv, "--mode", "append"]) == 0
    assert JD.read_jdbc(spark, url, "TRIPS", props={"driver": drv}).count() == 100


def test_external_catalog_table_and_partitioned_target(spark, tmp):
    spark.range(6).selectExpr("id", "cast(id % 2 as string) AS part").write.parquet(f"{tmp}/ext")
    t = S.external_table(spark, "ext_catalog", f"{tmp}/ext", persistent=True)
    assert t.count() == 6 and spark.table("ext_catalog").count() == 6
    K.ensure_table(spark, "green_target", schemas.GREEN_RAW, partition_by=["VendorID"],
                   path=f"{tmp}/green_target")
    K.ensure_table(spark, "green_target", schemas.GREEN_RAW, partition_by=["VendorID"],
                   path=f"{tmp}/green_target")
    cols = spark.table("green_target").columns
    assert cols[-1] == "VendorID" and len(cols) == len(schemas.GREEN_RAW)


def test_day_filters_push_timestamp_ranges_to_scan(spark):
    from farebox.operators import filters as FL
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    for df in (FL.on_day(li, "l_shipdate", "1996-03-15"),
               FL.in_period(li, "l_shipdate", "1996-01-01", "1996-02-01"),
               FL.between_days(li, "l_shipdate", "1996-01-01", "1996-01-15")):
        plan = plan_text(df.select("l_orderkey"))
        assert "GreaterThanOrEqual(l_shipdate," in plan and "LessThan(l_shipdate," in plan


def _pages(tmp, *pages):
    os.makedirs(f"{tmp}/landed", exist_ok=True)
    for i, p in enumerate(pages):
        with open(f"{tmp}/landed/{i}.json", "w") as f:
            f.write(p + "\n")
    return f"{tmp}/landed"


@pytest.mark.parametrize("bad", ['{"page_no": 2, "records": "oops"}', '{"page_no": 2, "records": [{"trip_pi', '{"page_no": 2}',
                                 '{"records": []}'])
def test_malformed_page_fails_the_load(spark, tmp, bad):
    ride = '{"page_no": %d, "records": [{"trip_pickup_date_time": "2009-06-14T23:23:00"}]}'
    folder = _pages(tmp, ride % 1, bad, ride % 3)
    with pytest.raises(Exception, match="malformed page"):
        load_pages(spark, folder).collect()
    assert load_pages(spark, _pages(tmp + "/fine", ride % 1, ride % 2, '{"page_no": 3, "records": []}', ride % 4)).count() == 2


def test_value_that_does_not_parse_fails_the_read(spark, tmp):
    for name, text, column in (("z", "LocationID,Borough,Zone,service_zone\n1,A,B,C,extra\nxx,A,B,C\n", "locationid"),):
        with open(f"{tmp}/{name}.csv", "w") as f:
            f.write(text)
        with pytest.raises(Exception, match=f"column {column}"):
            S.read_zones(spark, f"{tmp}/{name}.csv").collect()
    with open(f"{tmp}/ok.csv", "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\n1,A,B,C,extra\n2,A\n")
    assert [tuple(r) for r in S.read_zones(spark, f"{tmp}/ok.csv").orderBy("locationid").collect()] == [
        (1, "A", "B", "C"), (2, "A", None, None)]
