"""A third of all rows on one key: results stay whole and the work is split."""

import os

from conftest import plan_text
from pyspark.sql import functions as F

from farebox.operators.windows import dedupe
from farebox.plans.loads import earliest_file_rows
from farebox.sinks.files import write_partitioned


def hot(spark, n=30000):
    # Every third row has key "hot"; files rotate over three months.
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        .alias("unique_row_id"),
        F.concat(F.lit("yellow_tripdata_2021-0"), (F.col("id") % 3 + 1).cast("string"),
                 F.lit(".csv")).alias("filename"),
        F.col("id").alias("v"))


def test_earliest_file_rows_hot_key(spark):
    df = hot(spark)
    kept = earliest_file_rows(df)
    plan = plan_text(kept)
    assert "partial_min" in plan or "min(" in plan
    # hot key: all rows are in file ..-01 (id % 3 == 0 -> month 1), all kept
    assert kept.filter(F.col("unique_row_id") == "hot").count() == 10000
    assert kept.count() == 30000


def test_dedupe_hot_key_keeps_one(spark):
    df = hot(spark)
    out = dedupe(df, ["unique_row_id"])
    assert out.filter(F.col("unique_row_id") == "hot").collect()[0].v == 0
    assert out.count() == 20001


def test_partitioned_write_splits_hot_day(spark, tmp):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("2021-01-01 10:00:00"))
        .otherwise(F.concat(F.lit("2021-02-"), F.lpad(((F.col("id") % 27) + 1).cast("string"), 2, "0"),
                            F.lit(" 10:00:00")))
        .cast("timestamp_ntz").alias("pickup_datetime"),
        (F.col("id") % 265).alias("PULocationID"))
    write_partitioned(df, f"{tmp}/p", "pickup_datetime", ["PULocationID"], num_partitions=8,
                      max_records_per_file=2000)
    hot_dir = f"{tmp}/p/pickup_date=2021-01-01"
    files = [f for f in os.listdir(hot_dir) if f.endswith(".parquet")]
    assert len(files) >= 5
    assert spark.read.parquet(f"{tmp}/p").count() == n
