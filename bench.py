"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run once to warm up, then timed 3 times; the median counts.
A query is executed end to end with the ``noop`` sink (the whole plan runs,
nothing is collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from farebox import catalog  # noqa: E402
from farebox import fixtures as fx  # noqa: E402
from farebox.session import get_spark, scratch_path  # noqa: E402

HEADLINE = [
    "monthly_zone_revenue", "fact_trips", "quarterly_revenue_yoy", "monthly_fare_percentiles",
    "fhv_traveltime_p90", "second_longest_dropoff", "trips_by_distance", "top_revenue_zones",
    "largest_tip_dropoff", "least_frequent_zone", "distinct_pickups", "profile_ranges",
    "quality_report", "merge_insert_rows", "monthly_load_idempotent", "tumbling_counts",
    "session_counts", "json_round_trip",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def time_query(spark, fn, sf_dir, repeats=3):
    run(fn(spark, sf_dir))  # warm-up
    times = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        run(fn(spark, sf_dir))
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def throughput(spark, sf_dir):
    """Rows/s of the two reference pipelines that publish a time: a bulk load
    of trips into a table and publishing trips as JSON messages."""
    from farebox.plans.loads import load_months, write_monthly_files
    from farebox.streaming.jobs import publish_json
    out = {}
    y = fx.raw_service(fx.trips(spark, sf_dir), "Yellow", keep_filename=True)
    n = y.count()
    root = scratch_path(spark, "bench-load")
    glob = write_monthly_files(y, f"{root}/landing", "yellow")
    t0 = time.perf_counter()
    load_months(spark, "yellow", glob, f"{root}/target")
    out["bulk_load_rows_per_sec"] = round(n / (time.perf_counter() - t0))
    g = fx.green(spark, sf_dir)
    m = g.count()
    t0 = time.perf_counter()
    publish_json(g, {"path": scratch_path(spark, "bench-json")})
    out["json_publish_rows_per_sec"] = round(m / (time.perf_counter() - t0))
    return out


def scan_targets(spark, sf_dir):
    """BASELINE targets: a partitioned day-range scan reads only the matching
    files (vs. the whole unpartitioned table), K1 writes exactly N files."""
    from pyspark.sql import functions as F

    from farebox.operators.filters import scan_between
    from farebox.sinks.files import write_parquet, write_partitioned
    t = fx.trips(spark, sf_dir).drop("l_suppkey", "l_partkey")
    part, flat = scratch_path(spark, "bench-part"), scratch_path(spark, "bench-flat")
    write_partitioned(t, part, "pickup_datetime", ["VendorID"])
    write_parquet(t, flat, 4)

    def files_of(df):
        f = df.select("_metadata.file_path", "_metadata.file_size").distinct()
        r = f.agg(F.count(F.lit(1)).alias("n"), F.sum("file_size").alias("b")).first()
        return int(r.n), int(r.b or 0)

    lo, hi = "1997-06-01", "1997-06-15"  # a 15-day window
    pruned = scan_between(spark, part, "pickup_date", lo, hi, ts="pickup_datetime")
    n_read, b_read = files_of(pruned)
    n_all, b_all = files_of(spark.read.parquet(part))
    n_flat, b_flat = files_of(spark.read.parquet(flat))
    return {"day_range_scan": {"files_read": n_read, "files_total": n_all,
                               "bytes_read": b_read, "bytes_unpartitioned": b_flat,
                               "bytes_ratio_unpartitioned_to_pruned":
                                   round(b_flat / b_read, 1) if b_read else None},
            "k1_files_written_for_n4": n_flat}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                      extra={"spark.driver.memory": "16g"})
    qs = catalog.queries()
    names = only or HEADLINE
    results = {}
    for name in names:
        results[name] = round(time_query(spark, qs[name], sf_dir), 3)
    extra = {**throughput(spark, sf_dir), **scan_targets(spark, sf_dir)} if not only else {}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds",
                      "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": results, "sf": sf, "cpus": cpus, **extra}))


if __name__ == "__main__":
    main()
