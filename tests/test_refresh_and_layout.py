"""Incremental rollups, distinct bitmaps, bucketed targets, Z-order, folded checks, load reports."""

import glob
import random
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from farebox.operators import quality as Q
from farebox.plans import loads as L
from farebox.session import at_once
from farebox.sinks.files import write_clustered, write_partitioned
from farebox.sinks.rollups import DistinctTable, Rollup, source_files
from tests.conftest import plan_text

SCHEMA = "zone string, day date, amount decimal(10,2), km double"


def rollup(tmp):
    return Rollup(f"{tmp}/state", lambda s, paths: s.read.schema(SCHEMA).parquet(*paths),
                  {"zone": F.col("zone"), "month": F.trunc("day", "month")},
                  {"n": ("count", F.lit(1)), "amount": ("sum", F.col("amount")), "lo": ("min", F.col("km")),
                   "hi": ("max", F.col("km")), "mean": ("avg", F.col("km"))})


def land(spark, tmp, month, n, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), f"2024-{month:02d}-{rng.randint(1, 28):02d}", f"{rng.randint(0, 999) / 100}", rng.random())
            for _ in range(n)]
    df = spark.createDataFrame(rows, "zone string, day string, amount string, km double")
    df = df.select("zone", F.col("day").cast("date"), F.col("amount").cast("decimal(10,2)"), "km")
    df.coalesce(1).write.mode("overwrite").parquet(f"{tmp}/landing/m{month}")


def same(got, want):
    key = lambda r: tuple(str(x) for x in r[:2])
    got, want = sorted(map(tuple, got.collect()), key=key), sorted(map(tuple, want.collect()), key=key)
    return [r[:-1] for r in got] == [r[:-1] for r in want] and [r[-1] for r in got] == pytest.approx([r[-1] for r in want])


def test_refresh_reads_only_new_and_changed_files(spark, tmp):
    files = f"{tmp}/landing"
    r = rollup(tmp)
    for m in (1, 2):
        land(spark, tmp, m, 50, m)
    first = r.refresh(spark, files)
    assert (first.files, first.rows) == (2, 100)
    land(spark, tmp, 3, 30, 3)
    assert all("/m3/" in f for f in r.delta(spark, files).inputFiles())
    second = r.refresh(spark, files)
    assert (second.files, second.rows) == (1, 30)
    assert same(r.read(spark, files), r.rebuilt(spark, files))
    assert r.refresh(spark, files).files == 0
    # a replaced file counts with its new rows only, a removed one not at all
    land(spark, tmp, 2, 20, 9)
    assert r.refresh(spark, files).rows == 20
    assert same(r.read(spark, files), r.rebuilt(spark, files))
    assert same(r.read(spark, f"{files}/m1"), r.rebuilt(spark, f"{files}/m1"))
    assert source_files(spark, files).count() == 3


def test_distinct_bitmaps(spark, tmp):
    rng = random.Random(1)
    rows = [(f"2024-01-{rng.randint(1, 20):02d}" if i % 50 else None, rng.choice([None, 0, -5, 7, 32768, 32769, rng.randint(-10**6, 10**12)]))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "day string, v long")
    t = DistinctTable(f"{tmp}/distinct")
    t.append(df.limit(2000), F.col("day"), {"v": F.col("v")})
    t.append(df, F.col("day"), {"v": F.col("v"), "same": F.col("v") * 0})
    for lo, hi in ((None, None), ("2024-01-03", "2024-01-09"), ("2024-01-20", None), ("2030-01-01", None)):
        want = {v for d, v in rows if v is not None and (lo is None or d and d >= lo) and (hi is None or d and d <= hi)}
        assert t.count(spark, "v", lo, hi).first().n == len(want)
    assert t.count(spark, "same").first().n == 1
    assert "PartitionFilters: [isnotnull(column" in plan_text(t.count(spark, "v", "2024-01-03"))


def test_distinct_bitmaps_are_made_of_distinct_values(spark):
    df = spark.range(5000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("day"), (F.col("id") % 7).alias("v"))
    states = DistinctTable.states(df, F.col("day"), {"v": F.col("v")})
    plan = plan_text(states, "simple")
    # values meet by hash below the sort that the bitmaps' aggregate needs, and no bitmap is shuffled
    above, below = plan[:plan.rindex("Sort [")], plan[plan.rindex("Sort ["):]
    assert "HashAggregate(keys=[column" in below and "Exchange" not in above
    # a day's 0 has a bucket of its own
    assert sorted(r[0] for r in states.select(F.bitmap_count("bitmap")).collect()) == [1, 1, 1, 6, 6, 6]


def stamped(spark, n, month="2024-01", at=0):
    return spark.range(at, at + n).select(F.md5(F.col("id").cast("string")).alias("unique_row_id"),
                                          F.lit("f.csv").alias("filename"), F.lit(month).alias("pickup_month"))


def test_bucketed_target_is_not_shuffled(spark, tmp):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        args = ("bucketed_target_test", f"{tmp}/target", 4)
        assert L.append_new_bucketed(spark, stamped(spark, 100), *args) == 100
        assert L.append_new_bucketed(spark, stamped(spark, 150, at=50), *args) == 100
        assert L.append_new_bucketed(spark, stamped(spark, 100), *args) == 0
        merge = L.merge_insert_bucketed(spark.table(args[0]), stamped(spark, 10))
        # the source and the broadcast months are the only exchanges: none above the target's scan
        plan = plan_text(merge, "simple")
        before, target = plan.split("FileScan parquet")[0], plan.split("SortMergeJoin")[1]
        assert plan.count("Exchange hashpartitioning(unique_row_id") == 1
        assert "Bucketed: true" in plan and "Exchange" in before and "SelectedBucketsCount" in target
        assert "pickup_month" in plan.split("PartitionFilters: ")[1].split("]")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS bucketed_target_test")


def test_rows_without_a_shared_key_are_not_shuffled(spark, tmp):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5k")
    try:
        stamped(spark, 20000).write.parquet(f"{tmp}/rows")
        rows = spark.read.parquet(f"{tmp}/rows")
        # both uses of the rows meet the few repeated hashes by broadcast before any shuffle
        plan = plan_text(L.earliest_file_rows(rows), "simple")
        assert plan.count("BroadcastHashJoin [__hash") >= 2 and "SortMergeJoin [__hash" not in plan
        reload = L.new_rows(rows, rows, part_col="pickup_month")
        assert "SortMergeJoin" not in plan_text(reload, "simple") and reload.count() == 0
        part = L.new_rows(rows.limit(15000), rows)
        assert part.count() == 5000 and part.columns == rows.columns
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_new_rows_tells_odd_keys_apart(spark):
    md5 = "0123456789abcdef0123456789abcdef"
    odd = [md5, md5.upper(), "\0" * 17 + "x", "x", "", md5[:-1] + "g", md5 * 2]
    target = spark.createDataFrame([(k, 0) for k in odd[::2]], "unique_row_id string, v int")
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([*odd, *odd, None])], "unique_row_id string, v int")
    key = lambda r: (r[0] is None, r[0] or "", r[1])
    want = L.merge_insert(target, rows)
    assert sorted(map(tuple, L.new_rows(target, rows).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    raw = rows.withColumn("unique_row_id", F.encode("unique_row_id", "UTF-8"))
    assert L.new_rows(raw.filter("v < 3"), raw).count() == 9


def test_file_counts(spark):
    rows = [("a", "k1"), ("a", "k1"), ("a", "k2"), ("b", "k1"), ("b", None), ("c", None), (None, "k3")]
    got = L.file_counts(spark.createDataFrame(rows, "filename string, unique_row_id string"))
    assert {tuple(r) for r in got.collect()} == {("a", 3, 2), ("b", 2, 1), ("c", 1, 0), (None, 1, 1)}


def test_a_load_keeps_the_earliest_file(spark, tmp):
    header = ",".join(f.name for f in L.schemas.GREEN_RAW)
    line = "{v},2021-0{m}-01 00:00:00,2021-01-01 00:30:00,N,1,7,9,1,1.5,10.0,0,0,0,0,,0.3,10.3,1,1,0"
    for month, trips in ((1, [(1, 1), (1, 1), (2, 1)]), (2, [(1, 1), (3, 2)])):
        with open(f"{tmp}/green_tripdata_2021-0{month}.csv", "w") as f:
            f.write("\n".join([header, *[line.format(v=v, m=m) for v, m in trips]]) + "\n")
    assert L.load_months(spark, "green", f"{tmp}/*.csv", f"{tmp}/target") == 4
    got = {tuple(r) for r in L.file_counts(spark.read.parquet(f"{tmp}/target")).collect()}
    assert got == {("green_tripdata_2021-01.csv", 3, 2), ("green_tripdata_2021-02.csv", 1, 1)}
    assert L.load_months(spark, "green", f"{tmp}/*.csv", f"{tmp}/target") == 0


def land_green(tmp, files):
    """Monthly files of (vendor, pickup, dropoff) rows."""
    header = ",".join(f.name for f in L.schemas.GREEN_RAW)
    for month, trips in files.items():
        with open(f"{tmp}/green_tripdata_2021-0{month}.csv", "w") as f:
            f.write("\n".join([header, *[f"{v},{p},{d},N,1,7,9,1,1.5,10.0,0,0,0,0,,0.3,10.3,1,1,0" for v, p, d in trips]]) + "\n")


def test_names_are_searched_for_once_a_file(spark, tmp):
    at = "2021-01-01 00:00:00"
    land_green(tmp, {1: [("1", at, at)] * 3, 2: [("2", at, at)]})
    with open(f"{tmp}/other.csv", "w") as f:
        f.write(open(f"{tmp}/green_tripdata_2021-02.csv").read())
    # a file listed twice is read twice, not four times
    paths = [f"{tmp}/green*.csv", f"{tmp}/other.csv", f"{tmp}/other.csv"]
    stamped = L._stamped(spark, "green", paths, 7, False)
    assert "BroadcastHashJoin [__source_path" in plan_text(stamped, "simple")
    got = sorted(tuple(r) for r in stamped.select("filename", "VendorID", "pickup_month").collect())
    assert got == [*[("green_tripdata_2021-01.csv", "1", "2021-01")] * 3, ("green_tripdata_2021-02.csv", "2", "2021-01"),
                   *[("other.csv", "2", "2021-01")] * 2]


def test_pickup_month_of_any_time(spark):
    times = ["2021-03-04 05:06:07.5", "0987-01-02 00:00:00", "+12021-03-04 00:00:00", "-0044-03-15 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz"))
    want = df.select(F.coalesce(F.date_format("t", "yyyy-MM"), F.lit("unknown")))
    assert L.with_pickup_month(df, "t").select("pickup_month").collect() == want.collect()


def test_months_of_one_file_compare_no_keys(spark, tmp):
    jan, feb, mar = ("2021-01-01 00:00:00", "2021-02-01 00:00:00", "2021-03-01 00:00:00")
    own = {1: [("1", jan, feb)] * 3 + [("2", jan, feb)] * 2, 2: [("1", feb, mar)] * 2}
    land_green(tmp, own)

    def held_and_kept():
        staged = L.stage_rows(L._stamped(spark, "green", f"{tmp}/*.csv", 7, False), f"{tmp}/t")
        main = L.main_files(L.layout(staged))
        narrow, real = [], L._narrow

        def noted(df, name):
            out = real(df, name)
            narrow.append((name, out.count()))
            return out

        L._narrow = noted
        try:
            kept = L.earliest_file_rows(staged, main=main)
        finally:
            L._narrow = real
        rows = lambda df: sorted(map(str, df.select(*staged.columns).collect()))
        assert rows(kept) == rows(L.earliest_file_rows(staged))
        return dict(narrow), kept.count()

    # each month in its own file: no key has to be looked for elsewhere
    assert held_and_kept() == ({"keys-astray": 0, "keys-again": 0}, 7)
    # a January trip in February's file again, one of January only there, and a key whose text
    # is the same without a pickup as without a dropoff time
    land_green(tmp, {1: own[1] + [("3", jan, "")], 2: own[2] + [("2", jan, feb), ("4", jan, feb), ("3", "", jan)]})
    assert held_and_kept() == ({"keys-astray": 3, "keys-again": 2}, 9)


def test_services_are_loaded_at_once(spark):
    meet = threading.Barrier(2, timeout=60)
    spark.sparkContext.setLocalProperty("asked.by", "test")

    def step(n):
        meet.wait()
        return n + spark.range(n).count(), spark.sparkContext.getLocalProperty("asked.by")

    try:
        assert at_once(spark, [lambda: step(1), lambda: step(2)]) == [(2, "test"), (4, "test")]
        with pytest.raises(ZeroDivisionError):
            at_once(spark, [lambda: 1, lambda: 1 // 0])
    finally:
        spark.sparkContext.setLocalProperty("asked.by", None)


def test_bucketed_write_has_more_tasks_than_buckets(spark, tmp):
    rows = stamped(spark, 600).withColumn("pickup_month", F.concat(F.lit("2024-0"), (F.abs(F.hash("unique_row_id")) % 9 + 1).cast("string")))
    try:
        assert L.append_new_bucketed(spark, rows, "bucketed_tasks_test", f"{tmp}/target", 2) == 600
        files = glob.glob(f"{tmp}/target/**/*.parquet", recursive=True)
        tasks = {f.split("part-")[1][:5] for f in files}
        assert len(files) <= 9 * 2 and len(tasks) > 2
        assert L.append_new_bucketed(spark, rows, "bucketed_tasks_test", f"{tmp}/target", 2) == 0
    finally:
        spark.sql("DROP TABLE IF EXISTS bucketed_tasks_test")


def groups_holding(path, col, value):
    """Row groups whose min/max admit the value: what a pushed-down filter reads."""
    hit = total = 0
    for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            stats = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}[col]
            total, hit = total + 1, hit + (stats.min <= value <= stats.max)
    return hit, total


def test_every_clustering_key_prunes(spark, tmp):
    df = spark.range(20000).select((F.rand(1) * 500).cast("int").alias("a"), (F.rand(2) * 500).cast("int").alias("b"),
                                   F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"))
    write_clustered(df, f"{tmp}/z", ["a", "b"], files=36)
    write_partitioned(df, f"{tmp}/sorted", "ts", ["a", "b"], num_partitions=36)
    for col in ("a", "b"):
        hit, total = groups_holding(f"{tmp}/z", col, 250)
        assert total >= 30 and hit <= total / 3, (col, hit, total)
    z, plain = groups_holding(f"{tmp}/z", "b", 250)[0], groups_holding(f"{tmp}/sorted", "b", 250)[0]
    assert z < plain / 3
    back = spark.read.parquet(f"{tmp}/z")
    assert back.count() == 20000 and back.columns == df.columns
    with pytest.raises(ValueError):
        write_clustered(df, f"{tmp}/none", [])


def test_clustering_text_and_nulls(spark, tmp):
    df = spark.createDataFrame([(str(i % 7) if i % 5 else None, None, i) for i in range(100)], "a string, b double, i int")
    write_clustered(df, f"{tmp}/z", ["a", "b"], files=4)
    assert sorted(r.i for r in spark.read.parquet(f"{tmp}/z").collect()) == list(range(100))


def test_checks_on_one_table_are_one_scan(spark, tmp):
    rows = [(i, i % 4 or None, "x" if i % 3 else None, i % 9) for i in range(60)] + [(1, 2, "y", 3), (None, 1, "x", 1), (None, 99, "z", 2)]
    spark.createDataFrame(rows, "id int, zone int, kind string, k int").write.parquet(f"{tmp}/t")
    spark.createDataFrame([(1,), (2,), (2,), (None,)], "z int").write.parquet(f"{tmp}/dim")
    t, dim = spark.read.parquet(f"{tmp}/t"), spark.read.parquet(f"{tmp}/dim")
    checks = [Q.check_unique(t, "id", "warn", "m"), Q.check_not_null(t, "kind", "error", "m"),
              Q.check_accepted(t, "kind", ["x", "y"], "warn", "m"), Q.check_relationship(t, "zone", dim, "z", "error", "m"),
              Q.check_relationship(t, "k", dim, "z", "error", "m"), Q.check_not_null(t, "id", "error", "m")]
    report = Q.run_checks(checks)
    got = {r.check: (r.failures, r.severity, r.status) for r in report.collect()}
    for c in checks:
        n = c.failing.count()
        assert got[c.name] == (n, c.severity, c.severity if n else "pass")
    assert plan_text(Q.run_checks(checks), "simple").count("FileScan parquet [id") == 1
    # a second uniqueness check and a check of failing rows alone still work
    more = Q.run_checks([*checks[:1], Q.check_unique(t, "k"), Q.Check("own", t.filter("id > 50"))])
    assert {r.check: r.failures for r in more.collect()} == {"m.unique_id": 1, "unique_k": 9, "own": 9}


def test_checks_on_an_empty_table(spark):
    t = spark.createDataFrame([], "id int, kind string")
    report = Q.run_checks([Q.check_unique(t, "id"), Q.check_not_null(t, "kind")])
    assert {r.check: (r.failures, r.status) for r in report.collect()} == {"unique_id": (0, "pass"), "not_null_kind": (0, "pass")}


def test_load_reports_what_it_counted(spark, tmp):
    header = ("VendorID,lpep_pickup_datetime,lpep_dropoff_datetime,store_and_fwd_flag,RatecodeID,PULocationID,DOLocationID,"
              "passenger_count,trip_distance,fare_amount,extra,mta_tax,tip_amount,tolls_amount,ehail_fee,improvement_surcharge,"
              "total_amount,payment_type,trip_type,congestion_surcharge")
    line = "{v},2021-01-01 00:0{v}:00,2021-01-01 00:30:00,N,1,7,9,1,1.5,10.0,0,0,0,0,,0.3,10.3,1,1,0"
    src = f"{tmp}/green_tripdata_2021-01.csv"
    with open(src, "w") as f:
        f.write("\n".join([header, *[line.format(v=v) for v in (1, 2, 3)]]) + "\n")
    first = L.load_month_report(spark, "green", 2021, 1, src, f"{tmp}/target")
    assert (first.source, first.staged, first.inserted, first.rejected, first.status) == (3, 3, 3, 0, "match")
    with open(src, "a") as f:
        f.write(line.format(v=4) + "\n")
    second = L.load_month_report(spark, "green", 2021, 1, src, f"{tmp}/target")
    assert (second.source, second.inserted, second.rejected) == (4, 1, 3)
