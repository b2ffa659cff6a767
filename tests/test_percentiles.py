"""Percentiles by digit selection: the order of keys, results, and a lazy plan."""

import math
import random
import struct

from pyspark.sql import functions as F

from farebox.operators.percentiles import group_percentile_values, order_key
from farebox.operators.windows import group_percentiles_on_rows
from tests.conftest import plan_text

P = {"p97": 0.97, "p90": 0.9, "p50": 0.5, "p0": 0.0, "p100": 1.0}


def bits(x):
    if x is None:
        return None
    if x != x:
        return 0x7FF8 << 48
    b = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -b if x < 0 else b


def test_order_key_is_the_ieee_order(spark):
    rng = random.Random(1)
    values = [0.0, -0.0, 1.0, 0.1, 5e-324, -5e-324, 2.0 ** -1022, math.nextafter(2.0 ** -1022, 0), math.inf, -math.inf, math.nan, None,
              1.7976931348623157e308]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(500)]
    values += [math.nextafter(2.0 ** e, d) for e in range(-1022, 1023, 37) for d in (0, math.inf)]
    rows = spark.createDataFrame([(x,) for x in values], "x double").select("x", order_key(F.col("x")).alias("k")).collect()
    assert all(r.k == bits(r.x) for r in rows)


def want(values, p):
    v = sorted(x for x in values if x is not None)
    if not v:
        return None
    at = p * (len(v) - 1)
    lo, hi = math.floor(at), math.ceil(at)
    return v[lo] if lo == hi else (hi - at) * v[lo] + (at - lo) * v[hi]


def test_values_of_many_scales_ties_and_nulls(spark):
    rng = random.Random(7)
    groups = {"close": [100 + rng.random() * 1e-9 for _ in range(400)], "wide": [rng.uniform(-1, 1) * 10 ** rng.randint(-30, 30) for _ in range(300)],
              "ties": [rng.choice([1.5, 2.5, None]) for _ in range(200)], "one": [3.0], "none": [None, None], None: [1.0, 2.0, None, -4.0]}
    df = spark.createDataFrame([(g, x) for g, v in groups.items() for x in v], "g string, x double").repartition(5)
    got = {r.g: r for r in group_percentile_values(df, "x", ["g"], P).collect()}
    assert set(got) == set(groups)
    for g, v in groups.items():
        for name, p in P.items():
            assert got[g][name] == want(v, p), (g, name)


def test_planning_runs_no_job(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("x"))
    sc = spark.sparkContext
    sc.setJobGroup("plan-only", "nothing runs")
    try:
        out = group_percentiles_on_rows(df, "x", ["g"], {"p90": 0.9})
        plan_text(out)
        assert not list(sc.statusTracker().getJobIdsForGroup("plan-only"))
        assert out.count() == 100
        assert list(sc.statusTracker().getJobIdsForGroup("plan-only"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_counts_are_shuffled_once(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), (F.col("id") % 701).cast("double").alias("x"))
    out = group_percentile_values(df, "x", ["g"], {"p90": 0.9})
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Range (") == 1 and "ReusedExchange" in final
