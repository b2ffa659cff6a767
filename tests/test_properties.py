"""Property tests: the one-pass backfill equals merging files one by one, and
dedupe keeps exactly the first row of every key under the total order."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from farebox.operators.windows import dedupe
from farebox.plans.loads import earliest_file_rows

ROWS = st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3", "k4"]),
                          st.sampled_from(["f_2020-01", "f_2020-02", "f_2020-03"]),
                          st.integers(0, 5)), min_size=1, max_size=25)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def sequential_merges(rows):
    """MERGE .. WHEN NOT MATCHED THEN INSERT, one file at a time in file order."""
    target = []
    for f in sorted({r[1] for r in rows}):
        have = {r[0] for r in target}
        target += [r for r in rows if r[1] == f and r[0] not in have]
    return sorted(target)


@SETTINGS
@given(ROWS)
def test_backfill_equals_sequential_merges(spark, rows):
    df = spark.createDataFrame(rows, "unique_row_id string, filename string, v int")
    got = sorted(tuple(r) for r in earliest_file_rows(df).collect())
    assert got == sequential_merges(rows)


@SETTINGS
@given(ROWS)
def test_dedupe_keeps_first_row_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k string, f string, v int")
    got = sorted(tuple(r) for r in dedupe(df, ["k"]).collect())
    expect = sorted(min(r for r in rows if r[0] == k) for k in {r[0] for r in rows})
    assert got == expect
