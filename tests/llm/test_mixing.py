import math

import pytest
from pyspark.sql import functions as F

from farebox.llm import mixing as mx
from farebox.llm.catalog import op3_source_mix
from tests.llm.helpers import frame, rows, save


def weights(tokens, a):
    z = sum(t ** a for t in tokens.values() if t)
    return {s: t ** a / z if t else 0.0 for s, t in tokens.items()}


def entropy(w):
    return -sum(x * math.log(x) for x in w.values() if x)


def sources(spark, tokens):
    return spark.createDataFrame(list(tokens.items()), "source string, tokens long")


def test_exponent_meets_the_target_entropy(spark):
    tokens = {"a": 100_000, "b": 5_000, "c": 3_000, "d": 800, "none": 0}
    a, budget = mx.exponent(sources(spark, tokens), 0.85, 1e9)
    assert entropy(weights(tokens, a)) == pytest.approx(0.85 * math.log(4), abs=1e-6)
    # the least budget with an epoch of every source
    assert min(weights(tokens, a)[s] * budget / t for s, t in tokens.items() if t) == pytest.approx(1)


def test_repetition_limit_takes_precedence(spark):
    tokens = {"a": 100_000, "b": 5_000, "c": 3_000, "d": 800}
    a, budget = mx.exponent(sources(spark, tokens), 0.99, 3.0)
    assert max(weights(tokens, a)[s] * budget / t for s, t in tokens.items()) == pytest.approx(3, abs=1e-4)
    assert mx.exponent(sources(spark, {"x": 5, "y": 5}), 0.9, 4.0)[0] == 1.0
    assert mx.exponent(sources(spark, {}), 0.9, 4.0) == (1.0, 0.0)


@pytest.mark.parametrize("budget", [None, 3_000.0])
def test_copies_are_full_epochs_and_a_longest_prefix(spark, budget):
    data = [r for r in rows(120) if r[0] is not None]
    small = mx.sized(frame(spark, data)).cache()
    mix = mx.plan(small, 0.95, 5.0, budget).collect()
    got = {}
    for r in mx.copies(small, spark.createDataFrame(mix)).collect():
        got.setdefault((r["source"], r["doc_id"], r["tie"]), []).append(r["epoch"])
    for m in mix:
        part = small.filter(F.col("source") == m["source"]).withColumn("key", mx._key(F.lit(m["full"]).cast("long"), mx.SEED)).collect()
        rest, upto = (m["epochs"] - m["full"]) * m["tokens"], 0
        whole = True
        for r in sorted(part, key=lambda r: (r["key"], r["tie"])):
            upto += r["n_tokens"]
            whole = whole and upto <= rest
            want = list(range(m["full"] + (1 if whole and m["tokens"] and rest > 0 else 0)))
            assert sorted(got.get((m["source"], r["doc_id"], r["tie"]), [])) == want
    if budget:
        assert sum(r["n_tokens"] for r in mx.copies(small, spark.createDataFrame(mix)).collect()) <= budget


def test_op3_blocks_and_whole_result(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mx, "BLOCK_TOKENS", 2_000)
    data = rows()
    out = op3_source_mix(spark, save(spark, tmp_path, documents=frame(spark, data))).collect()
    assert {r["doc_id"] for r in out} == {r[0] for r in data}  # every document at least once
    blocks = {}
    for r in out:
        blocks.setdefault(r["block"], []).append(r["place"])
    assert len(blocks) > 1 and all(sorted(p) == list(range(1, len(p) + 1)) for p in blocks.values())
    assert {r["source"] for r in out} == {"", "src0", "src1", "src2"}


def test_empty_and_tokenless_tables(spark, tmp_path):
    assert op3_source_mix(spark, save(spark, tmp_path, documents=frame(spark, []))).count() == 0
    none = frame(spark, [(1, None, "en", "a", 0), (2, "", "en", "b", 0)])
    assert sorted(r["doc_id"] for r in mx.mixed(none).collect()) == [1, 2]


def test_repeated_keeps_columns_and_null_sources(spark):
    out = mx.repeated(frame(spark))
    assert out.columns == frame(spark).columns
    assert {r["source"] for r in out.collect()} == {r[3] for r in rows()}


def test_repeated_stands_columns_named_as_the_plans_own(spark):
    names = ["full", "tie", "epoch", "cut_key", "cut_tie", "n_tokens", "_n", "_mix", "_row", "a.b"]
    docs = frame(spark)
    for i, c in enumerate(names):
        docs = docs.withColumn(c, F.lit(i))
    out = mx.repeated(docs)
    assert out.columns == docs.columns
    plain = sorted(map(str, mx.repeated(frame(spark)).select("doc_id", "source", "text").collect()))
    assert sorted(map(str, out.select("doc_id", "source", "text").collect())) == plain
    assert {tuple(r) for r in out.select(*[f"`{c}`" for c in names]).collect()} == {tuple(range(len(names)))}
