"""Operator 13 against brute force, and that bounds skip without changing results."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from farebox.llm import catalog, lexical
from farebox.session import scratch_path
from tests.llm.helpers import WORDS, frame, rows, save

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def found(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    bags = [(i, Counter(found(t))) for i, t in docs]
    lens = [sum(b.values()) for _, b in bags]
    n, total = sum(x > 0 for x in lens), sum(lens)
    df = Counter(t for _, b in bags for t in b)
    wanted = {}
    for item, t in items:
        wanted.setdefault(item, set()).update(found(t))
    out = []
    for item, ts in wanted.items():
        scored = []
        for (i, b), size in zip(bags, lens):
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * ((10**9 * b[t]) // (1000 * b[t] + 20 * (50 + 50 * size * n // total))) for t in ts if t in b)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def corpus(n=300, seed=4):
    rng = random.Random(seed)
    words = WORDS + [f"rare{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 90)))) for i in range(n)]


def questions(docs, n=12, seed=9):
    rng = random.Random(seed)
    return [(i, " ".join(rng.sample(rng.choice(docs)[1].split(), 1) + rng.choices(WORDS, k=3) + [f"rare{rng.randrange(200)}"]))
            for i in range(n)]


def test_ranked_is_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SHARD_BYTES", 6000)
    monkeypatch.setattr(lexical, "STEP_BYTES", 1500)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 5)
    docs = corpus() + [(7, "the the the"), (None, "the of rare3"), (None, None), (400, ""), (401, " .,!"), (402, "RARE3 Ünï rare3")]
    items = questions(docs[:300]) + [(50, None), (51, "..."), (52, "nowhere"), (None, "rare3 the"), (3, "rare9"), (60, "ünï Ünï")]
    a = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, term string").repartition(3)
    b = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, score string")
    got = sorted((tuple(r)[:4] for r in lexical.ranked(a, b, 10).collect()), key=str)
    assert got == brute(docs, items, 10)


def test_query_is_brute_force(spark, tmp_path):
    data = rows()
    items = [(0, data[3][1][:60]), (1, "the of and"), (2, "日本語 don't")]
    sf = save(spark, tmp_path, documents=frame(spark, data),
              benchmark=spark.createDataFrame(items, "item_id long, text string"))
    got = sorted((tuple(r) for r in catalog.op13_pair_maxscore(spark, sf).collect()), key=str)
    assert got == brute([r[:2] for r in data], items, 50)


def test_pair_bounds_hold_and_tighten():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n, m = int(rng.integers(1, 6)), 40
        adds = rng.integers(1, 100, (n, m)) * (rng.random((n, m)) < 0.3)
        adds[:, 0] += 1
        most = adds.max(axis=1)
        both = [(adds[j] > 0) & (adds[j + 1] > 0) for j in range(n - 1)]
        joint = np.array([(adds[j] + adds[j + 1])[both[j]].max(initial=0) for j in range(n - 1)] + [-1])
        bound = lexical.pair_bounds(most, joint)
        for j in range(n):
            assert adds[j:].sum(axis=0).max() <= bound[j] <= most[j:].sum()
    # two terms that never meet add no more than the larger of them
    assert lexical.pair_bounds(np.array([5, 7]), np.array([0, -1])).tolist() == [7, 7, 0]


def test_bounds_skip_documents(spark):
    docs = corpus(2000)
    a = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    b = spark.createDataFrame([(1, "rare150 the of and to in")], "item_id long, text string")
    got = lexical.ranked(a, b, 5).collect()
    assert [tuple(r)[:4] for r in got] and sorted((tuple(r)[:4] for r in got), key=str) == brute(docs, [(1, "rare150 the of and to in")], 5)
    holding = sum(bool(set(found(t)) & {"rare150", "the", "of", "and", "to", "in"}) for _, t in docs)
    assert got[0].opened < holding / 4


def test_index_covers_every_row(spark):
    docs = frame(spark)
    path = scratch_path(spark, "index")
    lexical.build(docs, path)
    index = lexical.open_index(spark, path)
    assert index.agg(F.sum(F.size("ids")).alias("n")).filter("n > 0").first().n == docs.count()
    want = sum(len(found(r[1])) for r in rows())
    assert index.agg(F.sum("n_terms")).first()[0] == want


def test_empty_tables(spark):
    docs, items = frame(spark), spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert lexical.ranked(docs.filter(F.lit(False)), items, 5).count() == 0
    assert lexical.ranked(docs, items.filter(F.lit(False)), 5).count() == 0
