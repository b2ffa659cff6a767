"""Operator 12 against brute force, and its awkward rows."""

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farebox.llm import catalog, runs
from tests.llm.helpers import frame, rows, save


def brute(w):
    """All maximal runs (start, length, period) by trying every period."""
    found, n = {}, len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)  # the smallest period of a stretch comes first
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain(text):
    return [w.decode() for w in (text or "").encode().split()]


def plant(doc_id, w):
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def digests(doc_id, w):
    found = brute(w)
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    text = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(found, key=lambda r: (r[0], r[2])))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha(text), sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=4))
def test_find_runs_is_brute_force(texts):
    names = np.array([x for t in texts for x in t], np.int64)
    sizes = [len(t) for t in texts]
    at = np.concatenate([[0], np.cumsum(sizes)])
    s, n, q = runs.find_runs(names, np.repeat(np.arange(len(texts)), sizes), max(sizes, default=0))
    want = sorted((at[i] + a, c, b) for i, t in enumerate(texts) for a, b, c in brute(t))
    assert list(zip(s, q, n)) == want


def test_long_periods_and_nested_runs():
    rng = random.Random(5)
    unit = [rng.randrange(50) for _ in range(700)]
    inner = [1, 2, 1, 2, 1, 2, 1, 2, 1, 2]
    w = [99, *(unit[:300] + inner + unit[300:]) * 5, 98, *[7] * 9]
    s, n, q = runs.find_runs(np.array(w), np.zeros(len(w), int), len(w))
    assert sorted(zip(s.tolist(), n.tolist(), q.tolist())) == brute(w)
    assert 710 in q


def test_query_is_brute_force(spark, tmp_path):
    data = rows(60) + [(1000 + i, "a b c " * i + "x" + " z" * (i % 9), "en", "s", 0) for i in range(60)]
    sf = save(spark, tmp_path, documents=frame(spark, data))
    got = sorted((tuple(r) for r in catalog.op12_periodic_runs(spark, sf).collect()), key=str)
    assert got == sorted((digests(r[0], plant(r[0], plain(r[1]))) for r in data), key=str)


def test_spans_texts_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "x a b a b a b a b y", "q"), (None, None, None)], "doc_id int, text string, runs string")
    out = {r.doc_id: r for r in runs.collapsed_runs(docs).collect()}
    assert [tuple(r) for r in out[1].runs] == [(1, 8, 2)] and out[1].collapsed == "x a b y" and out[1].n_words == 10
    assert out[None].runs == [] and out[None].collapsed == ""


def test_slices_do_not_change_results(spark, monkeypatch):
    docs = frame(spark)
    whole = sorted(map(str, runs.collapsed_runs(docs).collect()))
    monkeypatch.setattr(runs, "SLICE_BYTES", 10)
    assert sorted(map(str, runs.collapsed_runs(docs).collect())) == whole


def test_empty_table(spark):
    assert runs.collapsed_runs(frame(spark).filter(F.lit(False))).count() == 0
