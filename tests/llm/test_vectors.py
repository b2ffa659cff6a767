import numpy as np
import pytest

from farebox.llm import forest, hnsw
from farebox.llm.catalog import op2_prefix_forest, op5_embedding_near_dedup
from tests.llm.helpers import save

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def table(spark, n=600, seed=4, awkward=True):
    """Random vectors with clusters of near copies, equal copies and unusable rows."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 16)) * rng.uniform(0.5, 2, (n, 1))
    x[100:160] = x[100] + rng.standard_normal((60, 16)) * 0.12
    x[300:330] = x[300]
    data = [(i, [float(np.float32(v)) for v in x[i]], int(i // 100 % 3)) for i in range(n)]
    if awkward:
        data += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] * 16, 0), (n + 3, [None] * 16, 1),
                 (n + 4, [float("inf")] + [0.0] * 15, 1), (n + 5, data[300][1], None), (n + 6, data[0][1], 2),
                 (None, data[1][1], 0), (5, data[5][1], 0)]
    return spark.createDataFrame([(*r, "s") for r in data], SCHEMA), data


def usable(data):
    ok = {}
    for i, v, label in data:
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v):
            ok[i] = (np.array(v, np.float64), label)
    return ok


def test_op2_recall_order_and_scores(spark, tmp_path):
    df, data = table(spark)
    got = op2_prefix_forest(spark, save(spark, tmp_path, embeddings=df)).collect()
    rows = usable(data)
    ids = np.array(sorted(rows))
    x = np.array([rows[i][0] for i in ids])
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(found) == [i for i in ids if i % 20 == 0]
    hit = total = 0
    for q, out in found.items():
        out.sort()
        assert [r for r, _, _ in out] == list(range(1, 21))
        assert q not in [v for _, v, _ in out]
        s = (x * rows[q][0]).sum(1)
        for _, v, score in out:
            assert score == pytest.approx(float(s[ids == v][0]), abs=1e-12)
        assert [(-sc, v) for _, v, sc in out] == sorted((-sc, v) for _, v, sc in out)
        s[ids == q] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        hit, total = hit + len(best & {v for _, v, _ in out}), total + 20
    assert hit / total >= 0.9


def test_forest_over_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(forest, "SHARD", 150)
    monkeypatch.setattr(forest, "QUERY_BLOCK", 10)
    df, data = table(spark, awkward=False)
    rows = forest.one_per_id(df)
    asked = rows.filter("vec_id % 20 = 0")
    exact = {(r[0], r[1]) for r in forest.search(rows, asked, 5, 10 ** 6, 600, 30).select("query_id", "vec_id").collect()}
    some, recall = forest.tuned(rows, asked, 5, 600)
    found = {(r[0], r[1]) for r in forest.search(rows, asked, 5, some, 600, 30).select("query_id", "vec_id").collect()}
    assert len(exact) == 150 and recall >= 0.9 and len(found & exact) >= 0.9 * len(exact)


def test_forest_descends_and_ascends():
    rng = np.random.default_rng(6)
    x = np.repeat(rng.standard_normal((100, 16)), 30, axis=0) + 0.3 * rng.standard_normal((3000, 16))
    q = x[::60] + 0.05 * rng.standard_normal((50, 16))
    tree = forest.Forest(x, float(np.linalg.norm(x, axis=1).max()))
    least = 1000  # of 3000 rows in 48 trees
    lo, hi = tree.ranges(q, least)
    codes = tree._codes(np.column_stack([q, np.zeros(len(q))]))
    for i in range(len(q)):
        for free in range(forest.BITS + 1):
            below = tree.codes >> np.uint64(free) == codes[i] >> np.uint64(free)
            if below.sum() >= least or free == forest.BITS:
                break
        assert ((hi[i] - lo[i]) == below.sum(0)).all()
        assert all(below[lo[i, t]:hi[i, t], t].all() for t in range(forest.TREES))
    ids = np.arange(len(x))
    found = tree.nearest(ids, q, np.full(len(q), -1), 10, least)
    by_query = [found[k:k + 10] for k in range(0, len(found), 10)]
    assert len(found) == 10 * len(q)
    best = np.argsort(-(q @ x.T), axis=1)[:, :10]
    hits = [len({f[1] for f in by_query[i]} & set(best[i].tolist())) for i in range(len(q))]
    assert np.mean(hits) >= 9


def test_fewer_rows_than_k_and_none(spark, tmp_path):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1, "s"), (1, [0.0, 2.0], 1, "s"), (2, [1.0, 1.0], 1, "s")], SCHEMA)
    got = op2_prefix_forest(spark, save(spark, tmp_path, embeddings=df)).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 2, 1.0), (0, 2, 1, 0.0)]
    folder = save(spark, tmp_path / "none", embeddings=df.limit(0))
    assert op2_prefix_forest(spark, folder).count() == 0
    assert op5_embedding_near_dedup(spark, folder).count() == 0


def brute_links(data):
    rows = usable(data)
    n_links, up = dict.fromkeys([i for i, _, _ in data if i is not None], 0), {}

    def top(v):
        while up.get(v, v) != v:
            v = up[v]
        return v

    for a, (x, la) in rows.items():
        for b, (y, lb) in rows.items():
            if a != b and la is not None and la == lb and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                n_links[a] += 1
                r, s = sorted((top(a), top(b)))
                if r != s:
                    up[s] = r
    return {i: (n, top(i), top(i) == i) for i, n in n_links.items()}


@pytest.mark.parametrize("shard", [8192, 60])
def test_op5_against_brute_force(spark, tmp_path, monkeypatch, shard):
    monkeypatch.setattr(hnsw, "SHARD", shard)
    monkeypatch.setattr(hnsw, "QUERY_BLOCK", shard)
    df, data = table(spark)
    got = op5_embedding_near_dedup(spark, save(spark, tmp_path, embeddings=df)).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == brute_links(data)
    assert len(got) == len({r[0] for r in got})


def islands(n, size, pairs, seed=1, d=64):
    """Groups of near copies, and single vectors of which each has one partner, last."""
    rng = np.random.default_rng(seed)

    def unit(v):
        return v / np.linalg.norm(v, axis=1)[:, None]

    x = unit(rng.standard_normal((n // size + 1, d)))[np.arange(n) // size] + 0.05 * unit(rng.standard_normal((n, d)))
    single = unit(rng.standard_normal((pairs, d)))
    return unit(np.concatenate([x, single])), unit(single + 0.3 * unit(rng.standard_normal((pairs, d))))


def test_audit_sees_rare_links():
    x, partners = islands(3960, 60, 40)
    x = x[np.random.default_rng(2).permutation(len(x))]
    q = np.random.default_rng(3).standard_normal((4000, 64))
    q /= np.linalg.norm(q, axis=1)[:, None]
    q[:40] = partners
    truth = [np.flatnonzero(x @ v >= 0.93) for v in q]
    assert 0 < sum(map(len, truth)) <= 60
    found = hnsw.links_in_shard(hnsw.Graph(x.astype(np.float32)), x, q, np.full(len(q), -1), 0.93)
    assert [f.tolist() for f in found] == [t.tolist() for t in truth]


def test_op5_rare_links_between_full_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD", 1500)
    monkeypatch.setattr(hnsw, "QUERY_BLOCK", 1500)
    x, partners = islands(4200, 60, 150)
    x = np.concatenate([x, partners])
    df = spark.createDataFrame([(i, v, 0, "s") for i, v in enumerate(x.tolist())], SCHEMA)
    x = x.astype(np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    got = {r[0]: r[1] for r in op5_embedding_near_dedup(spark, save(spark, tmp_path, embeddings=df)).collect()}
    assert got == dict(enumerate(((x @ x.T >= 0.93).sum(1) - 1).tolist()))


def test_graph_finds_near_neighbours():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1500, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph = hnsw.Graph(x)
    ids, _ = graph.search(x[:100], 96)
    truth = np.argsort(-(x[:100] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids, truth)]) > 0.9
