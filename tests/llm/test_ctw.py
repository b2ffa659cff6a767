import collections
import math
import zlib

import numpy as np
import pytest

from farebox.llm import ctw
from farebox.llm.catalog import op10_context_tree
from tests.llm.helpers import frame, rows, save


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0


def path(raw):
    b = bytes([ctw.END]) * ctw.DEPTH + raw + bytes([ctw.END])
    for i in range(ctw.DEPTH, len(b)):
        node = 1
        for k in range(8):
            bit = b[i] >> (7 - k) & 1
            yield b[i - ctw.DEPTH:i], node, bit
            node = node * 2 + bit


def kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


class Plain:
    """Context-tree weighting with dictionaries."""

    def __init__(self, texts):
        self.n, self.weight, kids = {}, {}, collections.defaultdict(list)
        for t in texts:
            for context, node, bit in path(t):
                for d in range(ctw.DEPTH + 1):
                    self.n.setdefault((context[ctw.DEPTH - d:], node), [0, 0])[bit] += 1
        for c, node in self.n:
            if c:
                kids[c[1:], node].append((c, node))
        for key in sorted(self.n, key=lambda k: -len(k[0])):
            e = kt(*self.n[key])
            self.weight[key] = e if len(key[0]) == ctw.DEPTH else np.logaddexp(
                e, sum(self.weight[k] for k in kids[key])) - math.log(2)

    def score(self, raw):
        total = 0.0
        for context, node, bit in path(raw):
            p = None
            for d in range(ctw.DEPTH, -1, -1):
                key = context[ctw.DEPTH - d:], node
                if key in self.n:
                    a = self.n[key]
                    own = (a[bit] + 0.5) / (sum(a) + 1)
                    share = 1.0 if p is None else math.exp(kt(*a) - math.log(2) - self.weight[key])
                    p = share * own + (1 - share) * (p or 0)
            total += math.log10(0.5 if p is None else p)
        return total


def test_op10_against_plain_python(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ctw, "COUNT_BYTES", 3_000)
    data = rows()
    folder = save(spark, tmp_path, documents=frame(spark, data).repartition(3))
    got = sorted(op10_context_tree(spark, folder).collect(), key=lambda r: (str(r["doc_id"]), r["n_bytes"]))
    texts = {k: (r[1] or "").encode().lower() for k, r in enumerate(data)}
    counts = collections.Counter()
    for k, r in enumerate(data):
        if not held(r[0]):
            counts.update([*texts[k].split(), b"\n"])
    n, v = sum(counts.values()), len(counts)
    model = Plain([texts[k] for k, r in enumerate(data) if not held(r[0])])
    order = sorted(texts, key=lambda k: (str(data[k][0]), len(texts[k])))
    assert len(got) == len(data)
    for r, k in zip(got, order):
        tokens = [*texts[k].split(), b"\n"]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held(data[k][0]), len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(model.score(texts[k]), rel=1e-7)
        assert r["bits_per_byte"] == pytest.approx(-r["score"] / math.log10(2) / (len(texts[k]) + 1))


def test_groups_hold_each_gram_once_whatever_the_chunks(spark, monkeypatch):
    met = []
    predicted = ctw.predicted

    def seen(summed, upper):
        met.extend(summed.select("key", "n").collect())
        return predicted(summed, upper)

    monkeypatch.setattr(ctw, "predicted", seen)
    texts = {i: "the same line in every chunk" + " and only here" * (i == 7) for i in range(40)}
    df = spark.createDataFrame([(i, t, i == 7) for i, t in texts.items()], "doc_id long, text string, held_out boolean")
    out = {}
    for chunks in (8, 1):
        met.clear()
        out[chunks] = {r["doc_id"]: r["score"] for r in ctw.score(df.repartition(chunks)).collect()}
        want = collections.Counter(g for i, t in texts.items() if i != 7 for g in ctw.grams(t.encode()).tolist())
        want.update(dict.fromkeys(ctw.grams(texts[7].encode()).tolist(), 0))
        assert len(met) == len(want) and {r["key"]: r["n"] for r in met} == want
    model = Plain([t.encode() for i, t in texts.items() if i != 7])
    for i, t in texts.items():
        assert out[8][i] == pytest.approx(model.score(t.encode()), rel=1e-7) and out[1][i] == pytest.approx(out[8][i])


def test_probabilities_of_all_bytes_sum_to_one():
    raw = b"abracadabra abracadabra"
    grams, n = np.unique(ctw.grams(raw), return_counts=True)
    nodes = ctw.weighted(grams, n, 0)
    for context in (grams[5] >> 8 << 8, int.from_bytes(b"zzzz", "big") << 8):
        assert (10 ** ctw.log10_of(context | np.arange(256), nodes)).sum() == pytest.approx(1)


def test_nothing_to_learn_from_and_empty(spark, tmp_path):
    only = [(i, "some text", "en", "s", 0) for i in range(2000) if held(i)][:3]
    r = op10_context_tree(spark, save(spark, tmp_path / "a", documents=frame(spark, only))).first()
    assert r["base_score"] == 0 and r["train_tokens"] == 0 and r["score"] == pytest.approx(10 * 8 * math.log10(0.5))
    assert op10_context_tree(spark, save(spark, tmp_path / "b", documents=frame(spark, []))).count() == 0


def test_lookup_and_lgamma():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(-2 ** 62, 2 ** 62, 5000))
    table = ctw.Lookup(keys)
    want = rng.integers(0, len(keys), 9000)
    assert (table.find(keys[want]) == want).all()
    with pytest.raises(KeyError):
        table.find(np.array([3]))
    x = np.array([0.5, 1, 1.5, 10, 1e5])
    assert ctw.lgamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-9)
