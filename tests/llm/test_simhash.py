import random

import numpy as np
import pytest
import xxhash

from farebox.llm import simhash as sh
from farebox.llm.catalog import op4_simhash_near_dedup
from farebox.llm.components import components
from tests.llm.helpers import frame, rows, save


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace(
        "\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints, radius=3):
    """Class of each place by brute force."""
    up = list(range(len(prints)))

    def top(v):
        while up[v] != v:
            up[v] = up[up[v]]
            v = up[v]
        return v

    for i, a in enumerate(prints):
        for j in range(i):
            if (int(a) ^ int(prints[j])).bit_count() <= radius:
                up[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(prints))]


def test_fingerprints_against_plain_python():
    for r in rows():
        assert sh.fingerprint(r[1]) == plain_fingerprint(r[1])


def test_op4_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    data = rows()
    for i in range(30):  # near copies: one word in a long text changed
        words = data[45][1].split()
        words[rng.randrange(len(words))] = "changed"
        data.append((100 + i, " ".join(words), "en", "src0", 0))
    out = op4_simhash_near_dedup(spark, save(spark, tmp_path, documents=frame(spark, data))).collect()
    assert len(out) == len(data)
    prints = [plain_fingerprint(r[1]) for r in data]
    of = groups(prints)
    least = {}
    for r, g in zip(data, of):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    want = sorted((str(r[0]), f"{p:016x}", str(least.get(g))) for r, p, g in zip(data, prints, of))
    assert sorted((str(r[0]), r[1], str(r[2])) for r in out) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_groups_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    prints = []
    for size, flips in [(150, 4), *[(int(rng.integers(1, 10)), 6)] * 25]:
        centre = [int(rng.integers(0, 2 ** 63)) * 2 + 1]
        for _ in range(size):
            x = centre[int(rng.integers(len(centre)))] if rng.random() < 0.4 else centre[0]
            block = int(rng.integers(4)) if rng.random() < 0.5 else None
            for _ in range(int(rng.integers(1, flips + 1))):
                x ^= 1 << int(rng.integers(64) if block is None else 16 * block + rng.integers(16))
            centre.append(x)
        prints += centre
    signed = np.unique(np.array(prints, np.uint64).view(np.int64))
    df = spark.createDataFrame([(int(x),) for x in signed], "fp long")
    of = dict(map(tuple, sh.connected(df).collect()))
    want = groups(signed.view(np.uint64).tolist())
    classes = {}
    for x, g in zip(signed.tolist(), want):
        classes.setdefault(g, []).append(x)
    for members in classes.values():
        assert {of.get(x, x) for x in members} == {min(members)}


def test_empty_table(spark, tmp_path):
    assert op4_simhash_near_dedup(spark, save(spark, tmp_path, documents=frame(spark, []))).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(200, 200 + i) for i in range(1, 50)] + [(7, 7), (None, 3), (5, 4)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(61)} | {200 + i: 200 for i in range(50)}


def test_one_of_each_group_stays(spark):
    text = "a b c d e f g h"
    data = [(1, text, "en", "s", 0), (2, text, "en", "s", 0), (3, "quite another text of words", "en", "s", 0),
            (None, text, "en", "s", 0)]
    kept = sh.deduplicated(frame(spark, data))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "None"]


def test_a_unique_text_stays_whatever_its_id_holds(spark):
    text, other = "a b c d e f g h", "some quite other words that nobody else has"
    data = [(1, text, "en", "s", 0), (5, text, "en", "s", 0), (5, other, "en", "s", 0), (5, other, "en", "s", 0),
            (1, "third text under the first id", "en", "s", 0), (7, None, "en", "s", 0), (8, "", "en", "s", 0)]
    kept = sh.deduplicated(frame(spark, data)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept if r["text"]) == [
        (1, text), (1, "third text under the first id"), (5, other), (5, other)]
    # empty and null texts are one text: the first stays
    assert [r["doc_id"] for r in kept if not r["text"]] == [7]
