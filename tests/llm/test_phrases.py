import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import GroupedData
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from farebox.llm import phrases
from farebox.llm.catalog import op8_phrase_dedup
from tests.llm.helpers import frame, rows, save, sentence


def plain(data):
    first = {}
    split = [(r[0], (r[1] or "").encode().split()) for r in data]
    for doc, words in split:
        if doc is not None:
            for k in range(len(words) - 12):
                w = tuple(words[k:k + 13])
                first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, words in split:
        stays = [True] * len(words)
        for k in range(len(words) - 12):
            if doc is not None and first[tuple(words[k:k + 13])] < doc:
                stays[k:k + 13] = [False] * 13
        kept = b" ".join(w for w, s in zip(words, stays) if s)
        out.append((str(doc), len(words), len(words) - sum(stays), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def data_with_passages():
    rng = random.Random(11)
    data = rows()
    passages = [sentence(rng, n) for n in (12, 13, 14, 30, 60)]
    for i in range(60):
        parts = [sentence(rng, rng.randint(0, 20))]
        for _ in range(rng.randint(1, 3)):
            words = rng.choice(passages).split()
            a = rng.randint(0, max(0, len(words) - 13))
            parts += [" ".join(words[a:rng.randint(min(a + 13, len(words)), len(words))]), sentence(rng, rng.randint(0, 8))]
        data.append((500 + i, " ".join(parts), "en", "src0", 0))
    data.append((700, "the same " * 40, "en", "src0", 0))  # repeats only itself
    data.append((701, "the same " * 30, "en", "src0", 0))
    data.append((702, data[-20][1], "en", "src0", 0))
    return data


@pytest.mark.parametrize("sizes", [(4_000, 16_000), (3, 20)])
def test_op8_against_brute_force(spark, tmp_path, monkeypatch, sizes):
    monkeypatch.setattr(phrases, "PHRASES", sizes[0])
    monkeypatch.setattr(phrases, "SHARD_SEGMENTS", sizes[1])
    data = data_with_passages()
    got = op8_phrase_dedup(spark, save(spark, tmp_path, documents=frame(spark, data))).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == plain(data)


def test_op8_line_amid_differing_words(spark, tmp_path, monkeypatch):
    """A line that most documents hold, each amid words of its own: no group grows with them."""
    monkeypatch.setattr(phrases, "PHRASES", 20)
    monkeypatch.setattr(phrases, "SHARD_SEGMENTS", 40)
    monkeypatch.setattr(phrases, "AUTOMATON", 7)
    alone, both = GroupedData.applyInArrow, PandasCogroupedOps.applyInArrow

    def few(t, most):
        if t.num_rows > most:
            raise ValueError(f"a group of {t.num_rows} rows")

    def of_one(self, func, schema):
        def run(t):
            few(t, 150)
            return func(t)
        return alone(self, run, schema)

    def of_two(self, func, schema):
        def run(a, b):
            few(a, 150)
            few(b, 9 * 150)
            return func(a, b)
        return both(self, run, schema)

    monkeypatch.setattr(GroupedData, "applyInArrow", of_one)
    monkeypatch.setattr(PandasCogroupedOps, "applyInArrow", of_two)
    rng = random.Random(5)
    line = " ".join(f"line{k}" for k in range(30))
    data = [(i, f"{sentence(rng, 12)} {line} {sentence(rng, 12)}", "en", "src0", 0) for i in range(400)]
    data += [(400 + i, data[i][1][20:], "en", "src0", 0) for i in range(0, 400, 9)]
    got = op8_phrase_dedup(spark, save(spark, tmp_path, documents=frame(spark, data))).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == plain(data)


def test_empty_table(spark, tmp_path):
    assert op8_phrase_dedup(spark, save(spark, tmp_path, documents=frame(spark, []))).count() == 0


def test_automata_have_a_step_a_word_not_a_character(monkeypatch):
    import ahocorasick
    made, plain = [], ahocorasick.Automaton

    def automaton(*kind):
        made.append(plain(*kind))
        return made[-1]
    monkeypatch.setattr(ahocorasick, "Automaton", automaton)
    phrase = " ".join(f"wörd{k}" * 5 for k in range(13))
    found = phrases._located([f"x {phrase} y", "x" + phrase, phrase], {phrase: 4}, 10)
    assert found == [[(1, 14, 4)], [], [(0, 13, 4)]]
    assert made[0].get_stats()["longest_word"] == 13


@pytest.mark.parametrize("size", [60, 1 << 20])
def test_many_texts_are_hashed_at_once_as_each_alone(monkeypatch, size):
    monkeypatch.setattr(phrases, "HASHED_BYTES", size)
    rng = random.Random(3)
    texts = [None, "", " \t", "wörd", sentence(rng, 12), sentence(rng, 13), "the same " * 40,
             *(f"\n{sentence(rng, rng.randint(0, 90))}\u3000ü" for _ in range(60)), ""]
    pieces, got = 0, []
    for at, to, raw, bounds in phrases.joined(pa.array(texts, pa.string())):
        pieces += 1
        h, start, end = phrases.word_hashes(raw)
        before = np.searchsorted(start, bounds)
        a, first, stop, sid, k = phrases.segments(h, np.diff(before))
        got += [(int(at + t), *x) for t, *x in zip(k, a.tolist(), (first - before[k]).tolist(), (stop - before[k]).tolist(), sid.tolist())]
        words = [w for t in texts[at:to] for w in (t or "").encode().split()]
        assert [raw[s:e] for s, e in zip(start, end)] == words
    alone = []
    for k, t in enumerate(texts):
        h = phrases.word_hashes((t or "").encode())[0]
        alone += [(k, *x[:4]) for x in zip(*(c.tolist() for c in phrases.segments(h, np.array([len(h)]))))]
    assert got == alone and {k for k, *_ in got} >= {5, 6}
    assert size == 60 or pieces == 1
