import math
import random
import zlib

import pytest

from farebox.llm import toxicity as tx
from farebox.llm.catalog import op6_toxicity
from tests.llm.helpers import frame, rows, save, sentence

LABELS = "doc_id long, quality int, toxic int"


def table(spark, n=700):
    rng = random.Random(8)
    data, labels = [], []
    for i in range(n):
        text, bad = sentence(rng, rng.randint(20, 200)).split(), i % 4 == 0
        if bad:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["grubworm", "snotface", "vilebeast"]))
        data.append((i, " ".join(text), "en", "src0", 0))
        labels.append((i, 1, int(bad)))
    return data, labels


def test_held_out_accuracy_and_folds(spark, tmp_path):
    data, labels = table(spark)
    folder = save(spark, tmp_path, documents=frame(spark, data), labels=spark.createDataFrame(labels, LABELS))
    got = {r["doc_id"]: r for r in op6_toxicity(spark, folder).collect()}
    toxic = {i for i, _, t in labels if t}
    assert set(got) == set(range(len(data)))
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [i for i, r in got.items() if r["held_out"]]
    assert sum(got[i]["predicted"] == (i in toxic) for i in held) / len(held) > 0.97


def test_held_out_labels_teach_nothing(spark, tmp_path):
    data, labels = table(spark, 300)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    scores = [op6_toxicity(spark, save(spark, tmp_path / str(k), documents=frame(spark, data),
                                       labels=spark.createDataFrame(x, LABELS))).orderBy("doc_id").collect()
              for k, x in enumerate((labels, turned))]
    assert scores[0] == scores[1]


def test_clean_text_around_does_not_hide_a_passage(spark):
    data, labels = table(spark)
    weights, intercept = tx.train(tx.labelled(frame(spark, data), spark.createDataFrame(labels, LABELS)))
    rng = random.Random(1)
    long = sentence(rng, 8000) + " grubworm snotface vilebeast " + sentence(rng, 8000)
    out = tx.score(frame(spark, [(1, long, "en", "s", 0), (2, sentence(rng, 16000), "en", "s", 0)]), weights, intercept)
    score = {r["doc_id"]: r["score"] for r in out.collect()}
    assert score[1] > 0.7 > score[2]


@pytest.mark.parametrize("labels,want", [([], 0.0), ([(0, 1, 1), (2, 1, 1)], 1.0), ([(0, 1, None), (None, 1, 1)], 0.0)])
def test_awkward_rows_and_missing_classes(spark, labels, want):
    out = tx.toxicity(frame(spark), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(rows()) and all(r["score"] == pytest.approx(want, abs=1e-6) for r in out)


def test_empty_tables(spark, tmp_path):
    folder = save(spark, tmp_path, documents=frame(spark, []), labels=spark.createDataFrame([], LABELS))
    assert op6_toxicity(spark, folder).count() == 0


def test_distinct_grams():
    grams = tx.Grams()
    a = grams.of("abcdabcd")
    assert len(a) == len(set(a.tolist())) and len(grams.of("abc")) == 0 and len(grams.of(None)) == 0
    assert set(grams.of("ABCDABCD").tolist()) == set(a.tolist())


def test_features_and_ratios_by_brute_force(spark):
    data, labels = table(spark, 60)
    texts = [t for _, t, *_ in data]
    bad = [b for _, _, b in labels]
    x = tx.features(spark.createDataFrame(list(zip(bad, texts)), "label int, text string"))
    grams = tx.Grams()
    of = {}
    for text, label in zip(texts, bad):
        seen = set()
        for n in tx.ORDERS:
            for i in range(len(text) - n + 1):
                (code,) = {int(a[0]) for a in grams.all(text[i:i + n])[tx.ORDERS.index(n):][:1]}
                seen.add(code)
        for code in seen:
            of.setdefault(code, []).append(label)
    n1, n0 = sum(bad), len(bad) - sum(bad)
    a1, a0 = n1 / len(bad), n0 / len(bad)
    want = {c: math.log((sum(v) + a1) / (n1 + a1)) - math.log((len(v) - sum(v) + a0) / (n0 + a0))
            for c, v in of.items() if len(v) >= tx.MIN_DOCS}
    got = {r["idx"]: r["ratio"] for r in tx.ratios(x, n1, n0).collect()}
    assert got == pytest.approx(want) and min(got.values()) < 0 < max(got.values())


def test_score_is_that_of_the_passage_with_the_largest(spark):
    data, labels = table(spark)
    weights, intercept = tx.train(tx.labelled(frame(spark, data), spark.createDataFrame(labels, LABELS)))
    text = " ".join(t for _, t, *_ in data[:6])
    grams, best = tx.Grams(), -math.inf
    for at in range(0, len(text) - 3, tx.PASSAGE):
        idx = set()
        for n in tx.ORDERS:
            for i in range(at, min(at + tx.PASSAGE, len(text) - n + 1)):
                idx.add(int(grams.all(text[i:i + n])[tx.ORDERS.index(n)][0]))
        best = max(best, sum(float(weights[i]) for i in idx))
    got = tx.score(frame(spark, [(1, text, "en", "s", 0)]), weights, intercept).first()["score"]
    assert got == pytest.approx(1 / (1 + math.exp(-best - intercept)))


def test_clean_words_do_not_add_up(spark):
    """Long clean texts of a large vocabulary, none of it in the labelled texts."""
    data, labels = table(spark)
    weights, intercept = tx.train(tx.labelled(frame(spark, data), spark.createDataFrame(labels, LABELS)))
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 11)))
    long = [(i, " ".join(word() if rng.random() < 0.5 else sentence(rng, 1) for _ in range(12_000)), "en", "s", 0)
            for i in range(6)]
    assert max(r["score"] for r in tx.score(frame(spark, long), weights, intercept).collect()) < tx.THRESHOLD
