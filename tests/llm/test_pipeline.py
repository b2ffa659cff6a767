import random

import corpus_pipeline as cp
from farebox.llm import secret_scan, toxicity
from farebox.llm.catalog import queries, vocabulary_path
from tests.llm.helpers import frame, save, sentence
from tests.llm.test_simhash import groups, plain_fingerprint
from tests.llm.test_toxicity import LABELS, table


def test_pipeline_against_its_parts(spark, tmp_path):
    from tokenizers import Tokenizer

    data, labels = table(spark)
    rng = random.Random(2)
    clean = [r for r in data if r[0] % 4]
    data += [(2000 + i, clean[i][1], "en", "src1", 0) for i in range(20)]  # copies
    data += [(3000 + i, sentence(rng, 50) + " password=hunter2hunter2 end", "en", "src2", 0) for i in range(5)]
    data += [(4000, None, None, None, None), (4001, "", "en", "", 0)]
    folder = save(spark, tmp_path, documents=frame(spark, data).drop("key", "score"),
                  labels=spark.createDataFrame(labels, LABELS))
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, folder)
        rows = docs.collect()
        seen.append(rows)
        docs = spark.createDataFrame(rows, docs.schema)
        if name != cp.STAGES[-1][0]:
            assert docs.columns == cp.COLUMNS
    tox, unique, safe, mix, tokens = seen
    rejected = {r[0] for r in data} - {r["doc_id"] for r in tox}
    assert rejected and all(i % 4 == 0 and i < 2000 for i in rejected)
    kept = sorted(tox, key=lambda r: r["doc_id"])
    of = groups([plain_fingerprint(r["text"]) for r in kept])
    assert sorted(r["doc_id"] for r in unique) == [r["doc_id"] for i, r in enumerate(kept) if of[i] == i]
    by_id = {r["doc_id"]: r for r in safe}
    assert set(by_id) == {r["doc_id"] for r in unique}
    for r in unique:
        text = (r["text"] or "").replace("password=hunter2hunter2", "[SECRET]")
        assert (by_id[r["doc_id"]]["text"] or "") == text
        if "[SECRET]" in text:
            assert by_id[r["doc_id"]]["n_chars"] == len(text)
    assert {r["doc_id"] for r in mix} == set(by_id)  # every document at least once
    library = Tokenizer.from_file(vocabulary_path())
    assert sorted((r["doc_id"], r["ids"]) for r in tokens) == sorted(
        (r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids) for r in mix)
    assert [n for n, _ in cp.STAGES] == ["toxicity", "simhash", "secrets", "mix", "bpe"]
    assert toxicity.THRESHOLD == 0.7 and secret_scan.KINDS[0] == "assign"


def test_every_operator_is_registered():
    assert [q.split("_")[0] for q in queries()] == [f"op{n}" for n in range(1, 14)]


def test_empty_documents(spark, tmp_path):
    folder = save(spark, tmp_path, documents=frame(spark, []).drop("key", "score"), labels=spark.createDataFrame([], LABELS))
    assert cp.run(spark, folder).count() == 0
