"""Operator 6: toxicity by a character n-gram linear classifier with naive Bayes features.

The features are distinct character n-grams (4 and 5 code points of the lower-cased
text), hashed to 2^20 indices.  From labelled rows, each index in at least ``MIN_DOCS``
texts gets the log ratio of its share in toxic and in clean texts, smoothed in
proportion to the classes so that an unseen n-gram is neutral.  Indices with a ratio of
``MIN_RATIO`` or more towards label 1 are kept, a text's features take the ratio as
their value, and a logistic regression is fitted on them.  N-grams that speak for label
0 are left out: clean text beside a toxic passage then doesn't hide it.

A text is scored by passages of ``PASSAGE`` code points (those in which an n-gram
starts, so none is cut), every one of the whole text; its score is the largest
probability of label 1.  So the words of a long clean text don't add up to a toxic one.

Fitting uses a bounded sample of the labelled rows: ``PER_CLASS`` of each label,
those with the smallest hash of their id.  Counting, fitting and scoring are Spark
jobs; the model has 2^20 numbers whatever the corpus, so it may be broadcast.

Defined cases: null and empty texts are scored by the intercept alone; without rows
of both labels every score is the share of label 1 among the labelled (0 if none);
labels of a repeated id count once, by the largest; rows whose label or id is null
train nothing; repeated rows get equal scores; other columns are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.common import fold, slices, staged, text_or_empty

ORDERS, DIM_BITS = (4, 5), 20

#: Bound of the labelled sample, by class.
PER_CLASS = {1: 3_000, 0: 6_000}

MIN_DOCS, MIN_RATIO, SMOOTHING = 4, 1.0, 1.0
ITERATIONS, REGULARISATION = 30, 1e-3

#: Code points of a passage.
PASSAGE = 2_000
THRESHOLD = 0.7


class Grams:
    """Distinct hashed n-grams of a text; keeps one array between texts."""

    def __init__(self) -> None:
        self.last = np.zeros(1 << DIM_BITS, np.int32)

    def all(self, text: str | None) -> list[np.ndarray]:
        """Index of the n-gram at each code point, an array for each n."""
        chars = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
        found = []
        for n in ORDERS:
            h = np.full(max(len(chars) - n + 1, 0), n, np.uint32)
            for k in range(n):
                h = (h ^ chars[k:len(h) + k]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x85EBCA6B)
            found.append((h >> np.uint32(32 - DIM_BITS)).astype(np.int32))
        return found

    def distinct(self, found: list[np.ndarray]) -> np.ndarray:
        idx = np.concatenate(found)
        at = np.arange(len(idx), dtype=np.int32)
        self.last[idx] = at
        return idx[self.last[idx] == at]

    def of(self, text: str | None) -> np.ndarray:
        return self.distinct(self.all(text))

    def passages(self, text: str | None) -> Iterator[np.ndarray]:
        """Distinct indices of each passage; one empty array for a text without n-grams."""
        found = self.all(text)
        for at in range(0, max(len(found[0]), 1), PASSAGE):
            yield self.distinct([f[at:at + PASSAGE] for f in found])


def features(docs: DataFrame) -> DataFrame:
    """(label, idx): labelled texts with their distinct n-gram indices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for b in slices(batches, 200):
            got = [grams.of(t) for t in b.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, got)])
            flat = np.concatenate([np.empty(0, np.int32), *got])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                names=["label", "idx"])

    return docs.select("label", "text").mapInArrow(run, "label int, idx array<int>")


def labelled(docs: DataFrame, labels: DataFrame, label: str = "toxic",
             per_class: dict[int, int] = PER_CLASS) -> DataFrame:
    """(label, text) of the bounded sample: ids first, then their texts."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))
    chosen = None
    for k, n in per_class.items():
        part = known.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        chosen = part if chosen is None else chosen.unionByName(part)
    return docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id").select("label", "text")


def ratios(x: DataFrame, n1: int, n0: int) -> DataFrame:
    """(idx, ratio): naive Bayes log-count ratios of the indices in ``MIN_DOCS`` texts or
    more, from (label, idx) with ``n1`` toxic and ``n0`` clean texts."""
    counts = (x.select("label", F.explode("idx").alias("idx")).groupBy("idx")
              .agg(F.sum("label").alias("c1"), F.count(F.lit(1)).alias("c")))
    a1, a0 = SMOOTHING * n1 / (n1 + n0), SMOOTHING * n0 / (n1 + n0)
    ratio = F.log((F.col("c1") + a1) / (n1 + a1)) - F.log((F.col("c") - F.col("c1") + a0) / (n0 + a0))
    return counts.filter(F.col("c") >= MIN_DOCS).select("idx", ratio.alias("ratio"))


def train(sample: DataFrame) -> tuple[np.ndarray, float]:
    """Weight of each index and the intercept, from (label, text)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors, VectorUDT

    x = staged(features(sample), "toxic-features")
    n = {r["label"]: r["n"] for r in x.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    weights = np.zeros(1 << DIM_BITS, np.float32)
    if not n1 or not n0:
        share = n1 / max(n0 + n1, 1)
        return weights, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    kept = ratios(x, n1, n0).filter(F.col("ratio") >= MIN_RATIO).orderBy("idx").toArrow()  # at most 2^20 rows
    idx, r = kept.column("idx").to_numpy(), kept.column("ratio").to_numpy()
    if not len(idx):
        return weights, float(np.log(n1 / n0))
    both = x.sparkSession.sparkContext.broadcast((idx, r))

    @F.udf(VectorUDT())
    def scaled(found):
        idx, r = both.value
        found = np.sort(np.array(found or [], np.int64))
        at = np.minimum(np.searchsorted(idx, found), len(idx) - 1)
        at = at[idx[at] == found]
        return Vectors.sparse(len(idx), at.tolist(), r[at].tolist())

    rows = x.select(F.col("label").cast("double").alias("label"), scaled("idx").alias("features"))
    model = LogisticRegression(maxIter=ITERATIONS, regParam=REGULARISATION, standardization=False).fit(rows)
    weights[idx] = (model.coefficients.toArray() * r).astype(np.float32)
    both.unpersist()
    return weights, float(model.intercept)


def score(docs: DataFrame, weights: np.ndarray, intercept: float, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (doc_id by default) and the ``score`` of every whole text: the
    largest of its passages."""
    keep = keep or ["doc_id"]
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, w = Grams(), model.value

        def largest(text: str) -> float:
            return max(w[idx].sum(dtype=np.float64) for idx in grams.passages(text))

        for b in slices(batches):
            z = np.array([largest(t) for t in b.column(len(keep)).to_pylist()]) + intercept
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(p, pa.float64())], names=[*keep, "score"])

    kept = docs.select(*[f"`{c}`" for c in keep])
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])
    whole = docs.select(*[f"`{c}`" for c in keep], F.col("text").alias("_scored"))
    return whole.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and ``score``: trained on the labelled rows, scoring all."""
    weights, intercept = train(labelled(docs, labels))
    return score(docs, weights, intercept, keep)


def held_out():
    """Rows that never train: crc32 of the id as text leaves 1 modulo 3."""
    return fold("doc_id", 3) == 1
