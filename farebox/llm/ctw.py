"""Operator 10: language-model scoring by context-tree weighting over bytes.

A text is its bytes with A-Z lower-cased and one end byte.  Every byte is eight binary
decisions, each with its own context tree over the ``DEPTH`` bytes before it.  A node
has the Krichevsky-Trofimov estimate of the decisions that training texts made in its
context; weighting mixes, at every node, that estimate with the product of its
children, so a decision's probability mixes the estimates of all depths along its path.
A path ends at the deepest context that training texts have shown.  The score is the
log10 probability of the text, ``bits_per_byte`` its code length.

How it runs: texts are dealt to chunks (the tasks that read them).  A chunk counts its
distinct grams (context and byte) and words.  Grams are gathered by their last two
context bytes, summed over the chunks to one row for each distinct gram, so that the
subtrees below these are whole in one group, and the two upper levels are plain
aggregations of at most 65,536 rows.  Each group then computes the probability of every
gram that any chunk needs, and a join by gram takes it to those chunks alone, as it is
done with the counts of words for the unigram base.  So a task holds its own chunk or
the distinct grams below two bytes, however many chunks there are, and nothing is
broadcast but the two upper levels.

Words travel as 64-bit hashes.  Defined cases: a null text is empty and consists of
the end only; without training texts every decision has probability 1/2 and the base
score is 0; repeated rows are scored (and counted) each; a null id trains; an empty table
gives an empty result; other columns are not needed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import Words, fold, slices, staged, text_or_empty

DEPTH, END = 4, 0xFF

#: Word hashes a task remembers before it starts afresh, and bytes counted at once.
MEMO, COUNT_BYTES = 400_000, 3_000_000

_LN2 = math.log(2)


def lgamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after eight steps of the recurrence, for x > 0."""
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5)
    return series - np.log(x * (x + 1) * (x + 2) * (x + 3)) - np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return lgamma(n0 + 0.5) + lgamma(n1 + 0.5) - lgamma(n0 + n1 + 1.0) - math.log(math.pi)


def grams(raw: bytes) -> np.ndarray:
    """For each byte of a text and its end: the DEPTH bytes before it, then itself."""
    a = np.frombuffer(bytes([END]) * DEPTH + raw + bytes([END]), np.uint8).astype(np.int64)
    out = np.zeros(len(raw) + 1, np.int64)
    for k in range(DEPTH + 1):
        out = out << 8 | a[k:len(out) + k]
    return out


def decisions(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (context << 8 | node) and bits of the eight decisions, a row for each gram."""
    byte, context = gram & 0xFF, gram >> 8 << 8
    place = np.arange(8)
    node = (1 << place) | (byte[:, None] >> (8 - place))
    return context[:, None] | node, byte[:, None] >> (7 - place) & 1


def _summed(key: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    by = np.argsort(key, kind="stable")
    key = key[by]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    return (key[first], *[np.add.reduceat(c[by], first) if len(first) else c for c in columns])


def weighted(gram: np.ndarray, n: np.ndarray, top: int) -> dict[int, tuple[np.ndarray, ...]]:
    """Nodes by depth, from DEPTH up to ``top``: sorted key, zeros, ones, ln of the
    estimate and ln of the weighted probability."""
    key, bit = decisions(gram)
    ones = bit * n[:, None]
    key, n0, n1 = _summed(key.ravel(), (n[:, None] - ones).ravel().astype(float), ones.ravel().astype(float))
    out, weight = {}, None
    for depth in range(DEPTH, top - 1, -1):
        below = None
        if weight is not None:
            key, n0, n1, below = _summed(key & ((1 << 8 * (depth + 1)) - 1), n0, n1, weight)
        estimate = log_kt(n0, n1)
        weight = estimate if below is None else np.logaddexp(estimate, below) - _LN2
        out[depth] = (key, n0, n1, estimate, weight)
    return out


def log10_of(gram: np.ndarray, nodes: dict[int, tuple[np.ndarray, ...]]) -> np.ndarray:
    """log10 probability of the last byte of each gram after the bytes before it."""
    full, bit = decisions(gram)
    p = np.full(full.shape, 0.5)
    open_ = np.zeros(full.shape, bool)  # a deeper context was seen
    for depth in range(DEPTH, -1, -1):
        key, n0, n1, estimate, weight = nodes[depth]
        if not len(key):
            continue
        want = full & ((1 << 8 * (depth + 1)) - 1)
        at = np.minimum(np.searchsorted(key, want), len(key) - 1)
        seen = key[at] == want
        kt = (np.where(bit == 1, n1[at], n0[at]) + 0.5) / (n0[at] + n1[at] + 1)
        own = np.where(open_, np.exp(np.minimum(estimate[at] - weight[at] - _LN2, 0.0)), 1.0)
        p = np.where(seen, own * kt + (1 - own) * p, p)
        open_ |= seen
    return np.log10(p).sum(1)


def counts(chunks: DataFrame) -> DataFrame:
    """(chunk, kind, key, n): training counts of the distinct grams (kind 0) and words
    (kind 1) of each chunk, zero for what only held-out texts have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Words()
        total: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        pending: dict[tuple[int, bool], list] = {}
        size = 0

        def settle() -> None:
            for (chunk, held), texts in pending.items():
                kinds = [np.concatenate([grams(t) for t in texts]), np.fromiter(
                    (h for t in texts for h in word_keys(t, memo)), np.uint64).view(np.int64)]
                for kind, keys in enumerate(kinds):
                    key, n = np.unique(keys, return_counts=True)
                    if held:
                        n = np.zeros_like(n)
                    if (chunk, kind) in total:
                        old = total[chunk, kind]
                        key, n = _summed(np.concatenate([old[0], key]), np.concatenate([old[1], n]))
                    total[chunk, kind] = key, n
            pending.clear()

        for b in slices(batches, 200):
            for chunk, held, text in zip(*(c.to_pylist() for c in b.columns)):
                raw = text.encode().lower()
                pending.setdefault((chunk, held), []).append(raw)
                size += len(raw) + 1
                if size > COUNT_BYTES:
                    settle()
                    size = 0
        settle()
        for (chunk, kind), (key, n) in total.items():
            for at in range(0, len(key), 100_000):
                k = key[at:at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k), chunk, np.int32)), pa.array(np.full(len(k), kind, np.int32)), pa.array(k),
                     pa.array(n[at:at + 100_000].astype(np.int64))], names=["chunk", "kind", "key", "n"])

    return chunks.select("chunk", "held_out", "text").mapInArrow(run, "chunk int, kind int, key long, n long")


#: Key of the end token: no word holds white space.
END_WORD = b"\n"


def word_keys(raw: bytes, memo: Words) -> list[int]:
    """Hashes of a text's words and of its end."""
    if len(memo) > MEMO:
        memo.clear()
    return [*map(memo.__getitem__, raw.split()), memo[END_WORD]]


def upper_levels(by_gram: DataFrame) -> dict[int, tuple[np.ndarray, ...]]:
    """Nodes of depth 0 and 1, from the subtrees below."""
    def run(t: pa.Table) -> pa.Table:
        key, n0, n1, _, weight = weighted(t.column("key").to_numpy(), t.column("n").to_numpy(), 2)[2]
        return pa.table({"key": key & 0xFFFF, "n0": n0, "n1": n1, "weight": weight})

    two = by_gram.groupBy("suffix").applyInArrow(run, "key long, n0 double, n1 double, weight double")
    one = two.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "weight")]).toArrow()  # at most 256 * 255 rows
    key, n0, n1, weight = (one.column(c).to_numpy() for c in ("key", "n0", "n1", "weight"))
    out = {}
    for depth, mask in ((1, 0xFFFF), (0, 0xFF)):
        key, n0, n1, below = _summed(key & mask, n0, n1, weight)
        estimate = log_kt(n0, n1)
        weight = np.logaddexp(estimate, below) - _LN2
        out[depth] = (key, n0, n1, estimate, weight)
    return out


def predicted(summed: DataFrame, upper: Broadcast) -> DataFrame:
    """(key, value): log10 probability of each distinct gram, from (suffix, key, n)
    with one row a gram; ``upper`` has the nodes of depth 0 and 1."""
    def run(t: pa.Table) -> pa.Table:
        key, n = t.column("key").to_numpy(), t.column("n").to_numpy()
        seen = n > 0
        nodes = upper.value | weighted(key[seen], n[seen], 2)
        value = np.concatenate([log10_of(key[i:i + 20_000], nodes) for i in range(0, len(key), 20_000)])
        return pa.table({"key": key, "value": value})

    return summed.groupBy("suffix").applyInArrow(run, "key long, value double")


class Lookup:
    """Open-addressing table of 64-bit keys; finds whole arrays at once."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.slot = np.full(1 << self.bits, -1, np.int32)
        self.keys = keys
        todo = np.arange(len(keys), dtype=np.int32)
        at = self._hash(keys)
        while len(todo):
            free = self.slot[at] < 0
            self.slot[at[free]] = todo[free]  # of those that meet, one stays
            lost = self.slot[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & ((1 << self.bits) - 1)

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        h = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        return (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key in the table's keys; all must be there."""
        at = self._hash(keys)
        out = self.slot[at]
        todo = np.flatnonzero(self.keys[out] != keys)
        at = at[todo]
        while len(todo):
            at = (at + 1) & ((1 << self.bits) - 1)
            got = self.slot[at]
            if (got < 0).any():
                raise KeyError("a gram or word that its chunk did not count")
            out[todo] = got
            wrong = self.keys[got] != keys[todo]
            todo, at = todo[wrong], at[wrong]
        return out


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_bytes, n_tokens, n_known, train_tokens, base_score, score):
    all texts, learning from those that are not held out; ``docs`` has doc_id, text
    and held_out."""
    chunks = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), "held_out",
                                F.spark_partition_id().alias("chunk")), "ctw-chunks")
    counted = staged(counts(chunks), "ctw-counts")
    found = counted.filter("kind = 0").select("chunk", "kind", "key", "n")
    # a row for each distinct gram, whatever the number of chunks; n is 0 where only held-out texts have it
    summed = staged(found.groupBy("key").agg(F.sum("n").alias("n")).withColumn(
        "suffix", F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))), "ctw-grams")
    trained = summed.filter("n > 0")
    upper = docs.sparkSession.sparkContext.broadcast(upper_levels(trained))

    of_grams = found.select("chunk", "kind", "key").join(
        predicted(summed, upper).hint("shuffle_hash"), "key").select("chunk", "kind", "key", "value")
    words = counted.filter("kind = 1")
    by_word = words.groupBy("key").agg(F.sum("n").alias("c"))
    totals = by_word.agg(F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    n_train, distinct = int(totals["n"] or 0), int(totals["v"] or 0)
    of_words = words.select("chunk", "kind", "key").join(by_word, "key").select(
        "chunk", "kind", "key", F.col("c").cast("double").alias("value"))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        kind, key, value = (b.column(c).to_numpy() for c in ("kind", "key", "value"))
        tables = [(Lookup(key[kind == k]), value[kind == k]) for k in (0, 1)]
        (gram, lp), (word, c) = tables
        base = np.log10((c + 0.1) / (n_train + 0.1 * (distinct + 1)))
        memo = Words()
        n_bytes, n_tokens, n_known, base_score, model = [], [], [], [], []
        for text in a.column("text"):
            raw = text.as_py().encode().lower()
            w = word.find(np.array(word_keys(raw, memo), np.uint64).view(np.int64))
            n_bytes.append(len(raw))
            n_tokens.append(len(w))
            n_known.append(int((c[w] > 0).sum()))
            base_score.append(float(base[w].sum()))
            model.append(float(lp[gram.find(grams(raw))].sum()))
        return pa.table({"doc_id": a.column("doc_id"), "held_out": a.column("held_out"),
                         "n_bytes": pa.array(n_bytes, pa.int64()), "n_tokens": pa.array(n_tokens, pa.int64()),
                         "n_known": pa.array(n_known, pa.int64()),
                         "train_tokens": pa.array([n_train] * a.num_rows, pa.int64()),
                         "base_score": pa.array(base_score, pa.float64()), "score": pa.array(model, pa.float64())})

    schema = ("doc_id long, held_out boolean, n_bytes long, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")
    return (chunks.groupBy("chunk").cogroup(of_grams.unionByName(of_words).groupBy("chunk")).applyInArrow(run, schema))


def bits_per_byte(score: str = "score", n_bytes: str = "n_bytes"):
    """Code length of a text (with its end) by byte."""
    return -F.col(score) / F.log10(F.lit(2.0)) / (F.col(n_bytes) + 1)


def held_out():
    """Rows that never train: crc32 of the id as text divisible by 10."""
    return fold("doc_id", 10) == 0
