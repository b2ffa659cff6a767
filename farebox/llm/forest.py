"""Operator 2: approximate nearest neighbours by a hash-prefix forest.

Rows are dealt to shards of at most about ``SHARD`` vectors.  A shard has ``TREES``
trees; each is a sorted array of long hash strings, one bit for the side of each of
``BITS`` random hyperplanes.  A query descends every tree to its longest prefix
match, by binary search.  Then all trees are ascended together, one prefix bit at a
time, until the rows below the prefixes are enough: the candidates, which are
compared exactly.  Every shard answers every block of queries, and the answers are
merged.

Nearness is the inner product.  It has the order of the angle when vectors get one
more component that lifts all to the same length, and queries a zero there.

``tuned`` measures recall against brute force on a bounded sample of queries and
doubles the number of candidates until the target is met, at the latest when a
shard is compared whole.  The need of candidates is by shard, so it doesn't change
with the size of the table.

Defined cases: vectors that are null, zero or hold null or non-finite components
take no part; rows that repeat an id are one vector; ties go to the smaller id;
with fewer candidates than k all are returned; an empty table gives an empty result;
other columns are not needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import staged
from farebox.llm.vectors import matrix, one_per_id

TREES, BITS, SHARD, QUERY_BLOCK = 48, 32, 16_384, 4_096
CANDIDATES, TARGET_RECALL, AUDIT_QUERIES = 2_048, 0.95, 128
SEED = 29

_FOUND = "query_id long, vec_id long, score double"


class Forest:
    """Sorted arrays of hash strings over the rows of a shard."""

    def __init__(self, x: np.ndarray, longest: float):
        self.x = x
        lift = np.sqrt(np.maximum(longest ** 2 - (x * x).sum(1), 0.0))
        planes = np.random.default_rng(SEED).standard_normal((x.shape[1] + 1, TREES * BITS)).astype(np.float32)
        self.planes = planes
        codes = self._codes(np.column_stack([x, lift]))
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.codes = np.take_along_axis(codes, self.order, axis=0)

    def _codes(self, v: np.ndarray) -> np.ndarray:
        """Hash strings, most significant bit first: a row for each vector, a column a tree."""
        out = np.zeros((len(v), TREES), np.uint64)
        v = v.astype(np.float32)
        for at in range(0, len(v), 2048):
            sides = (v[at:at + 2048] @ self.planes > 0).reshape(-1, TREES, BITS)
            for bit in range(BITS):
                out[at:at + 2048] |= sides[:, :, bit].astype(np.uint64) << np.uint64(BITS - 1 - bit)
        return out

    def ranges(self, queries: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the candidates of each query begin and end in each tree."""
        codes = self._codes(np.column_stack([queries, np.zeros(len(queries))]))
        lo, hi = np.zeros(codes.shape, np.int64), np.zeros(codes.shape, np.int64)
        todo = np.arange(len(queries))
        for free in range(BITS + 1):  # bits given up so far, in all trees together
            prefix = codes[todo] >> np.uint64(free) << np.uint64(free)
            for t in range(TREES):
                lo[todo, t] = np.searchsorted(self.codes[:, t], prefix[:, t])
                hi[todo, t] = np.searchsorted(self.codes[:, t], prefix[:, t] + np.uint64(1 << free))
            todo = todo[(hi[todo] - lo[todo]).sum(1) < least]
            if not len(todo):
                break
        return lo, hi

    def nearest(self, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, least: int) -> list[tuple]:
        """(query id, row id, inner product): the k best candidates of each query."""
        out: list[tuple] = []
        if least >= len(self.x):
            every = np.arange(len(self.x))
            lo = hi = None
        else:
            lo, hi = self.ranges(queries, least)
        for i, q in enumerate(queries):
            if lo is None:
                rows = every
            else:
                mark = np.zeros(len(self.x), bool)
                for t in range(TREES):
                    mark[self.order[lo[i, t]:hi[i, t], t]] = True
                rows = np.flatnonzero(mark)
            rows = rows[ids[rows] != query_ids[i]]
            rough = self.x[rows] @ q
            if len(rows) > k:
                last = np.partition(rough, len(rows) - k)[len(rows) - k]
                rows = rows[rough >= last - 1e-9 * (1 + abs(last))]
            exact = (self.x[rows] * q).sum(1)  # the same rounding for equal vectors
            best = np.lexsort((ids[rows], -exact))[:k]
            out += [(int(query_ids[i]), int(ids[rows[j]]), float(exact[j])) for j in best]
        return out


def search(rows: DataFrame, queries: DataFrame, k: int, candidates: int, n_rows: int, n_queries: int) -> DataFrame:
    """(query_id, vec_id, score): the k nearest found of each query, from tables of
    usable (vec_id, embedding)."""
    shards, blocks = -(-n_rows // SHARD) or 1, -(-n_queries // QUERY_BLOCK) or 1
    longest = rows.agg(F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
                       .alias("m")).first()["m"] or 0.0
    longest = float(longest) ** 0.5

    def key(col: Column, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(SEED), col), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = rows.select("vec_id", "embedding", key(F.col("vec_id"), shards).alias("shard"), every(blocks).alias("block"))
    right = queries.select("vec_id", "embedding", key(F.col("vec_id"), blocks).alias("block"), every(shards).alias("shard"))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if a.num_rows and b.num_rows:
            a = a.sort_by("vec_id")
            forest = Forest(matrix(a.column("embedding")), longest)
            found = forest.nearest(a.column("vec_id").to_numpy(), matrix(b.column("embedding")),
                                   b.column("vec_id").to_numpy(), k, candidates)
        cols = list(zip(*found)) or [[], [], []]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64())})

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(run, _FOUND)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def tuned(rows: DataFrame, queries: DataFrame, k: int, n_rows: int, target: float = TARGET_RECALL) -> tuple[int, float]:
    """Candidates by shard that reach the target recall on a sample of queries, and that recall."""
    sample = staged(queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(AUDIT_QUERIES), "ann-audit")
    truth = staged(search(rows, sample, k, SHARD * 64, n_rows, AUDIT_QUERIES), "ann-truth")
    total = truth.count()
    candidates = CANDIDATES
    while True:
        found = search(rows, sample, k, candidates, n_rows, AUDIT_QUERIES)
        # a found row that ties with the last true one counts as found
        worst = truth.groupBy("query_id").agg(F.min("score").alias("worst"))
        hits = found.join(worst, "query_id").filter("score >= worst").count()
        recall = min(1.0, hits / total) if total else 1.0
        if recall >= target or candidates >= 2 * SHARD:
            return candidates, recall
        candidates *= 2


def nearest(vectors: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row that
    satisfies ``queries``, among all other rows."""
    rows = staged(one_per_id(vectors), "ann-rows")
    asked = rows.filter(queries)
    n_rows, n_queries = rows.count(), asked.count()
    candidates, _ = tuned(rows, asked, k, n_rows)
    return search(rows, asked, k, candidates, n_rows, n_queries).select("query_id", "rank", "vec_id", "score")
