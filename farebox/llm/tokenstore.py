"""Operator 7: token-id files, coded with canonical length-limited Huffman codes.

A store is a folder of three Parquet tables, so any file system and committer that
Spark knows will do, and a lost task is simply written again:

* ``codebook``  id, length: code lengths from the counts of all ids, at most
  ``LIMIT`` bits (package-merge).  Codes are canonical: ascending by length, then id.
* ``segments``  part, segment, start, doc_ids, lengths, payload, checkpoints: whole
  documents in ascending doc_id order, up to about ``SEGMENT`` ids a row.  ``start``
  counts all ids before the segment.  The payload is the bit stream, most significant
  bit first in big-endian 32-bit words; ``checkpoints`` holds the bit offset of every
  ``BLOCK``-th id, so blocks decode independently.

Reading decodes all blocks of a segment in lockstep: a step looks up the next
``LIMIT`` bits of every block in one table of (id, length).  The codebook is bounded
by the vocabulary; nothing else is sent to the driver but one token count a part.

Defined cases: a null text is empty and holds only the end id; repeated doc_ids stand
next to each other, ordered by their text; null doc_ids come first; an empty table
gives an empty store; other columns are not stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm.bpe import codec
from farebox.llm.common import slices, staged, text_or_empty

LIMIT, BLOCK, SEGMENT = 18, 512, 1 << 18
END_ID = 0

_IDS = "part int, segment long, before long, doc_ids array<long>, lengths array<int>, ids binary, seen array<int>, times array<long>"
_CODED = "part int, segment long, start long, doc_ids array<long>, lengths array<int>, payload binary, checkpoints array<long>"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits for positive
    counts, by package-merge: every level pairs up the items of the level below and
    merges the pairs with the leaves; going back down, the cheapest 2n - 2 items
    tell how many of the rarest leaves each level takes."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids have no code of at most {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    levels, items, is_leaf = [], leaves, np.ones(n, bool)
    for _ in range(limit):
        levels.append(is_leaf)
        pairs = items[:len(items) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        by = np.argsort(both, kind="stable")
        items, is_leaf = both[by], by < n
    length, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(levels):
        own = int(leaf[:take].sum())
        length[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = length
    return out


def canonical(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Code of each id: ascending by (length, id)."""
    codes, code, last = np.zeros(len(ids), np.uint64), 0, 0
    for i in np.lexsort((ids, lengths)).tolist():
        code <<= int(lengths[i]) - last if last else 0
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def pack(codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bit stream of codes in order, and the bit offset of every BLOCK-th one."""
    ends = np.cumsum(lengths)
    at = ends - lengths
    words = np.zeros((int(ends[-1]) >> 5) + 2 if len(ends) else 1, np.uint32)
    if len(ends):
        placed = codes << (64 - lengths - (at & 31)).astype(np.uint64)
        word = at >> 5
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        for half, shift in ((0, 32), (1, 0)):
            part = ((placed >> np.uint64(shift)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            words[word[first] + half] |= np.bitwise_or.reduceat(part, first)
    return words.astype(">u4").tobytes(), at[::BLOCK]


class Table:
    """Decoding table over the next LIMIT bits."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.id, self.length = np.zeros(1 << LIMIT, np.uint32), np.ones(1 << LIMIT, np.int64)
        # in the order of their codes the ids' stretches of the table follow each other
        lengths = np.asarray(lengths, np.int64)
        order = np.argsort(canonical(ids, lengths).astype(np.int64) << (LIMIT - lengths), kind="stable")
        ids, lengths = np.asarray(ids)[order], lengths[order]
        each = np.left_shift(1, LIMIT - lengths)
        self.id[:each.sum()], self.length[:each.sum()] = np.repeat(ids, each), np.repeat(lengths, each)

    def unpack(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The first ``n`` ids of a segment, all its blocks at once."""
        words = np.concatenate([np.frombuffer(payload, ">u4"), np.zeros(2, np.uint32)]).astype(np.uint64)
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        at = np.asarray(checkpoints, np.int64)
        out = np.empty((len(at), BLOCK), np.uint32)
        last = len(pairs) - 1
        for step in range(min(BLOCK, n)):
            word = np.minimum(at >> 5, last)
            bits = pairs[word] >> (64 - LIMIT - (at & 31)).astype(np.uint64) & np.uint64((1 << LIMIT) - 1)
            bits = bits.astype(np.int64)
            out[:, step] = self.id[bits]
            at = at + self.length[bits]
        return out.ravel()[:n]


def id_type(path: str) -> str:
    """Integers that hold every id of a vocabulary."""
    return "<u2" if len(codec(path).bytes_of) <= 1 << 16 else "<u4"


def encoded(docs: DataFrame, path: str, kind: str, end_id: int = END_ID) -> DataFrame:
    """Segments of ids, in ascending doc_id order over (part, segment); ``before``
    counts the ids of the part before the segment.  The last segment of a part also tells the
    ids ``seen`` in the part and how many ``times``; the vocabulary bounds them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, part, segment = codec(path), TaskContext.get().partitionId(), 0
        names: list = []
        arrays: list[np.ndarray] = []
        size, before, end = 0, 0, np.array([end_id], np.uint32)
        total = np.zeros(max(len(own.bytes_of), end_id + 1), np.int64)

        def row(last: bool = False) -> pa.RecordBatch:
            nonlocal total
            lengths, ids = [len(a) for a in arrays], np.concatenate(arrays)
            total += np.bincount(ids, minlength=len(total))
            seen = np.flatnonzero(total) if last else None
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int64()), pa.array([before], pa.int64()),
                 pa.array([names], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())),
                 pa.array([ids.astype(kind).tobytes()], pa.binary()), pa.array([seen], pa.list_(pa.int32())),
                 pa.array([total[seen] if last else None], pa.list_(pa.int64()))],
                names=["part", "segment", "before", "doc_ids", "lengths", "ids", "seen", "times"])

        for b in slices(batches, 100):
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.concatenate([own.encode(text), end])
                if arrays and size + len(ids) > SEGMENT:
                    yield row()
                    names, arrays, size, before, segment = [], [], 0, before + size, segment + 1
                names.append(doc)
                arrays.append(ids)
                size += len(ids)
        if arrays:
            yield row(last=True)

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).repartitionByRange(n, "doc_id")
               .sortWithinPartitions("doc_id", "text"))
    return ordered.mapInArrow(run, _IDS)


def id_counts(segments: DataFrame) -> DataFrame:
    """(id, n) over all segments, from the sums of their parts."""
    both = F.explode(F.arrays_zip("seen", "times")).alias("x")
    return (segments.filter("seen is not null").select(both)
            .groupBy(F.col("x.seen").cast("long").alias("id")).agg(F.sum("x.times").alias("n")))


def write(docs: DataFrame, path: str, out: str) -> None:
    """Encode ``docs`` with the vocabulary at ``path`` and write the store ``out``."""
    spark = docs.sparkSession
    kind = id_type(path)
    segments = staged(encoded(docs, path, kind), "store-ids")
    counts = id_counts(segments).toArrow()  # bounded by the vocabulary
    ids, n = counts.column("id").to_numpy(), counts.column("n").to_numpy()
    order = np.argsort(ids)
    ids, lengths = ids[order], code_lengths(n[order])
    book = pa.table({"id": ids, "length": lengths})
    spark.createDataFrame(book).coalesce(1).write.mode("overwrite").parquet(f"{out}/codebook")

    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    parts = segments.groupBy("part").agg(F.sum(size).alias("size")).orderBy("part").collect()  # one number a part
    bases, base = {}, 0
    for r in parts:
        bases[r["part"]] = base
        base += r["size"]

    top = int(ids[-1]) + 1 if len(ids) else 1
    code_of, length_of = np.zeros(top, np.uint64), np.zeros(top, np.int64)
    code_of[ids], length_of[ids] = canonical(ids, lengths), lengths
    shared = spark.sparkContext.broadcast((code_of, length_of, bases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code_of, length_of, bases = shared.value
        for b in slices(batches, 1):
            x = np.frombuffer(b.column("ids")[0].as_py(), kind)
            payload, marks = pack(code_of[x], length_of[x])
            start = bases[b.column("part")[0].as_py()] + b.column("before")[0].as_py()
            yield pa.RecordBatch.from_arrays(
                [*b.select(["part", "segment"]).columns, pa.array([start], pa.int64()),
                 *b.select(["doc_ids", "lengths"]).columns, pa.array([payload], pa.binary()),
                 pa.array([marks.tolist()], pa.list_(pa.int64()))],
                names=["part", "segment", "start", "doc_ids", "lengths", "payload", "checkpoints"])

    segments.drop("seen", "times").mapInArrow(run, _CODED).write.mode("overwrite").option("compression", "uncompressed").parquet(f"{out}/segments")
    shared.unpersist()


def read(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document of a store, ids as
    little-endian unsigned 32-bit integers."""
    book = spark.read.parquet(f"{out}/codebook").toArrow()  # bounded by the vocabulary
    ids, lengths = book.column("id").to_numpy(), book.column("length").to_numpy()
    shared = spark.sparkContext.broadcast((ids, lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(*shared.value)
        for b in slices(batches, 1):
            r = b.to_pylist()[0]
            ends = np.cumsum(np.array(r["lengths"], np.int64))
            raw = table.unpack(r["payload"], np.array(r["checkpoints"]), int(ends[-1])).astype("<u4").tobytes()
            first = ends - np.array(r["lengths"])
            cut = [raw[4 * i:4 * j] for i, j in zip(first.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(r["doc_ids"], pa.int64()), pa.array(first + r["start"], pa.int64()),
                 pa.array(r["lengths"], pa.int64()), pa.array(cut, pa.binary())],
                names=["doc_id", "start", "n_tokens", "ids"])

    return spark.read.parquet(f"{out}/segments").select("start", "doc_ids", "lengths", "payload", "checkpoints").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")
