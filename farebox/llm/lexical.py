"""Operator 13: ranked lexical search with pair bounds in MaxScore.

``build`` writes an index of all documents to the shared folder.  A read task closes a shard
whenever it has seen ``SHARD_BYTES`` of text and gives a row for each term of the shard (its
documents and their counts) and one for the shard's documents (ids and lengths).  A shard is
therefore bounded whatever the files are like, and no text is shuffled.

``search`` takes the query set in blocks.  Its terms' weights come from the index by one
aggregate, then

1. for each shard the *pair lists* are computed and stored: for neighbouring terms of an item,
   heaviest first, the documents that hold both and the largest joint impact.  Documents of
   these lists are scored at once; the ``k``-th best of all shards is a floor no result
   lies below.
2. for each shard MaxScore runs over an item's terms, heaviest first.  What terms ``j`` and
   after can add is bounded by the best way to split them into single terms and listed pairs:
   a pair adds at most the larger of its two maxima and its joint impact, which is often
   much less than the two maxima together.  Documents that hold only terms whose bound lies
   below the floor are never opened, and the others are dropped as soon as what they have and
   the bound of what is left do not reach it.
3. the ``k`` best of the shards' best are ranked.

Scores are exact and whole numbers; bounds only skip documents that cannot be among the best.

Defined results: a null or empty text has no terms, is no result and counts in none of the
statistics; an item without terms has no rows; items that share an id (or have none) are one
item with all their terms; repeated documents are ranked each by itself, a null doc_id after
the others of its score; extra columns are not read; an empty table on either side gives an
empty result.  A very long text makes a shard of its own: memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farebox.llm.common import staged, text_or_empty
from farebox.llm.runs import byte_slices
from farebox.session import scratch_path

#: Characters outside terms: all of ASCII but digits and letters.
LETTERS = set(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
TABLE = np.array([c if c > 127 else 32 if c not in LETTERS else c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)

#: Text of a shard and of a step within it; items of a block.  They fix sizes, not results.
SHARD_BYTES, STEP_BYTES, BLOCK_ITEMS = 16 << 20, 4 << 20, 256

INDEX_DDL = ("shard string, term string, ids array<bigint>, docs binary, counts binary, "
             "n_docs bigint, n_filled bigint, n_terms bigint")

NAMES = ["shard", "term", "ids", "docs", "counts", "n_docs", "n_filled", "n_terms"]


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of all texts one after the other, with the text's number of each."""
    texts = pc.fill_null(texts, "")
    texts = pa.concat_arrays([texts])  # a buffer of these rows only
    _, offsets, data = texts.buffers()
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    clean = pa.Array.from_buffers(texts.type, len(texts), [None, offsets, pa.py_buffer(TABLE[raw].tobytes())], 0, texts.offset)
    parts = pc.ascii_split_whitespace(clean)
    flat, doc = parts.flatten(), pc.list_parent_indices(parts).to_numpy()
    real = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(real), doc[real.to_numpy(zero_copy_only=False)]


def _shard(name: str, ids: list[pa.Array], flat: list[pa.Array], doc: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of one shard: its documents' row, then one for each term."""
    doc_ids, number = pa.concat_arrays(ids), np.concatenate(doc)
    lens = np.bincount(number, minlength=len(doc_ids)).astype(np.int64)
    empty = pa.nulls
    yield pa.RecordBatch.from_arrays(
        [pa.array([name]), empty(1, pa.string()),
         pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids), pa.array([b""], pa.binary()),
         pa.array([lens.tobytes()], pa.binary()), pa.array([len(lens)], pa.int64()),
         pa.array([int((lens > 0).sum())], pa.int64()), pa.array([int(lens.sum())], pa.int64())], names=NAMES)
    coded = pa.concat_arrays(flat).dictionary_encode()
    vocabulary = coded.dictionary
    key = coded.indices.to_numpy().astype(np.int64) * max(len(doc_ids), 1) + number
    pairs, counts = np.unique(key, return_counts=True)
    term, docs = pairs // max(len(doc_ids), 1), (pairs % max(len(doc_ids), 1)).astype(np.int32)
    starts = np.searchsorted(term, np.arange(len(vocabulary) + 1))
    sizes, counts = np.diff(starts), counts.astype(np.int32)
    for lo in range(0, len(vocabulary), 20_000):
        hi = min(lo + 20_000, len(vocabulary))
        a, b = starts[lo], starts[hi]
        at = pa.array(((starts[lo:hi + 1] - a) * 4).astype(np.int32)).buffers()[1]
        binary = [pa.Array.from_buffers(pa.binary(), hi - lo, [None, at, pa.py_buffer(x[a:b].tobytes())]) for x in (docs, counts)]
        nothing = empty(hi - lo, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * (hi - lo)), vocabulary.slice(lo, hi - lo), empty(hi - lo, pa.list_(pa.int64())), *binary,
             pa.array(sizes[lo:hi], pa.int64()), nothing, nothing], names=NAMES)


def build(docs: DataFrame, path: str) -> None:
    """Write the index of ``docs`` (doc_id, text) to ``path``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, ids, flat, doc, rows = TaskContext.get().partitionId(), 0, 0, [], [], [], 0
        for b in byte_slices(batches, "text", STEP_BYTES):
            words, number = terms(b.column("text"))
            ids.append(b.column("doc_id").cast(pa.int64())), flat.append(words), doc.append(number + rows)
            rows, held = rows + b.num_rows, held + b.column("text").nbytes
            if held >= SHARD_BYTES:
                yield from _shard(f"{part}-{made}", ids, flat, doc)
                made, held, ids, flat, doc, rows = made + 1, 0, [], [], [], 0
        if rows:
            yield from _shard(f"{part}-{made}", ids, flat, doc)

    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty("text").alias("text"))
    read.mapInArrow(work, INDEX_DDL).write.mode("overwrite").option("compression", "zstd").parquet(path)


def open_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_DDL).parquet(path)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each once, by Spark expressions."""
    low = F.translate(text_or_empty("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(low, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))
    return items.select("item_id", F.explode(F.array_distinct(found)).alias("term")).distinct()


def impacts(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a unit of weight adds for each document of a list."""
    c = counts.astype(np.int64)
    return (1_000_000_000 * c) // (1000 * c + 20 * m)


def pair_bounds(most: np.ndarray, joint: np.ndarray) -> np.ndarray:
    """``R[j]``: the most that terms ``j`` and after can add to a document.

    ``most[j]`` is the largest impact of term ``j`` and ``joint[j]`` the largest joint impact
    of terms ``j`` and ``j + 1`` (0 where no document holds both, -1 where no list was
    stored).  The best split into singles and listed pairs is found from the end.
    """
    n = len(most)
    left = np.zeros(n + 2, np.int64)
    for j in range(n - 1, -1, -1):
        left[j] = most[j] + left[j + 1]
        if j + 1 < n and joint[j] >= 0:
            left[j] = min(left[j], max(most[j], most[j + 1], joint[j]) + left[j + 2])
    return left[:n + 1]


class Shard:
    """The terms of one block of items in one shard, from the shard's rows."""

    def __init__(self, rows: pa.Table, joint: dict, total_docs: int, total_terms: int):
        cols = {c: rows.column(c).to_pylist() for c in ("term", "weight", "items", "docs", "counts")}
        own = cols["term"].index(None)
        self.ids = rows.column("ids").combine_chunks().slice(own, 1).flatten()
        self.floors = {f["item_id"]: f["floor"] for f in rows.column("floors")[own].as_py() or []} if "floors" in rows.column_names else {}
        lens = np.frombuffer(cols["counts"][own], np.int64)
        m = 50 + 50 * lens * total_docs // max(total_terms, 1)
        self.n, self.docs, self.adds, self.weight, self.items, self.joint = len(lens), {}, {}, {}, {}, joint
        for term, weight, items, docs, counts in zip(*cols.values()):
            if term is None:
                continue
            docs = np.frombuffer(docs, np.int32)
            self.docs[term], self.weight[term] = docs, weight
            self.adds[term] = weight * impacts(np.frombuffer(counts, np.int32), m[docs])
            for item in items:
                self.items.setdefault(item, []).append(term)
        for found in self.items.values():
            found.sort(key=lambda t: (-self.weight[t], t))

    def add(self, score: np.ndarray, term: str, some: np.ndarray | None = None) -> None:
        """Add a term's impacts to all its documents, or to ``some`` (sorted) only."""
        docs, adds = self.docs[term], self.adds[term]
        if some is None or len(some) * 8 > len(docs):
            score[docs] += adds
        else:
            at = np.minimum(np.searchsorted(docs, some), len(docs) - 1)
            hit = docs[at] == some
            score[some[hit]] += adds[at[hit]]

    def best(self, score: np.ndarray, docs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k documents with the greatest scores above 0, ties by id (none last)."""
        value = score[docs]
        if len(docs) > k:
            floor = max(1, int(np.partition(value, len(value) - k)[len(value) - k]))
            docs, value = docs[value >= floor], value[value >= floor]
        else:
            docs, value = docs[value > 0], value[value > 0]
        ids = self.ids.take(pa.array(docs))
        none = ids.is_null().to_numpy(zero_copy_only=False)
        order = np.lexsort((pc.fill_null(ids, 0).to_numpy(), none, -value))[:k]
        return docs[order], value[order]

    def lists(self) -> Iterator[tuple[str, str, int, np.ndarray]]:
        """Neighbouring terms of every item, their largest joint impact and their documents."""
        second = {}
        for found in self.items.values():
            for a, b in zip(found, found[1:]):
                second.setdefault(a, set()).add(b)
        score = np.zeros(self.n, np.int64)
        held = np.zeros(self.n, bool)
        for a, others in second.items():
            score[self.docs[a]] = self.adds[a]
            held[self.docs[a]] = True
            for b in others:
                both = held[self.docs[b]]
                docs = self.docs[b][both]
                joint = int((score[docs] + self.adds[b][both]).max()) if len(docs) else 0
                yield a, b, joint, docs
            score[self.docs[a]] = 0
            held[self.docs[a]] = False

    def seeds(self, lists: dict, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each item the best of the documents of its heaviest pairs, scored whole."""
        for item, found in self.items.items():
            some = np.zeros(0, np.int32)
            for pair in zip(found, found[1:]):
                some = np.union1d(some, lists[pair])
                if len(some) >= k:
                    break
            score = np.zeros(self.n, np.int64)
            for t in found:
                self.add(score, t, some)
            yield item, *self.best(score, some, k)

    def search(self, found: list[str], k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The k best documents that score ``floor`` or more, and how many were opened."""
        most = np.array([self.adds[t].max() for t in found], np.int64)
        joint = np.array([self.joint.get(p, -1) for p in zip(found, found[1:])] + [-1], np.int64)
        bound, floor = pair_bounds(most, joint), max(floor, 1)
        score = np.zeros(self.n, np.int64)
        first = int(np.argmax(bound < floor))  # bound[len(found)] is 0
        seen = np.zeros(self.n, bool)
        for t in found[:first]:
            self.add(score, t)
            seen[self.docs[t]] = True
        some = np.flatnonzero(seen).astype(np.int32)
        opened = len(some)
        for j in range(first, len(found)):
            some = some[score[some] + bound[j] >= floor]
            if not len(some):
                break
            self.add(score, found[j], some)
        some = some[score[some] >= floor]
        return *self.best(score, some, k), opened


PAIRS_DDL = "shard string, block int, a string, b string, joint bigint, docs binary, item_id bigint, score bigint"
PAIRS = pa.schema([("shard", pa.string()), ("block", pa.int32()), ("a", pa.string()), ("b", pa.string()),
                   ("joint", pa.int64()), ("docs", pa.binary()), ("item_id", pa.int64()), ("score", pa.int64())])
FOUND_DDL = "item_id bigint, doc_id bigint, score bigint, opened bigint"
FOUND = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64()), ("opened", pa.int64())])


def _packed(docs: np.ndarray, n: int) -> bytes:
    """A list of documents as numbers or as bits, whichever is shorter."""
    if 4 * len(docs) <= (n + 7) // 8:
        return docs.astype(np.int32).tobytes()
    bits = np.zeros(n, bool)
    bits[docs] = True
    return np.packbits(bits).tobytes()


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    if not rows:
        return schema.empty_table()
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _block_terms(index: DataFrame, wanted: DataFrame, total_docs: int, block: Column) -> DataFrame:
    """(block, term) with the term's weight and the block's items that hold it, written."""
    lists = index.filter(F.col("term").isNotNull()).join(wanted.select("term").distinct(), "term", "left_semi")
    weight = F.floor(1000 * F.log((2.0 * total_docs + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weights = lists.groupBy("term").agg(F.sum("n_docs").alias("df")).select("term", weight.alias("weight"))
    # a null id does not survive collect_list by itself
    ids = F.transform(F.collect_list(F.struct("item_id")), lambda x: x["item_id"])
    return staged(wanted.withColumn("block", block).groupBy("block", "term").agg(ids.alias("items")).join(weights, "term"),
                  "lexical-terms")


def pair_lists(rows: DataFrame, k: int, total_docs: int, total_terms: int) -> DataFrame:
    """The stored pair lists (a, b, joint impact, documents) of every shard and block, and
    the ``k`` best scores of every item among the documents of its heaviest lists."""

    def work(key: tuple, table: pa.Table) -> pa.Table:
        shard = Shard(table, {}, total_docs, total_terms)
        name, block = key[0].as_py(), key[1].as_py()
        lists, out = {}, []
        for a, b, joint, docs in shard.lists():
            lists[a, b] = docs
            out.append((name, block, a, b, joint, _packed(docs, shard.n), None, None))
        for item, _, value in shard.seeds(lists, k):
            out += [(name, block, None, None, None, None, item, int(v)) for v in value]
        return _arrow(out, PAIRS)

    return staged(rows.groupBy("shard", "block").applyInArrow(work, PAIRS_DDL), "lexical-pairs")


def search(index: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents of every item of (item_id, text): item_id, rank, doc_id,
    score and ``opened``, the documents that MaxScore had to open for the item in the shard
    of the row's document."""
    wanted = item_terms(items.select(F.col("item_id").cast("bigint").alias("item_id"), "text"))
    whole = index.filter(F.col("term").isNull())
    totals = whole.agg(F.coalesce(F.sum("n_filled"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    total_docs, total_terms = int(totals[0]), int(totals[1])
    blocks = 1 + items.count() // BLOCK_ITEMS
    block = F.pmod(F.coalesce(F.xxhash64("item_id"), F.lit(0)), F.lit(blocks)).cast("int")

    by_block = _block_terms(index, wanted, total_docs, block)
    postings = index.filter(F.col("term").isNotNull()).join(by_block, "term")
    own = whole.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).drop("term").select(
        "*", F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("weight"),
        F.array().cast("array<bigint>").alias("items"))
    cols = ["shard", "block", "term", "weight", "items", "ids", "docs", "counts"]
    rows = postings.select(*cols).unionByName(own.select(*cols))

    stored = pair_lists(rows, k, total_docs, total_terms)
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score")))
    floors = (stored.filter(F.col("score").isNotNull()).select("item_id", "score", place.alias("place")).filter(F.col("place") <= k)
              .groupBy("item_id").agg(F.count("*").alias("n"), F.min("score").alias("floor")).filter(F.col("n") == k)
              .groupBy(block.alias("block")).agg(F.collect_list(F.struct("item_id", "floor")).alias("floors")))
    # the floors travel on the row of the shard's documents
    rows = (postings.select(*cols, F.lit(None).cast(floors.schema["floors"].dataType).alias("floors"))
            .unionByName(own.select(*cols).join(floors, "block", "left")))

    def work(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        a, b, joint = (right.column(c).to_pylist() for c in ("a", "b", "joint"))
        shard = Shard(left, dict(zip(zip(a, b), joint)), total_docs, total_terms)
        out = []
        for item, found in shard.items.items():
            docs, value, opened = shard.search(found, k, shard.floors.get(item, 1))
            ids = shard.ids.take(pa.array(docs)).to_pylist()
            out += [(item, i, int(v), opened) for i, v in zip(ids, value)]
        return _arrow(out, FOUND)

    pairs = stored.filter(F.col("a").isNotNull()).select("shard", "block", "a", "b", "joint")
    best = (rows.groupBy("shard", "block").cogroup(pairs.groupBy("shard", "block")).applyInArrow(work, FOUND_DDL))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score", "opened"))


def ranked(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Index ``docs`` in the shared folder and search it for ``items``."""
    path = scratch_path(docs.sparkSession, "llm-lexical-index")
    build(docs, path)
    return search(open_index(docs.sparkSession, path), items, k)
