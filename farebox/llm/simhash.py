"""Operator 4: near-duplicates by SimHash, linked by meet-in-the-middle ball hashing.

A fingerprint has a bit for each of 64 places, set where over half the hashes of
the text's shingles have it.  Two fingerprints link at ``RADIUS`` = 3 or fewer
differing bits.

The radius is odd, so first one of ``BLOCKS`` blocks of 16 bits is left out in
turn: a pair at distance 1 to 3 differs inside some block, and without that block
it is at distance 2 or less.  Every distinct fingerprint then emits, for each block,
all variants within half of that remaining radius (itself and its 48 neighbours),
shuffles on the variant, and whatever collides is deduplicated and verified by
the distance of the whole fingerprints.  Equal fingerprints are one vertex from
the start, so groups of exact copies of any size cost one row.

A variant is shared by more than two fingerprints only inside a dense group.  Those
that also share the left-out block are at distance 2 or less and are linked through the
smallest of them.  Members that these links have not connected meet once more by flips inside
the block (see ``across``), so a dense group is never expanded into its pairs.

Defined cases: a null or empty text has no words and fingerprint zero, linked like
any other; repeated rows give equal rows; an empty table gives an empty result;
other columns are not needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import text_or_empty, slices, staged
from farebox.llm.components import components

RADIUS, SHINGLE, BLOCKS, BITS = 3, 3, 4, 64

#: Seed of the shingles' XXH64, fixed by contract.
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text, unsigned."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(flat, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    parts = zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
    h = np.array([xxh64_intdigest(flat[i:j], SEED) for i, j in parts], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, mark, fp): the fingerprint of every text as a signed 64-bit integer; the
    mark is a hash of the text, which tells texts of one id apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(2), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "mark", "fp"])

    return docs.select("doc_id", "text", _mark()).mapInArrow(run, "doc_id long, mark long, fp long")


def _mark() -> Column:
    return F.xxhash64(text_or_empty()).alias("mark")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def variants(fps: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(key, fp, block): for each block left out, the fingerprint itself and its
    neighbours at distance 1.  The block's place in the key holds its number."""
    width = BITS // blocks
    rows = []
    for k in range(blocks):
        block = ((1 << width) - 1) << (k * width)
        flips = [0] + [1 << p for p in range(BITS) if not block >> p & 1]
        rows += [F.struct(F.lit(_signed(~block & (1 << 64) - 1)).alias("kept"), F.lit(_signed(block)).alias("block"),
                          F.lit(_signed(flip | (k + 1) << (k * width))).alias("flip")) for flip in flips]
    return (fps.select("fp", F.explode(F.array(*rows)).alias("v"))
            .select(F.col("fp").bitwiseAND(F.col("v.kept")).bitwiseXOR(F.col("v.flip")).alias("key"),
                    "fp", F.col("v.block").alias("block")))


def _near(a: str, b: str, radius: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius


def links(fps: DataFrame, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """Links between distinct fingerprints at distance 1 to ``radius``, and the
    members of dense variants: (a, b) and (key, block, fp).

    The links are those of variants shared by two fingerprints, and in dense ones
    those to the smallest that shares the left-out block, which is at distance 2 or less.
    """
    if radius != RADIUS:
        raise ValueError("blocks and variants are laid out for a radius of 3")
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # one shuffle serves the counts and the members: all that read it use the same columns and filters
    met = variants(fps).filter("key is not null and block is not null and fp is not null").repartition(n, "key")
    counts = met.groupBy("key", "block").agg(F.min("fp").alias("a"), F.max("fp").alias("b"), F.count(F.lit(1)).alias("n"))
    two = counts.filter((F.col("n") == 2) & _near("a", "b", radius)).select(
        F.lit(None).cast("long").alias("key"), F.lit(None).cast("long").alias("block"), "a", "b")
    many = counts.filter("n > 2").select(F.col("key").alias("k"), F.col("block").alias("l"), "a").hint("shuffle_hash")
    # an inner join on the shuffle's own key: one that asks for more would shuffle again
    same = (F.col("block").bitwiseXOR(F.col("l")) == 0) & (F.col("fp") >= F.col("a"))
    dense = met.join(many, (F.col("key") == F.col("k")) & same)
    dense = dense.select("key", "block", F.col("fp").alias("a"), F.lit(None).cast("long").alias("b"))
    both = staged(two.unionByName(dense), "simhash-met")
    dense = both.filter("b is null").select("key", "block", F.col("a").alias("fp"), _inside("a"))
    least = F.min("fp").over(Window.partitionBy("key", "inside"))  # at most 49 members each
    star = dense.select("fp", least.alias("a")).filter("a != fp").select("a", F.col("fp").alias("b"))
    return both.filter("b is not null").select("a", "b").unionByName(star).distinct(), dense


def _inside(fp: str) -> Column:
    return F.col(fp).bitwiseAND(F.col("block")).alias("inside")


def across(dense: DataFrame, joined: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links between members of a dense variant that ``joined`` (id,
    component) has not connected yet.

    Of a pair's differing bits, either exactly one lies in some block, or all three
    lie in one block.  So a member meets those whose block value differs by one bit;
    and members that are equal outside the block meet by one flip on one side and two
    flips on the other.
    """
    known = joined.withColumnRenamed("id", "fp")
    named = dense.join(known, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    open_ = (named.groupBy("key", "block").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .filter("lo != hi").select("key", "block"))
    members = staged(named.join(open_, ["key", "block"], "left_semi"), "simhash-open")
    # those with the same variant and block value are linked already: one of them will do
    left = members.groupBy("key", "block", "inside", "component").agg(F.min("fp").alias("fp"))
    base = members.filter((F.col("fp").bitwiseXOR(F.col("key"))).bitwiseAND(F.bitwise_not("block")) == 0)
    width = BITS // BLOCKS

    def flips(n: int) -> Column:
        out = []
        for k in range(BLOCKS):
            bits = [1 << (k * width + p) for p in range(width)]
            masks = bits if n == 1 else [x | y for i, x in enumerate(bits) for y in bits[:i]]
            block = _signed(((1 << width) - 1) << (k * width))
            out.append(F.when(F.col("block") == block, F.array(*[F.lit(_signed(m)) for m in masks])))
        return F.explode(F.coalesce(*out)).alias("mask")

    def flipped(rows: DataFrame, n: int) -> DataFrame:
        return rows.select("key", F.col("fp").alias("b"), F.col("component").alias("other"), "inside", flips(n)).select(
            "key", "b", "other", F.col("inside").bitwiseXOR(F.col("mask")).alias("inside"))

    one = left.join(flipped(left, 1), ["key", "inside"])
    three = flipped(base, 1).select("key", "inside", F.col("b").alias("fp"), F.col("other").alias("component")).join(
        flipped(base, 2), ["key", "inside"])
    pairs = [x.filter("component != other").select(F.col("fp").alias("a"), "b") for x in (one, three)]
    return pairs[0].unionByName(pairs[1]).filter(_near("a", "b", radius)).distinct()


def connected(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(id, component) of the fingerprints that link with others."""
    near, dense = links(fps, radius)
    near = staged(near, "simhash-links")
    joined = components(near)
    more = staged(across(dense, joined, radius), "simhash-across")
    if more.isEmpty():
        return joined
    # links between components: the same again over both kinds
    return components(near.unionByName(more))


def grouped(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, mark, fp, best): ``best`` is the component's first text, as a struct of its
    doc_id, mark and fp: smallest id, then mark; a text without an id comes last."""
    prints = staged(fingerprints(docs, shingle), "simhash-prints")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "fp")
    first = staged(prints.groupBy("fp").agg(F.min(order).alias("first")).repartition(n, "fp"), "simhash-first")
    joined = connected(first.select("fp"), radius)
    vertex = (first.join(joined.withColumnRenamed("id", "fp"), "fp", "left")
              .select("fp", "first", F.coalesce("component", "fp").alias("component")))
    smallest = vertex.groupBy("component").agg(F.min("first").alias("best"))
    of = vertex.join(smallest, "component").select("fp", "best")
    return prints.join(of, "fp").select("doc_id", "mark", "fp", "best")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable."""
    return grouped(docs, shingle, radius).select("doc_id", "fp", F.col("best.doc_id").alias("component_id"))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one text of each component: the first by doc_id.

    An id that occurs with several texts is decided text by text, so that a text without a
    near copy stays whatever else its id holds.  Rows that repeat the id and the text of the
    one that stays can't be told from it and stay; so do rows without an id."""
    out = grouped(docs, shingle, radius)
    same = (F.col("doc_id") == F.col("best.doc_id")) & (F.col("mark") == F.col("best.mark"))
    dropped = out.filter(F.col("doc_id").isNotNull() & ~F.coalesce(same, F.lit(False))).select("doc_id", "mark").distinct()
    dropped = dropped.select(F.col("doc_id").alias("_dropped"), F.col("mark").alias("_dropped_mark"))
    gone = (docs["doc_id"] == dropped["_dropped"]) & (F.xxhash64(text_or_empty(docs["text"])) == dropped["_dropped_mark"])
    return docs.join(dropped, gone, "left_anti").select(*docs.columns)
