"""Operator 8: substring dedup with automata of repeated phrases.

A window is ``WINDOW`` consecutive words.  A word goes if a window that covers it also
starts in a document with a smaller id.

1. Every window has an anchor: the five words inside it with the least hash.  Equal
   windows have equal anchors, so a window can only recur where its anchor does.  A
   segment is a run of windows with the same anchor.  A document sends the anchors and ids of
   its distinct segments, a fifth of its words; what holds an anchor that two documents share
   comes back to it, with the segments it is the first document of.
2. Documents give the places of those segments, and the first document of a segment its
   text: a passage that a third of all documents hold is told once.
3. Shards of distinct segments, dealt by anchor, confirm the recurring phrases: a
   segment that is alone with its anchor is one phrase, of others each window that two
   documents share.  Each shard compiles them into Aho-Corasick automata (of at most
   about ``PHRASES`` segments) and streams its segments through them, which locates every
   occurrence, with the first document that holds it.
4. The occurrences go back to the documents by anchor and segment id (128 bits together),
   as spans of words.

Words are compared as they are; the automata run over words, numbered one by one as they
are met in a shard, hashes only bring together what may be equal.

Defined cases: null and empty texts have no words; documents under 13 words keep all;
rows that repeat an id don't remove each other's words; rows with a null id neither
remove nor lose words; an empty table gives an empty result; other columns are not needed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import slices, staged, text_or_empty

WINDOW, ANCHOR = 13, 5
PHRASES, SHARD_SEGMENTS, AUTOMATON = 4_000, 16_000, 40_000

#: Bytes of words hashed at once, and of texts joined for it (a longer text stands
#: alone); fixes memory, not results.
HASHED_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: A 64-bit number for each byte.
_OF_BYTE = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
_OF_BYTE ^= _OF_BYTE >> np.uint64(32)
_OF_BYTE *= np.uint64(0xA0761D6478BD642F)

_SPAN = "struct<s:int,e:int,first:long>"


#: Odd, so that its powers have inverses modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Powers:
    """Powers of a number modulo 2^64, made as far as they are needed."""

    def __init__(self, base: int):
        self.base, self.of = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.of) < n:
            step = self.of[-1:] * self.base
            self.of = np.concatenate([self.of, self.of * step])
        return self.of[:n]


POWERS, INVERSES = Powers(_BASE), Powers(_INVERSE)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, first byte and end byte of every word of a text: a polynomial of the
    word's bytes, the same wherever it stands, from one running sum for many words."""
    b = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(b) + 2, np.int8)
    inside[1:-1] = ~_IS_SPACE[b]
    edges = np.flatnonzero(np.diff(inside))
    start, end = edges[::2], edges[1::2]
    size = end - start
    h, at = np.empty(len(start), np.uint64), 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + HASHED_BYTES, side="right")))
        lo, hi = start[at], end[to - 1]
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_OF_BYTE[b[lo:hi]] * POWERS.upto(hi - lo), out=total[1:])
        h[at:to] = (total[end[at:to] - lo] - total[start[at:to] - lo]) * INVERSES.upto(hi - lo)[start[at:to] - lo]
        at = to
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) + size.astype(np.uint64)
    return h ^ (h >> np.uint64(32)), start, end


def joined(texts: pa.Array) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Texts one after another, a space behind each, some ``HASHED_BYTES`` at a time: the first
    text's number, the end text's, the bytes, and the byte each text starts at with the end."""
    raws = [(t or "").encode() for t in texts.to_pylist()]
    ends = np.cumsum([len(r) + 1 for r in raws], dtype=np.int64)
    at, before = 0, 0
    while at < len(raws):
        to = max(at + 1, int(np.searchsorted(ends, before + HASHED_BYTES, side="right")))
        yield at, to, b" ".join([*raws[at:to], b""]), np.r_[before, ends[at:to]] - before
        at, before = to, int(ends[to - 1])


def segments(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first word, end word, id and text of each run of windows with one anchor,
    from the hashes of the words of texts, one text after another with ``n`` words each.

    The id is a polynomial of the words' hashes, the same wherever the words stand; it
    comes from one running sum, so no segment's text is put together for it.
    """
    windows = np.maximum(n - WINDOW + 1, 0)
    if not windows.any():
        none = np.empty(0, np.int64)
        return none, none, none, none, none
    g = np.zeros(len(h) - ANCHOR + 1, np.uint64)
    for k in range(ANCHOR):
        g = (g ^ h[k:len(g) + k]) * np.uint64(0x9E3779B97F4A7C15)
        g ^= g >> np.uint64(31)
    # the least of each window of g, the leftmost of equal ones
    wide = len(h) - WINDOW + 1
    least, at = g[:wide].copy(), np.arange(wide)
    for k in range(1, WINDOW - ANCHOR + 1):
        less = np.flatnonzero(g[k:wide + k] < least)
        least[less], at[less] = g[less + k], less + k
    # windows inside a text; texts share no word, so their anchors stand at different words
    text = np.repeat(np.arange(len(n)), windows)
    window = np.arange(len(text)) + np.repeat((np.cumsum(n) - n) - (np.cumsum(windows) - windows), windows)
    at = at[window]
    run = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    first, end = window[run], window[np.r_[run[1:], len(at)] - 1] + WINDOW
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * POWERS.upto(len(h)))])
    sid = (total[end] - total[first]) * INVERSES.upto(len(h))[first] + (end - first).astype(np.uint64)
    sid = (sid ^ (sid >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    sid ^= sid >> np.uint64(32)
    return g[at[run]].view(np.int64), first, end, sid.view(np.int64), text[run]


def _mixed(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """One number for a row and a value of it; what is equal in both stays equal."""
    return value.view(np.uint64) ^ ((row.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


def _variant() -> Column:
    """Tells texts of one id apart: 16 bits of a hash."""
    return F.xxhash64(text_or_empty()).bitwiseAND(F.lit(0xFFFF)).alias("variant")


def anchors(docs: DataFrame) -> DataFrame:
    """(anchor, sid, doc_id): the distinct segments of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 500):
            ids = b.column(0).to_numpy()
            for at, _, raw, bounds in joined(b.column(1)):
                h, start, _ = word_hashes(raw)
                a, _, _, s, k = segments(h, np.diff(np.searchsorted(start, bounds)))
                order = np.lexsort((s, a, k))
                a, s, k = a[order], s[order], k[order]
                new = np.ones(len(a), bool)
                new[1:] = (k[1:] != k[:-1]) | (a[1:] != a[:-1]) | (s[1:] != s[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(s[new]), pa.array(ids[at + k[new]])],
                                                 names=["anchor", "sid", "doc_id"])

    return docs.select("doc_id", "text").mapInArrow(run, "anchor long, sid long, doc_id long")


def recurring_segments(docs: DataFrame) -> DataFrame:
    """(anchor, sid, doc_id, place, text, last) from (doc_id, text, variant, shared,
    firsts): the segments of shared anchors; text and the last document only where
    the document is the first that holds the segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 200):
            ids, variant = b.column(0).to_numpy(), b.column(2).to_numpy()
            shared, firsts = b.column(3), b.column(4)
            recur, of_doc = shared.values.to_numpy(), shared.offsets.to_numpy()
            first_sid, first_last = (firsts.values.field(k).to_numpy() for k in ("sid", "last"))
            of_first = firsts.offsets.to_numpy()
            for at, to, raw, bounds in joined(b.column(1)):
                h, begin, stop = word_hashes(raw)
                words_before = np.searchsorted(begin, bounds)
                a, first, end, s, k = segments(h, np.diff(words_before))
                some = np.repeat(np.arange(to - at), np.diff(of_doc[at:to + 1]))
                # a pair taken for another is a row too many, which no phrase joins
                hit = np.isin(_mixed(k, a), _mixed(some, recur[of_doc[at]:of_doc[to]]))
                a, first, end, s, k = a[hit], first[hit], end[hit], s[hit], k[hit]
                lo, hi = of_first[at], of_first[to]
                some = np.repeat(np.arange(to - at), np.diff(of_first[at:to + 1]))
                told = dict(zip(zip(some.tolist(), first_sid[lo:hi].tolist()), first_last[lo:hi].tolist()))
                texts, lasts = [None] * len(s), [None] * len(s)
                for i in np.flatnonzero(np.isin(_mixed(k, s), _mixed(some, first_sid[lo:hi]))).tolist():
                    last = told.pop((int(k[i]), int(s[i])), None)
                    if last is not None:
                        texts[i], lasts[i] = b" ".join(raw[begin[first[i]]:stop[end[i] - 1]].split()).decode(), last
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(s), pa.array(ids[at + k]), pa.array(variant[at + k] << 40 | first - words_before[k]),
                     pa.array(texts, pa.string()), pa.array(lasts, pa.int64())],
                    names=["anchor", "sid", "doc_id", "place", "text", "last"])

    return docs.select("doc_id", "text", "variant", "shared", "firsts").mapInArrow(
        run, "anchor long, sid long, doc_id long, place long, text string, last long")


def _windows(words: Sequence) -> list[Sequence]:
    return [words[i:i + WINDOW] for i in range(len(words) - WINDOW + 1)]


class _Numbers(dict):
    """Word -> number; equal words, and only they, have one number."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n

    def of(self, text: str) -> tuple[int, ...]:
        return tuple(map(self.__getitem__, text.split(" ")))


def _located(group: list[str], phrases: dict[str, int], most: int) -> list[list[tuple[int, int, int]]]:
    """The same as ``_located_numbers`` of texts."""
    number = _Numbers()
    return _located_numbers([number.of(t) for t in group], {number.of(p): first for p, first in phrases.items()}, most)


def _located_numbers(group: list[tuple[int, ...]], phrases: dict[tuple[int, ...], int],
                     most: int) -> list[list[tuple[int, int, int]]]:
    """For each segment the spans of words (start, end, first document) that automata
    of at most ``most`` of the ``phrases`` (phrase -> first document) locate in it."""
    import ahocorasick

    out: list[list[tuple[int, int, int]]] = [[] for _ in group]
    todo = list(phrases.items())
    for k in range(0, len(todo), most):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, first in todo[k:k + most]:
            automaton.add_word(key, (len(key), first))
        automaton.make_automaton()
        for words, spans in zip(group, out):
            for last, (size, first) in automaton.iter(words):
                e = last + 1
                if spans and spans[-1][2] == first and spans[-1][0] <= e - size <= spans[-1][1] <= e:
                    spans[-1] = (spans[-1][0], e, first)
                else:
                    spans.append((e - size, e, first))
    return out


_FOUND = f"anchor long, sid long, spans array<{_SPAN}>"


def _found(keys: list[tuple[int, int]], found: list[list[tuple[int, int, int]]]) -> pa.Table:
    rows = [(k, s) for k, s in zip(keys, found) if s]
    spans = [x for _, s in rows for x in s]
    start, end, first = (pa.array([x[i] for x in spans], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64())))
    offsets = np.cumsum([0, *(len(s) for _, s in rows)])
    return pa.table({
        "anchor": pa.array([k[0] for k, _ in rows], pa.int64()), "sid": pa.array([k[1] for k, _ in rows], pa.int64()),
        "spans": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                          pa.StructArray.from_arrays([start, end, first], ["s", "e", "first"]))})


def located(distinct: DataFrame, shards: int) -> DataFrame:
    """(anchor, sid, spans) of the distinct segments that hold a recurring phrase."""
    phrases_at_once, most = PHRASES, AUTOMATON

    def run(t: pa.Table) -> pa.Table:
        by_anchor = defaultdict(list)
        number = _Numbers()  # each text is numbered once, for phrases and for what they are sought in
        for anchor, sid, text, first, last in zip(*(t.column(c).to_pylist() for c in ("anchor", "sid", "text", "first", "last"))):
            by_anchor[anchor].append((sid, number.of(text), first, last))
        keys, found = [], []
        group: list[tuple[int, ...]] = []
        phrases: dict[tuple[int, ...], int] = {}

        def done() -> None:
            found.extend(_located_numbers(group, phrases, most))
            group.clear()
            phrases.clear()

        for anchor, same in by_anchor.items():
            if len(same) == 1:
                _, words, first, last = same[0]
                if first < last:
                    phrases[words] = first
            else:
                phrases.update((w, lo) for w, (lo, hi) in _ranges(x[1:] for x in same).items() if lo < hi)
            for sid, words, _, _ in same:
                keys.append((anchor, sid))
                group.append(words)
            if len(group) >= phrases_at_once:
                done()
        done()
        return _found(keys, found)

    sizes = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > phrases_at_once)
    hot = staged(sizes, "phrases-hot")
    if hot.isEmpty():
        cold = distinct
    else:
        cold = distinct.join(hot, "anchor", "left_anti")
    out = (cold.withColumn("shard", F.pmod("anchor", F.lit(shards))).groupBy("shard").applyInArrow(run, _FOUND))
    return out if cold is distinct else out.unionByName(located_of_hot(distinct, hot))


def _ranges(segments: Iterable[tuple[tuple, int, int]]) -> dict[tuple, tuple[int, int]]:
    """The first and last document of each window of (words, first, last)."""
    range_of: dict[tuple, tuple[int, int]] = {}
    for words, first, last in segments:
        for w in _windows(words):
            lo, hi = range_of.get(w, (first, last))
            range_of[w] = (min(lo, first), max(hi, last))
    return range_of


def located_of_hot(distinct: DataFrame, hot: DataFrame) -> DataFrame:
    """The same for the segments of ``hot`` anchors (anchor, size), each dealt to as many
    shards as it needs; what a task holds is bounded whatever the anchor's size."""
    most = AUTOMATON
    salts = F.ceil(F.col("size") / PHRASES).cast("int")
    rows = staged(distinct.join(hot, "anchor").withColumn("salt", F.pmod(F.xxhash64("sid"), salts).cast("int"))
                  .drop("size"), "phrases-hot-segments")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2_000):
            dealt = defaultdict(list)
            for anchor, salt, text, *segment in zip(*(c.to_pylist() for c in b.columns)):
                dealt[anchor, salt].append((tuple(text.split(" ")), *segment))
            out = [(*key, " ".join(w), lo, hi) for key, same in dealt.items() for w, (lo, hi) in _ranges(same).items()]
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 5, kinds)],
                                             names=["anchor", "salt", "phrase", "lo", "hi"])

    # once by shard, so a window that every segment holds is a row a shard, then over the shards
    of_shard = (rows.select("anchor", "salt", "text", "first", "last")
                .mapInArrow(windows, "anchor long, salt int, phrase string, lo long, hi long")
                .groupBy("anchor", "salt", "phrase").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    confirmed = (of_shard.groupBy("anchor", "phrase")
                 .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.collect_list("salt").alias("salts"))
                 .filter("lo < hi").select("anchor", F.explode("salts").alias("salt"), "phrase", "lo"))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        phrases = dict(zip(b.column("phrase").to_pylist(), b.column("lo").to_pylist()))
        keys = list(zip(a.column("anchor").to_pylist(), a.column("sid").to_pylist()))
        return _found(keys, _located(a.column("text").to_pylist(), phrases, most))

    return (rows.groupBy("anchor", "salt").cogroup(confirmed.groupBy("anchor", "salt")).applyInArrow(run, _FOUND))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, variant, spans): the word spans of each document that windows also
    starting in a smaller doc_id cover."""
    known = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # kept by anchor while three steps read it; what a lost executor held is computed again
    sent = anchors(known).repartition(n, "anchor").persist(StorageLevel.MEMORY_AND_DISK)
    shared = sent.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    shared = shared.select(F.col("anchor").alias("recurs")).hint("shuffle_hash")
    back = sent.join(shared, F.col("anchor") == F.col("recurs")).drop("recurs")
    each = back.groupBy("anchor", "sid").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last"))
    told = (back.select("doc_id", "anchor", F.lit(None).cast("struct<sid:long,last:long>").alias("first"))
            .unionByName(each.select("doc_id", F.lit(None).cast("long").alias("anchor"), F.struct("sid", "last").alias("first"))))
    of_doc = staged(told.groupBy("doc_id").agg(F.collect_set("anchor").alias("shared"), F.collect_list("first").alias("firsts")),
                    "phrases-shared")
    sent.unpersist()
    rows = staged(recurring_segments(known.withColumn("variant", _variant()).join(of_doc, "doc_id")), "phrases-segments")
    distinct = rows.filter("text is not null").select("anchor", "sid", "text", F.col("doc_id").alias("first"), "last")
    shards = max(1, -(-distinct.count() // SHARD_SEGMENTS))
    found = located(distinct, shards)
    start = F.col("place").bitwiseAND(F.lit((1 << 40) - 1)).cast("int")
    return (rows.select("anchor", "sid", "doc_id", "place").join(found, ["anchor", "sid"])
            .select("doc_id", F.shiftright("place", 40).alias("variant"), start.alias("at"),
                    F.explode(F.filter("spans", lambda s: s["first"] < F.col("doc_id"))).alias("x"))
            .groupBy("doc_id", "variant")
            .agg(F.collect_set(F.struct((F.col("at") + F.col("x.s")).alias("s"), (F.col("at") + F.col("x.e")).alias("e")))
                 .alias("spans")))


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` are the words that stay, joined by
    one space."""
    spans = staged(repeated_spans(docs), "phrases-spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 500):
            n_words, n_removed, kept = [], [], []
            spans_of, found = b.column(2).offsets.to_numpy(), b.column(2).is_valid().to_pylist()
            s, e = (b.column(2).values.field(k).to_numpy() for k in ("s", "e"))
            for k, text in enumerate(b.column(1).to_pylist()):
                words = (text or "").encode().split()
                n_words.append(len(words))
                if found[k]:
                    x = slice(spans_of[k], spans_of[k + 1])
                    covered = np.bincount(s[x], minlength=len(words) + 1) - np.bincount(e[x], minlength=len(words) + 1)
                    words = list(compress(words, (np.cumsum(covered) == 0).tolist()))
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _variant())
    return whole.join(spans, ["doc_id", "variant"], "left").select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string")
