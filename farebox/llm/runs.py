"""Operator 12: periodic runs of words by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are
identical) and a length of at least ``max(6, 4 * q)`` that no neighbouring word extends.

Words are numbered within their document.  For each power of two ``2^k`` every factor
(stretch of ``2^k`` words) gets a name, made from the names of its two halves; factors that
occur once in their document are left out, for no longer factor that recurs holds them.
Occurrences of a factor within a window of twice its length (starts at most ``2^k`` apart)
form arithmetic progressions whose difference is the factor's period, so the distance ``p``
from an occurrence to its successor proposes ``p``.  A run of period ``q`` and length
``4 * q`` holds such a pair at each of its first ``q`` words on the level with
``2^(k-1) < q <= 2^k``; there a nearer successor would make the period smaller.  Neighbouring
occurrences with the same distance are one stretch, which is extended word by word where it
can be, and stretches with the same place and period count once.

Documents are independent: Spark deals them, a task works on slices of some megabytes of
text, many documents at a time, in numpy.  A longer text is one slice; memory follows it.

Defined results: a null or empty text has no words, no runs and an empty collapsed text; a
null id is kept as it is; repeated rows each get their result; an empty table gives an empty
table; columns other than those asked for are neither read nor returned, so their names
can't clash; very long texts are taken whole (``n log n`` steps for ``n`` words).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import text_or_empty, words

#: A run has at least this many words and this many periods.
MIN_WORDS, MIN_PERIODS = 6, 4

#: Bytes of text worked on at once; fixes memory, not results.
SLICE_BYTES = 2 << 20

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS_DDL = "array<struct<start: bigint, length: bigint, period: bigint>>"


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds about ``most`` bytes, or one row."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes), 0
        while at < b.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield b.slice(at, to - at)
            at = to


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts one after the other, and where each text's words start
    (with the end of the last)."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, offsets = parts.flatten(), parts.offsets.to_numpy() - parts.offsets[0].as_py()
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return flat.filter(real), before[offsets]


def find_runs(names: np.ndarray, doc: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period.

    ``names`` are words as numbers, ``doc`` the number of the text each belongs to (not
    falling) and ``longest`` the most words of a text.  Places count over all texts.
    """
    n = len(names)
    # the text is part of a word's name, so that no factor recurs outside its own text
    key = doc.astype(np.int64) * (int(names.max()) + 1 if n else 1) + names
    same = key.copy()
    at = np.arange(n, dtype=np.int64)
    starts, lengths, periods = [], [], []
    size = 1
    while len(at) and size < longest:
        order = np.argsort(key, kind="stable")
        place, value = at[order], key[order]
        new = np.concatenate([[True], value[1:] != value[:-1]])
        last = np.concatenate([new[1:], [True]])
        gap = np.where(last, 0, np.concatenate([place[1:], [0]]) - place)
        # distances of half a factor or less were found one level below
        near = (gap > size // 2) & (gap <= size)
        if near.any():
            i, p = place[near], gap[near]
            by = np.argsort(i)
            i, p = i[by], p[by]
            first = np.concatenate([[True], (i[1:] != i[:-1] + 1) | (p[1:] != p[:-1])])
            begin = np.flatnonzero(first)
            end = np.concatenate([begin[1:], [len(i)]]) - 1
            a, q, b = i[begin], p[begin], i[end] + size + p[begin]
            enough = b - a >= np.maximum(MIN_WORDS, MIN_PERIODS * q)
            a, b, q = a[enough], b[enough], q[enough]
            a, b = _extended(same, a, b, q)
            starts.append(a), lengths.append(b - a), periods.append(q)
        # a run of a longer period needs MIN_PERIODS of them in one text
        if size * MIN_PERIODS >= longest:
            break
        recurs = ~(new & last)
        place, name = place[recurs], np.cumsum(new)[recurs]
        named = np.full(n + size, -1, np.int64)
        named[place] = name
        place = np.sort(place)
        right = named[place + size]
        place, right = place[right >= 0], right[right >= 0]
        key, at = named[place] * (n + 1) + right, place
        size *= 2
    if not starts:
        return (np.zeros(0, np.int64),) * 3
    found = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods), np.concatenate(lengths)], 1), axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def _extended(same: np.ndarray, a: np.ndarray, b: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches [a, b) of period q, widened while the next word keeps the period."""
    a, b, n = a.copy(), b.copy(), len(same)
    while True:
        left = (a > 0) & (same[a - 1] == same[a - 1 + q])
        right = (b < n) & (same[np.minimum(b, n - 1)] == same[b - q])
        if not (left.any() or right.any()):
            return a, b
        a, b = a - left, b + right


def collapsed_runs(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with n_words, ``runs`` (by start, then period, places counted
    from 0) and ``collapsed``: the text without the words that lie in a run behind its first
    period, joined by one space."""
    out = docs.select(*keep, text_or_empty(text).alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields[:-1]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, "_text", SLICE_BYTES):
            flat, bounds = split_words(b.column("_text"))
            counts = np.diff(bounds)
            doc = np.repeat(np.arange(len(counts)), counts)
            names = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
            start, length, period = find_runs(names, doc, int(counts.max(initial=0)))
            mark = np.zeros(len(flat) + 1, np.int64)
            np.add.at(mark, start + period, 1)
            np.add.at(mark, start + length, -1)
            stays = np.cumsum(mark[:-1]) == 0
            kept = np.concatenate([[0], np.cumsum(stays)])[bounds]
            own = doc[start] if len(start) else start
            places = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(counts)))])
            runs = pa.ListArray.from_arrays(
                pa.array(places, pa.int32()),
                pa.StructArray.from_arrays([pa.array(x) for x in (start - bounds[own], length, period)], fields=list(RUN)))
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), flat.filter(pa.array(stays))), " ")
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(counts, pa.int64()), runs, texts],
                                             names=[*b.schema.names[:-1], "n_words", "runs", "collapsed"])

    return out.mapInArrow(work, ", ".join([*fields, "n_words bigint", f"runs {RUNS_DDL}", "collapsed string"]))


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length/period; ties: smallest start, then period.
    Null where there is none."""
    def better(best: Column, r: Column) -> Column:
        a, b = best["length"] * r["period"], r["length"] * best["period"]
        return F.when(best.isNull() | (b > a), r).otherwise(best)  # runs come by start, then period

    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(runs, none, better)


def listed(runs: Column) -> Column:
    """``start,length,period`` and a line feed for every run."""
    line = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return F.array_join(line, "")


def planted(doc_id: Column, text: Column) -> Column:
    """The text of the contract's query: every tenth document by the id's crc32 gets a
    periodic end; the others, and those without an id or words, stay as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    w = words(text)
    n = F.size(w)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    unit = F.slice(w, (a + 1).cast("int"), p.cast("int"))
    again = F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int")))
    moved = F.concat(F.slice(w, F.lit(1), a.cast("int")), F.slice(again, F.lit(1), (n - a).cast("int")))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(moved, " ")).otherwise(text)
