"""Operator 5: embedding near-duplicates with navigable small-world graphs.

Vectors are compared within a label.  Equal vectors of a label are one vertex with a
count from the start.  A label's vertices are dealt to shards of at most about
``SHARD`` (a hot label simply has more shards); each shard gets a hierarchical
navigable small-world graph, and every block of a label's vertices queries every
shard of the label.

Graphs are built in batches: a batch searches the graph so far, gets up to ``M``
neighbours that are closer to it than to each other, and the reverse links are
pruned by the same rule.  Searches run for a whole block at once, as array
operations over all their beams.  A query whose beam is filled by links is asked
again with a beam four times as wide, so dense groups are found whole.  Then an audit compares
answers with brute force over the shard: queries of the block are drawn until ``AUDIT``
of them have a few links (one to ``FEW``) to other vertices of the shard, or until every
query of the block is audited; queries without a link or of dense groups are audited
but don't count, so rare links (most of all those between shards) are seen.  As long as
a link is missed, the beam is doubled.  Where a beam would hold a quarter of the
shard or more, the whole shard is compared instead, so the widening ends.

Whatever is found is verified by cosine in double precision.  The tasks return, for
each vertex, its number of links and a link to the root of its local component: as
many rows as vertices, not pairs.  Components are united over these.

Defined cases: vectors that are null, zero or hold null or non-finite components
and rows with a null label link with nothing and are their own component; rows that
repeat an id are one vector (the least usable); rows with a null id are left out;
an empty table gives an empty result; other columns are not needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import staged
from farebox.llm.components import components
from farebox.llm.vectors import matrix, one_per_id

LEAST_COSINE = 0.93
SHARD, QUERY_BLOCK = 8_192, 8_192
M, M0, BUILD_BEAM, BATCH, BEAM, AUDIT, FEW = 12, 24, 48, 256, 48, 256, 8
SEED = 41

_FOUND = "vertex long, n_links long, root long"


def _top(ids: np.ndarray, sims: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` most similar of each row, most similar first."""
    by = np.argsort(-sims, axis=1, kind="stable")[:, :width]
    return np.take_along_axis(ids, by, 1), np.take_along_axis(sims, by, 1)


class Graph:
    """A hierarchical navigable small-world graph over unit vectors (float32)."""

    def __init__(self, x: np.ndarray):
        self.x = x
        n = len(x)
        rng = np.random.default_rng(SEED)
        level = np.floor(-np.log(1 - rng.random(n)) / np.log(M)).astype(int)
        if n:
            level[0] = level.max()
        self.layers = [np.full((n, M0 if k == 0 else M), -1, np.int32) for k in range(level.max(initial=0) + 1)]
        at, size = 1, 1
        while at < n:
            batch = np.arange(at, min(n, at + size))
            self._insert(batch, level)
            at += len(batch)
            size = min(BATCH, at)

    def _insert(self, batch: np.ndarray, level: np.ndarray) -> None:
        q = self.x[batch]
        entry = np.zeros((len(batch), 1), np.int64)
        for k in range(len(self.layers) - 1, -1, -1):
            found, sims = self.beam(k, q, entry, BUILD_BEAM)
            entry = found[:, :4]
            member = np.flatnonzero(level[batch] >= k)
            if not len(member):
                continue
            # neighbours may also come from the batch itself, each from those before it
            own = q[member] @ q[member].T
            own[np.triu_indices(len(member))] = -np.inf
            ids = np.concatenate([found[member], np.broadcast_to(batch[member], (len(member), len(member)))], 1)
            ids, sims = _top(ids, np.concatenate([sims[member], own], 1), BUILD_BEAM)
            ids = np.where(np.isfinite(sims), ids, -1)
            near = self._diverse(ids, sims, M)
            self.layers[k][batch[member], :M] = near
            self._reverse(k, np.repeat(batch[member], M), near.ravel())

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        """Of each row's candidates (most similar first) those that are closer to it
        than to any chosen before; free places go to the nearest others."""
        v = self.x[ids]
        among = np.einsum("bcd,bed->bce", v, v)
        chosen = np.zeros(ids.shape, bool)
        for c in range(ids.shape[1]):
            rival = np.where(chosen, among[:, c, :], -np.inf).max(1)
            chosen[:, c] = (ids[:, c] >= 0) & (rival < sims[:, c])
        rank = np.where(ids < 0, 2, np.where(chosen, 0, 1)) * ids.shape[1] + np.arange(ids.shape[1])
        # a quarter of the places stays for the nearest, chosen or not
        rank[:, :width // 4] = np.where(ids[:, :width // 4] >= 0, 0, rank[:, :width // 4])
        by = np.argsort(rank, axis=1, kind="stable")[:, :width]
        out = np.take_along_axis(ids, by, 1).astype(np.int32)
        if out.shape[1] < width:
            out = np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1)
        return out

    def _reverse(self, k: int, source: np.ndarray, target: np.ndarray) -> None:
        source, target = source[target >= 0], target[target >= 0]
        if not len(target):
            return
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        to, first, count = np.unique(target, return_index=True, return_counts=True)
        width = self.layers[k].shape[1]
        most = int(count.max())
        new = np.full((len(to), most), -1, np.int64)
        new[np.repeat(np.arange(len(to)), count), np.arange(len(target)) - np.repeat(first, count)] = source
        ids = np.concatenate([self.layers[k][to].astype(np.int64), new], 1)
        sims = np.einsum("bd,bcd->bc", self.x[to], self.x[ids])
        sims[ids < 0] = -np.inf
        ids, sims = _top(ids, sims, min(ids.shape[1], width + 24))
        full = (ids >= 0).sum(1) > width
        kept = np.full((len(to), width), -1, np.int32)
        kept[~full] = np.pad(ids, ((0, 0), (0, max(0, width - ids.shape[1]))), constant_values=-1)[~full, :width]
        if full.any():
            kept[full] = self._diverse(ids[full], sims[full], width)
        self.layers[k][to] = kept

    def beam(self, k: int, q: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The most similar nodes of layer ``k`` found by beams of ``width``, and
        their similarities; -1 and -inf fill up."""
        links, x, b = self.layers[k], self.x, len(q)
        seen = np.zeros((b, len(x)), bool)
        row = np.arange(b)[:, None]
        sims = np.einsum("bd,bcd->bc", q, x[entry])
        sims[entry < 0] = -np.inf
        for c in range(1, entry.shape[1]):  # an entry that is given twice counts once
            sims[(entry[:, c:c + 1] == entry[:, :c]).any(1), c] = -np.inf
        seen[np.broadcast_to(row, entry.shape)[entry >= 0], entry[entry >= 0]] = True
        ids = np.pad(np.where(np.isfinite(sims), entry, -1), ((0, 0), (0, max(0, width - entry.shape[1]))), constant_values=-1)
        sims = np.pad(sims, ((0, 0), (0, max(0, width - entry.shape[1]))), constant_values=-np.inf)
        done = ids < 0
        while True:
            best = np.where(done, -np.inf, sims)
            step = min(width, max(4, width // 12))
            pick = np.argpartition(-best, step - 1, axis=1)[:, :step]
            open_ = np.isfinite(np.take_along_axis(best, pick, 1))
            live = np.flatnonzero(open_.any(1))
            if not len(live):
                return ids, sims
            nodes = np.where(open_[live], np.take_along_axis(ids[live], pick[live], 1), -1)
            mark = done[live]
            np.put_along_axis(mark, pick[live], True, 1)
            done[live] = mark
            near = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(live), -1).astype(np.int64)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[live[:, None], near] & (near >= 0)] = -1
            got = near >= 0
            who = np.broadcast_to(live[:, None], near.shape)
            seen[who[got], near[got]] = True
            new = np.full(near.shape, -np.inf, np.float32)
            new[got] = np.einsum("nd,nd->n", q[who[got]], x[near[got]])
            all_ids = np.concatenate([ids[live], near], 1)
            all_sims = np.concatenate([sims[live], new], 1)
            all_done = np.concatenate([done[live], ~got], 1)
            by = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            ids[live] = np.take_along_axis(all_ids, by, 1)
            sims[live] = np.take_along_axis(all_sims, by, 1)
            done[live] = np.take_along_axis(all_done, by, 1) | ~np.isfinite(sims[live])

    def search(self, q: np.ndarray, width: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Descend from the top layer; ``own`` adds the queries' own nodes as entries."""
        entry = np.zeros((len(q), 1), np.int64)
        for k in range(len(self.layers) - 1, 0, -1):
            entry = self.beam(k, q, entry, 8)[0][:, :4]
        if own is not None:
            entry = np.column_stack([own, entry])
        return self.beam(0, q, entry, min(width, len(self.x)))


def audited(x: np.ndarray, q: np.ndarray, own: np.ndarray, least: float) -> dict[int, int]:
    """Queries drawn at random, and for each how many nodes brute force links with it:
    drawn until ``AUDIT`` have one to ``FEW`` links besides their own node, or all are."""
    drawn = np.random.default_rng(SEED).permutation(len(q))
    out: dict[int, int] = {}
    few = 0
    for at in range(0, len(drawn), 128):
        part = drawn[at:at + 128]
        n = (x @ q[part].T >= least).sum(0)
        out.update(zip(part.tolist(), n.tolist()))
        others = n - (own[part] >= 0)
        few += int(((others >= 1) & (others <= FEW)).sum())
        if few >= AUDIT:
            break
    return out


def links_in_shard(graph: Graph, x: np.ndarray, q: np.ndarray, own: np.ndarray, least: float) -> list[np.ndarray]:
    """For each query the nodes with cosine >= ``least`` (its own among them, if it is
    a node), beams widened until the audit finds no missed link.  ``x`` and ``q`` are
    unit vectors in double precision, ``own`` the queries' nodes or -1."""
    truth = audited(x, q, own, least)
    width = BEAM
    found: list[np.ndarray] = [None] * len(q)  # type: ignore[list-item]
    ask = np.arange(len(q))
    while True:
        todo, wide = ask, width
        while len(todo):
            again = []
            if 4 * wide >= len(x):
                for i in todo:
                    found[i] = np.flatnonzero(x @ q[i] >= least)
                break
            for at in range(0, len(todo), max(16, min(256, 65_536 // wide))):
                part = todo[at:at + max(16, min(256, 65_536 // wide))]
                ids, sims = graph.search(q[part].astype(np.float32), wide, own[part])
                for i, f, s in zip(part, ids, sims):
                    if np.isfinite(s[-1]) and s[-1] >= least - 0.01:
                        again.append(i)
                    else:
                        f = f[s >= least - 0.001]
                        found[i] = np.sort(f[x[f] @ q[i] >= least]) if len(f) else f
            todo, wide = np.array(again, np.int64), 4 * wide
        missing = [i for i, n in truth.items() if len(found[i]) < n]
        if not missing or 4 * width >= len(x):
            return found
        # audited queries whose links are all there need not be asked again
        ask = np.array(sorted({*range(len(q))} - truth.keys() | {*missing}), np.int64)
        width *= 2


def vertices(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (vec_id, vertex) and vertices (vertex, label, embedding, n): equal
    vectors of a label are one vertex, named by the smallest id."""
    rows = staged(one_per_id(vectors.filter(F.col("label").isNotNull()), "label"), "hnsw-rows")
    one = staged(rows.groupBy("label", "embedding").agg(F.min("vec_id").alias("vertex"), F.count(F.lit(1)).alias("n")),
                 "hnsw-vertices")
    members = rows.join(one.filter("n > 1"), ["label", "embedding"], "left").select(
        "vec_id", F.coalesce("vertex", "vec_id").alias("vertex"))
    return members, one


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    members, one = vertices(vectors)
    sizes = one.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    dealt = one.join(sizes, "label").withColumn("shards", F.ceil(F.col("size") / SHARD).cast("int")).withColumn(
        "blocks", F.ceil(F.col("size") / QUERY_BLOCK).cast("int"))

    def key(n: str, salt: int):
        return F.pmod(F.xxhash64(F.lit(salt), "vertex"), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    rows = ["vertex", "embedding", "n"]
    left = dealt.select("label", *rows, key("shards", 1).alias("shard"), every("blocks").alias("block"))
    right = dealt.select(F.col("label").alias("label"), *[F.col(c).alias(c) for c in rows], key("blocks", 2).alias("block"), every("shards").alias("shard"))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        vertex, n_links, root = [], [], []
        if a.num_rows and b.num_rows:
            a, b = a.sort_by("vertex"), b.sort_by("vertex")
            name, asked = a.column("vertex").to_numpy(), b.column("vertex").to_numpy()
            copies = a.column("n").to_numpy()
            x, q = matrix(a.column("embedding")), matrix(b.column("embedding"))
            x /= np.linalg.norm(x, axis=1)[:, None]
            q /= np.linalg.norm(q, axis=1)[:, None]
            at = np.minimum(np.searchsorted(name, asked), len(name) - 1)
            own = np.where(name[at] == asked, at, -1)
            # nodes are inserted in an order that has nothing to do with their ids
            mixed = np.random.default_rng(SEED).permutation(len(x))
            place = np.argsort(mixed)
            found = links_in_shard(Graph(x[mixed].astype(np.float32)), x[mixed], q,
                                   np.where(own >= 0, place[own], -1), least)
            found = [mixed[f] for f in found]
            up: dict[int, int] = {}

            def top(v: int) -> int:
                while up.get(v, v) != v:
                    up[v] = up.get(up[v], up[v])
                    v = up[v]
                return v

            for v, f in zip(asked.tolist(), found):
                for w in name[f].tolist():
                    r, s = top(v), top(w)
                    if r != s:
                        up[max(r, s)] = min(r, s)
            count = [int(copies[f].sum()) for f in found]
            # a row for each vertex met here; only queries bring links of their own
            links = dict(zip(asked.tolist(), count))
            for v in sorted({*links, *up}):
                vertex.append(v)
                n_links.append(links.get(v, 0))
                root.append(top(v))
        return pa.table({"vertex": pa.array(vertex, pa.int64()), "n_links": pa.array(n_links, pa.int64()),
                         "root": pa.array(root, pa.int64())})

    found = staged(left.groupBy("label", "shard", "block").cogroup(right.groupBy("label", "shard", "block"))
                   .applyInArrow(run, _FOUND), "hnsw-found")
    joined = components(found.filter("vertex != root").select(F.col("vertex").alias("a"), F.col("root").alias("b")))
    by_vertex = (found.groupBy("vertex").agg(F.sum("n_links").alias("found"))
                 .join(joined.withColumnRenamed("id", "vertex"), "vertex", "left"))
    linked = (members.join(by_vertex, "vertex", "left").select(
        "vec_id", F.greatest(F.col("found") - 1, F.lit(0)).alias("found"), F.coalesce("component", "vertex").alias("component")))
    every_id = vectors.filter(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    component = F.coalesce("component", "vec_id")
    return every_id.join(linked, "vec_id", "left").select(
        "vec_id", F.coalesce("found", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"))
