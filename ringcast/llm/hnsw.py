"""Approximate nearest neighbours: a navigable small-world graph per shard.

Rows are dealt to shards by the power of two of their length, then by a hash, so
a shard holds about ``SHARD`` rows whose lengths differ by a factor of two at
most. Largest inner product becomes nearness on a sphere: every row gets one more
component, sqrt(R^2 - |x|^2) with R the shard's longest length, so all rows have
length R and a row's inner product with (query, 0) is the query's with the row.

A shard's equal vectors are one node with a list of ids. Nodes get geometric
levels; each level is a flat array of neighbours (``links`` rows a node, twice as
many on level 0, -1 for none). Nodes enter in batches: a batch descends the
levels in lockstep, its beam on each of its levels gives candidates, batch mates
are candidates too; neighbours are taken nearest first, leaving out candidates
that are nearer to a taken one, and links back are cut to size by the same rule.
Searching descends the same way and ends with a beam of ``beam`` nodes on level 0,
scored in double precision on the original vectors. The best of all shards' lists
are merged. Every row is in a graph; a task holds one shard and one group of
queries, both of bounded size. Recall is measured by the tests.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do rows with a null vec_id. A shorter vector counts
as zero beyond its end. Rows that repeat a vec_id are candidates each, never for
a query of their own id; as queries they share one list. Ties go to the smaller
vec_id. A shard of no more nodes than the beam is searched whole. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringcast.llm.vectors import FINITE, matrix
from ringcast.session import materialize

SHARD = 1 << 19  # numbers (rows x components) of a shard
GROUP = 1 << 18  # and of a group of queries
BATCH = 512


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, v (doubles) and the power of two of its length, of the rows that take part."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    v = v.filter(f"vec_id is not null and exists(v, x -> x <> 0) and {FINITE.format('v')}")
    # scaled by the largest component, so that no square leaves the doubles
    largest = F.array_max(F.transform("v", F.abs))
    v = v.withColumn("largest", largest).withColumn("length", F.sqrt(F.aggregate(
        "v", F.lit(0.0), lambda s, x: s + (x / F.col("largest")) * (x / F.col("largest")))))
    return v.select("vec_id", "v", F.floor(F.log2("largest") + F.log2("length")).cast("int").alias("power"))


def on_sphere(v: np.ndarray) -> np.ndarray:
    """Rows of equal length whose inner products with (query, 0) keep the order, in single precision."""
    v = v / np.abs(v).max(initial=1e-300)
    square = (v * v).sum(axis=1)
    v = np.concatenate([v, np.sqrt(np.maximum(square.max(initial=0) - square, 0))[:, None]], axis=1)
    return (v / np.sqrt(square.max(initial=1e-300))).astype(np.float32)


def beam_search(points: np.ndarray, links: np.ndarray, queries: np.ndarray, start: np.ndarray, beam: int):
    """(ids, nearness), nearest first, -1 for none: per query the ``beam`` best
    nodes found from its start nodes [query, n]. All queries step together; a
    step opens each one's best node not opened yet."""
    b, rows = len(queries), np.arange(len(queries))
    seen = np.zeros((b, len(points)), dtype=bool)
    ids = np.full((b, beam), -1, dtype=np.int32)
    near = np.full((b, beam), -np.inf, dtype=np.float32)
    closed = np.ones((b, beam), dtype=bool)
    n = min(start.shape[1], beam)
    ids[:, :n] = start[:, :n]
    ok = ids[:, :n] >= 0
    near[:, :n] = np.where(ok, np.einsum("bnd,bd->bn", points[ids[:, :n]], queries), -np.inf)
    closed[:, :n] = ~ok
    r, c = np.nonzero(ok)
    seen[r, ids[r, c]] = True
    while len(rows):
        best = np.where(closed[rows], -np.inf, near[rows]).argmax(axis=1)
        go = ~closed[rows, best]
        rows, best = rows[go], best[go]
        if not len(rows):
            break
        closed[rows, best] = True
        found = links[ids[rows, best]]
        r, c = np.nonzero((found >= 0) & ~seen[rows[:, None], found])
        new = found[r, c]
        q = rows[r]
        seen[q, new] = True
        score = np.einsum("nd,nd->n", points[new], queries[q])
        # only what beats the beam's worst is merged
        worst = near[q].min(axis=1) if len(q) < b else near.min(axis=1)[q]
        keep = score > worst
        r, new, score, q = r[keep], new[keep], score[keep], q[keep]
        if not len(q):
            continue
        touched, at, count = np.unique(q, return_index=True, return_counts=True)
        most = int(count.max())
        column = np.arange(len(q)) - np.repeat(at, count)
        where = np.repeat(np.arange(len(touched)), count)
        more_near = np.full((len(touched), most), -np.inf, dtype=np.float32)
        more_ids = np.full((len(touched), most), -1, dtype=np.int32)
        more_near[where, column], more_ids[where, column] = score, new
        all_near = np.concatenate([near[touched], more_near], axis=1)
        all_ids = np.concatenate([ids[touched], more_ids], axis=1)
        all_closed = np.concatenate([closed[touched], more_ids < 0], axis=1)
        top = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        near[touched], ids[touched], closed[touched] = (np.take_along_axis(x, top, 1) for x in (all_near, all_ids, all_closed))
    order = np.argsort(-near, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)


def spread(points: np.ndarray, centre: np.ndarray, ids: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Per row up to ``most`` of its candidates (nearest first, -1 for none): those
    nearer to the centre than to any taken one, then the nearest of the others."""
    b, k = ids.shape
    if k <= most:
        return np.pad(ids, ((0, 0), (0, most - k)), constant_values=-1)
    v = points[ids]
    between = v @ v.transpose(0, 2, 1)
    taken, left = np.zeros((b, k), dtype=bool), ids >= 0
    closest = np.full((b, k), -np.inf, dtype=np.float32)  # to any taken one
    for j in range(k):
        take = left[:, j] & (near[:, j] > closest[:, j]) & (taken.sum(axis=1) < most)
        taken[:, j] = take
        closest[take] = np.maximum(closest[take], between[take, j])
    rank = np.where(taken, 0, np.where(left, 1, 2)) * k + np.arange(k)
    top = np.sort(rank, axis=1)[:, :most]
    return np.where(top < 2 * k, np.take_along_axis(ids, top % k, 1), -1).astype(np.int32)


class Graph:
    """A shard's levels: for each, the nodes on it and their flat neighbour array (node numbers)."""

    def __init__(self, points: np.ndarray, links: int = 16, beam: int = 128, seed: int = 7):
        n = len(points)
        self.points, self.links, self.beam = points, links, beam
        draw = np.random.default_rng(seed).random(n)
        # the first node in is on the top level, so every level below can be entered from it
        self.level = np.minimum((-np.log(1 - draw) / np.log(links)).astype(np.int64), 12)
        self.order = np.lexsort((np.arange(n), -self.level))
        self.top = int(self.level.max(initial=0))
        self.arrays = [np.full((n, links * (1 if level else 2)), -1, dtype=np.int32) for level in range(self.top + 1)]
        first = self.order[:1]
        at = 1
        while at < n:
            batch = self.order[at:at + max(1, min(BATCH, at))]
            self._insert(batch, first)
            at += len(batch)
        self.entry = int(first[0]) if n else -1

    def _insert(self, batch: np.ndarray, first: np.ndarray) -> None:
        start = np.repeat(first[None, :], len(batch), axis=0).astype(np.int32)
        for level in range(self.top, -1, -1):
            on = self.level[batch] >= level
            if not on.all():
                start[~on, :1] = beam_search(self.points, self.arrays[level], self.points[batch[~on]], start[~on], 1)[0]
            if on.any():
                nodes = batch[on]
                ids, near = beam_search(self.points, self.arrays[level], self.points[nodes], start[on], self.beam)
                self._connect(level, nodes, ids, near)
                start[on, :1] = ids[:, :1]

    def _connect(self, level: int, nodes: np.ndarray, ids: np.ndarray, near: np.ndarray) -> None:
        links, points = self.arrays[level], self.points
        mates = points[nodes] @ points[nodes].T
        np.fill_diagonal(mates, -np.inf)
        k = min(len(nodes), self.beam)
        near_mates = np.argpartition(-mates, k - 1, axis=1)[:, :k]
        mates = np.take_along_axis(mates, near_mates, 1)
        near = np.concatenate([near, mates], axis=1)
        ids = np.where(np.isfinite(near), np.concatenate([ids, nodes[near_mates].astype(np.int32)], axis=1), -1)
        top = np.argsort(-near, axis=1, kind="stable")[:, :self.beam]
        ids, near = np.take_along_axis(ids, top, 1), np.take_along_axis(near, top, 1)
        chosen = spread(points, points[nodes], ids, near, self.links)
        links[nodes, :self.links] = chosen
        # links back: each node that was chosen gets its choosers, cut to size by the same rule
        r, c = np.nonzero(chosen >= 0)
        to, by = chosen[r, c], nodes[r].astype(np.int32)
        have = links[to] == by[:, None]
        to, by = to[~have.any(axis=1)], by[~have.any(axis=1)]
        if not len(to):
            return
        score = np.einsum("nd,nd->n", points[to], points[by])
        order = np.lexsort((-score, to))
        to, by, score = to[order], by[order], score[order]
        changed, at, count = np.unique(to, return_index=True, return_counts=True)
        place = np.arange(len(to)) - np.repeat(at, count)
        width = links.shape[1]
        keep = place < 2 * width
        more = np.full((len(changed), min(int(count.max()), 2 * width)), -1, dtype=np.int32)
        more[np.repeat(np.arange(len(changed)), count)[keep], place[keep]] = by[keep]
        ids = np.concatenate([links[changed], more], axis=1)
        near = np.where(ids >= 0, np.einsum("bnd,bd->bn", points[ids], points[changed]), -np.inf)
        top = np.argsort(-near, axis=1, kind="stable")
        ids, near = np.take_along_axis(ids, top, 1), np.take_along_axis(near, top, 1)
        most = int((ids >= 0).sum(axis=1).max())
        links[changed] = spread(points, points[changed], ids[:, :most], near[:, :most], width)

    def pack(self) -> dict[str, bytes]:
        """Flat arrays: level 0's neighbours of all nodes, then each upper level's
        nodes and their neighbours."""
        upper = [np.flatnonzero(self.level >= level).astype(np.int32) for level in range(1, self.top + 1)]
        return {"entry": np.int64(self.entry).tobytes(), "base": self.arrays[0].tobytes(),
                "counts": np.array([len(x) for x in upper], dtype=np.int32).tobytes(),
                "nodes": b"".join(x.tobytes() for x in upper),
                "above": b"".join(self.arrays[i + 1][x].tobytes() for i, x in enumerate(upper))}


def search_graph(points: np.ndarray, packed: dict[str, bytes], queries: np.ndarray, links: int, beam: int) -> np.ndarray:
    """Node numbers of each query's beam, nearest first, -1 for none."""
    n = len(points)
    if n <= beam:
        return np.broadcast_to(np.arange(n, dtype=np.int32), (len(queries), n))
    counts = np.frombuffer(packed["counts"], dtype=np.int32)
    ends = np.concatenate([[0], np.cumsum(counts)])
    nodes = np.frombuffer(packed["nodes"], dtype=np.int32)
    above = np.frombuffer(packed["above"], dtype=np.int32).reshape(-1, links)
    start = np.full((len(queries), 1), int(np.frombuffer(packed["entry"], dtype=np.int64)[0]), dtype=np.int32)
    for level in range(len(counts) - 1, -1, -1):
        array = np.full((n, links), -1, dtype=np.int32)
        array[nodes[ends[level]:ends[level + 1]]] = above[ends[level]:ends[level + 1]]
        start = beam_search(points, array, queries, start, 1)[0]
    return beam_search(points, np.frombuffer(packed["base"], dtype=np.int32).reshape(n, -1), queries, start, beam)[0]


PACKED = ("entry", "base", "counts", "nodes", "above")


def build_shard(rows: pa.Table, links: int, beam: int) -> pa.Table:
    """One row: the shard's graph, its distinct vectors and their ids."""
    v = matrix(rows.column("v"))
    ids = rows.column("vec_id").to_numpy()
    v, own = np.unique(v, axis=0, return_inverse=True)
    own = own.reshape(-1)
    order = np.lexsort((ids, own))
    ends = np.cumsum(np.bincount(own, minlength=len(v))).astype(np.int64)
    packed = Graph(on_sphere(v), links, beam).pack()
    return pa.table({"shard": rows.column("shard")[:1], "width": pa.array([v.shape[1]], pa.int32()),
                     "vectors": [v.tobytes()], "ids": [ids[order].astype(np.int64).tobytes()], "ends": [ends.tobytes()],
                     **{name: [packed[name]] for name in PACKED}})


SHARD_SCHEMA = "shard long, width int, vectors binary, ids binary, ends binary, " + ", ".join(f"{x} binary" for x in PACKED)


def search_shard(shard: pa.Table, queries: pa.Table, k: int, links: int, beam: int) -> pa.Table:
    """query_id, vec_id, score: a shard's k best for each query."""
    out: list[list] = [[], [], []]
    if shard.num_rows and queries.num_rows:
        one = {name: shard.column(name)[0].as_py() for name in shard.column_names}
        v = np.frombuffer(one["vectors"]).reshape(-1, one["width"])
        ids, ends = (np.frombuffer(one[x], dtype=np.int64) for x in ("ids", "ends"))
        begin = np.concatenate([[0], ends[:-1]])
        points, asked = on_sphere(v), matrix(queries.column("v"), one["width"])
        near = asked[:, :one["width"]]
        near = near / np.maximum(np.abs(near).max(axis=1, initial=0), 1e-300)[:, None]
        near = np.concatenate([near, np.zeros((len(near), 1))], axis=1).astype(np.float32)
        own = queries.column("vec_id").to_numpy()
        for at in range(0, len(asked), BATCH):
            found = search_graph(points, one, near[at:at + BATCH], links, beam)
            for i, nodes in enumerate(found, start=at):
                nodes = nodes[nodes >= 0]
                score = np.einsum("nd,d->n", v[nodes], asked[i, :one["width"]])
                best = np.argsort(-score, kind="stable")
                kept, last = [], None
                for j in best.tolist():
                    if len(kept) >= k and score[j] != last:
                        break
                    last = score[j]
                    # equal vectors: the k smallest ids but the query's own are enough
                    some = ids[begin[nodes[j]]:min(ends[nodes[j]], begin[nodes[j]] + k + 1)]
                    if own[i] in some:
                        some = ids[begin[nodes[j]]:ends[nodes[j]]]
                        some = some[some != own[i]][:k]
                    kept.extend((-float(last), x) for x in some[:k].tolist())
                kept = sorted(kept)[:k]
                out[0].extend([int(own[i])] * len(kept))
                out[1].extend(x for _, x in kept)
                out[2].extend(-s for s, _ in kept)
    return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()),
                     "score": pa.array(out[2], pa.float64())})


def build_index(rows: DataFrame, width: int, links: int, beam: int) -> DataFrame:
    """One stored row per shard. Shard numbers are dealt by length's power of two, then by hash."""
    per = max(1, SHARD // width)
    first, total = {}, 0
    for r in sorted(rows.groupBy("power").count().collect(), key=lambda r: r.power):
        shards = -(-r["count"] // per)
        first[r.power] = (total, shards)
        total += shards
    if not first:
        return rows.sparkSession.createDataFrame([], SHARD_SCHEMA)
    begin, many = (F.create_map(*[F.lit(y) for p, x in first.items() for y in (p, x[i])])[F.col("power")] for i in (0, 1))
    dealt = rows.withColumn("shard", (begin + F.pmod(F.xxhash64("vec_id", "v"), many.cast("long"))).cast("long"))
    return dealt.select("shard", "vec_id", "v").groupBy("shard").applyInArrow(
        lambda table: build_shard(table, links, beam), SHARD_SCHEMA)


def nearest(vectors: DataFrame, queries: str, k: int = 20, links: int = 16, build_beam: int = 96, beam: int = 192) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: about the k largest inner products
    of each vector that the SQL condition ``queries`` names with all others."""
    rows = materialize(whole_vectors(vectors), "hnsw-rows")
    asked = rows.filter(queries)
    shape = rows.agg(F.max(F.size("v")).alias("d"), F.count_if(F.expr(queries)).alias("q")).first()
    width = max(1, shape.d or 0)
    index = materialize(build_index(rows, width, links, build_beam), "hnsw-index")
    shards = index.agg(F.max("shard")).first()[0] or 0
    groups = max(1, -(-shape.q // max(1, GROUP // width)))
    left = index.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = asked.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", "v"), F.lit(groups)).cast("int").alias("group")) \
        .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(int(shards)).cast("long"))))
    found = left.groupBy("shard", "group").cogroup(right.groupBy("shard", "group")).applyInArrow(
        lambda shard, some: search_shard(shard, some, k, links, beam), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
