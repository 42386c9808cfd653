"""Operator 6: nearest neighbours by vantage-point trees per shard.

Vectors are dealt to shards by a hash of their id, so no vector, cluster or
copy makes a shard large.  A task gathers one shard, builds its tree (inner
nodes split at the median distance to a vantage point and keep the smallest
and largest distance on either side) and streams the queries through it in
batches: the triangle inequality bounds the distance from a query to every
leaf, leaves are visited nearest bound first, and a query ends when the next
bound times ``factor`` exceeds its k-th distance.  Factor 1 is exact; larger
factors end earlier.  Shards grow in number, not in size; each query meets
each shard once and the shards' k best are merged by a top-k window.

Defined results: vectors that are null, empty, all zero or hold a null or
non-finite component take no part, nor do null ids; every row is a candidate,
so an id with several rows may be found several times, but an id asks once
(with its smallest vector, in array order) and never finds its own rows; only
vectors of a query's dimension are its candidates; equal distances go to the smaller id; fewer candidates
than k give fewer rows; empty tables give an empty result; extra columns are
ignored.  Distances are Euclidean in double precision, summed in component
order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 200_000
LEAST_SHARDS = 16
LEAF = 256
FACTOR = 1.0
QUERY_BATCH = 256


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows, squares added in component order."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return np.sqrt(out)


def distances_within(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """``distances`` where row i's may reach ``most[i]``, infinite elsewhere.

    A matrix product estimates all; only pairs whose estimate, less its
    rounding error, is small enough are computed.
    """
    aa, bb = (a * a).sum(1), (b * b).sum(1)
    slack = 1e-12 * (aa[:, None] + bb[None, :])
    i, j = np.nonzero(aa[:, None] + bb[None, :] - 2 * (a @ b.T) - slack <= (most * most)[:, None])
    total = np.zeros(len(i))
    for k in range(a.shape[1]):
        total += (a[i, k] - b[j, k]) ** 2
    out = np.full((len(a), len(b)), np.inf)
    out[i, j] = np.sqrt(total)
    return out


@dataclass
class Tree:
    """Leaves are runs of ``order``; inner nodes come before their children."""
    points: np.ndarray
    ids: np.ndarray
    vantage: list[int]                 # point of an inner node, -1: a leaf
    sides: list[tuple]                 # inner: (child, least, most) twice; leaf: (start, end)
    order: np.ndarray

    @staticmethod
    def build(points: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> Tree:
        t = Tree(points, ids, [], [], np.arange(len(ids)))
        todo = [(0, len(ids), None)]
        while todo:
            lo, hi, slot = todo.pop()
            me = len(t.vantage)
            if slot:
                parent, side, least, most = slot
                s = list(t.sides[parent])
                s[side] = (me, least, most)
                t.sides[parent] = tuple(s)
            part = t.order[lo:hi]
            if hi - lo > leaf:
                # the point farthest from the run's first one, as vantage point
                far = part[int(distances(points[part[:1]], points[part])[0].argmax())]
                d = distances(points[far:far + 1], points[part])[0]
                o = np.argsort(d, kind="stable")
                mid = (hi - lo) // 2
                if d[o[0]] < d[o[-1]]:
                    t.order[lo:hi], d = part[o], d[o]
                    t.vantage.append(int(far))
                    t.sides.append((None, None))
                    todo += [(lo, lo + mid, (me, 0, d[0], d[mid - 1])), (lo + mid, hi, (me, 1, d[mid], d[-1]))]
                    continue
            t.vantage.append(-1)
            t.sides.append((lo, hi))
        return t

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """A lower bound of the distance from each query to each leaf."""
        at = {0: np.zeros(len(q))}
        cols, leaves = [], []
        for me, v in enumerate(self.vantage):
            low = at.pop(me)
            if v < 0:
                cols.append(low)
                leaves.append(self.sides[me])
                continue
            d = distances(q, self.points[v:v + 1])[:, 0]
            for child, least, most in self.sides[me]:
                at[child] = np.maximum(low, np.maximum(d - most, least - d))
        return np.stack(cols, 1), leaves

    def nearest(self, q: np.ndarray, own: np.ndarray, k: int, factor: float = FACTOR
                ) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest; infinite distances where there are fewer."""
        best = np.full((len(q), k), np.iinfo(np.int64).max)
        dist = np.full((len(q), k), np.inf)
        if not len(self.ids) or not len(q):
            return best, dist
        low, leaves = self.bounds(q)
        first = np.argsort(low, axis=1, kind="stable")
        live = np.arange(len(q))
        for r in range(low.shape[1]):
            leaf = first[live, r]
            # a hair of slack, so that rounding never prunes what the inequality allows
            go = low[live, leaf] * factor <= dist[live, -1] * (1 + 1e-9) + 1e-12
            live, leaf = live[go], leaf[go]
            if not len(live):
                break
            for one in np.unique(leaf).tolist():
                rows = live[leaf == one]
                part = self.order[leaves[one][0]:leaves[one][1]]
                d = distances_within(q[rows], self.points[part], dist[rows, -1])
                ids = np.broadcast_to(self.ids[part], d.shape)
                d[ids == own[rows, None]] = np.inf
                new = np.isfinite(d).any(1)
                rows, d, ids = rows[new], d[new], ids[new]
                d, ids = np.concatenate([dist[rows], d], 1), np.concatenate([best[rows], ids], 1)
                o = np.lexsort((ids, d), axis=1)[:, :k]
                dist[rows], best[rows] = np.take_along_axis(d, o, 1), np.take_along_axis(ids, o, 1)
        return best, dist


def usable(vector: str | Column) -> Column:
    c = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return c.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(c, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: Column, k: int = 10, factor: float = FACTOR, vec_id: str = "vec_id",
            vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest of every query.

    ``queries``: which rows of ``vectors`` (as vec_id, vector) are queries.
    """
    v = (vectors.select(vectors[vec_id].cast("long").alias("vec_id"),
                        vectors[vector].cast("array<double>").alias("vector"))
         .where(F.col("vec_id").isNotNull() & usable("vector")))
    shards = max(LEAST_SHARDS, -(-vectors.count() // shard_rows))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    asked = (v.where(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    rows = (v.withColumn("shard", shard).withColumn("asks", F.lit(0))
            .unionByName(asked.withColumn("asks", F.lit(1)))
            .withColumn("dim", F.size("vector")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query_id", "vec_id", "score"]
        at, points, ids, tree = None, [], [], None
        asked_ids, asked_rows = [], []

        def answer() -> pa.RecordBatch:
            own, q = np.concatenate(asked_ids), np.concatenate(asked_rows)
            asked_ids.clear()
            asked_rows.clear()
            best, dist = tree.nearest(q, own, k, factor)
            ok = np.isfinite(dist)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(own, ok.sum(1))), pa.array(best[ok]), pa.array(dist[ok])], names=names)

        for b in batches:
            if not b.num_rows:
                continue
            key = np.stack([b.column(c).to_numpy() for c in ("shard", "dim", "asks")], 1)
            flat, size = b.column("vector").flatten().to_numpy(), key[:, 1]
            start = np.r_[0, np.cumsum(size)]
            vec = b.column("vec_id").to_numpy()
            cut = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1), True])
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
                part = flat[start[lo]:start[hi]].reshape(hi - lo, -1)
                if at != (group := tuple(key[lo, :2])):
                    if asked_ids:
                        yield answer()
                    at, points, ids, tree = group, [], [], None
                if not key[lo, 2]:
                    points.append(part)
                    ids.append(vec[lo:hi])
                    continue
                if not points:         # no candidate in this shard
                    continue
                if tree is None:
                    tree = Tree.build(np.concatenate(points), np.concatenate(ids))
                for x in range(0, hi - lo, QUERY_BATCH):
                    asked_ids.append(vec[lo:hi][x:x + QUERY_BATCH])
                    asked_rows.append(part[x:x + QUERY_BATCH])
                    if sum(map(len, asked_ids)) >= QUERY_BATCH:
                        yield answer()
        if asked_ids:
            yield answer()

    order = ("shard", "dim", "asks", "vec_id")
    found = (rows.repartition(shards, "shard").sortWithinPartitions(*order)
             .select("shard", "dim", "asks", "vec_id", "vector")
             .mapInArrow(run, "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
a AS (SELECT vec_id, min(e) AS e FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(
      range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])), lambda s, x: s + x)) AS score
  FROM a q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
WHERE rank <= 10
"""
