"""Approximate nearest neighbours: one HNSW graph per shard, results merged (operator 5).

1. Equal vectors are one point: of each point the smallest ``k + 1`` ids are enough for any
   query's k nearest, so a vector that a third of all rows share is reduced before the shuffle.
2. Points are dealt to shards of about ``SHARD_POINTS`` (fewer if longer than ``SHARD_BYTES``) by hash.  A shard becomes a hierarchical
   navigable small-world graph: points get levels with geometrically falling chances; on each
   level a point is tied to neighbours chosen among its ``WIDE`` nearest, leaving out those that
   lie closer to one already chosen, and ties are made mutual.  Neighbours are stored as flat
   arrays of numbers, one row per point, with the shard's vectors and ids.
3. Queries, in blocks, are sent past the shards: the graph arrives first and is held.  A search
   goes down the levels greedily and keeps the ``BEAM`` best points on the lowest one; all
   queries of a block take their steps together.
4. A shard answers with the k best rows by exact cosine, in double precision on the original
   vectors; the answers of all shards are ranked together.

All rows are indexed; the graph finds nearly all true neighbours (see the measured recall in the
README and tests).

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part,
nor do rows without an id; vectors are compared with those of their own length only; rows of
one id are one another's own row and never found for each other; ties go to the smaller id; a
query with fewer than k candidates gets them all.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorgrid.llm.common import map_batches, partitions, quoted
from sensorgrid.llm.words import mix
from sensorgrid.staging import stage

SHARD_POINTS = 16000
#: Bytes of vectors, which make shards of long vectors smaller.
SHARD_BYTES = 32 << 20
#: Ties per point on the upper levels; twice as many on the lowest.
TIES = 16
WIDE = 64
BEAM = 160
QUERY_BLOCK = 256
#: Points of a shard whose products with all others are held at a time.
ROWS = 512


def usable(vector: Column) -> Column:
    wide = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & sound & F.exists(wide, lambda x: x != 0)


def _spread(unit: np.ndarray, nearest: np.ndarray, close: np.ndarray, most: int) -> np.ndarray:
    """Of each row's points, nearest first, up to ``most`` that are closer to the row than to any taken before."""
    rows = np.arange(len(nearest))
    chosen, counts = np.full((len(rows), most), -1), np.zeros(len(rows), np.int64)
    between = np.full(nearest.shape, -np.inf, np.float32)
    for rank in range(nearest.shape[1]):
        take = np.flatnonzero((counts < most) & (between[:, rank] < close[:, rank]))
        chosen[take, counts[take]] = nearest[take, rank]
        counts[take] += 1
        later = nearest[take, rank + 1 :]
        sims = np.einsum("qd,qkd->qk", unit[nearest[take, rank]], unit[later])
        between[take, rank + 1 :] = np.maximum(between[take, rank + 1 :], sims)
    return chosen


def _ties(unit: np.ndarray, most: int) -> np.ndarray:
    """(n, most or a few more) neighbour numbers of unit vectors, -1 where there are fewer."""
    n = len(unit)
    if n < 2:
        return np.full((n, most), -1, np.int32)
    wide = min(WIDE, n - 1)
    chosen = np.full((n, most // 2), -1)
    for first in range(0, n, ROWS):
        own = np.arange(first, min(first + ROWS, n))
        near = unit[own] @ unit.T
        near[np.arange(len(own)), own] = -np.inf
        nearest = np.argpartition(-near, wide - 1, axis=1)[:, :wide]
        close = np.take_along_axis(near, nearest, axis=1)
        order = np.argsort(-close, axis=1, kind="stable")
        chosen[own] = _spread(unit, np.take_along_axis(nearest, order, axis=1), np.take_along_axis(close, order, axis=1), most // 2)
    a, b = np.nonzero(chosen >= 0)[0], chosen[chosen >= 0]
    edges = np.unique(np.concatenate([np.column_stack([a, b]), np.column_stack([b, a])]), axis=0)
    order = np.lexsort((-np.einsum("ed,ed->e", unit[edges[:, 0]], unit[edges[:, 1]]), edges[:, 0]))
    a, b = edges[order, 0], edges[order, 1]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    out = np.full((n, most), -1, np.int32)
    fits = place < most
    out[a[fits], place[fits]] = b[fits]
    # A point that all its neighbours have dropped for nearer ones is added to its nearest one's list.
    lost = np.setdiff1d(np.arange(n), out[out >= 0])
    if len(lost):
        hosts = chosen[lost, 0]
        by_host = np.argsort(hosts, kind="stable")
        hosts, lost = hosts[by_host], lost[by_host]
        place = np.arange(len(hosts)) - np.searchsorted(hosts, hosts)
        more = np.full((n, place.max() + 1), -1, np.int32)
        more[hosts, place] = lost
        out = np.concatenate([out, more], axis=1)
    return out


class Graph:
    """An HNSW graph in flat arrays.  ``levels`` holds, from the lowest up, the numbers of the
    points on the level and their neighbours, as places on that level."""

    def __init__(self, unit: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.unit, self.levels = unit, levels

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int) -> Graph:
        unit = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
        chance = (mix(np.arange(len(unit), dtype=np.uint64) + np.uint64(seed)) >> np.uint64(11)).astype(float) / 2**53
        height = np.floor(-np.log(np.maximum(chance, 1e-15)) / np.log(TIES)).astype(int)
        levels, points = [], np.arange(len(unit))
        while len(points):
            levels.append((points, _ties(unit[points], TIES if levels else 2 * TIES)))
            points = np.flatnonzero(height >= len(levels))
        return cls(unit, levels)

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """(queries, beam) points, best first; -1 where there are fewer."""
        q = len(queries)
        at = np.repeat(self.levels[-1][0][:1], q)
        for points, ties in self.levels[:0:-1]:
            moving = np.arange(q)
            while len(moving):
                here = np.searchsorted(points, at[moving])
                around = ties[here]
                places = np.where(around >= 0, points[around], at[moving][:, None])
                near = np.einsum("qd,qkd->qk", queries[moving], self.unit[places])
                own = np.einsum("qd,qd->q", queries[moving], self.unit[at[moving]])
                best = near.argmax(axis=1)
                better = near[np.arange(len(moving)), best] > own
                at[moving[better]] = places[better, best[better]]
                moving = moving[better]
        return self._beam(queries, at, beam)

    def _beam(self, queries: np.ndarray, start: np.ndarray, beam: int) -> np.ndarray:
        points, ties = self.levels[0]
        q, n = len(queries), len(self.unit)
        seen = np.zeros((q, n), bool)
        rows = np.arange(q)
        seen[rows, start] = True
        found = np.full((q, beam), -1, np.int64)
        near = np.full((q, beam), -np.inf, np.float32)
        open_ = np.zeros((q, beam), bool)
        found[:, 0], near[:, 0], open_[:, 0] = start, np.einsum("qd,qd->q", queries, self.unit[start]), True
        busy = rows
        while len(busy):
            pick = np.where(open_[busy], near[busy], -np.inf).argmax(axis=1)
            here = found[busy, pick]
            open_[busy, pick] = False
            around = ties[here]
            fresh = (around >= 0) & ~seen[busy[:, None], around]
            seen[busy[:, None], np.where(around >= 0, around, here[:, None])] = True
            sims = np.where(fresh, np.einsum("qd,qkd->qk", queries[busy], self.unit[around]), -np.inf)
            all_near = np.concatenate([near[busy], sims], axis=1)
            all_found = np.concatenate([found[busy], np.where(fresh, around, -1)], axis=1)
            all_open = np.concatenate([open_[busy], fresh], axis=1)
            top = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
            side = np.arange(len(busy))[:, None]
            near[busy], found[busy], open_[busy] = all_near[side, top], all_found[side, top], all_open[side, top]
            busy = busy[open_[busy].any(axis=1)]
        order = np.argsort(-near, axis=1, kind="stable")
        return found[rows[:, None], order]


def _arrays(parts: list[np.ndarray]) -> list[bytes]:
    return [np.ascontiguousarray(p).tobytes() for p in parts]


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, vector, ids) sorted by shard: the arrays of each shard's graph."""

    def packed(shard: int, vectors: list, ids: list) -> pa.RecordBatch:
        x = np.array(vectors, np.float64)
        order = np.argsort([i[0] for i in ids], kind="stable")
        x, ids = x[order], [ids[i] for i in order]
        graph = Graph.build(x, shard)
        sizes = np.array([x.shape[1], len(graph.levels), *(len(p) for p, _ in graph.levels)], np.int64)
        owners = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64)
        arrays = [sizes, x, owners, np.concatenate(ids).astype(np.int64)]
        for points, ties in graph.levels:
            arrays += [points.astype(np.int64), ties]
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([_arrays(arrays)], pa.list_(pa.binary()))], names=["shard", "arrays"])

    shard, vectors, ids = None, [], []
    for batch in batches:
        for now, vector, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now != shard and vectors:
                yield packed(shard, vectors, ids)
                vectors, ids = [], []
            shard = now
            vectors.append(vector)
            ids.append(sorted(own))
    if vectors:
        yield packed(shard, vectors, ids)


class Shard:
    def __init__(self, arrays: list[bytes]):
        sizes = np.frombuffer(arrays[0], np.int64)
        width = int(sizes[0])
        self.vectors = np.frombuffer(arrays[1], np.float64).reshape(-1, width)
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.owners, self.ids = (np.frombuffer(a, np.int64) for a in arrays[2:4])
        levels = [
            (np.frombuffer(arrays[4 + 2 * i], np.int64), np.frombuffer(arrays[5 + 2 * i], np.int32).reshape(int(n), -1))
            for i, n in enumerate(sizes[2:])
        ]
        self.graph = Graph((self.vectors / self.norms[:, None]).astype(np.float32), levels)

    def answers(self, own: np.ndarray, queries: np.ndarray, k: int, beam: int) -> Iterator[tuple[int, int, float]]:
        """The k best rows of the shard for each query: (query id, row id, cosine)."""
        norms = np.sqrt((queries * queries).sum(axis=1))
        found = self.graph.search((queries / norms[:, None]).astype(np.float32), beam)
        for row, points in enumerate(found):
            points = points[points >= 0]
            cosine = (self.vectors[points] * queries[row]).sum(axis=1) / (self.norms[points] * norms[row])
            best = []
            for c, p in sorted(zip(-cosine, points, strict=True)):
                if len(best) >= k and c > best[k - 1][0]:
                    break
                best += [(c, int(i)) for i in self.ids[self.owners[p] : self.owners[p + 1]] if i != own[row]]
                best.sort()
            for c, i in best[:k]:
                yield int(own[row]), i, -float(c)


def _search(k: int, beam: int):
    """Rows (shard, arrays, ids, vectors) sorted by shard, arrays first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            for i in range(batch.num_rows):
                arrays, ids, vectors = (batch.column(c)[i] for c in (1, 2, 3))
                if arrays.is_valid:
                    shard = Shard(arrays.as_py())
                    continue
                own = ids.values.to_numpy()
                flat = vectors.values.to_numpy().reshape(len(own), -1)
                found = list(shard.answers(own, flat, k, beam))
                a, b, c = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], names=["query_id", "vec_id", "score"]
                )

    return run


def build_index(vectors: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Graphs ``(shard, arrays)`` of ``vectors (vec_id, v)``, and ``(width, first, shards)``: the
    shards of each vector length."""
    spark = vectors.sparkSession
    own = Window.partitionBy("v").orderBy("vec_id")
    few = vectors.distinct().withColumn("r", F.row_number().over(own)).where(F.col("r") <= k + 1)
    points = stage(few.groupBy("v").agg(F.collect_list("vec_id").alias("ids")).withColumn("width", F.size("v")), "vectors")
    widths = points.groupBy("width").count()
    size = F.greatest(F.col("count") / SHARD_POINTS, F.col("count") * F.col("width") * 8 / SHARD_BYTES)
    count = F.greatest(F.lit(1), F.ceil(size))
    # One row per vector length.
    shards = widths.select("width", count.alias("shards"), (F.sum(count).over(
        Window.orderBy("width").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - count).alias("first"))
    dealt = points.join(shards, "width").select(
        (F.col("first") + F.pmod(F.xxhash64("v"), F.col("shards"))).alias("shard"), "v", "ids"
    )
    parts = max(partitions(spark), 1)
    index = map_batches(dealt.repartition(parts, "shard").sortWithinPartitions("shard"), _build, "shard long, arrays array<binary>")
    return stage(index, "vector-graphs"), stage(shards, "vector-shards")


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, beam: int = BEAM, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows of ``vectors`` to each row of
    ``queries`` by cosine (runs jobs)."""

    def clean(df: DataFrame) -> DataFrame:
        wide = F.transform(quoted(vector_col), lambda x: x.cast("double"))
        rows = df.where(usable(quoted(vector_col)) & quoted(id_col).isNotNull())
        return rows.select(quoted(id_col).cast("long").alias("vec_id"), wide.alias("v"))

    index, shards = build_index(clean(vectors), k)
    asked = clean(queries).distinct().withColumn("width", F.size("v"))
    blocks = (
        asked.withColumn("block", F.floor(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) / _block_share(asked)))
        .groupBy("width", "block").agg(F.collect_list(F.struct("vec_id", "v")).alias("q"))
        .select("width", F.col("q.vec_id").alias("ids"), F.flatten("q.v").alias("vectors"))
    )
    sent = blocks.join(shards, "width").select(
        F.explode(F.sequence(F.col("first"), F.col("first") + F.col("shards") - 1)).alias("shard"),
        F.lit(None).cast("array<binary>").alias("arrays"), "ids", "vectors",
    )
    graphs = index.select("shard", "arrays", F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<double>").alias("vectors"))
    rows = graphs.unionAll(sent).repartition("shard").sortWithinPartitions("shard", F.col("arrays").isNull())
    found = map_batches(rows, _search(k, beam), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _block_share(asked: DataFrame) -> int:
    """Hash values per block, so that a block holds about QUERY_BLOCK queries."""
    return max(1, (QUERY_BLOCK << 20) // max(asked.count(), QUERY_BLOCK))


__all__ = ["Graph", "build_index", "nearest", "usable"]
