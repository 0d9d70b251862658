"""Exact top-k inner products through a pivot-distance index.

Every vector is stored under its nearest pivot and its distance from it, in the order (dimension, pivot,
distance), so that a run of rows is an annulus around a pivot. A task visits the annuli of its rows
in the order of their bounds. For an annulus [low, high] around pivot p the triangle inequality gives
d(q, x) >= max(0, d(q, p) - high, low - d(q, p)), and with it an upper bound of the inner product
(|q|^2 + |x|^2 - d^2) / 2. A query whose bound is below its k-th best score so far skips the annulus.

Pivots are a bounded sample (``pivots``); a second bounded sample (``probes``) gives each query a first
threshold, which is the score of real rows and so never too high. All rows are indexed and searched; rows of the same
pivot and distance are told apart by id when the index is cut into partitions, so a repeated vector is no hot spot.
Queries reach the tasks in blocks of at most about ``block`` rows, one after another: the results of a block are stored
and its broadcast is dropped before the next one is read. Scores are 64-bit numbers; sums that a float holds exactly are made as floats.

Cases: a vector that is null, or holds a null, NaN or infinite component, and a row without an id, take no part.
Vectors meet only those of the same length (the empty vector too, with score 0). Repeated rows of one id are
candidates each on its own, but never of a query with their id; a repeated query row counts once. Ties go to the smaller
id. Other columns are ignored. Inner products must fit 64 bits.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..sinks.stage import stage

RING = 256
_NONE = 1 - 2**63  # no score; products are larger


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): floor(256 * x) of every component, for the rows that take part."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & fine).select(
        F.col(key).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(c * 256)).alias("v"),
    )


def _sample(vectors: DataFrame, rows: int, seed: int) -> list:
    """``rows`` vectors, the same for the same table."""
    return vectors.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(rows).collect()


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


def _by_length(rows: list) -> dict[int, np.ndarray]:
    """Vectors by length, with the origin first."""
    out = defaultdict(list)
    for r in rows:
        out[len(r["v"])].append(r["v"])
    return {n: np.array([[0] * n, *vs], dtype=np.float64) for n, vs in out.items()}


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: as floats where no sum can reach 2^53, else as 64-bit numbers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    wide, other = a.astype(np.float64), b.astype(np.float64)
    if np.sqrt((wide**2).sum(1).max()) * np.sqrt((other**2).sum(1).max()) < 2.0**52:
        return (wide @ other.T).astype(np.int64)
    return a @ b.T


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), length)


def build_index(vectors: DataFrame, pivots: int = 32, partitions: int | None = None) -> tuple[DataFrame, dict]:
    """The stored index (id, v, n, pivot, distance) and the pivots by length of the vectors."""
    spark = vectors.sparkSession
    centres = _by_length(_sample(vectors, pivots, 1))
    shared = spark.sparkContext.broadcast(centres)
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("v", T.ArrayType(T.LongType())),
        T.StructField("n", T.IntegerType()), T.StructField("pivot", T.IntegerType()),
        T.StructField("distance", T.DoubleType()),
    ])

    def nearest(batches):
        for batch in batches:
            lengths = np.asarray(batch.column(1).value_lengths())
            for n in np.unique(lengths):
                part = batch.filter(pa.array(lengths == n))
                centre = shared.value.get(int(n), np.zeros((1, n)))
                d = _distances(_matrix(part.column(1), int(n)).astype(np.float64), centre)
                best = d.argmin(1)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(np.full(len(best), n), pa.int32()),
                    pa.array(best, pa.int32()), pa.array(d[np.arange(len(best)), best], pa.float64()),
                ], names=schema.names)

    keyed = vectors.mapInArrow(nearest, schema)
    order = ("n", "pivot", "distance", "id")
    spread = keyed.repartitionByRange(partitions, *order) if partitions else keyed.repartitionByRange(*order)
    return stage(spread.sortWithinPartitions(*order), "pivot-index"), centres


class _Search:
    """The best ``k`` of a block of queries of one length over the rows seen so far."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, floor: np.ndarray, centre: np.ndarray, k: int) -> None:
        self.ids, self.q, self.k = ids, q, k
        self.wide = q.astype(np.float64)
        self.norms = (self.wide**2).sum(1)
        self.to_pivots = _distances(self.wide, centre)
        self.floor = floor
        self.score = np.full((len(ids), k), _NONE)
        self.best = np.full((len(ids), k), np.iinfo(np.int64).max)

    def add(self, pivot: int, low: float, high: float, ids: np.ndarray, x: np.ndarray, bound: np.ndarray) -> None:
        active = np.flatnonzero(bound >= np.maximum(self.floor, self.score[:, -1]))
        if not len(active):
            return
        scores = _products(self.q[active], x)
        scores[self.ids[active][:, None] == ids[None, :]] = _NONE
        hit = scores.max(1) >= np.maximum(self.floor, self.score[:, -1])[active]
        active, scores = active[hit], scores[hit]
        if not len(active):
            return
        scores[scores < self.floor[active][:, None]] = _NONE
        s = np.concatenate([self.score[active], scores], 1)
        i = np.concatenate([self.best[active], np.broadcast_to(ids, scores.shape)], 1)
        order = np.lexsort((i, -s), axis=1)[:, : self.k]
        self.score[active] = np.take_along_axis(s, order, 1)
        self.best[active] = np.take_along_axis(i, order, 1)

    def bounds(self, pivot: int, low: float, high: float, largest: float) -> np.ndarray:
        d = self.to_pivots[:, pivot]
        gap = np.maximum(0, np.maximum(d - high, low - d))
        # rounding of the distances must not cut off a row that ties
        return (self.norms + largest - gap**2) / 2 + 1e-6 * (self.norms + largest) + 1e-6


def _chunks(batch: pa.RecordBatch):
    """(length, pivot, rows) of the annuli of a sorted batch, at most RING rows each."""
    n, pivot = np.asarray(batch.column(2)), np.asarray(batch.column(3))
    cuts = np.flatnonzero((np.diff(n) != 0) | (np.diff(pivot) != 0)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(n)], strict=True):
        for start in range(a, b, RING):
            yield int(n[a]), int(pivot[a]), slice(start, min(b, start + RING))


def search(
    index: DataFrame, centres: dict, queries: DataFrame, k: int = 5, block: int = 4096, probes: int = 1024
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best rows of each query (id, v)."""
    spark = index.sparkSession
    queries = queries.dropDuplicates(["id", "v"])
    blocks = max(1, math.ceil(queries.count() / block))
    number = F.pmod(F.xxhash64("id", "v"), F.lit(blocks))
    sample = _sample(index.select("id", "v"), probes, 2)
    by_length: dict[int, list] = defaultdict(list)
    for r in sample:
        by_length[len(r["v"])].append((r["id"], r["v"]))
    schema = T.StructType([
        T.StructField(c, t) for c, t in (
            ("number", T.IntegerType()), ("query_id", T.LongType()), ("vec_id", T.LongType()), ("score", T.LongType()))
    ])
    found = None
    for b in range(blocks):
        asked: dict[int, list] = defaultdict(list)
        for at, r in enumerate(queries.where(number == b).collect()):
            asked[len(r["v"])].append((at, r["id"], r["v"]))
        sent = {}
        for n, rows in asked.items():
            ids = np.array([r[1] for r in rows], dtype=np.int64)
            q = np.array([r[2] for r in rows], dtype=np.int64).reshape(len(rows), n)
            floor = np.full(len(ids), _NONE)
            if len(near := by_length.get(n, [])) > k:
                s = _products(q, np.array([v for _, v in near], dtype=np.int64).reshape(len(near), n))
                s[ids[:, None] == np.array([i for i, _ in near])[None, :]] = _NONE
                floor = np.sort(s, 1)[:, -k]
            sent[n] = (np.array([r[0] for r in rows]), ids, q, floor, centres.get(n, np.zeros((1, n))))
        shared = spark.sparkContext.broadcast(sent)

        def visit(batches, shared=shared):
            running = {n: _Search(*x[1:], k) for n, x in shared.value.items()}
            for batch in batches:
                rings = []
                ids, distance = np.asarray(batch.column(0)), np.asarray(batch.column(4))
                for n, pivot, rows in _chunks(batch):
                    if n not in running:
                        continue
                    x = _matrix(batch.column(1).slice(rows.start, rows.stop - rows.start), n)
                    low, high = distance[rows][0], distance[rows][-1]
                    largest = float((x.astype(np.float64) ** 2).sum(1).max())
                    bound = running[n].bounds(pivot, low, high, largest)
                    rings.append((bound.mean(), n, pivot, low, high, ids[rows], x, bound))
                for _, n, *ring in sorted(rings, key=lambda r: -r[0]):
                    running[n].add(*ring)
            for n, s in running.items():
                q, j = np.nonzero(s.score > _NONE)
                order = shared.value[n][0]
                yield pa.RecordBatch.from_arrays([
                    pa.array(order[q], pa.int32()), pa.array(s.ids[q], pa.int64()), pa.array(s.best[q, j], pa.int64()),
                    pa.array(s.score[q, j], pa.int64()),
                ], names=schema.names)

        part = index.select("id", "v", "n", "pivot", "distance").mapInArrow(visit, schema)
        best = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("vec_id"))
        ranked = part.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        ranked = stage(ranked.select("query_id", "rank", "vec_id", "score"), "top-k")
        shared.destroy()
        found = ranked if found is None else found.unionByName(ranked)
    return found


def top_k(
    vectors: DataFrame, asked: Column, *, key: str = "vec_id", vector: str = "embedding", k: int = 5,
    pivots: int = 32, block: int = 4096, probes: int = 1024,
) -> DataFrame:
    """The ``k`` best other rows of every row for which ``asked`` (a condition on ``id``) holds."""
    rows = quantised(vectors, key, vector)
    index, centres = build_index(rows, pivots)
    return search(index, centres, index.where(asked).select("id", "v"), k, block, probes)
