"""Exact top-k inner products with a KD-tree for each shard.

A shard is a bounded run of rows of an input partition; its tree splits at the
median of the widest dimension and keeps the tight bounding box of each node.
A search visits nodes in order of their best possible score,
sum(max(q * low, q * high)), and stops when that is below the k-th score so far.
The k-th score starts from what the block of queries scores against itself, so
every shard prunes from its first node on.  Queries come in bounded blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import scratch, tuned

SHARD_ROWS = 8192
LEAF_ROWS = 128
#: Queries that are broadcast together, 4 MB at 64 dimensions.
QUERY_BLOCK = 8192
#: Vectors with longer components are multiplied as Python integers: products
#: of shorter ones stay below 2**53.
EXACT = 1 << 26
#: Scores beyond these come back as these.
LEAST, MOST = -(1 << 63), (1 << 63) - 1


class KdTree:
    """Rows of a shard in leaf order, with the boxes of all nodes."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order = np.arange(len(ids))
        self.child: list[tuple[int, int]] = []  # numbers of both children, or (-1, -1)
        self.span: list[tuple[int, int]] = []
        low, high, todo = [], [], [(0, len(ids), -1, 0)]
        while todo:
            i, j, parent, side = todo.pop()
            here = len(self.span)
            if parent >= 0:
                pair = list(self.child[parent])
                pair[side] = here
                self.child[parent] = tuple(pair)
            rows = points[order[i:j]]
            lo, hi = rows.min(axis=0), rows.max(axis=0)
            self.child.append((-1, -1))
            self.span.append((i, j))
            low.append(lo)
            high.append(hi)
            if j - i > LEAF_ROWS and (wide := hi - lo).any():
                mid = (j - i) // 2
                order[i:j] = order[i:j][np.argpartition(rows[:, int(np.argmax(wide))], mid)]
                todo += [(i, i + mid, here, 0), (i + mid, j, here, 1)]
        self.ids, self.points = ids[order], points[order]
        self.low, self.high = np.array(low), np.array(high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Best possible score of each query (row) in each node."""
        return _held(np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T)

    def search(self, query: np.ndarray, own: int, bounds: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """At most k (score, -id) of scores of at least ``floor``, best first."""
        best: list[tuple[int, int]] = []
        todo = [(-bounds[0], 0)]
        while todo:
            bound, node = heapq.heappop(todo)
            if -bound < floor:
                break
            left, right = self.child[node]
            if left >= 0:
                for c in (left, right):
                    if bounds[c] >= floor:
                        heapq.heappush(todo, (-bounds[c], c))
                continue
            i, j = self.span[node]
            scores = _held(self.points[i:j] @ query)
            for r in np.flatnonzero(scores >= floor).tolist():
                entry = (int(scores[r]), -int(self.ids[i + r]))
                if -entry[1] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                floor = max(floor, best[0][0])
        return sorted(best, reverse=True)


def _held(scores: np.ndarray) -> np.ndarray:
    """Whole numbers cut to the range of a long; floats here never pass it."""
    return np.clip(scores, LEAST, MOST) if scores.dtype == object else scores


def _matrix(vectors: pa.Array, scale: float) -> np.ndarray:
    """floor(scale * x) of vectors of one length: float64 where all products
    are exact in it, else Python integers."""
    ends = vectors.offsets.to_numpy()
    x = vectors.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    q = np.floor(scale * x.reshape(len(vectors), int(ends[1] - ends[0])))
    if q.size and np.abs(q).max() * np.sqrt(q.shape[1]) >= EXACT:
        return _whole(q)
    return q


def _whole(q: np.ndarray) -> np.ndarray:
    """The same numbers as Python integers, which never overflow."""
    out = np.empty(q.shape, object)
    out[...] = [[int(v) for v in row] for row in q.tolist()]
    return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Runs of up to SHARD_ROWS rows with vectors of one length."""
    held: dict[int, list[pa.RecordBatch]] = {}

    def out(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, pa.Array]:
        t = pa.Table.from_batches(parts).combine_chunks()
        return t.column(0).to_numpy(), t.column(1).combine_chunks()

    for b in batches:
        sizes = np.diff(b.column(1).offsets.to_numpy())
        for size in np.unique(sizes).tolist():
            held.setdefault(size, []).append(b.filter(pa.array(sizes == size)) if (sizes != size).any() else b)
            if sum(p.num_rows for p in held[size]) >= SHARD_ROWS:
                yield out(held.pop(size))
    for parts in held.values():
        yield out(parts)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``is_query`` names the
    ``k`` other rows with the highest integer inner product, ties to the
    smaller id.

    Components become floor(scale * x).  Vectors that are null or hold null or
    non-finite components take no part, nor rows without an id.  Vectors of
    other lengths than the query's have no product with it.  Rows that share a
    query's id are its own; of several query rows of one id the smallest asks.
    Fewer candidates than ``k``: all of them.  A score beyond the range of a
    long is the end of that range, and ties there go to the smaller id as well.
    Empty tables give no rows; other columns are not read, whatever their names.
    """
    spark = tuned(vectors.sparkSession)
    # an infinite component makes the cast below infinite, never an error
    finite = F.forall(F.col(vector_col).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("asked"))
    asked = rows.where("asked").groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    while blocks > 1 and (asked.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).count().agg(F.max("count")).first()[0] or 0) > QUERY_BLOCK:
        blocks *= 2
    found = scratch(spark, "top-k")
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow().combine_chunks()
        _search(rows.select("vec_id", "v"), mine, k, scale).write.mode("append").parquet(found)
    hits = spark.read.schema("query_id long, vec_id long, score long").parquet(found)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(rows: DataFrame, asked: pa.Table, k: int, scale: float) -> DataFrame:
    queries: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for ids, vectors in _shards(iter(asked.to_batches())):
        size, m = len(vectors[0]), _matrix(vectors, scale)
        if size in queries:
            old = queries[size]
            if old[1].dtype != m.dtype:
                old, m = (old[0], _whole(old[1])), _whole(m)
            ids, m = np.concatenate([old[0], ids]), np.concatenate([old[1], m])
        queries[size] = ids, m
    floors = {}
    for size, (ids, m) in queries.items():
        # what the block scores against itself is a floor for each k-th score
        floors[size] = np.full(len(ids), -np.inf, object)
        if len(ids) > k:
            for at in range(0, len(ids), 256):
                s = _held(m[at : at + 256] @ m.T)
                for r, row in enumerate(s, at):
                    floors[size][r] = np.partition(np.delete(row, r), -k)[-k]
    shared = rows.sparkSession.sparkContext.broadcast((queries, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, vectors in _shards(batches):
            size = len(vectors[0])
            if size not in shared.value[0]:
                continue
            (q_ids, q), floor = shared.value[0][size], shared.value[1][size]
            points = _matrix(vectors, scale)
            if points.dtype != q.dtype:
                points, q = _whole(points), _whole(q)
            tree = KdTree(ids, points)
            hits: list[tuple[int, int, int]] = []
            for at in range(0, len(q_ids), 256):
                bounds = tree.bounds(q[at : at + 256])
                for r, row in enumerate(bounds, at):
                    hits += [(int(q_ids[r]), -i, s) for s, i in tree.search(q[r], int(q_ids[r]), row, k, floor[r])]
            if hits:
                a, b, c = zip(*hits)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64())], names=["query_id", "vec_id", "score"])

    return rows.mapInArrow(run, "query_id long, vec_id long, score long")
