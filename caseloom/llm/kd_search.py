"""Exact top-k search by inner product with a KD-tree per shard.

Vectors are scaled to integers and dealt into shards by hash. A shard's tree splits at the median of the widest
component; every node has its tight bounding box. A box bounds a query's score by the sum of the larger of q * low and
q * high over the components. Search pops nodes by falling bound and ends when the best bound is below the kth score.
Each query first searches the shard it lives in; the kth score it finds there goes with it to all other shards, which
return only what reaches it. Queries and vectors meet in cells of one shard and one block of queries, both of bounded
size, so no task holds all queries or all vectors.

Defined cases. See vectors.usable for ids and vectors that take no part; vectors of other lengths than the query's are no
candidates. Ties go to the smaller id. Fewer than k candidates: all of them. Scores are exact; one beyond a signed
64-bit integer raises.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.vectors import ids, matrix, ranked, usable
from caseloom.session import cut_lineage

SHARD_ROWS, BLOCK_ROWS, LEAF = 8192, 2048, 64
FOUND = "query_id long, vec_id long, score long"


class Tree:
    """Rows of one shard, in the order of the leaves; node 0 is the root."""

    def __init__(self, vec_id: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        self.vec_id, self.points = vec_id, points
        order = np.arange(len(points))
        self.span: list[tuple[int, int]] = []
        self.child: list[tuple[int, int] | None] = []
        low, high = [], []
        todo = [(0, len(points), -1)]
        while todo:
            a, b, parent = todo.pop()
            node = len(self.span)
            if parent >= 0:
                self.child[parent] = (*(self.child[parent] or ()), node)
            rows = points[order[a:b]]
            lo, hi = rows.min(axis=0), rows.max(axis=0)
            self.span.append((a, b))
            self.child.append(None)
            low.append(lo)
            high.append(hi)
            wide = int(np.argmax(hi - lo))
            if b - a > leaf and hi[wide] > lo[wide]:
                mid = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(rows[:, wide], mid)]
                todo += [(a + mid, b, node), (a, a + mid, node)]
        self.vec_id, self.points = vec_id[order], points[order]
        self.low, self.high = np.array(low), np.array(high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Highest score that a row of each node can have, by query and node."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query_id: int, query: np.ndarray, bound: np.ndarray, k: int, floor) -> list[tuple]:
        """Up to k (score, vec_id) of the best, those that reach `floor`; best-first over the nodes."""
        top: list[tuple] = []  # a heap: the worst of the best on top
        kth = floor
        nodes = [(-bound[0], 0)]
        while nodes:
            least, node = heapq.heappop(nodes)
            if kth is not None and -least < kth:
                break
            if self.child[node]:
                for child in self.child[node]:
                    if kth is None or bound[child] >= kth:
                        heapq.heappush(nodes, (-bound[child], child))
                continue
            a, b = self.span[node]
            scores = self.points[a:b] @ query
            near = np.flatnonzero(scores >= kth) if kth is not None else np.arange(b - a)
            near = near[self.vec_id[a + near] != query_id]
            if len(near) > 4 * k:  # many at once: only the best k of them by score and id can count
                near = near[np.lexsort((self.vec_id[a + near], -scores[near]))[:k]]
            for i in near:
                item = (scores[i], -int(self.vec_id[a + i]))
                if len(top) < k:
                    heapq.heappush(top, item)
                elif item > top[0]:
                    heapq.heapreplace(top, item)
                if len(top) == k and (kth is None or top[0][0] > kth):
                    kth = top[0][0]
        return [(int(s), -v) for s, v in sorted(top, reverse=True)]


def _whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): floats while every sum stays exact in them, Python integers beyond."""
    scaled = np.floor(vectors * float(scale))
    most = float(np.abs(scaled).max(initial=0))
    return scaled if most * most * max(1, scaled.shape[1]) < 2.0**52 else np.array([[int(x) for x in row] for row in scaled], dtype=object).reshape(scaled.shape)


def _searched(vectors: pa.Table, queries: pa.Table, scale: int, k: int) -> list[tuple]:
    tree_points, points = _whole(matrix(vectors["embedding"]), scale), _whole(matrix(queries["embedding"]), scale)
    if tree_points.dtype != points.dtype:
        tree_points, points = tree_points.astype(object), points.astype(object)
        tree_points, points = (np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape) for m in (tree_points, points))
    tree = Tree(ids(vectors["vec_id"]), tree_points)
    bounds = tree.bounds(points)
    floors = queries["floor"].to_pylist() if "floor" in queries.column_names else [None] * len(points)
    out = []
    for i, q in enumerate(ids(queries["vec_id"]).tolist()):
        out += [(q, v, s) for s, v in tree.search(q, points[i], bounds[i], k, floors[i])]
    return out


def _table(rows: list[tuple]) -> pa.Table:
    q, v, s = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.int64())})


def _home(scale: int, k: int):
    """Search of a shard by the queries that live in it."""
    def run(cell: pa.Table) -> pa.Table:
        own = cell.filter(cell["is_query"])
        return _table(_searched(cell, own, scale, k) if own.num_rows else [])

    return run


def _away(scale: int, k: int):
    """Search of a shard by a block of queries from other shards."""
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        queries = queries.rename_columns([c.removeprefix("q_") for c in queries.column_names])
        return _table(_searched(vectors, queries, scale, k) if vectors.num_rows and queries.num_rows else [])

    return run


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) over vectors(vec_id, embedding); is_query is a condition on vec_id, SQL or a column."""
    v = usable(vectors).withColumn("is_query", F.expr(is_query) if isinstance(is_query, str) else is_query)
    sizes = v.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    shards, blocks = max(1, -(-sizes["n"] // shard_rows)), max(1, -(-sizes["q"] // block_rows))
    v = v.withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int"))
    home = cut_lineage(v.groupBy("dim", "shard").applyInArrow(_home(scale, k), FOUND), "home")
    if shards == 1:
        return ranked(home, k, "high")
    floors = home.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    asked = v.where("is_query").join(floors, F.col("vec_id") == F.col("query_id"), "left").select(
        "vec_id", "dim", "embedding", "floor", F.col("shard").alias("own"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> own").drop("own")
    asked = asked.select(*[F.col(c).alias(f"q_{c}") for c in asked.columns])  # both sides come from one frame
    dealt = v.select("vec_id", "dim", "embedding", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    cell = ["dim", "shard", "block"]
    away = dealt.groupBy(*cell).cogroup(asked.groupBy(*[f"q_{c}" for c in cell])).applyInArrow(_away(scale, k), FOUND)
    return ranked(home.union(away), k, "high")
