"""Approximate nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into balanced partitions: recursive bisection at the median of the
graph's slowest direction, then swaps that raise the number of neighbours kept together. A small network learns from a
vector to the share of its neighbours in each partition. Every row goes to its most probable partition; a query searches
the partitions the network finds most probable, by exact distance on the original vectors, until `mass` of the
probability, at least `probes` partitions and more than k rows are covered.

Partitions of any size are split into cells of about `cell_rows` by hash, and a partition's queries into blocks, so
neither a common vector nor a common query gathers in one task. The sample (`sample` rows of the smallest hash) is all
that reaches the driver.

Defined cases. See vectors.usable for ids and vectors that take no part, zero vectors among them; vectors of other lengths
than the query's are no candidates. Ties go to the smaller id. Fewer than k candidates: all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.vectors import ids, matrix, ranked, usable
from caseloom.session import cut_lineage

SAMPLE, PARTITIONS, NEIGHBOURS, HIDDEN = 8192, 16, 10, 128
PROBES, MASS = 4, 0.98
CELL_ROWS, BLOCK_ROWS = 4096, 1024
FOUND = "query_id long, vec_id long, score double"


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k nearest other rows of each row."""
    out, square = np.empty((len(x), k), np.int64), (x * x).sum(axis=1)
    for a in range(0, len(x), 1024):
        d = square[None, :] - 2 * (x[a : a + 1024] @ x.T)
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        out[a : a + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_cut(graph: np.ndarray, parts: int, seed: int = 3, rounds: int = 12) -> np.ndarray:
    """Partition of each row; sizes differ by at most one a bisection."""
    n, rng = len(graph), np.random.default_rng(seed)
    label = np.zeros(n, np.int64)
    done = 1
    while done < parts:
        new = label.copy()
        for p in range(done):
            rows = np.flatnonzero(label == p)
            new[rows] = 2 * p + _bisected(graph, rows, rng, rounds)
        label, done = new, 2 * done
    return label


def _bisected(graph: np.ndarray, rows: np.ndarray, rng: np.random.Generator, rounds: int) -> np.ndarray:
    """0 or 1 for each of the rows, half each, with few edges between the halves."""
    place = np.full(len(graph), -1)
    place[rows] = np.arange(len(rows))
    to = place[graph[rows]]
    inside = to >= 0
    a, b = np.repeat(np.arange(len(rows)), inside.sum(axis=1)), to[inside]
    a, b = np.concatenate((a, b)), np.concatenate((b, a))
    degree = np.bincount(a, minlength=len(rows)) + 1e-9
    v = rng.standard_normal(len(rows))
    for _ in range(60):  # the slowest direction of a walk on the graph, apart from the constant one
        v -= (v @ degree) / degree.sum()
        v = 0.5 * v + 0.5 * np.bincount(a, weights=v[b], minlength=len(rows)) / degree
        v /= np.abs(v).max() or 1.0
    side = np.zeros(len(rows), np.int64)
    side[np.argsort(v, kind="stable")[len(rows) // 2 :]] = 1
    for _ in range(rounds):
        toward = np.bincount(a, weights=2.0 * side[b] - 1, minlength=len(rows))  # neighbours on side 1 minus those on side 0
        gain = np.where(side == 0, toward, -toward)
        zero, one = (np.flatnonzero(side == s) for s in (0, 1))
        zero, one = zero[np.argsort(-gain[zero], kind="stable")], one[np.argsort(-gain[one], kind="stable")]
        m = min(len(zero), len(one))
        swaps = int((gain[zero[:m]] + gain[one[:m]] > 0).sum()) // 2
        if not swaps:
            break
        side[zero[:swaps]], side[one[:swaps]] = 1, 0
    return side


@dataclass
class Router:
    """One hidden layer; rows are scaled as the sample was."""

    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum(((x - self.mean) / self.scale) @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fitted(x: np.ndarray, parts: int, neighbours: int = NEIGHBOURS, epochs: int = 40, seed: int = 3) -> Router:
    """A router from a sample of vectors."""
    mean = x.mean(axis=0)
    scale = float(np.sqrt(((x - mean) ** 2).mean())) or 1.0
    dim, rng = x.shape[1], np.random.default_rng(seed)
    k = min(neighbours, len(x) - 1)
    if parts < 2 or k < 1:
        return Router(mean, scale, np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    graph = neighbour_graph(x, k)
    label = balanced_cut(graph, parts)
    target = np.zeros((len(x), parts))
    for column in (label[graph].T if k else []):
        target[np.arange(len(x)), column] += 1 / (k + 1)
    target[np.arange(len(x)), label] += 1 / (k + 1)
    z = (x - mean) / scale
    params = [rng.standard_normal((dim, HIDDEN)) * np.sqrt(2 / dim), np.zeros(HIDDEN), rng.standard_normal((HIDDEN, parts)) * np.sqrt(1 / HIDDEN), np.zeros(parts)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(epochs):
        rate = 0.003 * (1 - epoch / epochs) + 1e-4
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            hidden = np.maximum(z[rows] @ params[0] + params[1], 0)
            out = hidden @ params[2] + params[3]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            delta = (out / out.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            back = (delta @ params[2].T) * (hidden > 0)
            step += 1
            for i, grad in enumerate((z[rows].T @ back, back.sum(axis=0), hidden.T @ delta, delta.sum(axis=0))):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad * grad
                params[i] = params[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Router(mean, scale, *params)


def _placed(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        p = shared.value.probabilities(matrix(batch.column("embedding"))).argmax(axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.int32())], names=[*batch.schema.names, "part"])


def _routed(batches: Iterator[pa.RecordBatch], shared, rows: np.ndarray, probes: int, mass: float, enough: int) -> Iterator[pa.RecordBatch]:
    """Partitions to search, most probable first."""
    for batch in batches:
        if not batch.num_rows:
            continue
        p = shared.value.probabilities(matrix(batch.column("embedding")))
        order = np.argsort(-p, axis=1, kind="stable")
        sums = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
        held = np.cumsum(rows[order], axis=1)
        before = np.arange(p.shape[1])[None, :]
        more = (before < probes) | (np.c_[np.zeros(len(p)), sums[:, :-1]] < mass) | (np.c_[np.zeros(len(p)), held[:, :-1]] < enough)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([o[m].tolist() for o, m in zip(order, more, strict=True)], pa.list_(pa.int32()))], names=[*batch.schema.names, "parts"])


def _reranked(vectors: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    out: list[tuple] = []
    if vectors.num_rows and queries.num_rows:
        order = np.argsort(ids(vectors["vec_id"]))
        vec, x = ids(vectors["vec_id"])[order], np.ascontiguousarray(matrix(vectors["embedding"])[order])
        for q, y in zip(ids(queries["vec_id"]).tolist(), matrix(queries["embedding"]), strict=True):
            d = np.sqrt(((x - y) ** 2).sum(axis=1))
            d[vec == q] = np.inf
            near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1]) if len(d) > k else np.arange(len(d))
            near = near[np.argsort(d[near], kind="stable")][:k]  # rows are in the order of ids
            out += [(q, int(vec[i]), float(d[i])) for i in near if vec[i] != q]
    q, v, s = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})


def nearest(vectors: DataFrame, is_query, k: int = 10, sample: int = SAMPLE, partitions: int = PARTITIONS, probes: int = PROBES,
            mass: float = MASS, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) over vectors(vec_id, embedding); is_query is a condition on vec_id; score is the distance."""
    v = usable(vectors, zero=False)
    lengths = [r["dim"] for r in v.groupBy("dim").count().collect()]
    found = None
    for dim in sorted(lengths):
        part = _nearest(v.where(F.col("dim") == dim).drop("dim"), is_query, k, sample, partitions, probes, mass, cell_rows, block_rows)
        found = part if found is None else found.union(part)
    return ranked(found if found is not None else v.sparkSession.createDataFrame([], FOUND), k, "low")


def _nearest(v: DataFrame, is_query, k, sample, partitions, probes, mass, cell_rows, block_rows) -> DataFrame:
    spark = v.sparkSession
    some = v.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").toArrow()["embedding"]  # `sample` bounds it
    x = matrix(some)
    parts = 1
    while parts * 2 <= partitions and len(x) // (parts * 2) >= 2 * NEIGHBOURS:
        parts *= 2
    shared = spark.sparkContext.broadcast(fitted(x, parts))
    placed = cut_lineage(v.mapInArrow(partial(_placed, shared=shared), "vec_id long, embedding array<double>, part int"), "placed")
    rows = np.zeros(parts, np.int64)
    for r in placed.groupBy("part").count().collect():  # one row a partition
        rows[r["part"]] = r["count"]
    cells = np.maximum(1, -(-rows // cell_rows))

    asked = v.where(is_query).mapInArrow(
        partial(_routed, shared=shared, rows=rows, probes=probes, mass=mass, enough=k + 1), "vec_id long, embedding array<double>, parts array<int>")
    asked = cut_lineage(asked.select("vec_id", "embedding", F.explode("parts").alias("part")), "asked")
    wanted = np.zeros(parts, np.int64)
    for r in asked.groupBy("part").count().collect():
        wanted[r["part"]] = r["count"]
    blocks = np.maximum(1, -(-wanted // block_rows))

    def number(counts: np.ndarray):
        return F.array(*[F.lit(int(c)) for c in counts])[F.col("part")]

    dealt = placed.withColumn("cell", F.pmod(F.xxhash64("vec_id", "embedding"), number(cells)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), number(blocks) - 1)))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), number(blocks)).cast("int")).withColumn(
        "cell", F.explode(F.sequence(F.lit(0), number(cells) - 1)))
    key = ["part", "cell", "block"]
    return dealt.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(partial(_reranked, k=k), FOUND)
