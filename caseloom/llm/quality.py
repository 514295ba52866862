"""Quality classifier: Naive Bayes support vectors.

Indicators of word n-grams and word-shape n-grams, hashed into `BUCKETS`, are scaled by the log ratio of their smoothed
class counts; a linear hinge-loss model over them is fitted by dual coordinate descent; a logistic curve fitted on rows
the model hasn't seen turns margins into scores. Fitting uses a bounded sample of labelled rows: at most `per_class` of
each label, those with the smallest hash of their id. Scoring reads every whole text, in one pass without a shuffle.

Defined cases. Null text counts as empty; an empty text is scored by the intercept. A document labelled both ways
counts as 0. Without labelled rows of both classes the score is the share of label 1 among them, or 0.5 without any.
Null doc_id: scored, never learnt from. Repeated rows are scored alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm.frames import free_name
from caseloom.llm.words import SPACE, Words, chunks, salted

BUCKETS = 1 << 18
PER_CLASS = 4000
THRESHOLD = 0.3

# Classes of bytes in a word's shape; other bytes stand for themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("0") : ord("9") + 1] = ord("0")
_SHAPE[128:] = ord("a")


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted buckets of the distinct n-grams of each text."""
    seen = np.zeros(BUCKETS, dtype=bool)
    for _, _, buf, at in chunks(column):
        words = Words(buf, at)
        shape = _SHAPE[buf]
        turn = ~SPACE[buf]
        turn[1:] &= shape[1:] != shape[:-1]
        turn[words.start] = True
        shapes = words.hashed(shape, turn)
        again = np.zeros(len(shapes), bool)
        again[1:] = words.hash[1:] == words.hash[:-1]
        shapes[again] = salted(shapes[again], 99)  # a word said twice running has a shape of its own
        grams = [words.runs(words.hash, 1, 10), words.runs(words.hash, 2, 10), words.runs(shapes, 1, 20),
                 words.runs(shapes, 2, 20), words.runs(shapes, 3, 20)]
        grams = [((h & np.uint64(BUCKETS - 1)).astype(np.int64), first) for h, first in grams]
        for k in range(len(at) - 1):
            for h, first in grams:
                seen[h[first[k] : first[k + 1]]] = True
            found = np.flatnonzero(seen)
            seen[found] = False
            yield found


@dataclass
class Model:
    ratio: np.ndarray  # log-count ratio of each bucket
    weight: np.ndarray  # weight of each scaled indicator
    bias: float
    slope: float
    offset: float

    def margin(self, found: np.ndarray) -> float:
        r = self.ratio[found]
        norm = math.sqrt(float(r @ r)) or 1.0
        return float(self.weight[found] @ r) / norm + self.bias

    def score(self, found: np.ndarray) -> float:
        z = self.slope * self.margin(found) + self.offset
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def fit(rows: list[np.ndarray], labels: np.ndarray, prior: float, cost: float = 1.0, epochs: int = 20, seed: int = 5) -> Model:
    """rows: buckets of each sampled text; prior: share of label 1 among all labelled rows."""
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    if not len(rows) or labels.min() == labels.max():
        z = math.log(prior / (1 - prior)) if len(rows) else 0.0
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 1.0, z)
    counts = np.ones((2, BUCKETS))
    for found, label in zip(rows, labels, strict=True):
        counts[label, found] += 1
    counts /= np.bincount(labels, minlength=2)[:, None] + 2
    ratio = np.log(counts[1] / counts[0])
    held = np.arange(len(rows)) % 4 == 3
    if len(set(labels[~held])) < 2 or len(set(labels[held])) < 2:
        held[:] = False
    weight, bias = _descend([rows[i] for i in np.flatnonzero(~held)], labels[~held], ratio, cost, epochs, seed)
    model = Model(ratio, weight, bias, 1.0, 0.0)
    judged = held if held.any() else ~held
    margins = np.array([model.margin(rows[i]) for i in np.flatnonzero(judged)])
    model.slope, model.offset = _platt(margins, labels[judged], prior)
    return model


def _descend(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the squared hinge loss; the intercept is one more indicator."""
    sign = np.where(labels == 1, 1.0, -1.0)
    share = np.bincount(labels, minlength=2) / len(labels)
    slack = 1 / (2 * cost * (0.5 / share[labels]))  # both classes weigh the same
    values = [(r := ratio[found]) / (math.sqrt(float(r @ r)) or 1.0) for found in rows]
    curve = np.array([float(v @ v) for v in values]) + 1.0 + slack
    alpha, weight, bias = np.zeros(len(rows)), np.zeros(BUCKETS), 0.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            found, v = rows[i], values[i]
            slope = sign[i] * (float(weight[found] @ v) + bias) - 1 + slack[i] * alpha[i]
            if alpha[i] == 0 and slope >= 0:
                continue
            step = max(alpha[i] - slope / curve[i], 0.0) - alpha[i]
            alpha[i] += step
            weight[found] += step * sign[i] * v
            bias += step * sign[i]
            most = max(most, abs(slope))
        if most < 1e-3:
            break
    return weight, bias


def _platt(margins: np.ndarray, labels: np.ndarray, prior: float) -> tuple[float, float]:
    """Logistic curve through margins, weighted so that the classes have the shares of all labelled rows."""
    share = max(labels.mean(), 1e-9)
    heavy = np.where(labels == 1, prior / share, (1 - prior) / max(1 - share, 1e-9))
    n1, n0 = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        d, h = heavy * (p - target), heavy * p * (1 - p) + 1e-12
        g = np.array([d @ margins + 1e-3 * (a - 1), d.sum()])
        hess = np.array([[(h * margins) @ margins + 1e-3, h @ margins], [h @ margins, h.sum() + 1e-9]])
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(max(a, 0.0)), float(b)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(list(features(batch.column("text"))), pa.list_(pa.int64()))], names=["doc_id", "found"])


def learnt(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, label: str = "quality") -> Model:
    """A model from docs(doc_id, text) and labels(doc_id, quality); ids with crc32(doc_id) mod 5 = 0 are held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("y")).where("y in (0, 1) and doc_id is not null")
    known = known.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).groupBy("doc_id").agg(F.min("y").cast("int").alias("y"))
    known = known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("y = 0").orderBy(*order).limit(per_class).union(known.where("y = 1").orderBy(*order).limit(per_class))
    ids = dict(chosen.collect())  # at most 2 * per_class rows
    if not ids:
        return fit([], np.zeros(0, np.int64), 0.5)
    small = docs.sparkSession.createDataFrame([(i,) for i in ids], "doc_id long")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(small), "doc_id", "left_semi")
    found: dict[int, np.ndarray] = {}
    for part in texts.mapInArrow(_extracted, "doc_id long, found array<long>").toArrow().to_batches():
        column = part.column("found")
        for k, i in enumerate(part.column("doc_id").to_pylist()):
            buckets = column[k].values.to_numpy()
            found[i] = buckets if i not in found else np.union1d(found[i], buckets)
    order = sorted(found)
    return fit([found[i] for i in order], np.array([ids[i] for i in order], dtype=np.int64), total.get(1, 0) / max(1, sum(total.values())))


def scored(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """docs with one more column, the score of `text`; `column` must be a free name.

    Only texts go to a worker and only scores come back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # three arrays of BUCKETS values

    @F.arrow_udf(T.DoubleType())
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in texts:
            yield pa.array([shared.value.score(found) for found in features(text)], pa.float64())

    return docs.withColumn(column, score(F.col("text").cast("string")))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pipeline form: the rows of docs whose score reaches the threshold."""
    column = free_name(docs, "score")
    return scored(docs, learnt(docs, labels), column).where(F.col(column) >= threshold).drop(column)
