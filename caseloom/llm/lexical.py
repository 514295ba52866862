"""Ranked lexical search, term at a time with limited accumulators.

One pass over all documents keeps, of each, the terms that any query of the block asks for, with their counts. A worker
gathers these into shards of posting lists and answers every query shard by shard. A query's terms come rarest first; a
document gets an accumulator when one of them finds it, until the bounds of the terms left cannot lift a new document to
the kth partial score (of this shard or of the worker's earlier ones). From then on only the accumulators that can still
reach it are updated, exactly. The workers' best k of each query meet in one ranking.

Terms are the runs of characters other than ASCII controls, blanks and punctuation, A-Z lower-cased. With N documents
that have a term, L terms in them, n terms in a document, tf of them the term, df documents with the term:
weight floor(1000 ln((2N + 2) / (2 df + 1))), score weight * (10^9 tf div (1000 tf + 8 (25 + 75 n N div L))), summed over
the query's terms, repeats included.

Defined cases. Null and blank texts hold no terms and are no documents. Documents without an id count in N, L and df but
aren't listed. Repeated rows are documents of their own; rows of the queries that are equal in id and text are one query.
A query without a term that is held anywhere, an empty table on either side: no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import cut_lineage

BLOCK_BYTES = 1 << 24  # text of the queries that are answered together, and so the size of what is broadcast
SHARD_POSTINGS = 1 << 21
_LETTERS = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes((b + 32 if 0x41 <= b < 0x5B else b) if b in _LETTERS else 0x20 for b in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


def _listed(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, terms, tfs): length and asked terms of every document that has a term."""
    number = shared.value.get
    for batch in batches:
        doc_ids, n, at, flat, tfs = [], [], [0], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            found = terms(text.as_py() or "")
            if not found:
                continue
            counts = Counter(map(number, found))
            counts.pop(None, None)
            doc_ids.append(doc_id)
            n.append(len(found))
            flat += counts.keys()
            tfs += counts.values()
            at.append(len(flat))
        at = pa.array(at, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(flat, pa.int32())),
             pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))], names=["doc_id", "n", "terms", "tfs"])


class Shard:
    """Posting lists of some documents: for each term the documents that hold it and the unweighted scores it gives them."""

    def __init__(self, doc_id: np.ndarray, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, docs: int, length: int, terms: int):
        self.doc_id = doc_id
        m = 25 + (75 * n * docs) // length
        doc = np.repeat(np.arange(len(doc_id)), sizes)
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
        order = np.argsort(term, kind="stable")
        order = order[impact[order] > 0]  # what adds nothing finds nothing
        self.doc, self.impact = doc[order], impact[order]
        self.at = np.searchsorted(term[order], np.arange(terms + 1))
        held = np.flatnonzero(np.diff(self.at))
        self.most = np.zeros(terms, np.int64)
        if len(held):
            self.most[held] = np.maximum.reduceat(self.impact, self.at[held])
        self.sums = np.zeros(len(doc_id), np.int64)

    def search(self, query: list[tuple[int, int]], k: int, floor: int) -> tuple[list[tuple[int, int]], int]:
        """Best k (score, doc_id), those that reach `floor`, and the number of accumulators made.

        query: (term, weight) with the rarest first.
        """
        bound = np.array([self.most[t] * w for t, w in query], dtype=np.int64)
        left = np.append(np.cumsum(bound[::-1])[::-1], 0)  # what the terms from here on can add
        sums, made, kth, step = self.sums, np.zeros(0, np.int64), floor, 0
        while step < len(query) and left[step] >= kth and left[step] > 0:
            t, w = query[step]
            step += 1
            a, b = self.at[t], self.at[t + 1]
            if a == b:
                continue
            docs = self.doc[a:b]
            made = np.concatenate([made, docs[sums[docs] == 0]])
            sums[docs] += w * self.impact[a:b]
            if len(made) >= k:
                kth = max(kth, int(np.partition(sums[made], len(made) - k)[len(made) - k]))
        live = np.sort(made[sums[made] + left[step] >= kth])
        score = sums[live]
        sums[made] = 0
        for (t, w), rest in zip(query[step:], left[step + 1 :], strict=True):
            a, b = self.at[t], self.at[t + 1]
            if a == b or not len(live):
                continue
            docs = self.doc[a:b]
            at = np.minimum(np.searchsorted(docs, live), b - a - 1)
            score += np.where(docs[at] == live, w * self.impact[a + at], 0)
            if len(live) > 4 * k:
                kth = max(kth, int(np.partition(score, len(score) - k)[len(score) - k]))
                live, score = (x[score + rest >= kth] for x in (live, score))
        doc_id = self.doc_id[live]
        best = np.lexsort((doc_id, -score))[:k]
        return [(int(score[i]), int(doc_id[i])) for i in best if score[i] > 0 and score[i] >= floor], len(made)


def _searched(batches: Iterator[pa.RecordBatch], shared, docs: int, length: int, k: int, most: int) -> Iterator[pa.RecordBatch]:
    """A worker's best k of each query."""
    queries, n_terms = shared.value
    top: list[list[tuple[int, int]]] = [[] for _ in queries]
    held: list[tuple[np.ndarray, ...]] = []

    def answer() -> None:
        doc_id, n, sizes, term, tf = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        shard = Shard(doc_id, n, sizes, term, tf, docs, length, n_terms)
        for q, query in enumerate(queries):
            floor = -top[q][-1][0] if len(top[q]) == k else 1
            found, _ = shard.search(query, k, floor)
            if found:
                top[q] = sorted([*top[q], *((-s, d) for s, d in found)])[:k]

    for batch in batches:
        lists, tfs = batch.column("terms"), batch.column("tfs")
        sizes = np.diff(lists.offsets.to_numpy())
        known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        kept = np.repeat(known, sizes)
        held.append((batch.column("doc_id").drop_null().to_numpy(), batch.column("n").to_numpy()[known], sizes[known],
                     lists.flatten().to_numpy()[kept], tfs.flatten().to_numpy()[kept]))
        if sum(len(x[3]) for x in held) >= most:
            answer()
    if held:
        answer()
    rows = [(q, d, -s) for q, best in enumerate(top) for s, d in best]
    q, d, s = zip(*rows, strict=True) if rows else ((), (), ())
    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(d, pa.int64()), pa.array(s, pa.int64())], names=["query", "doc_id", "score"])


def _answered(docs: DataFrame, items: pa.Table, k: int, shard_postings: int) -> DataFrame:
    """(query, doc_id, score): the best k of each row of items, by its number."""
    sc = docs.sparkSession.sparkContext
    asked = [Counter(terms(t or "")) for t in items["text"].to_pylist()]
    number = {t: i for i, t in enumerate(sorted(set().union(*asked)))}
    lists = cut_lineage(docs.mapInArrow(partial(_listed, shared=sc.broadcast(number)), "doc_id long, n long, terms array<int>, tfs array<long>"), "terms")
    n_docs, length = lists.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(number), np.int64)
    for t, n in lists.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row a term of the queries
        df[t] = n
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df]
    queries = [sorted(((number[t], q * weight[number[t]]) for t, q in a.items() if df[number[t]] and weight[number[t]] > 0),
                      key=lambda x: (df[x[0]], x[0])) for a in asked]
    found = lists.where(F.size("terms") > 0).mapInArrow(
        partial(_searched, shared=sc.broadcast((queries, len(number))), docs=n_docs, length=length or 1, k=k, most=shard_postings),
        "query int, doc_id long, score long")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "doc_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best of docs(doc_id, text) for each query of items(item_id, text).

    Queries are answered in blocks of about `block_bytes` of text, each over all documents.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    blocks = 1 + (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes
    found = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow()  # about block_bytes
        names = part.select(["item_id"]).append_column("query", pa.array(range(part.num_rows), pa.int32()))
        best = _answered(docs, part, k, shard_postings).join(F.broadcast(spark.createDataFrame(names)), "query")
        best = best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        best = cut_lineage(best, "best") if blocks > 1 else best
        found = best if found is None else found.union(best)
    return found
