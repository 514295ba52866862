"""Harmonic packing: documents cut into pieces of reciprocal-capacity classes, a fixed number of pieces to a sequence.

A piece of `length` tokens has class capacity // length: class k holds lengths in (capacity / (k + 1), capacity / k], and
k pieces of it fit whatever their lengths. Each worker tokenizes its documents, cuts them (whole sequences first, the tail
by `cuts`, a table of the cheapest cuts of every tail length) and fills the sequences of each class by itself, k pieces
each. What is left open at the end of a worker, under k pieces a class, is numbered over all workers by counts and filled
the same way; one sequence a class stays short in all, and is cut at the powers of two that its length is the sum of.

Defined cases. Null text counts as empty: its one id is `end_id`. Null doc_id and repeated rows are packed like others.
Texts of any length are packed whole. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.bpe import PATTERN, byte_letters
from caseloom.session import cut_lineage

CAPACITY = 2048
END_ID = 1
#: What one more piece may cost, in tokens of padding: fewer cuts against fuller sequences.
CUT_COST = 1.0
FLUSH = 1 << 19  # tokens handed on at once
PIECE = "doc_id long, start long, ids array<int>, doc_tokens long, sequence_id long, offset long"
OPEN = ", class int, part int, at long"


def cuts(capacity: int = CAPACITY, cut_cost: float = CUT_COST) -> np.ndarray:
    """First piece of the best cut of every tail length below capacity.

    A piece costs its share of the padding of a full sequence of its class, none if that is a power of two, and
    `cut_cost`; the cheapest sums follow from those of shorter tails.
    """
    length = np.arange(1, capacity + 1)
    k = capacity // length
    one = np.where(length & (length - 1) == 0, 0.0, (capacity - k * length) / k) + cut_cost
    best, first = np.concatenate(([0.0], one)), np.arange(capacity + 1)
    for n in range(2, capacity):
        both = one[: n - 1] + best[n - 1 : 0 : -1]
        at = int(both.argmin())
        if both[at] < best[n]:
            best[n], first[n] = both[at], at + 1
    return first


def lengths(n: int, first: np.ndarray) -> list[int]:
    """Lengths of the pieces of n tokens, in order."""
    capacity = len(first) - 1
    out = [capacity] * (n // capacity)
    n %= capacity
    while n:
        out.append(int(first[n]))
        n -= out[-1]
    return out


class Tokens:
    """Ids of whole texts, equal to the tokenizers library's for the same file.

    The file's pieces are read as ranks where the order of its merges is the order of their ids, as then the lowest rank
    is the first merge; other files, and texts that the ranked encoder refuses, go to the tokenizers library.
    """

    def __init__(self, spec: str):
        self.spec, self.library, self.ranked = spec, None, None
        held = json.loads(spec)
        model, added = held["model"], held["added_tokens"]
        vocab, special = model["vocab"], {t["content"]: t["id"] for t in added}
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        letters = byte_letters()
        base = {p: i for p, i in vocab.items() if p not in special}
        plain = held["normalizer"] is None and held["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        whole = sorted(merged) == merged and len(merged) + 256 == len(base) and not any(
            t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
        if plain and whole and not model["ignore_merges"] and not model["dropout"]:
            self.ranked = tiktoken.Encoding("file", pat_str=PATTERN.replace(r"\p{White_Space}", r"\s").replace(r"\P{White_Space}", r"\S"),
                                            mergeable_ranks={bytes(letters[c] for c in p): i for p, i in base.items()}, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        if self.ranked is not None:
            try:
                return self.ranked.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # white space by the hundred thousand exceeds its stack
                pass
        if self.library is None:
            self.library = tokenizers.Tokenizer.from_str(self.spec)
            self.library.no_truncation()
            self.library.no_padding()
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


class _Rows:
    """Pieces on their way out, as Arrow batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.tokens = schema, [], 0

    def add(self, doc_id, start: int, ids: np.ndarray, *rest) -> None:
        self.rows.append((doc_id, start, ids, *rest))
        self.tokens += len(ids)

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) if self.rows else [()] * len(self.schema)
        at = np.concatenate(([0], np.cumsum([len(i) for i in cols[2]]))).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.uint32), *cols[2]]).view(np.int32)
        arrays = [pa.array(c, f.type) if i != 2 else pa.ListArray.from_arrays(pa.array(at), pa.array(flat))
                  for i, (c, f) in enumerate(zip(cols, self.schema, strict=True))]
        self.rows, self.tokens = [], 0
        return pa.RecordBatch.from_arrays(arrays, names=self.schema.names)


_LONGS = {"doc_id": pa.int64(), "start": pa.int64(), "ids": pa.list_(pa.int32()), "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64()}
_PIECE = pa.schema(_LONGS)
_OPEN = pa.schema(_LONGS | {"class": pa.int32(), "part": pa.int32(), "at": pa.int64()})


def _filled(batches: Iterator[pa.RecordBatch], shared, first: np.ndarray, end_id: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a worker's documents, class by class in full sequences; the open ones at last, without a sequence."""
    tokens, capacity, part = Tokens(shared.value), len(first) - 1, TaskContext.get().partitionId()
    held: dict[int, list] = {}
    out, made = _Rows(_OPEN), 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            ids = np.append(tokens.ids(text.as_py() or ""), np.uint32(end_id))
            start = 0
            for n in lengths(len(ids), first):
                k = capacity // n
                row = held.setdefault(k, [])
                row.append((doc_id, start, ids[start : start + n].copy() if k > 1 else ids[start : start + n], len(ids)))
                start += n
                if len(row) == k:
                    offset = 0
                    for piece in row:
                        out.add(*piece, (part << 40) + made, offset, k, part, 0)
                        offset += len(piece[2])
                    made, held[k] = made + 1, []
                if out.tokens >= FLUSH:
                    yield out.batch()
    for k, row in held.items():
        for at, piece in enumerate(row):
            out.add(*piece, None, None, k, part, at)
    yield out.batch()


def _finished(bin_: pa.Table) -> pa.Table:
    """The pieces of one sequence; one that lacks pieces is cut into sequences of power-of-two lengths."""
    rows = sorted(bin_.to_pylist(), key=lambda r: r["number"])
    ids = [np.array(r["ids"], np.int32).view(np.uint32) for r in rows]
    total, k = sum(map(len, ids)), rows[0]["class"]
    ends = [total] if len(rows) == k else np.cumsum([1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]).tolist()
    base = (1 << 62) + (k << 46) + (rows[0]["bin"] << 5)
    out, at, segment, begun = _Rows(_PIECE), 0, 0, 0
    for r, piece in zip(rows, ids, strict=True):
        done = 0
        while done < len(piece):
            n = min(len(piece) - done, ends[segment] - at)
            out.add(r["doc_id"], r["start"] + done, piece[done : done + n], r["doc_tokens"], base + segment, at - begun)
            done, at = done + n, at + n
            if at == ends[segment]:
                segment, begun = segment + 1, at
    return pa.Table.from_batches([out.batch()])


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, cut_cost: float = CUT_COST) -> DataFrame:
    """Pieces (doc_id, start, ids, doc_tokens, sequence_id, offset) of docs(doc_id, text), tokenized by the file at `path`.

    capacity: a power of two up to 65,536.
    """
    with open(path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # the tokenizer's file, of fixed size
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = cut_lineage(docs.mapInArrow(partial(_filled, shared=shared, first=cuts(capacity, cut_cost), end_id=end_id), PIECE + OPEN), "pieces")
    rest = pieces.where("sequence_id is null").drop("sequence_id", "offset")
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rest.groupBy("class", "part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    numbered = rest.join(parts, ["class", "part"]).withColumn("number", F.col("before") + F.col("at"))
    bins = numbered.withColumn("bin", F.expr("number div class")).select("doc_id", "start", "ids", "doc_tokens", "class", "bin", "number")
    return pieces.where("sequence_id is not null").select(*_PIECE.names).unionByName(bins.groupBy("class", "bin").applyInArrow(_finished, PIECE))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        flat, at = ids.values.to_numpy().astype("<i4", copy=False), ids.offsets.to_numpy()
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(at, at[1:], strict=False)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64()),
             *(batch.column(c) for c in ("doc_tokens", "sequence_id", "offset"))],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces with length and CRC-32 of their ids (little-endian, 32 bits) in place of the ids."""
    return pieces.mapInArrow(
        _digests, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
