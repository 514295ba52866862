"""Byte-level BPE encoding and decoding with a minimal acyclic transducer of frequent words.

Words (pieces of the pre-tokenizer) are counted over all documents; the most frequent, up to `LEXICON`, are merged once
on the driver and compiled with their ids into a transducer whose outputs sum to the word's rank, the index of its ids.
Executors memory-map it. Each batch sends its distinct words through the transducer together; words it doesn't hold are
merged exactly, by the merge ranks. A worker keeps the ids of recent words, up to `RECENT`.

Results equal those of the tokenizers library for the same file with add_special_tokens=False: special tokens inside a
text become their id; decoding joins the bytes of the ids and replaces invalid UTF-8.

Defined cases. Null text counts as empty: no ids. Null doc_id, repeated rows and other columns pass through. Texts of
any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import tempfile
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm.frames import free_name
from caseloom.llm.lexicon import Lexicon, compile_words
from caseloom.session import cut_lineage

LEXICON = 50_000
RECENT = 200_000
LONG = 64
_NONE = np.iinfo(np.int64).max
#: Fixed value: the pre-tokenizer's pattern, with white space as Unicode's property of that name.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+".replace(r"\s", r"\p{White_Space}").replace(
    r"\S", r"\P{White_Space}")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """Vocabulary and merges of a tokenizer file; merges words exactly."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            raw = f.read()
        self.digest, spec = hashlib.sha256(raw).digest(), json.loads(raw)
        letters = byte_letters()
        raw = {piece: i for piece, i in spec["model"]["vocab"].items()}
        self.pieces: list[bytes] = [b""] * (1 + max([*raw.values(), *(t["id"] for t in spec["added_tokens"])]))
        for piece, i in raw.items():
            self.pieces[i] = bytes(letters[c] for c in piece)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            self.pieces[i] = content.encode()
        self.byte_id = [0] * 256
        for letter, b in letters.items():
            self.byte_id[b] = raw[letter]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for k, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[raw[left], raw[right]] = (k, raw[left + right])
        # the same as arrays, in the order of left * size + right
        size = len(self.pieces)
        table = np.array(sorted((left * size + right, k, new) for (left, right), (k, new) in self.rank.items()), dtype=np.int64).reshape(-1, 3)
        self.codes, self.ranks, self.joined = (np.ascontiguousarray(table[:, i]) for i in range(3))

    def merge(self, word: bytes) -> list[int]:
        return self.merge_all([word])[0].tolist()

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and how many each has: the pair of lowest rank, the leftmost of equals, is joined
        until none is left. Words up to LONG bytes take each step together."""
        out = [np.zeros(0, np.int64)] * len(words)
        for i, word in enumerate(words):
            if len(word) > LONG:
                out[i] = np.array(self._merge_long([self.byte_id[b] for b in word]))
        live = np.array([i for i, word in enumerate(words) if 0 < len(word) <= LONG], dtype=np.int64)
        length = np.array([len(words[i]) for i in live], dtype=np.int64)
        ids = np.array(self.byte_id)[np.frombuffer(b"".join(words[i] for i in live), np.uint8)]
        while len(live):
            first = np.cumsum(length) - length
            code = ids[:-1] * len(self.pieces) + ids[1:]
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            key = np.full(len(ids), _NONE)
            known = self.codes[at] == code
            key[:-1][known] = (self.ranks[at[known]] << 32) + np.flatnonzero(known)
            key[first + length - 1] = _NONE  # no pair reaches into the next word
            best = np.minimum.reduceat(key, first)
            done = best == _NONE
            if done.any():
                for i, a, n in zip(live[done], first[done], length[done], strict=True):
                    out[i] = ids[a : a + n]
            spot = (best[~done] & 0xFFFFFFFF).astype(np.int64)
            ids[spot] = self.joined[at[spot]]
            stay = np.repeat(~done, length)
            stay[spot + 1] = False
            ids, live, length = ids[stay], live[~done], length[~done] - 1
        return np.concatenate([np.zeros(0, np.int64), *out]).astype(np.uint32), np.array([len(o) for o in out], dtype=np.int64)

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap over a linked list, for words without a bound on their length."""
        after, prior = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(self.rank[p][0], i, p, self.rank[p][1]) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.rank]
        heapq.heapify(heap)
        while heap:
            _, i, (left, right), new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[i] >= 0:
                prior[after[i]] = i
            for a in (prior[i], i):
                if a >= 0 and after[a] >= 0 and (found := self.rank.get((ids[a], ids[after[a]]))):
                    heapq.heappush(heap, (found[0], a, (ids[a], ids[after[a]]), found[1]))
        return [i for i in ids if i >= 0]


class Splitter:
    """Texts into words and special tokens."""

    def __init__(self, special: dict[str, int]):
        self.special = special
        self.words = regex.compile(PATTERN)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def split(self, text: str) -> list[str]:
        """Words in order; a special token is given as it is written."""
        if self.marks is None or not any(s in text for s in self.special):
            return self.words.findall(text)
        out = []
        for k, part in enumerate(self.marks.split(text)):
            out.extend([part] if k % 2 else self.words.findall(part))
        return out


def _counted(batches: Iterator[pa.RecordBatch], special: dict[str, int], most: int) -> Iterator[pa.RecordBatch]:
    """Word counts; what has gathered is handed on whenever it outgrows `most` words."""
    splitter, counts = Splitter(special), Counter()

    def flushed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for text in batch.column("text"):
            counts.update(splitter.split(text.as_py() or ""))
            if len(counts) > most:
                yield flushed()
    yield flushed()


def frequent_words(docs: DataFrame, special: dict[str, int], n: int = LEXICON) -> list[str]:
    """The most frequent words of all texts: all that are said more often than a cutoff, which leaves n at most.

    The cutoff comes from a histogram of the counts, exact below 4096 and in sixteenths of a doubling above, so neither it
    nor the words that reach the driver grow with the data.
    """
    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        partial(_counted, special=special, most=200_000), "word string, n long")
    total = cut_lineage(counts.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1"), "words")
    step = F.when(F.col("n") < 4096, F.col("n")).otherwise(F.floor(F.log2("n") * 16) + 4096 - 12 * 16).cast("long")
    histogram = {r["step"]: r["words"] for r in total.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()}
    kept, cutoff = 0, None
    for s in sorted(histogram, reverse=True):
        if kept + histogram[s] > n:
            break
        kept, cutoff = kept + histogram[s], s
    if cutoff is None:
        return []
    return [r["word"] for r in total.where(step >= cutoff).select("word").collect() if r["word"] not in special]


class Encoder:
    """Made once in a worker: the mapped lexicon, the ids of its words and those of recent other words."""

    _made: dict[str, Encoder] = {}

    def __init__(self, parts: dict):
        self.merges, self.splitter = parts["merges"], Splitter(parts["merges"].special)
        with tempfile.TemporaryFile() as f:  # a file without a name: nothing stays when the worker ends
            f.write(parts["lexicon"])
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.lexicon, self.known_at, self.known_ids = Lexicon(self.map), parts["at"], parts["ids"]
        piece = [np.frombuffer(p, np.uint8) for p in self.merges.pieces]
        self.piece_len = np.array([len(p) for p in piece])
        self.piece_at = np.cumsum(self.piece_len) - self.piece_len
        self.piece_bytes = np.concatenate(piece)
        self.reset()

    def reset(self) -> None:
        self.row: dict[str, int] = {}
        self.ids, self.at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    @classmethod
    def of(cls, shared) -> Encoder:
        key = shared.value["key"]
        if key not in cls._made:
            cls._made.clear()
            cls._made[key] = cls(shared.value)
        return cls._made[key]

    def learn(self, words: set[str]) -> None:
        """Ids of words not met lately: out of the transducer, or merged."""
        new = [w for w in words if w not in self.row]
        if not new:
            return
        if len(self.row) + len(new) > RECENT and self.row:
            self.reset()
            new = list(words)
        marks = [w for w in new if w in self.merges.special]
        new = [w for w in new if w not in self.merges.special] if marks else new
        raw = [w.encode() for w in new]
        rank = self.lexicon.ranks(raw)
        held, rest = np.flatnonzero(rank >= 0), np.flatnonzero(rank < 0)
        start, length = self.known_at[rank[held]], np.diff(self.known_at)[rank[held]]
        merged, sizes = self.merges.merge_all([raw[i] for i in rest])
        names = [new[i] for i in (*held, *rest)] + marks
        ids = np.concatenate([_gathered(self.known_ids, start, length), merged, np.array([self.merges.special[w] for w in marks], np.uint32)])
        begin, ends = len(self.row), np.cumsum(np.concatenate([length, sizes, np.ones(len(marks), np.int64)]))
        self.row.update(zip(names, range(begin, begin + len(names)), strict=True))
        self.at = np.concatenate([self.at, self.at[-1] + ends])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, unsigned 32-bit."""
        split = [self.splitter.split(t) for t in texts]
        self.learn(set().union(*split))
        at, ids, out = self.at, self.ids, []
        for words in split:
            rows = np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))
            out.append(_gathered(ids, at[rows], at[rows + 1] - at[rows]))
        return out

    def decode(self, ids: np.ndarray) -> str:
        return _gathered(self.piece_bytes, self.piece_at[ids], self.piece_len[ids]).tobytes().decode("utf-8", "replace")


def _gathered(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """flat[start : start + length] of each, end to end."""
    ends = np.cumsum(length)
    if not len(ends):
        return flat[:0]
    return flat[np.arange(ends[-1]) + np.repeat(start - (ends - length), length)]


def encoder(docs: DataFrame, path: str, n: int = LEXICON):
    """A broadcast of what workers need: vocabulary, merges and the compiled lexicon, all of bounded size."""
    merges = Merges(path)
    words = sorted(w.encode() for w in frequent_words(docs, merges.special, n))
    flat, sizes = merges.merge_all(words)
    lexicon = compile_words(words)
    at = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    key = hashlib.sha256(merges.digest + lexicon).hexdigest()
    return docs.sparkSession.sparkContext.broadcast({"key": key, "merges": merges, "lexicon": lexicon, "at": at, "ids": flat})


def _encoded(batches: Iterator[pa.RecordBatch], shared, text: int, kept: int) -> Iterator[pa.RecordBatch]:
    """The first `kept` columns, the ids of the column numbered `text` and what they decode to."""
    coder = Encoder.of(shared)
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            ids = coder.encode([t or "" for t in part.column(text).to_pylist()])
            sizes = np.concatenate(([0], np.cumsum([len(i) for i in ids])))
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:kept], lists, pa.array([coder.decode(i) for i in ids], pa.string())],
                names=[*part.schema.names[:kept], *_encoded_names(part.schema.names[:kept])])


def _encoded_names(taken: list[str]) -> tuple[str, str]:
    def free(base: str) -> str:
        while base in {t.lower() for t in taken}:
            base += "_"
        return base

    return free("ids"), free("decoded")


def encoded(docs: DataFrame, path: str, n: int = LEXICON) -> DataFrame:
    """docs with two more columns (names made free by underscores): `ids` array<int> and `decoded`, the text they give back."""
    names = _encoded_names(docs.columns)
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.ArrayType(T.IntegerType())), T.StructField(names[1], T.StringType())])
    kept = len(docs.columns)
    if dict(docs.dtypes).get("text") == "string":  # goes to a worker once, not beside a copy of itself
        held, text = docs, docs.columns.index("text")
    else:
        held, text = docs.withColumn(free_name(docs, "whole_text"), F.col("text").cast("string")), kept
    return held.mapInArrow(partial(_encoded, shared=encoder(docs, path, n), text=text, kept=kept), schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids, decoded) into the digest columns."""
    for batch in batches:
        ids, n, hashes = batch.column("ids"), [], []
        flat, at = ids.values.to_numpy(), ids.offsets.to_numpy()
        for a, b in zip(at, at[1:], strict=False):
            n.append(int(b - a))
            hashes.append(hashlib.sha256(flat[a:b].astype("<u4").tobytes()).hexdigest())
        text = [hashlib.sha256(t.encode()).hexdigest() for t in batch.column("decoded").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(hashes), pa.array(text)],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def digests(docs: DataFrame) -> DataFrame:
    """docs(doc_id, ids, decoded) as token count and SHA-256 of ids (little-endian, 32 bits) and decoded text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "ids", "decoded").mapInArrow(
        _digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
