"""Substring dedup by sliding sentence spans.

A text is cut into sentences that together cover it. Every run of `RUN` consecutive sentences is hashed (128 bits, case
and white space aside); runs are joined over all documents; the first place of a run is the smallest (doc_id, position).
Sentences covered by a run whose first place is elsewhere are repeated; stretches of repeated sentences of `MIN_WORDS`
words or more are removed. The rest of the text stays byte for byte.

Given `passage`, runs of words are hashed too, so that a passage needs no whole sentence: of the runs of half a passage
that a stretch of `passage` words holds, the one with the smallest hash is kept, the same one wherever the stretch is.
A kept run whose first place is elsewhere is removed, so no stretch of `passage` words that an earlier place holds stays
whole. The ends of a passage that begins or ends inside a sentence may stay, up to half of `passage` words each.

Defined cases. Null or empty text: unchanged. Null doc_id: unchanged, and no place of a run. Rows that share doc_id and
text count as one document; rows that share only the id are ordered by the hash of their text. A run repeated within
one document loses its later places (those that overlap the first one too). Other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm.frames import free_name
from caseloom.llm.words import Words, chunks, salted
from caseloom.session import cut_lineage

RUN = 2
MIN_WORDS = 25
PASSAGE = 50
#: Places from here on are numbers of words, those below are numbers of sentences.
_WORDS_FROM = 1 << 30
#: A sentence ends after its closing marks and the white space that follows, or after a line break.
_END = re.compile(r"[.!?]+[\"')\]]*\s+|\s*\n\s*")
_WORD = re.compile(r"[^\x20\t\n\x0b\x0c\r]+")  # as `Words` cuts them


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences; together they are the whole text."""
    cuts = [0]
    for m in _END.finditer(text):
        if text[cuts[-1] : m.end()].strip():
            cuts.append(m.end())
    if cuts[-1] < len(text):
        cuts.append(len(text))
    return list(zip(cuts, cuts[1:], strict=False))


def _digests(text: str, run: int) -> list[bytes]:
    """Hash of each run, at the number of its first sentence."""
    parts = [" ".join(text[a:b].lower().split()) for a, b in sentences(text)]
    return [hashlib.blake2b("\n".join(parts[i : i + run]).encode(), digest_size=16).digest() for i in range(len(parts) - run + 1)]


def _run_rows(batches: Iterator[pa.RecordBatch], run: int) -> Iterator[pa.RecordBatch]:
    names = ["hi", "lo", "doc_id", "doc_key", "pos"]
    for batch in batches:
        ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "doc_key"))
        for start in range(0, batch.num_rows, 512):
            each = [_digests(t or "", run) for t in batch.column("text").slice(start, 512).to_pylist()]
            count = np.array([len(d) for d in each], dtype=np.int64)
            flat = np.frombuffer(b"".join(d for ds in each for d in ds), np.int64).reshape(-1, 2)
            rows = np.repeat(np.arange(start, start + len(each)), count)
            pos = np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)
            yield pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1]), pa.array(ids[rows]), pa.array(keys[rows]), pa.array(pos.astype(np.int32))], names=names)


def selected(hashes: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """Of every `width` consecutive hashes of one text the smallest one's number, the last of equal ones."""
    many = len(hashes) - width + 1
    if many <= 0:
        return np.zeros(0, np.int64)
    best, at = hashes[:many].copy(), np.zeros(many, np.int64)
    for k in range(1, width):
        lower = hashes[k : k + many] <= best
        best[lower] = hashes[k : k + many][lower]
        at[lower] = k
    text = np.searchsorted(first, np.arange(len(hashes)), "right")
    return np.unique((at + np.arange(many))[text[:many] == text[width - 1 :]])


def _word_rows(batches: Iterator[pa.RecordBatch], passage: int) -> Iterator[pa.RecordBatch]:
    names, run = ["hi", "lo", "doc_id", "doc_key", "pos"], passage // 2
    for batch in batches:
        ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "doc_key"))
        for row, _, buf, at in chunks(batch.column("text")):
            words = Words(buf, at)
            hi, first = words.runs(words.hash, run)
            lo, _ = words.runs(salted(words.hash, 1), run)
            kept = selected(hi, first, passage - run + 1)
            text = np.searchsorted(first, kept, "right") - 1
            pos = (kept - first[text] + _WORDS_FROM).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hi[kept].view(np.int64)), pa.array(lo[kept].view(np.int64)), pa.array(ids[row + text]), pa.array(keys[row + text]), pa.array(pos)], names=names)


def repeated_words(text: str, starts: list[int], run: int) -> list[tuple[int, int]]:
    """(start, end) of the stretches to remove, given the first words of non-first runs; white space after a stretch goes along."""
    begins = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out: list[tuple[int, int]] = []
    for k in sorted(starts):
        a, b = begins[k], begins[k + run]
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def repeated(text: str, starts: list[int], run: int, min_words: int) -> list[tuple[int, int, int]]:
    """(start, end, sentences) of the stretches to remove, given the first sentences of non-first runs."""
    spans = sentences(text)
    covered = sorted({k for s in starts for k in range(s, min(s + run, len(spans)))})
    out, k = [], 0
    while k < len(covered):
        end = k
        while end + 1 < len(covered) and covered[end + 1] == covered[end] + 1:
            end += 1
        a, b = spans[covered[k]][0], spans[covered[end]][1]
        if len(text[a:b].split()) >= min_words:
            out.append((a, b, end - k + 1))
        k = end + 1
    return out


def _cleaned(batches: Iterator[pa.RecordBatch], run: int, min_words: int, passage: int | None, text_column: str, added: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """The last column holds the first sentences and words of non-first runs."""
    for batch in batches:
        at = batch.schema.get_field_index(text_column)
        texts, cut, gone = [], [], []
        for text, starts in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
            whole = repeated(text, [k for k in starts if k < _WORDS_FROM], run, min_words) if text and starts else []
            spans = [(a, b) for a, b, _ in whole]
            if words := [k - _WORDS_FROM for k in starts or [] if k >= _WORDS_FROM]:
                spans = _united(spans + repeated_words(text, words, passage // 2))
            kept, last = [], 0
            for a, b in spans:
                kept.append(text[last:a])
                last = b
            texts.append("".join([*kept, text[last:]]) if spans else text)
            cut.append([{"start": a, "end": b} for a, b in spans])
            gone.append(sum(n for _, _, n in whole))
        columns = list(batch.columns[:-1])
        columns[at] = pa.array(texts, batch.schema.field(at).type)
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(cut, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(gone, pa.int32())],
            names=[*batch.schema.names[:-1], *added])


def cleaned(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS, spans: str = "removed_spans", count: str = "removed_sentences", passage: int | None = None) -> DataFrame:
    """docs with `text` cleaned and two more columns: the removed spans of the old text and the number of repeated sentences in them."""
    spans, count, key = free_name(docs, spans), free_name(docs, count), free_name(docs, "doc_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id"), F.col("text")))
    named = keyed.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(key).alias("doc_key"), F.col("text").cast("string").alias("text"))
    columns = "hi long, lo long, doc_id long, doc_key long, pos int"
    runs = named.mapInArrow(partial(_run_rows, run=run), columns)
    if passage:  # twice the runs: hashed again for the join, as they take less time than disk
        runs = runs.union(named.mapInArrow(partial(_word_rows, passage=passage), columns))
    else:
        runs = cut_lineage(runs, "runs")
    place = F.struct("doc_id", "doc_key", "pos")
    first = cut_lineage(
        runs.groupBy("hi", "lo").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("hi", "lo", "first"), "repeated")
    later = runs.join(first, ["hi", "lo"]).where(place != F.col("first"))
    starts, other = free_name(keyed, "starts"), free_name(keyed, "doc_id_2")
    found = later.groupBy("doc_id", "doc_key").agg(F.collect_set("pos").alias(starts))  # positions of one document
    found = found.withColumnsRenamed({"doc_id": other, "doc_key": key})
    marked = keyed.join(found, (keyed["doc_id"] == found[other]) & (keyed[key] == found[key]), "left").select(
        *[keyed[c] for c in docs.columns], starts)
    added = T.StructType.fromDDL(f"{spans} array<struct<start:int,end:int>>, {count} int")
    schema = T.StructType(docs.schema.fields + added.fields)
    return marked.mapInArrow(partial(_cleaned, run=run, min_words=min_words, passage=passage, text_column="text", added=(spans, count)), schema)


def without_repeats(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """Pipeline form: docs with repeated stretches taken out of `text`; `n_chars`, where there is one, follows the text."""
    out = cleaned(docs, run, min_words).select(docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
