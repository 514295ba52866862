"""Phrase collocation mining with counting quotient filters.

Workers split their texts into words and write shards: word ids local to a shard, and its words with counts. The words
said `least` times or more in a language get dense ids; a shard meets those of its own words, so no vocabulary is ever
held as a whole. Each shard counts its pairs of such words in a quotient filter; filters are merged by prefix, as many
prefixes as the data needs, in rounds when a shard's blocks would become too small. Pairs that reach `least` mark a bitmap
of fixed size; words of three are counted, by filters again, where both their pairs are marked. A mark in common with
another pair only costs time: the counts decide. All phrases that can reach `least` are counted exactly.

Defined cases. Null text counts as empty, null lang as `und`. Repeated rows count each time. Texts of any length are read
whole. An empty table gives an empty result. Columns other than text and lang are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.quotient import BLOCK, Grams, marks
from caseloom.operators.ranking import numbered
from caseloom.session import cut_lineage

LEAST, TOP, INSIDE = 10, 2000, 50
SHARD_BYTES = 1 << 24  # of words, at 8 bytes each
MERGE_KEYS = 1 << 19  # n-grams that a merge reads, about
FAN_BITS, FAN_SHARDS = 10, 256  # a round of merges splits a prefix by so many bits and joins so many shards' blocks
BITMAP_BITS = 27  # 16 MB, whatever the data
CHUNK = 1 << 18  # words of a row, about; documents stay whole
_BREAK, _NONE = 0, 1
_TABLE = bytes(b + 32 if 0x41 <= b < 0x5B else 0x0A if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b for b in range(256))
SHARD = "shard long, lang string, word string, id int, n long, seq array<int>"
COUNTED = "seq array<int>, " + BLOCK
_SHARD = pa.schema({"shard": pa.int64(), "lang": pa.string(), "word": pa.string(), "id": pa.int32(), "n": pa.int64(), "seq": pa.list_(pa.int32())})
_BLOCK = pa.schema({"prefix": pa.int64(), "grp": pa.int64(), "n": pa.int32(), "slots": pa.int32(), "wide": pa.int32(), "runs": pa.binary(),
                    "rest": pa.binary(), "counts": pa.binary(), "more": pa.binary()})
_COUNTED = pa.schema([pa.field("seq", pa.list_(pa.int32())), *_BLOCK])


def words(text: str) -> list[bytes]:
    """The words of a text, a line feed between pieces, and empty words, which count for nothing."""
    return text.encode().translate(_TABLE).replace(b"\n", b" \n ").split(b" ")


def _ints(rows: list[np.ndarray]) -> pa.Array:
    at = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int32)))


def _sharded(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[pa.RecordBatch]:
    """Shards of texts: rows with `word`, its number in the shard and its count, and rows with `seq`, numbers of words."""
    base, made = TaskContext.get().partitionId() << 32, 0
    ids: dict[str, dict[bytes, int]] = {}
    chunks, chunk, size, number = [], [], 0, count(2)

    def rows(shard: int) -> Iterator[pa.RecordBatch]:
        if chunk:
            chunks.append(np.concatenate(chunk))
        total = np.zeros(next(number), np.int64)
        for c in chunks:
            total += np.bincount(c, minlength=len(total))
        for lang, held in ids.items():
            own = [(w, i) for w, i in held.items() if i > _NONE]
            if own:
                w, i = zip(*own, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(shard, pa.int64()), len(w)), pa.repeat(pa.scalar(lang), len(w)), pa.array(w, pa.binary()).cast(pa.string()),
                     pa.array(i, pa.int32()), pa.array(total[list(i)]), pa.nulls(len(w), _SHARD.field("seq").type)], schema=_SHARD)
        yield pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(shard, pa.int64()), len(chunks)), *(pa.nulls(len(chunks), t) for t in _SHARD.types[1:5]), _ints(chunks)], schema=_SHARD)

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            if lang not in ids:
                ids[lang] = defaultdict(number.__next__, {b"\n": _BREAK, b"": _NONE})
            found = words(text.as_py() or "")
            seq = np.fromiter(map(ids[lang].__getitem__, found), np.int32, len(found))
            chunk.append(np.append(seq[seq != _NONE], np.int32(_BREAK)))
            size += 8 * len(found)
            if sum(map(len, chunk[-1:])) > CHUNK or len(chunk) >= 512:
                chunks.append(np.concatenate(chunk))
                chunk.clear()
            if size >= shard_bytes:
                yield from rows(base + made)
                made, size, number = made + 1, 0, count(2)
                ids, chunks, chunk = {}, [], []
    yield from rows(base + made)


def _sorted_blocks(grams: Grams, ids: list[np.ndarray], prefix_bits: int, grp: int) -> list[tuple]:
    return grams.blocks(*grams.counted(*grams.permuted(ids)), prefix_bits, grp)


def _block_columns(blocks: list[tuple]) -> list[pa.Array]:
    cols = list(zip(*blocks, strict=True)) if blocks else [()] * len(_BLOCK)
    return [pa.array(c, t) for c, t in zip(cols, _BLOCK.types, strict=True)]


def _pairs(seqs: pa.Table, known: pa.Table, grams: Grams, prefix_bits: int) -> pa.Table:
    """A shard with global ids, and the filter of its pairs in blocks."""
    if not seqs.num_rows or not known.num_rows:
        return _COUNTED.empty_table()
    local = known["id"].to_numpy()
    chunks = [np.asarray(s.values.to_numpy()) for s in seqs["seq"]]
    gid = np.zeros(1 + max([int(local.max()), *(int(c.max(initial=0)) for c in chunks)]), np.uint32)
    gid[local] = known["gid"].to_numpy() + 1
    out, pairs = [], []
    for c in chunks:
        x = gid[c]
        x = x[(x > 0) | (np.append(x[1:], np.uint32(0)) > 0)]  # one break between words stays
        out.append(x.view(np.int32))
        both = (x[:-1] > 0) & (x[1:] > 0)
        pairs.append((x[:-1][both] - 1, x[1:][both] - 1))
    grp, ids = seqs["shard"][0].as_py(), [np.concatenate(p) for p in zip(*pairs, strict=True)]
    pairs.clear()
    blocks = _sorted_blocks(grams, ids, prefix_bits, grp)
    first = pa.Table.from_arrays([_ints(out), *(pa.nulls(len(out), t) for t in _BLOCK.types)], schema=_COUNTED)
    second = pa.Table.from_arrays([pa.nulls(len(blocks), _COUNTED.types[0]), *_block_columns(blocks)], schema=_COUNTED)
    return pa.concat_tables([first, second])


def _triples(batches: Iterator[pa.RecordBatch], shared, pair: Grams, grams: Grams, prefix_bits: int, most: int) -> Iterator[pa.RecordBatch]:
    """Filters of the words of three whose two pairs are marked, in blocks."""
    bitmap, part, made = np.frombuffer(shared.value, np.uint8), TaskContext.get().partitionId() << 32, 0
    held: list[tuple[np.ndarray, ...]] = []

    def batch_of(grp: int) -> pa.RecordBatch:
        blocks = _sorted_blocks(grams, [np.concatenate(p) for p in zip(*held, strict=True)], prefix_bits, grp)
        held.clear()
        return pa.RecordBatch.from_arrays(_block_columns(blocks), schema=_BLOCK)

    for batch in batches:
        for s in batch.column("seq"):
            x = s.values.to_numpy().view(np.uint32)
            at = np.flatnonzero((x[:-1] > 0) & (x[1:] > 0))
            place = marks(*pair.permuted([x[at] - 1, x[at + 1] - 1]), pair.half, BITMAP_BITS)
            at = at[(bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0]
            at = at[:-1][at[1:] == at[:-1] + 1]
            held.append((x[at] - 1, x[at + 1] - 1, x[at + 2] - 1))
            if sum(len(h[0]) for h in held) > most:
                yield batch_of(part + made)
                made += 1
    if held:
        yield batch_of(part + made)


def _merging(grams: Grams, before: int, after: int):
    """Merge of the blocks of one prefix, into blocks of longer prefixes."""
    def run(blocks: pa.Table) -> pa.Table:
        rows = blocks.to_pylist()
        return pa.Table.from_arrays(_block_columns(grams.blocks(*grams.merged(rows, before), after, rows[0]["grp"])), schema=_BLOCK)

    return run


def _frequent(grams: Grams, prefix_bits: int, least: int):
    """Merge of the blocks of one prefix, into the ids of the n-grams that reach `least`."""
    def run(blocks: pa.Table) -> pa.Table:
        hi, lo, n = grams.merged(blocks.to_pylist(), prefix_bits)
        enough = n >= least
        hi, lo = hi[enough], lo[enough]
        ids = {f"w{i}": pa.array(w.astype(np.int64)) for i, w in enumerate(grams.ids(hi, lo), 1)}
        return pa.table(ids | {"f": pa.array(n[enough]), "mark": pa.array(marks(hi, lo, grams.half, BITMAP_BITS))})

    return run


def _prefix_bits(rows: int, grams: Grams, merge_keys: int) -> int:
    return min(grams.half, max(0, (rows // merge_keys).bit_length()))


def _merged(blocks: DataFrame, grams: Grams, first: int, last: int, least: int, fan_bits: int) -> DataFrame:
    """(w1, .., f, mark) of the n-grams that reach `least`, from blocks by prefixes of `first` bits."""
    done = first
    while done < last:
        after = min(last, done + fan_bits)
        near = blocks.withColumn("grp", F.floor(F.col("grp") / FAN_SHARDS)).groupBy("prefix", "grp")
        blocks = cut_lineage(near.applyInArrow(_merging(grams, done, after), BLOCK), "blocks")
        done = after
    schema = ", ".join(f"w{i} long" for i in range(1, grams.k + 1)) + ", f long, mark long"
    return cut_lineage(blocks.groupBy("prefix").applyInArrow(_frequent(grams, done, least), schema), "grams")


def _bitmap(pairs: DataFrame) -> bytes:
    """The marks of all pairs: at most 2^BITMAP_BITS bits, whatever the pairs."""
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    place = F.col("mark") + 1  # these functions count from 1
    rows = pairs.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    for r in rows.collect():
        bits = np.frombuffer(r["bits"], np.uint8)
        out[(r["bucket"] - 1) * 4096 : (r["bucket"] - 1) * 4096 + len(bits)] = bits
    return out.tobytes()


def counted(docs: DataFrame, least: int = LEAST, shard_bytes: int = SHARD_BYTES, merge_keys: int = MERGE_KEYS,
            fan_bits: int = FAN_BITS, id_bits: int = 0) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(lang, n) of all words, and the phrases that reach `least`: words (gid, lang, word, f), pairs (w1, w2, f) and
    words of three (w1, w2, w3, f), by the ids of their words."""
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    shards = cut_lineage(docs.mapInArrow(partial(_sharded, shard_bytes=shard_bytes), SHARD), "shards")
    said = shards.where("seq is null")
    totals = cut_lineage(said.groupBy("lang", "word").agg(F.sum("n").alias("f")), "words")
    langs = totals.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = cut_lineage(numbered(totals.where(F.col("f") >= least), [], ["lang", "word"], "gid").withColumn("gid", F.col("gid") - 1), "frequent")
    n_words, n_rows = frequent.agg(F.count("*"), F.coalesce(F.sum("f"), F.lit(0))).first()
    bits = max(1, id_bits, n_words.bit_length())
    if bits > 32:
        raise ValueError("more than 2^32 words")
    pair, triple = Grams(2, bits), Grams(3, bits)
    spark = docs.sparkSession
    last = _prefix_bits(n_rows, pair, merge_keys)
    first = min(last, fan_bits)
    own = said.select("shard", "id", "lang", "word").join(frequent.select("lang", "word", "gid"), ["lang", "word"]).select(F.col("shard").alias("of"), "id", "gid")
    held = cut_lineage(shards.where("seq is not null").select("shard", "seq").groupBy("shard").cogroup(own.groupBy("of")).applyInArrow(
        lambda seqs, known: _pairs(seqs, known, pair, first), COUNTED), "pairs")
    pairs = _merged(held.where("seq is null").drop("seq"), pair, first, last, least, fan_bits)
    shared = spark.sparkContext.broadcast(_bitmap(pairs))
    last = _prefix_bits(n_rows, triple, merge_keys)
    first = min(last, fan_bits)
    seqs = held.where("seq is not null").select("seq")
    blocks = cut_lineage(seqs.mapInArrow(partial(_triples, shared=shared, pair=pair, grams=triple, prefix_bits=first, most=shard_bytes // 16), BLOCK), "triples")
    triples = _merged(blocks, triple, first, last, least, fan_bits)
    return langs, frequent, pairs.drop("mark"), triples.drop("mark")


def _score(a: str, left: str, right: str) -> F.Column:
    """floor(1000000 a a / (l r)) in decimals of 38 digits."""
    big = "cast({} as decimal(19, 0))".format
    return F.expr(f"cast(1000000 as decimal(7, 0)) * ({big(a)} * {big(a)}) div ({big(left)} * {big(right)})")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, inside: int = INSIDE, **sizes) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of two or three words of each language.

    docs(text, lang). A phrase's score is the lowest of its cuts'; phrases that lie in a longer one at least `inside`
    percent of the time are left out.
    """
    langs, frequent, pairs, triples = counted(docs, least, **sizes)

    def word(i: int) -> DataFrame:
        return frequent.select(F.col("gid").alias(f"w{i}"), F.col("word").alias(f"t{i}"), F.col("f").alias(f"f{i}"), *(["lang"] if i == 1 else []))

    def pair(i: int) -> DataFrame:
        return pairs.select(F.col("w1").alias(f"w{i}"), F.col("w2").alias(f"w{i + 1}"), F.col("f").alias(f"f{i}{i + 1}"))

    within = triples.select("f", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"))
    within = within.groupBy("p.w1", "p.w2").agg(F.max("f").alias("longer"))
    two = pairs.join(within, ["w1", "w2"], "left").where(F.coalesce(100 * F.col("longer") < inside * F.col("f"), F.lit(True)))
    two = two.join(word(1), "w1").join(word(2), "w2").select(
        "lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), F.col("f").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"))
    two = two.withColumn("score", _score("a", "l", "r"))
    three = triples.join(pair(1), ["w1", "w2"]).join(pair(2), ["w2", "w3"]).join(word(1), "w1").join(word(2), "w2").join(word(3), "w3")
    three = three.withColumns({"one": _score("f", "f1", "f23"), "other": _score("f", "f12", "f3")})
    later = F.col("other") < F.col("one")
    three = three.select("lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), F.col("f").alias("a"), F.when(later, F.col("f12")).otherwise(
        F.col("f1")).alias("l"), F.when(later, F.col("f3")).otherwise(F.col("f23")).alias("r"), F.least("one", "other").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(langs, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
