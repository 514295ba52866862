"""MinHash near-dedup: one-permutation hashing with optimal densification, banded buckets, star-shaped edges.

Every text becomes its set of distinct word shingles and one signature of `BINS` minima from a single hash. Equal sets
fall into one class first, so copies cost one row each. Classes meet in buckets of `ROWS` bins; a bucket gives edges
from its smallest class, its centre, to the others (a star), confirmed on the full sets.

A star can miss links: two members may be similar to one another and not to the centre. Let D be what a member's set
differs in from the centre's, E what it adds and R what it lacks. Two members differ in the shingles that are in one D
only, so similar ones must have much of D in common whenever one of them failed against the centre. Prefix filtering
over E and R, rarest first, finds them: shingles that no other component's member holds come first and meet nobody, so
copies edited apart fall out without ever being paired, and no link is lost. What is found is confirmed on full sets.

Defined cases. Null or blank text: `n_shingles` 0, linked with nothing. Null doc_id: no vertex; `component_id` null,
kept. Rows that share a doc_id are one vertex, linked by any of its texts; in the pipeline's form, which decides by row,
each text stands for itself. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.frames import free_name
from caseloom.llm.words import mix, salted, shingle_sets
from caseloom.operators.resolve import components
from caseloom.session import cut_lineage

BINS, ROWS = 128, 4  # 32 buckets a text; a pair at 0.8 misses all of them with probability 5e-8
SKETCH = "doc_id long, node long, n long, hi long, lo long, bands array<long>"
DELTA = "c long, m long, rep long, cid long, n long, e array<long>, r array<long>"


def _probes(n: int = 64) -> np.ndarray:
    """Where an empty bin looks for a value, attempt by attempt: the second hash of optimal densification."""
    each = np.arange(BINS * n, dtype=np.uint64) + np.uint64(1)
    return (mix(each) % np.uint64(BINS)).astype(np.int64).reshape(BINS, n)


_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - 7)
_PROBES = _probes()


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each bin; empty bins borrow from the first full bin on their probe path."""
    at = np.searchsorted(shingles, _EDGES)
    full = np.append(at[1:], len(shingles)) > at
    values = shingles[np.minimum(at, len(shingles) - 1)]
    empty = np.flatnonzero(~full)
    if len(empty):
        path = _PROBES[empty]
        hit = full[path]
        found = hit.argmax(axis=1)
        donor = path[np.arange(len(empty)), found]
        lost = ~hit[np.arange(len(empty)), found]
        if lost.any():  # a probe path without a full bin: the next full bin in the ring
            ring = np.flatnonzero(full)
            donor[lost] = ring[np.searchsorted(ring, empty[lost]) % len(ring)]
        values = values.copy()
        values[empty] = values[donor]
    return values


def _sketched(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    band = np.arange(BINS // ROWS, dtype=np.uint64)
    for batch in batches:
        n, hi, lo, bands = [], [], [], []
        for s in shingle_sets(batch.column("text"), words):
            n.append(len(s))
            digest = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
            hi.append(digest[0])
            lo.append(digest[1])
            if not len(s):
                bands.append([])
                continue
            sig, key = signature(s), np.zeros(len(band), np.uint64)
            for k in range(ROWS):
                key = salted(key ^ sig[k::ROWS], k + 1)
            bands.append(mix(key + band).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("node"), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()),
             pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "node", "n", "hi", "lo", "bands"])


def _pairs_of_sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Runs of rows of (text_a, text_b) with the shingle sets of both sides, some hundred texts at a time."""
    for start in range(0, batch.num_rows, 256):
        part = batch.slice(start, 256)
        centres = part.column("text_a").dictionary_encode()  # a star's centre comes with every member
        sets = list(shingle_sets(centres.dictionary, words))
        yield part, list(zip([sets[k] for k in centres.indices.to_pylist()], shingle_sets(part.column("text_b"), words), strict=True))


def _confirmed(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs with 100 * intersection >= percent * union on the full sets."""
    for batch in batches:
        for part, sets in _pairs_of_sets(batch, words):
            both = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in sets]
            keep = [n > 0 and 100 * n >= percent * (len(x) + len(y) - n) for n, (x, y) in zip(both, sets, strict=True)]
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _differing(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """What each member's set adds to its centre's and lacks of it."""
    def lists(values: list[np.ndarray]) -> pa.Array:
        at = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([*values, np.zeros(0, np.uint64)]).view(np.int64)))

    for batch in batches:
        for part, sets in _pairs_of_sets(batch, words):
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("c", "m", "rep", "cid", "n")), lists([np.setdiff1d(y, x, assume_unique=True) for x, y in sets]),
                 lists([np.setdiff1d(x, y, assume_unique=True) for x, y in sets])], names=["c", "m", "rep", "cid", "n", "e", "r"])


class _Texts:
    """The texts of all classes that share a bucket with another."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, words: int, percent: int):
        self.words, self.percent = words, percent
        # the nodes grow with the documents, so they are never broadcast, however few they are
        self.rows = cut_lineage(docs.select("node", "text").join(nodes.hint("merge"), "node", "left_semi"), "texts")

    def beside(self, pairs: DataFrame, a: str, b: str) -> DataFrame:
        """pairs with text_a and text_b, the texts of the nodes in two of its columns."""
        return pairs.join(self.rows.select(F.col("node").alias(b), F.col("text").alias("text_b")), b).join(
            self.rows.select(F.col("node").alias(a), F.col("text").alias("text_a")), a)

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """(a, b) of the rows of pairs(x, y, a, b) whose texts, those of nodes x and y, are similar."""
        full = self.beside(pairs, "x", "y").select("a", "b", "text_a", "text_b")
        return cut_lineage(full.mapInArrow(partial(_confirmed, words=self.words, percent=self.percent), "a long, b long"), "links")

    def deltas(self, stars: DataFrame) -> DataFrame:
        """(c, m, rep, cid, n, e, r) of stars(c, m, rep, cid, n)."""
        full = self.beside(stars, "c", "m").select("c", "m", "rep", "cid", "n", "text_a", "text_b")
        return cut_lineage(full.mapInArrow(partial(_differing, words=self.words), DELTA), "deltas")


def _joined(links: DataFrame) -> DataFrame:
    """(uid, cid) of the vertices of links (a, b)."""
    ends = links.select(F.col("a").alias("uid")).union(links.select(F.col("b").alias("uid"))).distinct()
    return cut_lineage(components(ends, links), "components")


def _with_cid(rows: DataFrame, label: DataFrame) -> DataFrame:
    return rows.join(label.withColumnRenamed("uid", "rep"), "rep", "left").withColumn("cid", F.coalesce("cid", "rep"))


def _missed(stars: DataFrame, texts: _Texts) -> DataFrame:
    """(x, y, a, b): pairs of members of one star and two components that may be similar; nodes x, y, components a, b.

    stars: (c, m, rep, cid, n). For a pair that is similar with sizes S in all,
    the Ds have o = (|D1| + |D2| - k S) / 2 elements in common or more, k = (100 - percent) / (100 + percent). Of those
    at least o - min(|R1|, |R2|) are in both Es; without any there, o are in both Rs. `slack` is how much of a D can
    differ from any similar set's.
    """
    p = texts.percent
    mixed = stars.groupBy("c").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).where("low < high").select("c")
    delta = texts.deltas(stars.join(cut_lineage(mixed, "mixed"), "c", "left_semi"))
    who = ["c", "m", "rep", "cid", "n", "en", "rn"]
    each = delta.select("c", "m", "rep", "cid", "n", F.size("e").alias("en"), F.size("r").alias("rn"), F.explode(F.concat(
        F.transform("e", lambda x: F.struct(F.lit(0).alias("lacks"), x.alias("x"))),
        F.transform("r", lambda x: F.struct(F.lit(1).alias("lacks"), x.alias("x"))))).alias("d")).select(*who, "d.lacks", "d.x")
    common = each.groupBy("c", "x").agg(F.count("*").alias("df"), F.min("cid").alias("low"), F.max("cid").alias("high")).where(
        "low < high").select("c", "x", "df")
    held = each.join(cut_lineage(common, "common"), ["c", "x"]).groupBy(*who, "lacks").agg(
        F.array_sort(F.collect_set(F.struct("df", "x"))).alias("xs"))  # of one text
    slack = F.floor(F.col("n") * (100 - p) / p)
    size = F.when(F.col("lacks") == 0, F.col("en")).otherwise(F.col("rn"))
    reach = F.when(F.col("lacks") == 0, slack).otherwise(slack - F.col("en"))
    ranked = held.withColumn("alone", size - F.size("xs")).select(*who, "lacks", "alone", F.posexplode("xs").alias("k", "s"))
    rows = cut_lineage(ranked.select(*who, "lacks", "s.x", (size - F.col("alone") - F.col("k")).alias("rest"), (F.col("alone") + F.col("k")).alias("at")).where(
        F.col("at") <= reach).drop("at"), "prefixes")  # rest: how many shingles from this one on
    other = rows.select("c", "x", *[F.col(n).alias(f"{n}_2") for n in ("m", "rep", "cid", "n", "en", "rn", "rest")])
    d1, d2 = F.col("en") + F.col("rn"), F.col("en_2") + F.col("rn_2")
    o = F.ceil(((d1 + d2) * (100 + p) - (100 - p) * (F.col("n") + F.col("n_2"))) / (2 * (100 + p)) - 1e-9)
    in_e = F.greatest(F.lit(1), o - F.least("rn", "rn_2"))
    fits = F.when(F.col("lacks") == 0, F.least("rest", "rest_2") >= in_e).otherwise(F.least("rest", "rest_2") >= o)
    met = rows.join(other, ["c", "x"]).where((F.col("cid") < F.col("cid_2")) & (o <= F.least(d1, d2)) & fits)
    return met.select(F.col("m").alias("x"), F.col("m_2").alias("y"), F.col("cid").alias("a"), F.col("cid_2").alias("b")).distinct()


def _shared(sketch: DataFrame, classes: DataFrame) -> DataFrame:
    """(doc_id, rep, low): the classes of the documents with several texts, by their smallest ids, and the smallest of these."""
    text = F.struct("hi", "lo", "n")
    several = sketch.where("doc_id is not null").groupBy("doc_id").agg(F.min(text).alias("one"), F.max(text).alias("other")).where("one <> other")
    own = sketch.join(cut_lineage(several.select("doc_id"), "several"), "doc_id", "left_semi").join(classes.select("hi", "lo", "rep"), ["hi", "lo"])
    own = cut_lineage(own.select("doc_id", "rep").distinct(), "own")
    return own.join(own.groupBy("doc_id").agg(F.min("rep").alias("low")), "doc_id")


class _Classes:
    """The texts of docs(doc_id, text) with a sketch each, and one row for each class of equal shingle sets."""

    def __init__(self, docs: DataFrame, words: int, by_id: bool):
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.docs = docs.withColumn("node", F.xxhash64("doc_id", "text"))
        self.sketch = cut_lineage(self.docs.mapInArrow(partial(_sketched, words=words), SKETCH), "sketch")
        first = F.min_by(F.struct("doc_id", "node", "bands"), F.struct("doc_id", "node")).alias("f")
        one = self.sketch.where("doc_id is not null and n > 0").groupBy("hi", "lo", "n").agg(first)
        # named by their smallest doc_id, or, where one id's texts are apart, by a number of their own
        rep = F.col("f.doc_id") if by_id else F.monotonically_increasing_id()
        self.rows = cut_lineage(one.select("hi", "lo", "n", rep.alias("rep"), "f.node", "f.bands"), "classes")


def _labelled(held: _Classes, percent: int, words: int, shared: DataFrame | None = None) -> DataFrame:
    """(uid, cid): the component of each class that is linked with another."""
    classes = held.rows
    rows = classes.select("rep", F.explode("bands").alias("key"))  # two numbers a row: these are most of what is shuffled
    centres = rows.groupBy("key").agg(F.min("rep").alias("crep"), F.max("rep").alias("last")).where("crep < last").select("key", "crep")
    met = rows.join(cut_lineage(centres, "centres"), "key").where("rep <> crep").select("crep", "rep").distinct()
    named = classes.select("rep", "node", "n")
    stars = cut_lineage(met.join(named.withColumnRenamed("node", "m"), "rep").join(
        named.select(F.col("rep").alias("crep"), F.col("node").alias("c")), "crep").select("c", "crep", "m", "rep", "n"), "stars")

    texts = _Texts(held.docs, stars.select(F.col("c").alias("node")).union(stars.select(F.col("m").alias("node"))).distinct(), words, percent)
    links = texts.confirm(stars.select(F.col("c").alias("x"), F.col("m").alias("y"), F.col("crep").alias("a"), F.col("rep").alias("b")))
    if shared is not None:
        links = links.union(shared.where("low < rep").select(F.col("low").alias("a"), F.col("rep").alias("b")))
    label = _joined(links)
    placed = cut_lineage(_with_cid(stars, label).select("c", "m", "rep", "cid", "n"), "placed")
    across = texts.confirm(_missed(placed, texts)).where("a <> b").distinct()
    if not across.isEmpty():
        joined = _joined(across).select(F.col("uid").alias("old"), F.col("cid").alias("root"))
        known = label.union(joined.select(F.col("old").alias("uid"), F.col("old").alias("cid"))).distinct()
        label = cut_lineage(known.join(joined, F.col("cid") == F.col("old"), "left").groupBy("uid").agg(
            F.min(F.coalesce("root", "cid")).alias("cid")), "label")
    return label


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs(doc_id, text)."""
    held = _Classes(docs, words, by_id=True)
    sketch, classes = held.sketch, held.rows
    shared = cut_lineage(_shared(sketch, classes), "shared")
    label = _labelled(held, percent, words, shared)
    ends = cut_lineage(_with_cid(classes.select("hi", "lo", "rep"), label).select("hi", "lo", "cid"), "ends")
    rows = sketch.select("doc_id", "n", "hi", "lo").join(ends, ["hi", "lo"], "left")
    # a blank text goes with its document's others
    beside = _with_cid(shared.select("doc_id", F.col("low").alias("rep")).distinct(), label).select("doc_id", F.col("cid").alias("own_cid"))
    rows = rows.join(beside, "doc_id", "left").withColumn("cid", F.coalesce("cid", "own_cid"))
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("cid", "doc_id")).alias("component_id"),
        F.coalesce(F.coalesce("cid", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, percent: int = 80, words: int = 5) -> DataFrame:
    """Pipeline form: rows of docs with one row of each group of similar texts, the smallest doc_id's.

    Rows are told apart by id and text, so of an id with several texts each stays or goes by itself; equal rows are
    copies too. Rows without a doc_id and blank texts stay, the latter once an id and text.
    """
    held = _Classes(docs, words, by_id=False)
    ends = _with_cid(held.rows.select("hi", "lo", "rep"), _labelled(held, percent, words)).select("hi", "lo", "cid")
    rows = held.sketch.where("doc_id is not null").select("doc_id", "node", "n", "hi", "lo")
    solid = rows.where("n > 0").join(cut_lineage(ends, "ends"), ["hi", "lo"]).groupBy("cid").agg(F.min(F.struct("doc_id", "node")).alias("f"))
    kept = solid.select("f.*").union(rows.where("n = 0").select("doc_id", "node").distinct())
    order, node, ident = free_name(docs, "copy"), free_name(docs, "node"), free_name(docs, "ident")
    kept = cut_lineage(kept.select(F.col("doc_id").alias(ident), F.col("node").alias(node)), "kept")
    named = docs.where(F.col("doc_id").isNotNull()).withColumns(
        {ident: F.col("doc_id").cast("long"), node: F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))})
    named = named.join(kept, [ident, node], "left_semi").withColumn(
        order, F.row_number().over(Window.partitionBy(ident, node).orderBy(F.xxhash64(*docs.columns))))
    return named.where(F.col(order) == 1).select(docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))
