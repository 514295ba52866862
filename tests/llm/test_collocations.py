"""Collocations against plain counting, and the filters against dictionaries."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from caseloom.llm import collocations
from caseloom.llm.queries import ORACLES, QUERIES
from caseloom.llm.quotient import Grams


def brute(docs, least, top, inside=50):
    f, n = Counter(), Counter()
    for text, lang in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w) if lang is not None else 0
            n["und"] += len(w) if lang is None else 0
            for k in (1, 2, 3):
                f.update(("und" if lang is None else lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    held = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    rows = {}
    for p, a in held.items():
        lang, w = p[0], p[1:]
        if any(len(q) > len(p) and q[0] == lang and w in (q[1:3], q[2:4]) and 100 * b >= inside * a for q, b in held.items()):
            continue
        cuts = [(10**6 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, *w[:k]], f[lang, *w[k:]]))
    return {(lang, rank, p.decode(), -a, x, y, n[lang], -s) for lang, r in rows.items() for rank, (s, a, p, x, y) in enumerate(sorted(r)[:top], 1)}


def test_query_equals_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{small}/documents.parquet'")
    cursor = con.execute(ORACLES["op12_collocations"])
    names = [d[0] for d in cursor.description]
    got = QUERIES["op12_collocations"](spark, small)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(cursor.fetchall())


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 4000, "merge_keys": 64, "fan_bits": 2}, {"shard_bytes": 9000, "merge_keys": 256, "id_bits": 32}])
def test_shards_rounds_and_wide_ids(spark, sizes):
    rng = random.Random(11)
    vocabulary = [f"W{i}" for i in range(40)] + ["é", "日本", "x'y", "\x00", "a b"]
    ends = [" "] * 14 + ["\t", ". ", ", ", "\n", "!?", "  "]
    docs = [("".join(rng.choice(vocabulary[: int(45 * rng.random() ** 2) + 1]) + rng.choice(ends) for _ in range(rng.randint(0, 60))),
             rng.choice(["en", "en", "en", "de", "und", None])) for _ in range(500)]
    docs += [("aa aa aa aa aa aa", "fr")] * 12 + [("New York City. new york city", "fr")] * 20 + [(None, "fr"), ("", "it"), (" ,.\n", "it")]
    frame = spark.createDataFrame(docs, "text string, lang string").repartition(6)
    got = collocations.collocations(frame, least=4, top=25, **sizes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = list(map(tuple, got.collect()))
    assert set(rows) == brute(docs, 4, 25) and len(rows) == len(set(rows))


@pytest.mark.parametrize(("k", "bits"), [(2, 1), (2, 17), (2, 32), (3, 1), (3, 7), (3, 21), (3, 22), (3, 32)])
def test_filters_are_lossless(k, bits):
    rng = np.random.default_rng(bits)
    grams = Grams(k, bits)
    ids = [rng.integers(0, 1 << bits, 3000) for _ in range(k)]
    ids = [np.concatenate([i, i[:700], np.repeat(i[:1], 400)]) for i in ids]
    hi, lo = grams.permuted(ids)
    assert all((a.astype(np.uint64) == b).all() for a, b in zip(ids, grams.ids(hi, lo), strict=True))
    want = Counter(zip(*(i.tolist() for i in ids), strict=True))
    halves = [grams.counted(*(x[part] for x in (hi, lo))) for part in (slice(None, 1500), slice(1500, None))]
    prefix = min(3, grams.half)
    rows = [dict(zip("prefix grp n slots wide runs rest counts more".split(), b, strict=True)) for h in halves for b in grams.blocks(*h, prefix, 0)]
    got = Counter()
    for p in {r["prefix"] for r in rows}:
        a, b, n = grams.merged([r for r in rows if r["prefix"] == p], prefix)
        got.update(dict(zip(zip(*(i.tolist() for i in grams.ids(a, b)), strict=True), n.tolist(), strict=True)))
    assert got == want


def test_exact_beyond_64_bits(spark):
    big = spark.createDataFrame([(3_000_000_000_000, 3_000_000_000_001, 3_000_000_000_007)], "a long, l long, r long")
    a, x, y = big.first()
    assert big.select(collocations._score("a", "l", "r")).first()[0] == 10**6 * a * a // (x * y)


def test_ugly_rows(spark, ugly):
    rows = [(r.text, r.lang) for r in ugly.collect()]
    got = collocations.collocations(ugly.withColumnRenamed("ids", "word"), least=2, top=50)
    assert set(map(tuple, got.collect())) == brute(rows, 2, 50)
    assert collocations.collocations(ugly.limit(0)).count() == 0
