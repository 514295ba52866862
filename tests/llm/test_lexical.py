"""Lexical search against scores computed document by document."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np

from caseloom.llm import lexical
from caseloom.llm.queries import ORACLES, QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(i, Counter(plain(t))) for i, t in docs if plain(t)]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = set()
    for item_id, text in set(items):
        scores = []
        for doc_id, c in held:
            n = sum(c.values())
            m = 25 + 75 * n * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in plain(text) if c[t])
            if score > 0 and doc_id is not None:
                scores.append((-score, doc_id))
        out |= {(item_id, rank, doc_id, -s) for rank, (s, doc_id) in enumerate(sorted(scores)[:k], 1)}
    return out


def test_query_equals_sql(spark, small):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    want = con.execute(ORACLES["op13_lexical_search"]).fetchall()
    got = QUERIES["op13_lexical_search"](spark, small).collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(got) > 100


def test_small_shards_blocks_ties_and_repeats(spark):
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(3000)] + ["ÉTÉ", "日本", "a_b", "x-Y", "q`", "\x7fz"]
    docs = [(i % 150, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(200)]
    docs += [(300, "common " * 50), (301, "common"), (302, "common"), (302, "common"), (None, "common w1"), (303, None), (304, " ,.-\n"), (305, "")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(20)]
    items += [(90, "common common COMMON"), (91, ""), (92, None), (93, "nowhere-held"), (90, "common common COMMON"), (94, "w1"), (None, "w2 été")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    q = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    for block_bytes, shard in ((1 << 24, 1 << 21), (200, 64)):
        got = [tuple(r) for r in lexical.ranked(d, q, block_bytes=block_bytes, shard_postings=shard).collect()]
        assert set(got) == want and len(got) == len(want)
    assert lexical.ranked(d.limit(0), q).count() == 0 and lexical.ranked(d, q.limit(0)).count() == 0


def test_accumulators_stop_early_and_stay_exact():
    rng = np.random.default_rng(3)
    n = 5000
    held = [np.flatnonzero(rng.random(n) < p) for p in (0.003, 0.01, 0.3, 0.6, 0.9)]
    order = np.argsort(np.concatenate(held), kind="stable")
    doc, term = np.concatenate(held)[order], np.repeat(np.arange(5), [len(h) for h in held])[order]
    tf = rng.integers(1, 4, len(doc))
    shard = lexical.Shard(np.arange(n), np.full(n, 50), np.bincount(doc, minlength=n), term, tf, n, 50 * n, 5)
    query = [(0, 6000), (1, 5000), (2, 1100), (3, 400), (4, 20)]
    found, made = shard.search(query, 10, 1)
    sums = np.zeros(n, np.int64)
    for t, w in query:
        a, b = shard.at[t], shard.at[t + 1]
        sums[shard.doc[a:b]] += w * shard.impact[a:b]
    assert found == [(int(sums[i]), int(i)) for i in np.lexsort((np.arange(n), -sums))[:10]]
    assert made < 100 and not shard.sums.any()
    assert shard.search(query, 10, found[-1][0])[0] == found  # documents that tie with the floor are found


def test_ugly_rows(spark, ugly):
    items = spark.createDataFrame([(1, "small text", "x")], "item_id long, text string, score string")
    got = lexical.ranked(ugly, items)
    rows = [(r.doc_id, r.text) for r in ugly.collect()]
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and {tuple(r) for r in got.collect()} == brute(rows, [(1, "small text")])
