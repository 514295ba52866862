"""URL filter, mixing, vector searches and fixity audit against brute force."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm import kd_search, learned_ann, mixing, queries, url_filter, warc_fixity

# URL filter --------------------------------------------------------------------------------------------------------


def plain_rule(url):
    rest = (url or "").partition("://")[2]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


ODD_URLS = [
    None, "", "no scheme", "http://", "http://NET/", "https://a.Example.NET/en/x", "http://example.net/english", "http://example.net/en/?q=://b.net/",
    "http://notexample.com/de/", "http://example.com/de/?a=1&b=2#f", "http://x.org/fr/a.html", "http://org/fr/", "http://ÄÖ.net/ü", "http://a.net",
    "://a.net/", "http://a.net/" + "x" * 100_000, "http://example.com#/de/", "x?://example.com/de/1", "http://.net/", "http://a.org/\n/b",
]


def test_rules_equal_a_plain_reading(spark, small):
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(ODD_URLS)], "page_id long, url string")
    judged = url_filter.judged(pages, url_filter.learnt(spark.createDataFrame([], "url string, bad int")))
    for r in judged.collect():
        host, path, rule, verdict = plain_rule(r.url)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), r.url
    for r in queries.QUERIES["op2_url_filter"](spark, small).join(spark.read.parquet(f"{small}/pages.parquet"), "page_id").collect():
        host, path, rule, verdict = plain_rule(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))


def test_trees_learn_lexical_marks(spark):
    rng = np.random.default_rng(1)
    urls = []
    for k in range(1500):
        bad = int(rng.random() < 0.4)
        tail = "".join(rng.choice(list("0123456789"), 12)) if bad else "news/today"
        urls.append((f"http://h{k % 7}.{'biz' if rng.random() < (0.7 if bad else 0.1) else 'com'}/{tail}" + ("?a=1&b=2&c=3" if bad else ""), bad))
    model = url_filter.learnt(spark.createDataFrame(urls[:1000], "url string, bad int"))
    out = url_filter.judged(spark.createDataFrame(urls[1000:], "url string, bad int"), model, rules=url_filter.RULES).collect()
    assert np.mean([(r.score >= 0.5) == (r.bad == 1) for r in out]) > 0.97


def test_url_features(spark):
    frame = spark.createDataFrame([("http://a.b.co/x/y.html?p=1&q=22#z",), (None,)], "url string").withColumns(
        {"host": url_filter.host_of(F.col("url")), "path": url_filter.path_of(F.col("url"))})
    numbers, suffixes = url_filter.lexical(frame, "url", "host", "path")
    full, empty = frame.select(*[c.alias(n) for n, c in (numbers | suffixes).items()]).collect()
    text = "http://a.b.co/x/y.html?p=1&q=22#z"
    share = [text.count(c) / len(text) for c in set(text)]
    assert math.isclose(full.entropy, -sum(p * math.log2(p) for p in share), rel_tol=1e-9)
    assert (full.depth, full.labels, full.parameters, full.fragment) == (2, 2, 2, 1)
    assert math.isclose(full.digits, 3 / len(text)) and (full.top, full.domain, full.file) == ("co", "b.co", ".html")
    assert (empty.length, empty.entropy, empty.parameters, empty.top) == (0, 0, 0, "")


def test_url_cases(spark, small):
    pages = spark.createDataFrame([(None, "http://a.org/x", "h", 1), (1, None, "h", 1), (1, None, "h", 1)], "page_id long, url string, host string, score int")
    labels = spark.createDataFrame([(None, 1, 0), (1, None, None), (1, 0, 1)], "doc_id long, quality int, toxic int")
    model = url_filter.learnt(url_filter.labelled_urls(pages, labels))
    out = url_filter.judged(pages, model)
    assert out.columns == [*pages.columns, "host_", "path", "rule", "verdict", "score_"] and out.count() == 3
    assert url_filter.judged(pages.limit(0), model).count() == 0


# mixing ------------------------------------------------------------------------------------------------------------


def mixes(spark, small):
    docs = spark.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/documents.parquet").select("doc_id", "source", "text")
    return docs, [mixing.Mix(), mixing.Mix(budget=0.9, max_epochs=1.0), mixing.Mix(budget=2.0, max_epochs=None, entropy=2.9, block_tokens=4000),
                  mixing.Mix(budget=0.5, max_epochs=1.2, block_tokens=500)]


def plain_exponent(tokens, mix):
    p = tokens / tokens.sum()

    def too_flat(a):
        w = p**a / (p**a).sum()
        return -(w * np.log(w)).sum() > mix.entropy if mix.entropy is not None else (w * tokens.sum() * mix.budget / tokens).max() > mix.max_epochs

    low, high = 0.0, 1.0
    if not too_flat(0.0):
        return 0.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if too_flat(mid) else (low, mid)
    return high


def test_mixing_meets_weights_and_budget(spark, small):
    docs, tried = mixes(spark, small)
    for mix in tried:
        rows = mixing.epochs(docs, mix).withColumn("n", mixing.n_tokens()).toPandas()
        assert len(rows) == docs.count()
        by = rows.assign(taken=rows.n * rows.copies).groupby("source").agg(n=("n", "sum"), taken=("taken", "sum"), w=("weight", "first"),
                                                                          least=("copies", "min"), most=("copies", "max"), longest=("n", "max"))
        a = plain_exponent(by.n.to_numpy(float), mix)
        share = (by.n / by.n.sum()) ** a
        assert np.allclose(by.w, share / share.sum(), atol=1e-6)
        quota = by.w * by.n.sum() * mix.budget
        assert (by.taken >= quota - 1e-3).all() and (by.taken < quota + by.longest).all()  # met, by no more than the last document
        assert (by.most - by.least <= 1).all()


def test_mixing_takes_whole_blocks_then_a_prefix(spark, small):
    """The documents taken once more are a prefix of their source in the order of block, then hash."""
    docs, (*_, mix) = mixes(spark, small)
    rows = mixing.epochs(docs, mix).toPandas()
    again = mixing.epochs(docs, mix).toPandas()
    assert rows.sort_values("doc_id").copies.tolist() == again.sort_values("doc_id").copies.tolist()
    other = mixing.epochs(docs, mixing.Mix(budget=0.5, max_epochs=1.2, block_tokens=500, seed=12)).toPandas()
    assert rows.sort_values("doc_id").copies.tolist() != other.sort_values("doc_id").copies.tolist()


def test_mixing_cases(spark, ugly):
    out = mixing.epochs(ugly.withColumn("weight", F.lit(1)))
    assert out.columns == [*ugly.columns, "weight", "weight_", "copies_"] and out.count() == ugly.count()
    assert {r.copies_ for r in out.where("doc_id = 1").collect()} <= {0, 1, 2} and len({r.copies_ for r in out.where("doc_id = 1").collect()}) == 1
    assert mixing.mixed(ugly).columns == ugly.columns
    assert mixing.mixed(ugly.limit(0)).count() == 0
    blank = ugly.where("doc_id in (2, 3, 4)")
    assert mixing.mixed(blank).count() == 3  # no tokens at all: every row once


# vectors -----------------------------------------------------------------------------------------------------------


def vectors_of(spark, small):
    rows = spark.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/embeddings.parquet").select("vec_id", "embedding").collect()
    return {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in rows}


def brute(vectors, queries_, score, k=10):
    out = {}
    for q in queries_:
        found = sorted((score(vectors[q], x), i) for i, x in vectors.items() if i != q and len(x) == len(vectors[q]))[:k]
        out[q] = [(i, abs(s)) for s, i in found]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, abs(r.score)))
        assert r["rank"] == len(out[r.query_id])
    return out


def whole(x):
    return np.floor(1024 * x).astype(object).astype(int)


def test_top_k_equals_brute_force(spark, small):
    vectors = vectors_of(spark, small)
    want = brute(vectors, [i for i in vectors if i % 20 == 0], lambda a, b: -int(whole(a) @ whole(b)))
    frame = spark.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/embeddings.parquet")
    for shard_rows, block_rows in ((8192, 2048), (60, 7)):
        assert answers(kd_search.top_k(frame, F.col("vec_id") % 20 == 0, shard_rows=shard_rows, block_rows=block_rows)) == want


ODD = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, []), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 0.0]),
       (8, [0.0, 0.0]), (9, [1.0, 0.0]), (None, [1.0, 0.0]), (10, [1.0, 2.0, 3.0]), (11, [1.0, 0.0, 0.0]), (2, [0.5, 0.5])]


def test_vector_cases(spark):
    frame = spark.createDataFrame([(i, x, 1) for i, x in ODD], "vec_id long, embedding array<float>, score int")
    top = answers(kd_search.top_k(frame, F.lit(True), k=3, shard_rows=2))
    assert top[0] == [(1, 1024**2), (9, 1024**2), (2, 512 * 1024)] and set(top) == {0, 1, 2, 8, 9, 10, 11}
    assert top[10] == [(11, 1024**2)]
    near = answers(learned_ann.nearest(frame, F.lit(True), k=3))
    assert [i for i, _ in near[0]] == [1, 9, 2] and set(near) == {0, 1, 2, 9, 10, 11}
    assert kd_search.top_k(frame.limit(0), F.lit(True)).count() == 0
    assert learned_ann.nearest(frame.limit(0), F.lit(True)).count() == 0


def test_every_row_of_a_repeated_id_is_searched(spark):
    rows = [(0, [1.0, 0.0]), (7, [9.0, 0.0]), (7, [0.0, 1.0]), (8, [2.0, 0.0]), (0, [0.0, 3.0])] + [(0, [50.0, 50.0])] * 300
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    top = answers(kd_search.top_k(frame.limit(4), F.col("vec_id") == 0, k=2))
    assert top[0] == [(7, 9 * 1024**2), (8, 2 * 1024**2)]
    assert answers(kd_search.top_k(frame, F.col("vec_id") == 8))[8] == [(0, 100 * 1024**2)] * 10
    both = answers(kd_search.top_k(frame, F.col("vec_id") == 7, k=302))[7]
    assert [i for i, _ in both] == [0] * 302
    near = answers(learned_ann.nearest(frame.limit(4), F.col("vec_id") == 0, k=3))
    assert near[0] == [(8, 1.0), (7, math.sqrt(2)), (7, 8.0)]


def test_top_k_of_large_components_is_exact(spark):
    big = [(0, [3e12, 1.0]), (1, [2.0, 1.0]), (2, [2.0, 1.001]), (3, [-2.0, 5.0])]
    got = answers(kd_search.top_k(spark.createDataFrame(big, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=2))
    x = {i: whole(np.array(v)) for i, v in big}
    assert got[0] == [(2, int(x[0] @ x[2])), (1, int(x[0] @ x[1]))]


def test_ann_recall_and_scores(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((30, 24))
    points = {i: centres[rng.integers(30)] + 0.6 * rng.standard_normal(24) for i in range(6000)}
    frame = spark.createDataFrame([(i, x.tolist()) for i, x in points.items()], "vec_id long, embedding array<double>")
    want = brute(points, [i for i in points if i % 50 == 0], lambda a, b: float(np.sqrt(((a - b) ** 2).sum())))
    got = answers(learned_ann.nearest(frame, F.col("vec_id") % 50 == 0, sample=2000, cell_rows=300, block_rows=20))
    assert set(got) == set(want) and all(len(g) == 10 for g in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9
    for q, found in got.items():
        for i, s in found:
            assert math.isclose(s, float(np.sqrt(((points[q] - points[i]) ** 2).sum())), rel_tol=1e-12)


def test_balanced_cut_is_balanced_and_keeps_clusters():
    rng = np.random.default_rng(0)
    x = np.concatenate([c + 0.1 * rng.standard_normal((100, 4)) for c in 10 * rng.standard_normal((8, 4))])
    graph = learned_ann.neighbour_graph(x, 8)
    label = learned_ann.balanced_cut(graph, 8)
    assert np.bincount(label).tolist() == [100] * 8
    assert (label[graph] == label[:, None]).mean() > 0.9


# WARC --------------------------------------------------------------------------------------------------------------


def test_audit_finds_exactly_the_damage(spark, small):
    records = [(f, o, f"h{f}-{o}") for f in range(4) for o in range(0, 3000 if f else 40_000, 37)]
    rotten = [r for r in records if r[1] % 41] + [(9, 5, "new"), (1, 1, "between")]
    rotten = [(f, o, h + "x" if o == 74 else h) for f, o, h in rotten]
    first, second = (spark.createDataFrame(x, "file long, offset long, hash string") for x in (records, rotten))
    got = {(r.file, r.offset, r.status, r.range_start) for r in warc_fixity.audit(first, second, range_bytes=100, fan=4).collect()}
    a, b = {r[:2]: r[2] for r in records}, {r[:2]: r[2] for r in rotten}
    want = {(*k, "missing" if k not in b else "extra" if k not in a else "altered", k[1] // 100 * 100) for k in {*a, *b} if a.get(k) != b.get(k)}
    assert got == want and {w[2] for w in want} == {"missing", "extra", "altered"}
    assert warc_fixity.audit(first, first, range_bytes=100, fan=4).count() == 0


def test_only_differing_branches_are_read(spark):
    records = spark.range(2000).selectExpr("id % 3 as file", "id * 10 as offset", "cast(id as string) as hash")
    levels = warc_fixity.tree(warc_fixity.leaves(records), 100, 4)
    assert [x.where("file = 0").count() for x in levels][-1] == 1 and levels[0].count() == 3 * 200
    other = warc_fixity.tree(warc_fixity.leaves(records.withColumn("hash", F.when(F.col("offset") == 3000, "bad").otherwise(F.col("hash")))), 100, 4)
    differing = [warc_fixity._differing(x, y).count() for x, y in zip(levels, other, strict=True)]
    assert differing == [1] * len(levels)


def test_archive_offsets(spark):
    pages = spark.createDataFrame([(2, "u2", "ßx"), (1, "u1", None), (None, None, "lost"), (1, "u1", None), (1001, "v", "")], "page_id long, url string, html string")
    rows = warc_fixity.archived(pages).collect()
    first = sorted((r.offset, r.length) for r in rows if r.file == 0)
    assert first[0][0] == 0 and first[1][0] == first[0][1] and first[2][0] == first[0][1] + first[1][1]
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: u2\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: 3\r\n\r\n"
    assert next(r.length for r in rows if r.page_id == 2) == len(head) + 3 + 4
    assert len(rows) == 5 and warc_fixity.audit(warc_fixity.archived(pages.limit(0)), warc_fixity.archived(pages)).count() == 5


# SQL ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, small, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"create view {table} as select * from '{small}/{table}.parquet'")
    df = queries.QUERIES[name](spark, small)
    cursor = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(map(str, ([row[names.index(c)] for c in sorted(names)] for row in cursor.fetchall())))
    got = sorted(map(str, ([row[c] for c in sorted(names)] for row in df.collect())))
    assert got == want and got
