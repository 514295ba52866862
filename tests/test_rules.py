"""Text, name, amount and checksum rules on hand-made rows."""

import datetime as dt
import itertools
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from caseloom import fixed
from caseloom.functions import checksums, html
from caseloom.functions import text as tx
from caseloom.operators import extract, follow, golden, quality, resolve, tables
from caseloom.sources import readers


def values(spark, column, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.select(column(F.col("t")).alias("v"), "i").orderBy("i").select("v").collect()]


def test_names(spark):
    got = values(spark, tx.normalize_name, "Yam Finance", "orbtoken", "The Bridge (v2)", "가나 Protocol", None)
    assert got == ["yam", "orb", "", "가나", ""]
    assert values(spark, tx.name_tokens, "Big Bad Finance a") == [["bad", "big"]]
    assert values(spark, lambda t: F.size(tx.trigrams(t)), "abc", "") == [4, 1]


def test_keywords_are_whole_words(spark):
    hit = values(spark, lambda t: tx.has_keyword(t, ["ether", "defi", "designat*", "해킹*"]),
                 "whether", "definition", "ethers", "designated", "비해킹", "가상자산 해킹으로")
    assert hit == [False, False, True, True, False, True]


def test_money(spark):
    assert values(spark, tx.max_amount, "lost $1.2 billion and $3M", "no money") == [1.2e9, None]
    assert values(spark, tx.loss_amount, "$56.9BNB", "$ 12K", "none") == [56.9, 12000.0, None]
    assert values(spark, tx.clean, "about $320 M, 300 × more") == ["about $320M, 300x more"]
    assert values(spark, lambda t: tx.states_amount(t, F.lit(121000.0)), "took $121K", "took $118K") == [True, False]


def test_days(spark):
    got = values(spark, tx.to_day, "1709632800", "1709632800000", "$D2024-03-05T01:02:03Z",
                 "Tue, 05 Mar 2024 10:00:00 GMT", "March 5, 2024", "soon")
    assert got == [dt.date(2024, 3, 5)] * 5 + [None]
    assert values(spark, tx.leaderboard_day, "3/5/24", "13/5/24", "x") == [dt.date(2024, 3, 5), None, None]


def test_checksum_vectors():
    lower = pd.Series(["0x5aaeb6053f3e94c9b9a09f33669435e7ef1beaed", "0xfb6916095ca1df60bb79ce92ce3ea74c37c5d359"])
    assert checksums.eip55_forms(lower).tolist() == [
        "0x5aAeb6053F3E94C9b9A09f33669435E7Ef1BeAed", "0xfB6916095ca1df60bB79Ce92cE3Ea74c37c5d359"]
    assert checksums.bech32_valid("bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t4")
    assert not checksums.bech32_valid("bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t5")
    assert checksums.base58_parts("1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa") == (True, 0, 25)


def test_addresses_of_a_text(spark):
    text = ("to 0x5aAeb6053F3E94C9b9A09f33669435E7Ef1BeAed and 0x5aaeb6053f3e94c9b9a09f33669435e7ef1beaed, "
            "1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa, not 1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNb, tx 0x" + "ab" * 32)
    df = spark.createDataFrame([("u", text)], "uid string, text string")
    got = {(r.chain, r.address) for r in extract.addresses(df).collect()}
    assert got == {("ETH", "0x5aAeb6053F3E94C9b9A09f33669435E7Ef1BeAed"), ("BTC", "1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa")}
    forms = {r.address: (r.family, r.valid, r.fixed, r.reason) for r in extract.address_formats(spark.createDataFrame(
        [("0x" + "ab" * 32,), ("0x5AAeb6053F3E94C9b9A09f33669435E7Ef1BeAed",), ("zz",)], "address string")).collect()}
    assert forms["0x" + "ab" * 32] == ("evm", False, None, "tx_hash")
    assert forms["0x5AAeb6053F3E94C9b9A09f33669435E7Ef1BeAed"] == (
        "evm", True, "0x5aaeb6053f3e94c9b9a09f33669435e7ef1beaed", "eip55_mismatch")
    assert forms["zz"] == ("other", False, None, "unknown_format")


def test_page_text_prefers_the_article():
    page = ("<html><head><meta property='og:description' content='about'></head><body><nav><p>menu</p></nav><div>"
            "<article><p>one two three</p><p>four<br>five</p><p>six</p></article><div>side</div></div></body></html>")
    root = html.parse(page)
    assert html.description(root) == "about"
    assert html.page_text(root) == "one two three\nfour\nfive\nsix"


def test_a_page_may_be_nested_without_end():
    page = "<font>" * 100_000 + "deep" + "</b>" * 100_000 + "<p>one</p>"
    assert html.page_text(html.parse(page)) == "one"
    assert html.fragment_text(page) == "deep\none"


def test_page_fields():
    page = ("<html><head><title> A <b>b</b></title><meta name=date content=' 2024-01-01 '><meta name='description' content=''>"
            "<meta name='twitter:description' content='t'></head><body><time datetime='2023'>x</time><div><p>a</p><p>b</p></div>"
            "<form><p>no</p></form><ul><li>one<li>two <p>three</ul><p>Credit: me</p></body></html>")
    root = html.parse(page)
    assert (html.title(root), html.published(root), html.description(root)) == ("A  b".replace("  ", " "), "2024-01-01", "t")
    assert html.page_text(root, drop=("^credit:",)) == "a\nb\none\ntwo three\nthree"
    assert html.page_text(root, selectors=("ul",)) == "one\ntwo three\nthree"
    assert html.fragment_text("<p>a<br>b</p> <i>c</i>") == "a\nb\nc"
    assert html.published(html.parse("<time>March 5</time>")) == "March 5" and html.page_text(html.parse("")) == ""


def test_articles_of_hand_made_pages(spark):
    page = ("<html><head><title>Site - The Big Case</title><meta property='og:description' content='about it'></head><body>"
            "<a href='/?tag=b'>B</a><a href='/?tag=a'>A</a><a href='/x'>no</a><p>out</p><article><p>Tuesday, March 5, 2024</p><p>lost <b>all</b></p></article></body></html>")
    (r,) = readers.articles(spark.createDataFrame([("u1", page)], "url string, html string"), title_prefix="Site - ").collect()
    assert (r.source_id, r.title, str(r.published_at), r.tags, r.hint) == ("u1", "The Big Case", "2024-03-05", ["A", "B"], "about it")
    assert r.text == "Tuesday, March 5, 2024\nlost  all".replace("  ", " ")


def vote(spark, rows):
    cols = "uid string, source string, amount_usd double, published_at date, amount_text string, tags array<string>"
    df = spark.createDataFrame(rows, cols).withColumn("g", F.lit(1))
    return [(r.amount_usd, r.amount_text) for r in golden.consensus(df, "g").collect()]


def test_consensus(spark):
    d = [dt.date(2024, 1, i) for i in range(1, 10)]
    many = [("a", "other", 352.0, d[0], "", []), ("b", "other", 352.0, d[1], "", []), ("c", "other", 387.5, d[2], "x", []),
            ("d", "other", 387.5, d[3], "late", []), ("e", "other", 388.0, d[2], "", [])]
    assert vote(spark, many) == [(387.5, "late")]
    assert vote(spark, many[:1]) == []
    trusted = [("a", "rekt", 100.0, d[0], "", []), ("b", "other", 200.0, d[5], "", [])]
    assert vote(spark, trusted) == [(100.0, "")]
    board = [("a", "rekt", 100.0, d[0], "", ["rekt_leaderboard"]), ("b", "other", 200.0, d[0], "", [])]
    assert vote(spark, board) == [(200.0, "")]


def folded_vote(amounts):
    """The rule on plain rows: clusters by running mean, the largest wins, the first of equals."""
    clusters = []
    for a, n in sorted(Counter(amounts).items()):
        if clusters and abs(a - clusters[-1][1] / clusters[-1][0]) / (clusters[-1][1] / clusters[-1][0]) <= 0.05:
            c = clusters[-1]
            clusters[-1] = (c[0] + n, c[1] + a * n, c[2])
        else:
            clusters.append((n, a * n, a))
    most = max(c[0] for c in clusters)
    return next(c for c in clusters if c[0] == most)


def test_consensus_equals_a_plain_fold(spark):
    rng, day = random.Random(3), dt.date(2024, 1, 1)
    for scale in (0.02, 0.3, 3):
        amounts = [round(100 * 2.718281828 ** rng.uniform(0, scale), 2) for _ in range(80)]
        (amount, _), = vote(spark, [(f"u{i:03d}", "other", a, day, "", []) for i, a in enumerate(amounts)])
        assert amount == folded_vote(amounts)[2]  # one day, no text: the smallest amount speaks


def test_consensus_of_a_hundred_thousand_amounts(spark):
    df = spark.range(100_000).select(
        F.format_string("u%06d", "id").alias("uid"), F.lit("other").alias("source"), (F.col("id") * 7 + 1000).cast("double").alias("amount_usd"),
        F.lit(dt.date(2024, 1, 1)).alias("published_at"), F.lit("").alias("amount_text"), F.array().cast("array<string>").alias("tags"), F.lit(1).alias("g"))
    (row,) = golden.consensus(df, "g").collect()
    assert row.amount_usd == folded_vote([i * 7 + 1000.0 for i in range(100_000)])[2]


CARD = ("uid string, source string, source_id string, url string, coll_day date, incident_type string, incident_date date, published_at date, "
        "tags array<string>, amount_usd double, amount_text string, title string, project string, relevant boolean, tx_hashes array<string>, "
        "chains array<string>, actors array<string>, enriched boolean, summary_ko string, summary_en string, attack_method string")
NO_ADDRESSES = "uid string, ord bigint, address string, chain string, role string, note string"


def cards_of(spark, *cards):
    base = {"source": "other", "source_id": "", "url": "", "incident_type": "scam_fraud", "tags": [], "amount_text": "", "relevant": True,
            "chains": [], "actors": [], "enriched": True, "summary_ko": "", "summary_en": "", "attack_method": "", "amount_usd": None, "tx_hashes": []}
    rows = []
    for uid, day, project, more in cards:
        row = base | {"uid": uid, "coll_day": day, "incident_date": day, "published_at": day, "project": project, "title": project} | more
        rows.append(tuple(row[c.split()[0]] for c in CARD.split(", ")))
    return spark.createDataFrame(rows, CARD)


def resolved(spark, cards):
    none = spark.createDataFrame([], NO_ADDRESSES)
    m = golden.members(cards, none, resolve.components(cards, resolve.merge_edges(cards, none)))
    g = golden.golden_records(m)
    tx_rows = golden.golden_tx(m).join(g.select("cid", "uid"), "cid")
    links = follow.followup_links(g, golden.golden_addresses(m, none).join(g.select("cid", "uid"), "cid"), None, tx_rows)
    return m, g, links


def test_follow_up_by_the_last_of_41_hashes(spark):
    many = [f"0x{i:064x}" for i in range(41)]
    cards = cards_of(spark, ("a", dt.date(2024, 1, 1), "Alphaville", {"tx_hashes": many}), ("b", dt.date(2024, 1, 8), "Omegatown", {"tx_hashes": many[-1:]}))
    m, g, links = resolved(spark, cards)
    assert {r.uid: len(r.tx_hashes) for r in g.collect()} == {"a": 41, "b": 1}
    assert [(r.uid, r.orig_uid) for r in links.collect()] == [("b", "a")]


def test_chains_of_follow_ups_and_revised_amounts(spark):
    """c reports on b, b on a; the three vote on a's amount again, d stays alone."""
    name, day = "Bridgekeeper", dt.date(2024, 1, 1)
    cards = cards_of(
        spark, ("a", day, name, {"amount_usd": 100.0}), ("b", day + dt.timedelta(10), name, {"amount_usd": 200.0}),
        ("c", day + dt.timedelta(20), name, {"amount_usd": 201.0, "incident_date": day + dt.timedelta(12)}), ("d", day, "Otherthing", {"amount_usd": 7.0}))
    m, g, links = resolved(spark, cards)
    assert {(r.uid, r.orig_uid) for r in links.collect()} == {("b", "a"), ("c", "b")}
    roots = follow.followup_roots(links)
    assert {(r.uid, r.root_uid) for r in roots.collect()} == {("b", "a"), ("c", "a")}
    revised = {r.uid: (r.amount_usd, r.amount_revised_from) for r in follow.revise_amounts(g, m, roots).collect()}
    assert revised["a"] == (201.0, 100.0) and revised["d"] == (7.0, None)


def test_names_are_compared_inside_a_day_only(spark):
    p = resolve.profile_table(cards_of(spark, ("a", dt.date(2024, 1, 1), "Moonbase", {}), ("b", dt.date(2024, 1, 1), "Moonbases", {}),
                                       ("c", dt.date(2024, 5, 6), "Moonbases", {})))
    assert {(str(r.scope), r.a, r.b) for r in resolve.name_pairs(p, ["scope"]).collect()} == {("2024-01-01", "moonbase", "moonbases")}


def test_numbers_inside_a_key(spark):
    df = spark.range(3000).selectExpr("id % 3 as k", "id * 7919 % 3000 as v").repartition(16)
    got = {(r.k, r.v): r.n for r in tables.numbered(df, ["k"], ["v"], "n").collect()}
    for k in range(3):
        ordered = sorted(v for (kk, v) in got if kk == k)
        assert [got[k, v] for v in ordered] == list(range(1, 1001))


@pytest.mark.parametrize("threshold, length", [(0.5, 9), (0.5, 40), (0.6, 30)])
def test_jaccard_pairs_of_longer_sets(spark, threshold, length):
    rng = random.Random(length)
    base = ["".join(rng.choice("abcdef") for _ in range(length)) for _ in range(12)]
    names = {"".join(c if rng.random() > 0.1 else rng.choice("abcdef") for c in rng.choice(base))[: rng.randint(1, length)] for _ in range(160)}
    df = spark.createDataFrame([(n,) for n in names], "norm string").withColumn("grams", tx.trigrams(F.col("norm")))
    got = {tuple(sorted((r.id_a, r.id_b))) for r in resolve.jaccard_pairs(df, [], "norm", "grams", threshold).collect()}

    def grams(s):
        s = f"  {s} "
        return {s[i:i + 3] for i in range(len(s) - 2)}

    want = {tuple(sorted(p)) for p in itertools.combinations(names, 2)
            if len(grams(p[0]) & grams(p[1])) / len(grams(p[0]) | grams(p[1])) >= threshold}
    assert got == want and want


def test_jaccard_pairs_equal_brute_force(spark):
    rng = random.Random(7)
    names = {"".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))) for _ in range(150)}
    df = spark.createDataFrame([(n,) for n in names], "norm string").withColumn("grams", tx.trigrams(F.col("norm")))
    got = {tuple(sorted((r.id_a, r.id_b))) for r in resolve.jaccard_pairs(df, [], "norm", "grams", 0.6).collect()}

    def grams(s):
        s = f"  {s} "
        return {s[i:i + 3] for i in range(len(s) - 2)}

    want = {tuple(sorted(p)) for p in itertools.combinations(names, 2)
            if len(grams(p[0]) & grams(p[1])) / len(grams(p[0]) | grams(p[1])) >= 0.6}
    assert got == want and want


@pytest.mark.parametrize("parts", [1, 7])
def test_components_do_not_depend_on_order(spark, parts):
    edges = [("a", "b"), ("b", "c"), ("e", "d"), ("z", "a"), ("f", "f")]
    df = spark.createDataFrame(edges[::-1] if parts == 7 else edges, "a string, b string").repartition(parts)
    vertices = spark.createDataFrame([(v,) for v in "abcdefz"], "uid string")
    got = {r.uid: r.cid for r in resolve.components(vertices, df).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "z": "a", "d": "d", "e": "d", "f": "f"}


def test_star_links_a_hot_key_linearly(spark):
    df = spark.range(5000).select(F.lit("hot").alias("key"), F.format_string("u%05d", "id").alias("uid"))
    edges = resolve.star(df, ["key"])
    assert edges.count() == 4999 and edges.select("a").distinct().collect()[0].a == "u00000"


def test_two_cards_named_unknown_join_by_date(spark):
    day = dt.date(2024, 1, 8)
    cols = ("uid string, source string, coll_day date, incident_type string, incident_date date, published_at date, "
            "tags array<string>, amount_usd double, title string, project string, relevant boolean, tx_hashes array<string>")
    rows = [(u, "other", day, t, d, d, [], None, "t", p, True, []) for u, t, d, p in (
        ("a", "scam_fraud", dt.date(2024, 1, 1), "Unknown"), ("b", "scam_fraud", dt.date(2024, 1, 12), "unknown"),
        ("c", "law_enforcement_action", dt.date(2024, 1, 1), "Unknown"), ("d", "scam_fraud", dt.date(2024, 2, 20), "Unknown"))]
    cards = spark.createDataFrame(rows, cols)
    none = spark.createDataFrame([], "uid string, address string, role string")
    comp = {r.uid: r.cid for r in resolve.components(cards, resolve.merge_edges(cards, none)).collect()}
    assert comp == {"a": "a", "b": "a", "c": "c", "d": "d"}


def test_delegated_account_is_no_contract(spark):
    code = ["0xef0100" + "ab" * 20, "0x6001", "0x", None]
    assert values(spark, quality.code_size, *code) == [0, 2, 0, 0]


def test_classes_by_ranges_leave_what_the_negated_ones_left(spark):
    """Over all code points; as negated classes these took most of the time of evidence and name keys."""
    points = spark.range(1, 0x110000).where("id < 55296 or id > 57343").selectExpr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32') as c")
    for ranges, negated in ((tx.UNQUOTED, r"[^0-9a-z가-힣$%.,]+"), (tx.UNNAMED, r"[^a-z0-9가-힣 ]+"), (tx.UNKEYED, "[^a-z0-9가-힣]+")):
        assert points.where(F.regexp_replace("c", ranges, "") != F.regexp_replace("c", negated, "")).count() == 0


def test_a_text_is_made_ready_for_its_evidence_once(spark):
    """The text was stripped of punctuation for each phrase that is looked for in it."""
    patches = spark.createDataFrame([("u1", "stolen — coins", 5.0, "lost $5", "no phrase", "Moonbase")],
                                    "uid string, p_date_evidence string, p_amount double, p_amount_evidence string, p_type_evidence string, p_project string")
    texts = spark.createDataFrame([("u1", "The Stolen coins of MOONBASE, they lost $5 " + "x " * 200)], "uid string, text string")
    found = extract.field_evidence(patches, texts)
    assert {r.field for r in found.where("found").collect()} == {"date", "amount", "project"}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?U)\\s+") == 10  # three times for each of three phrases, once for the text; 15 before


def test_texts_are_searched_for_addresses_once(spark):
    """The search ran three times: for plain forms, for the strings to decode and for those to join back."""
    texts = spark.createDataFrame([("u1", f"to 0x{'ab' * 20} and 1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa now")], "uid string, text string")
    found = extract.addresses(texts)
    assert {(r.chain, r.address) for r in found.collect()} == {("ETH", f"0x{'ab' * 20}"), ("BTC", "1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa")}
    assert "regexp_extract_all" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_keyword_test_hits_where_the_pattern_does(spark):
    rng = random.Random(5)
    lists = [fixed.PRESS_KEYWORDS, fixed.CRIME_KEYWORDS, fixed.CRYPTO_KEYWORDS + fixed.CHAIN_KEYWORDS, fixed.MESSAGE_KEYWORDS,
             ["a", "ab", "abc*", "ab*", "b", "c.d", "wallets*"], ["x*"], ["solo"], [], ["", "*"]]
    words = [w.rstrip("*") for ws in lists for w in ws]

    def part():
        w = rng.choice(words)
        return rng.choice([w, w.upper(), w[:-1], w + rng.choice(["s", "es", "ed", "ing", "er", "ers", "x", "s1", "_"]), rng.choice("abx1") + w, "가" + w])

    texts = ["", None, "\u017folana", "to\u212aen"] + [rng.choice(["", " ", "-", "é"]).join(part() for _ in range(rng.randint(1, 3))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for ws in lists:
        plain = F.coalesce("t", F.lit("")).rlike(tx.keyword_pattern(ws))
        assert df.where(tx.has_keyword(F.col("t"), ws) != plain).count() == 0, ws
    assert "rypto(?:currenc" in tx.keyword_test(fixed.PRESS_KEYWORDS)
