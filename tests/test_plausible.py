"""Generated doubtful pairs against the rule on all pairs; numbers and sums inside keys."""

import datetime as dt
import random

from pyspark.sql import functions as F

from caseloom.functions.alike import alike
from caseloom.operators import plausible, ranking, resolve

CARD = ("uid string, source string, title string, published_at date, coll_day date, relevant boolean, incident_type string, project string, "
        "incident_date date, chains array<string>, amount_usd double, actors array<string>, tags array<string>")
DAY = dt.date(2024, 3, 4)


def cards_of(spark, rows):
    return spark.createDataFrame(rows, CARD).repartition(4)


def random_cards(n, seed):
    rng = random.Random(seed)
    names = ["Orbit", "Orbital Vault", "orbita", "Vault Mixer", "kraken", "Krakenn", "", "Unknown", "zz top", "Top Coin", None]
    rows = []
    for i in range(n):
        def day(missing, rng=rng):
            return None if rng.random() < missing else DAY + dt.timedelta(days=rng.randint(0, 9))
        rows.append((
            f"u{i:04d}", "rss:a", rng.choice(["Robinhood employees charged", "robinhood listing case", "exchange theft", None]), day(0.2), DAY,
            rng.random() < 0.95, rng.choice(["hack_exploit", "rug_pull", "sanctions_designation", "law_enforcement_action"]), rng.choice(names), day(0.4),
            rng.choice([[], None, ["Ethereum"], ["ETHEREUM", "bsc"], ["BSC", "tron"], ["ethereum", "Ethereum"], ["tron", None]]),
            rng.choice([None, 0.0, 1.0, 2.0, 4.0, 0.5, 8.0, 1e6, 2e6, 5e5, 3.3e6, 4e6 + 0.01]), rng.choice([[], ["Mr Robinhood"], None]),
            []))
    return rows


def test_generated_pairs_equal_the_rule_on_all_pairs(spark):
    cards = cards_of(spark, random_cards(260, 7))
    every = cards.select(F.col("uid").alias("uid_a")).crossJoin(cards.select(F.col("uid").alias("uid_b"))).where("uid_a < uid_b")
    want = {tuple(r) for r in resolve.plausible_pairs(cards, every).select("uid_a", "uid_b").collect()}
    placed, reach = plausible.plausible_reach(cards)
    got = [tuple(r) for r in plausible.pairs(placed, reach).collect()]
    assert set(got) == want and len(got) == len(want) > 500
    places = {(r.cell, r.uid): r.place for r in placed.collect()}
    for r in reach.collect():
        own = places.get((r.cell, r.uid))
        assert r.n == r.last - r.first + 1 - (own is not None and r.first <= own <= r.last) > 0


def test_a_busy_chain_grows_with_its_cards(spark):
    def rows(n):
        return [(f"u{i}", "rss:a", "t", DAY, DAY, True, "hack_exploit", f"name{i}", DAY, ["Ethereum"], 1000.0 + i / n, [], []) for i in range(n)]
    sizes = []
    for n in (400, 1600):
        placed, reach = plausible.plausible_reach(cards_of(spark, rows(n)))
        sizes.append(reach.count())
        assert reach.agg(F.sum("n")).first()[0] == n * (n - 1) and placed.where("cell like 'a|i%'").count() == n
    assert sizes == [400, 1600]


def test_ranges_are_counted_without_a_look_at_the_members(spark):
    """A card knows by itself whether it stands in a cell that it looks into; reach met all members of all cells for that."""
    cards = cards_of(spark, random_cards(80, 3))
    placed, reach = plausible.plausible_reach(cards)
    assert "Join" not in reach._jdf.queryExecution().optimizedPlan().toString()
    own = reach.join(placed, ["cell", "uid"], "left").where("n <> last - first + 1 - cast(coalesce(place between first and last, false) as int)")
    assert own.count() == 0 < reach.count()


def test_no_cards(spark):
    placed, reach = plausible.plausible_reach(cards_of(spark, random_cards(3, 1)).limit(0))
    assert placed.count() == 0 and reach.count() == 0


def test_numbers_and_sums_of_null_keys(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]), i, rng.randint(0, 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, l int, i int, v int").repartition(7)
    held = {}
    for k, l, i, v in sorted(rows, key=lambda r: r[2]):
        held.setdefault((k, l), []).append((i, v))
    numbered = {(r.k, r.l, r.i): r.n for r in ranking.numbered(df, ["k", "l"], ["i"], "n").collect()}
    sums = {(r.k, r.l, r.i): r.s for r in ranking.running_sum(df, ["k", "l"], ["i"], "v", "s").collect()}
    assert len(numbered) == len(sums) == 300
    for (k, l), own in held.items():
        total = 0
        for n, (i, v) in enumerate(own, 1):
            total += v
            assert numbered[k, l, i] == n and sums[k, l, i] == total
    assert ranking.numbered(df, [], ["i"], "n").where("n = i + 1").count() == 300


def test_names_alike_meet_once_a_bin_and_not_by_keys(spark):
    rng = random.Random(11)
    texts = sorted({"".join(rng.choice("abcé가") for _ in range(rng.randint(0, 7))) for _ in range(300)} | {"orbit vault", "orbit vaults", "\U0001f600orbit"})
    rows = [(f"bin{b}", t, b < 2 and rng.random() < 0.2) for b in range(3) for t in texts if rng.random() < 0.6]
    names = spark.createDataFrame(rows, "bin string, norm string, open boolean")

    def grams(t):
        padded = f"  {t} "
        return {padded[i:i + 3] for i in range(len(t) + 1)}

    def jaccard(a, b):
        return len(grams(a) & grams(b)) / len(grams(a) | grams(b))

    want = sorted((b, x, y) for b, x, ox in rows for c, y, oy in rows if b == c and x != y and (ox or oy) and jaccard(x, y) >= plausible.NAME_ALIKE)
    for block in (8, 10_000):  # many cells of a bin, and one
        assert sorted(map(tuple, plausible.alike_names(names, block).collect())) == want
    opened = sum(o for _, _, o in rows)
    assert plausible.dealt_names(names, 10_000).count() == sum(b != "bin2" for b, _, _ in rows) + opened  # a row a name, not one a key
    dealt = plausible.dealt_names(names, 8).groupBy("bin", "i", "j").count()
    assert dealt.agg({"count": "max"}).first()[0] < 60


def test_a_common_name_part_alone_is_found():
    texts = [f"{i:03d}swap" for i in range(200)] + ["swap", "wap"]
    found = dict(alike(["swap", "none"], texts, 0.3))
    assert {texts[j] for j in found[0]} == {t for t in texts if t.endswith("swap")} and not len(found[1])
