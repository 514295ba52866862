"""Golden records and the cards merged into them."""

import datetime as dt

import __spark_entry__ as entry
from caseloom.operators import golden

DAY = dt.date(2024, 1, 1)


def test_merged_cards_are_kept_in_rank_order(spark):
    rows = [("c1", u, s, f"https://x/{u}", f"title {u}", DAY, (r, u)) for u, s, r in [("a", "other", 3), ("b", "rekt", 1), ("d", "doj", 2)]]
    rows += [("c2", "e", "other", "https://x/e", "alone", None, (1, "e"))]
    m = spark.createDataFrame(rows, "cid string, uid string, source string, url string, title string, published_at date, rank struct<r1: int, r5: string>")
    got = sorted((r.cid, r.place, r.uid, r.merged_into, r.source, r.url, r.title, r.published_at) for r in golden.merged_from(m).collect())
    assert got == [("c1", 1, "d", "b", "doj", "https://x/d", "title d", DAY), ("c1", 2, "a", "b", "other", "https://x/a", "title a", DAY)]


def test_no_card_of_an_incident_is_left_out(spark, small):
    rows = entry.queries()["agg_golden_record"](spark, small).collect()
    records = {r.uid: r for r in rows if r.merged_into is None}
    merged = [r for r in rows if r.merged_into is not None]
    assert merged and sum(r.n_members for r in records.values()) == len(rows)
    for uid, record in records.items():
        assert sorted(r.place for r in merged if r.merged_into == uid) == list(range(1, record.n_members))
