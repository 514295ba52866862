"""State tables and streams: replays change nothing, streams equal batches."""

import datetime as dt
import pathlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from caseloom.operators import tables
from caseloom.plans.catalog import QUERIES
from caseloom.plans.fixture import load
from caseloom.session import cut_lineage, scratch_path
from caseloom.streaming import jobs


def items(spark, *rows):
    return spark.createDataFrame([(u, t, 0, s, dt.date(2024, 1, 1), dt.date(2024, 1, 1)) for u, t, s in rows],
                                 "uid string, title string, arrival int, status string, published_at date, first_seen date")


def test_a_replayed_batch_is_idempotent(spark):
    state, out = scratch_path(spark, "items"), scratch_path(spark, "out")
    work = jobs.ingest(spark, state, out)
    first = items(spark, ("a", "x", "enriched"), ("b", "x", "pending"))
    second = items(spark, ("a", "again", "enriched"), ("b", "again", "enriched"), ("c", "x", "enriched"))
    work(first, 0)
    work(second, 1)
    work(second, 1)
    new = {(r.batch, r.uid) for r in spark.read.parquet(out).select("batch", "uid").collect()}
    assert new == {(0, "a"), (0, "b"), (1, "b"), (1, "c")}
    assert {(r.uid, r.status) for r in jobs.items_now(spark, state).collect()} == {
        ("a", "enriched"), ("b", "enriched"), ("c", "enriched")}


def files_under(path):
    return {p: p.stat().st_mtime_ns for p in pathlib.Path(path.removeprefix("file:")).rglob("*.parquet")}


def test_a_batch_leaves_the_files_of_history_alone(spark):
    state, work = scratch_path(spark, "items"), None
    work = jobs.ingest(spark, state, scratch_path(spark, "out"))
    work(items(spark, *((f"u{i}", "x", "enriched") for i in range(2000))), 0)
    before = files_under(state)
    work(items(spark, *((f"v{i}", "x", "enriched") for i in range(10))), 1)
    after = files_under(state)
    assert len(before) > 100 and 1 <= len(after) - len(before) <= 10 and all(after[p] == t for p, t in before.items())
    assert jobs.items_now(spark, state).count() == 2010


def test_a_log_is_compacted(spark):
    path, small = scratch_path(spark, "log"), scratch_path(spark, "small")
    schema = "uid string, written bigint, first_seen date"
    for written, day in ((1, dt.date(2024, 1, 1)), (2, dt.date(2024, 2, 2))):
        tables.append_changes(path, spark.createDataFrame([("k", written, day)], schema), "uid", written)
    tables.compacted(spark, path, schema, "uid", "written", small, parts=4)
    assert len(files_under(small)) == 1
    assert [(r.written, r.first_seen) for r in tables.changes_of(spark, small, schema).collect()] == [(2, dt.date(2024, 1, 1))]


def test_first_drop_is_a_baseline(spark):
    snapshot, out = scratch_path(spark, "snap"), scratch_path(spark, "added")
    work = jobs.snapshot_diff(spark, snapshot, out)
    for i, drop in enumerate((["a", "b"], ["a", "b", "c"], ["c", "d"])):
        for _ in range(2):  # every drop is delivered twice
            work(spark.createDataFrame([(v,) for v in drop], "value string"), i)
    assert {(r.batch, r.value) for r in spark.read.parquet(out).collect()} == {(1, "c"), (2, "d")}
    assert sorted(r.value for r in tables.batches(spark, snapshot, "value string").collect()) == ["a", "b", "c", "d"]


ALERT = "uid string, members array<string>, incident_type string, amount_usd double"


def alert_run(spark, *runs):
    """uids told on one channel that takes one a run"""
    store = scratch_path(spark, "alerts")
    work = jobs.alerts(spark, store, spark.createDataFrame([("chat", 0.0, 1)], "channel string, min_amount double, max_per_run int"))
    for i, rows in enumerate(runs):
        batch = spark.createDataFrame([(u, m, "scam_fraud", a) for u, m, a in rows], ALERT)
        work(batch, i)
        work(batch, i)  # again, as after a restart
    return [(r.batch, r.uid) for r in spark.read.parquet(f"{store}/out").orderBy("batch").collect()]


def test_alert_once_per_channel(spark):
    got = alert_run(spark, [("a", ["a", "b"], 5.0), ("c", ["c"], 9.0)], [("b", ["a", "b"], 5.0), ("c", ["c"], 9.0)], [("a", ["a", "b"], 5.0)])
    assert got == [(0, "c"), (1, "b")]


def test_alerts_over_the_limit_go_first_in_the_next_run(spark):
    got = alert_run(spark, [("a", ["a"], 5.0), ("c", ["c"], 9.0)], [("z", ["z"], 50.0)], [("y", ["y"], 60.0)], [])
    assert got == [(0, "c"), (1, "a"), (2, "z"), (3, "y")]


def card(uid, day, project="p", seen=1):
    return (uid, dt.date(2024, 1, day), project), [(uid, "ETH", f"0x{uid}", "attacker", dt.date(2024, seen, 1))]


def stored(spark, path, *cards):
    tables.replace_cards(
        spark, path, spark.createDataFrame([c for c, _ in cards], "uid string, coll_day date, project string"),
        spark.createDataFrame([a for _, rows in cards for a in rows], "uid string, chain string, address string, role string, first_seen date"))
    held = {r.uid: r.first_seen.month for r in tables.stored_addresses(spark, path).collect()}
    return sorted((r.uid, r.coll_day.day, r.project, held.get(r.uid)) for r in tables.stored_cards(spark, path).collect())


def test_replacing_a_card_keeps_the_others_of_its_day(spark):
    path = scratch_path(spark, "cards")
    assert stored(spark, path, card("a", 1), card("b", 1), card("c", 2)) == [("a", 1, "p", 1), ("b", 1, "p", 1), ("c", 2, "p", 1)]
    assert stored(spark, path, card("a", 1, "new", 3)) == [("a", 1, "new", 1), ("b", 1, "p", 1), ("c", 2, "p", 1)]
    assert stored(spark, path, (card("b", 1)[0], [])) == [("a", 1, "new", 1), ("b", 1, "p", None), ("c", 2, "p", 1)]
    assert stored(spark, path, card("c", 3, "moved")) == [("a", 1, "new", 1), ("b", 1, "p", None), ("c", 3, "moved", 2 - 1)]
    assert stored(spark, path, (card("a", 1, "bare")[0], [])) == [("a", 1, "bare", None), ("b", 1, "p", None), ("c", 3, "moved", 1)]


def test_links_follow_a_report_that_moves(spark, small):
    """Two reports of one address; the first comes again on a later day and is then the follow-up."""
    cards = load(spark, small, "cards").where("relevant").limit(2).withColumns({
        "uid": F.concat(F.lit("u"), F.row_number().over(Window.orderBy("k")).cast("string")), "tx_hashes": F.array().cast("array<string>")})
    cards = cards.withColumns({
        "coll_day": F.when(F.col("uid") == "u1", F.lit(dt.date(2024, 1, 1))).otherwise(F.lit(dt.date(2024, 1, 8))),
        "title": F.concat("uid", F.lit(" one of its own")), "project": F.concat("uid", F.lit("name")),
        "addresses": F.array(F.struct(F.lit("0xshared").alias("address"), F.lit("attacker").alias("role")))})
    store = scratch_path(spark, "links")
    work = jobs.link_followups(spark, store)
    cards = cut_lineage(cards)

    def links():
        return [(r.uid, r.orig_uid) for r in jobs.links_now(spark, store).collect()]

    work(cards, 0)
    assert links() == [("u2", "u1")]
    work(cards.where("uid = 'u1'").withColumn("coll_day", F.lit(dt.date(2024, 1, 20))), 1)
    assert links() == [("u1", "u2")]
    work(cards.where("uid = 'u1'").withColumn("coll_day", F.lit(dt.date(2024, 5, 20))), 2)
    assert links() == []


def test_refresh_touches_changed_days_only(spark, small):
    store = scratch_path(spark, "refresh")
    rows = spark.createDataFrame([("a", dt.date(2024, 1, d), "t", 1.0) for d in (1, 2, 3)],
                                 "uid string, day date, type string, amount_usd double").withColumns(
        {"event_date": F.col("day"), "project": F.lit("p"), "followup_uid": F.lit(None).cast("string")})
    assert jobs.incremental_refresh(spark, rows, store).count() == 3
    assert jobs.incremental_refresh(spark, rows, store).count() == 0
    later = rows.withColumn("amount_usd", F.when(F.dayofmonth("day") == 2, 7.0).otherwise(F.col("amount_usd")))
    assert [str(r.day) for r in jobs.incremental_refresh(spark, later, store).collect()] == ["2024-01-02"]
    folded = later.withColumn("followup_uid", F.when(F.dayofmonth("day") == 3, "x"))
    assert [str(r.day) for r in jobs.incremental_refresh(spark, folded, store).collect()] == ["2024-01-03"]
    assert {(r.day.day, r["new"], r.amount) for r in jobs.stats_now(spark, store).collect()} == {(1, 1, 1.0), (2, 1, 7.0), (3, 0, 0.0)}
    gone = folded.where(F.dayofmonth("day") != 1)
    assert [str(r.day) for r in jobs.incremental_refresh(spark, gone, store).collect()] == ["2024-01-01"]
    assert {r.day.day for r in jobs.stats_now(spark, store).collect()} == {2, 3}
    assert jobs.incremental_refresh(spark, gone, store).count() == 0


def test_sum_over_types_is_the_total(spark, small):
    by_type = QUERIES["agg_stats_type"](spark, small).agg(F.sum("count"), F.sum("new")).first()
    total = QUERIES["agg_stats_totals"](spark, small).select("total_count", "new_count").first()
    assert tuple(by_type) == tuple(total)
