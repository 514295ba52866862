"""Follow-ups of a name that very many cards share."""

import datetime as dt

from pyspark.sql import functions as F

from caseloom.operators import follow

DAY = dt.date(2024, 1, 1)


def test_a_hot_name_meets_history_by_its_distinct_dates(spark):
    """Two days of 20,000 cards with one name and three dates: four hundred million pairs of cards, nine of cells."""
    p = spark.range(40_000).select(
        F.concat(F.lit("u"), F.format_string("%06d", "id")).alias("uid"), F.lit("harbourtrust").alias("norm"), F.lit("attack").alias("fam"),
        F.when(F.col("id") < 20_000, F.lit(DAY)).otherwise(F.lit(DAY + dt.timedelta(9))).alias("scope"),
        F.when(F.col("id") % 4 > 0, F.date_add(F.lit(DAY), F.col("id").cast("int") % 4)).alias("ref"), F.lit(None).cast("date").alias("pub"))
    p = p.withColumn("ord", follow.history_order())
    gap = F.abs(F.datediff("ref_l", "ref_r"))
    left = follow._left(p, ["norm", "fam"], ["ref"])
    hits = follow._prior(left, follow._right(p, ["norm", "fam"], ["ref"]), ["norm", "fam"], gap <= 14)
    got = {(r["low"], r["high"], r["n"]) for r in hits.groupBy("hit.uid").agg(F.min("uid_l").alias("low"), F.max("uid_l").alias("high"), F.count("*").alias("n")).collect()}
    # the newest incident of the earliest day comes first in its list; cards without a date have none to compare
    assert got == {("u020001", "u039999", 15_000)}
    assert hits.select("hit.uid").first()["uid"] == "u000003"


def test_null_inputs_meet_as_cells_too(spark):
    rows = [("a", "n", "f", DAY, None), ("b", "n", "f", DAY + dt.timedelta(3), None), ("c", "n", "f", DAY + dt.timedelta(3), None),
            ("d", "m", "f", DAY + dt.timedelta(30), None)]
    p = spark.createDataFrame(rows, "uid string, norm string, fam string, scope date, ref date").withColumn("pub", F.lit(None).cast("date"))
    p = p.withColumn("ord", follow.history_order())
    hits = follow._prior(follow._left(p, ["norm", "fam"], ["ref"]), follow._right(p, ["norm", "fam"], ["ref"]), ["norm", "fam"])
    assert {(r.uid_l, r.hit.uid) for r in hits.collect()} == {("b", "a"), ("c", "a")}


def test_a_shared_key_finds_its_earliest_day_without_a_row_a_day(spark):
    rows = [("k", 0, "b"), ("k", 0, "a"), ("k", 3, "c"), ("k", 14, "d"), ("k", 17, "e"), ("k", 40, "f"), ("l", 3, "g"), ("m", 0, "h"), ("m", 0, "i")]
    keys = spark.createDataFrame([(k, DAY + dt.timedelta(d), u) for k, d, u in rows], "key string, scope date, uid string").select(
        "key", "scope", F.struct(F.col("scope").alias("day"), F.lit(0).alias("o1"), F.lit(0).alias("o2"), "uid").alias("ord"))
    hits = follow.shared_hits(keys)
    assert {(r.uid_l, r.hit.uid) for r in hits.collect()} == {("c", "a"), ("d", "a"), ("e", "c")}
    assert "Generate" not in hits._jdf.queryExecution().optimizedPlan().toString()


def test_each_rule_is_a_plan_of_its_own(spark):
    """What links are made of is written rule by rule; one plan of all rules held hundreds of exchanges in the driver."""
    rows = [(f"u{i}", "rss:a", "Title of a case", "hack_exploit", f"moonbase{i}", DAY + dt.timedelta(i), DAY, DAY, 5.0, [], []) for i in range(3)]
    g = spark.createDataFrame(rows, "uid string, source string, title string, incident_type string, project string, coll_day date, "
                              "incident_date date, published_at date, amount_usd double, tags array<string>, tx_hashes array<string>").withColumn("relevant", F.lit(True))
    links = follow.followup_links(g, spark.createDataFrame([("u0", "0xa", "attacker"), ("u2", "0xA", "unknown")], "uid string, address string, role string"))
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 1
    assert ("u2", "u0") in {(r.uid, r.orig_uid) for r in links.collect()}
