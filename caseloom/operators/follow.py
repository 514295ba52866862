"""Follow-ups: later incidents that report on one of the last 14 collected days, and what that does to amounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom import fixed
from caseloom.functions import text as tx
from caseloom.operators import golden, resolve
from caseloom.session import cut_lineage

DAYS = fixed.FOLLOWUP_DAYS


def history_order(scope: str = "scope") -> Column:
    """Earliest day first; inside a day newest incident first, as that day's list is shown."""
    low = F.lit(-10_000_000)
    return F.struct(
        F.col(scope).alias("day"), (-F.coalesce(F.unix_date("ref"), low)).alias("o1"),
        (-F.coalesce(F.unix_date("pub"), low)).alias("o2"), F.col("uid").alias("uid"),
    )


def _prior(left: DataFrame, right: DataFrame, keys: list[str], when: Column | None = None) -> DataFrame:
    """(uid, hit): earliest right row of the 14 days before the left row, on equal keys and a 14-day bin of days.

    Left rows with equal rule inputs meet history as one cell, as history's do, so a name that many cards share on a day
    costs its distinct dates, not its cards. Cards and hits are written: each rule is a few short plans of its own.
    """
    width = F.lit(DAYS)
    cards = cut_lineage(left.select("uid_l", F.struct(*[c for c in left.columns if c != "uid_l"]).alias("_cell")), "cells")
    l = cards.select("_cell").distinct().select("_cell", "_cell.*")
    l = l.withColumn("_bin", F.floor(F.unix_date("scope_l") / width).cast("bigint"))
    first = F.floor(F.unix_date("scope_r") / width).cast("bigint")
    r = right.withColumn("_bin", F.explode(F.array(first, first + 1)))
    gap = F.datediff("scope_l", "scope_r")
    met = l.join(r, [*keys, "_bin"]).where((gap >= 1) & (gap <= DAYS))
    if when is not None:
        met = met.where(when)
    cells = met.groupBy("_cell").agg(F.min("ord").alias("hit"))
    return cut_lineage(cards.join(cells, "_cell").groupBy("uid_l").agg(F.min("hit").alias("hit")), "hits")


def _left(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    renamed = [F.col(c).alias(f"{c}_l") for c in ["uid", "scope", *cols]]
    return df.select(*keys, *renamed)


def _right(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """History reduced to one row per distinct rule input and day, holding the earliest of them."""
    cells = df.groupBy(*keys, "scope", *cols).agg(F.min("ord").alias("ord"))
    return cells.select(*keys, F.col("scope").alias("scope_r"), *[F.col(c).alias(f"{c}_r") for c in cols], "ord")


def shared_hits(keys: DataFrame) -> DataFrame:
    """(uid_l, hit): earliest row of the 14 days before that shares an address or transaction. keys: (key, scope, ord).

    Per key and day one row, and of these the first that a window of 14 days holds: rows number the days of a key, not the
    days in reach. Most keys are seen on one day and meet nothing, so few rows go back to the cards.
    """
    seen = keys.groupBy("key", "scope").agg(F.min("ord").alias("ord"))
    before = Window.partitionBy("key").orderBy(F.unix_date("scope")).rangeBetween(-DAYS, -1)
    earliest = seen.select("key", "scope", F.first("ord").over(before).alias("hit")).where("hit is not null")
    return keys.select("key", "scope", F.col("ord.uid").alias("uid_l")).join(earliest, ["key", "scope"]).groupBy("uid_l").agg(
        F.min("hit").alias("hit"))


def followup_links(incidents: DataFrame, addresses: DataFrame, decisions: DataFrame | None = None,
                   tx_rows: DataFrame | None = None, ident: str = "uid") -> DataFrame:
    """(uid, day, orig_uid, orig_day): each incident with its earliest match among the 14 days before.

    incidents: golden records; addresses: (ident, address, role) of golden records; tx_rows: (ident, tx), all their hashes.
    ident is a column of the incidents, by which addresses and hashes name them.
    """
    more = [] if ident == "uid" else [ident]
    p = cut_lineage(resolve.profiles(incidents, *more).withColumn("ord", history_order()), "history")
    hits = []

    if tx_rows is None:
        tx_rows = incidents.where("relevant").select(ident, F.explode("tx_hashes").alias("tx"))
    said = addresses.where(F.col("role") != "victim").select(ident, F.concat(F.lit("a:"), F.lower("address")).alias("key")).unionByName(
        tx_rows.select(ident, F.concat(F.lit("t:"), F.lower("tx")).alias("key")))
    keys = said.join(p.select(ident, "scope", "ord"), ident).where("key is not null and scope is not null").select("key", "scope", "ord")
    hits.append(cut_lineage(shared_hits(cut_lineage(keys, "keys")), "hits"))

    # equal name: dates within 14 days in one family
    named = p.where(F.length("norm") >= 4)
    ref_gap = tx.days_apart(F.col("ref_l"), F.col("ref_r"))
    hits.append(_prior(_left(named, ["norm", "fam"], ["ref"]), _right(named, ["norm", "fam"], ["ref"]),
                       ["norm", "fam"], ref_gap <= 14))

    # equal name, close amounts, published within 7 days, any family
    paid = named.where((F.col("amount") > 0) & F.col("pub").isNotNull()).withColumn(
        "bin", resolve.amount_bin(F.col("amount")))
    near = paid.withColumn("bin", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)))
    a, b = F.col("amount_l"), F.col("amount_r")
    close = (F.abs(a - b) / F.greatest(a, b) <= fixed.AMOUNT_TOLERANCE) & (
        tx.days_apart(F.col("pub_l"), F.col("pub_r")) <= 7)
    hits.append(_prior(_left(paid, ["norm", "bin"], ["amount", "pub"]), _right(near, ["norm", "bin"], ["amount", "pub"]),
                       ["norm", "bin"], close))

    # matching names with compatible dates; names are compared where their days can be 14 days apart
    bin_ = F.floor(F.unix_date("scope") / F.lit(DAYS)).cast("bigint")
    nodes = resolve.name_nodes(p, "ord").withColumn("g", bin_)
    both = p.select("scope", "norm", "toks").distinct().withColumn("g", F.explode(F.array(bin_, bin_ + 1)))
    pairs = cut_lineage(resolve.node_pairs(resolve.name_pairs(both, ["g"]), nodes, ["g"]), "names")
    dates = ["inc", "pub", "lb"]
    left = _left(nodes, ["g", "node", "fam"], dates).withColumnRenamed("node", "x").join(pairs, ["g", "x"]).drop("g", "x")
    right = _right(nodes, ["node", "fam"], dates).withColumnRenamed("node", "y")
    hits.append(_prior(left, right, ["y", "fam"], resolve.dates_fit("l", "r")))

    hits.append(_release_hits(p))

    rule = hits[0]
    for part in hits[1:]:
        rule = rule.unionByName(part)
    found = rule.groupBy("uid_l").agg(F.min("hit").alias("hit"))
    if decisions is not None:
        judged = _judged_hits(incidents, p, decisions).join(found.select("uid_l"), "uid_l", "left_anti")
        found = found.unionByName(judged)
    return found.join(p.select(F.col("uid").alias("uid_l"), "scope"), "uid_l").select(
        F.col("uid_l").alias("uid"), F.col("scope").alias("day"), F.col("hit.uid").alias("orig_uid"),
        F.col("hit.day").alias("orig_day"))


def _release_hits(p: DataFrame) -> DataFrame:
    amount = F.coalesce(F.col("amount").cast("string"), F.lit(""))
    legal = p.where("fam = 'legal' and pub is not null and source <> ''").withColumn(
        "release", F.concat_ws("|", "source", amount))
    first = F.floor(F.unix_date("scope") / F.lit(DAYS)).cast("bigint")
    binned = legal.select("release", "title", F.explode(F.array(first, first + 1)).alias("g")).distinct()
    one = cut_lineage(resolve.jaccard_pairs(resolve.with_grams(binned, ["release", "g"]), ["release", "g"], "title", "grams", fixed.TITLE_JACCARD).select(
        "release", F.col("id_a").alias("title"), F.col("id_b").alias("other")).distinct(), "titles")
    two = one.select("release", F.col("other").alias("title"), F.col("title").alias("other"))
    same = binned.select("release", "title", F.col("title").alias("other")).distinct()
    left = _left(legal, ["release", "title"], ["pub"]).join(
        one.unionByName(two).unionByName(same), ["release", "title"]).drop("title")
    right = _right(legal, ["release", "title"], ["pub"]).withColumnRenamed("title", "other")
    return _prior(left, right, ["release", "other"], tx.days_apart(F.col("pub_l"), F.col("pub_r")) <= 7)


def _judged_hits(incidents: DataFrame, p: DataFrame, decisions: DataFrame) -> DataFrame:
    yes = resolve.accepted(decisions).where("same").select("uid_a", "uid_b")
    both = yes.unionByName(yes.select(F.col("uid_b").alias("uid_a"), F.col("uid_a").alias("uid_b")))
    met = resolve.plausible_pairs(incidents, both, (1, DAYS)).select("uid_a", F.col("uid_b").alias("uid"))
    return met.join(p.select("uid", "ord"), "uid").groupBy(F.col("uid_a").alias("uid_l")).agg(
        F.min("ord").alias("hit"))


def followup_roots(links: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(uid, root_uid): links followed to the first report, by pointer jumping (rounds grow with log of chain length).

    A link may point to a follow-up; folding one level up would lose rows, so every follow-up goes to its root.
    """
    hop = cut_lineage(links.select("uid", F.col("orig_uid").alias("root_uid")))
    for _ in range(max_rounds):
        up = hop.select(F.col("uid").alias("root_uid"), F.col("root_uid").alias("next"))
        jumped = cut_lineage(
            hop.join(up, "root_uid", "left").select(
                "uid", F.coalesce("next", "root_uid").alias("root_uid"), F.col("next").isNotNull().alias("moved")))
        hop = jumped.select("uid", "root_uid")
        if not jumped.where("moved").take(1):
            return hop
    raise RuntimeError(f"follow-up chains did not settle in {max_rounds} rounds")


def revise_amounts(incidents: DataFrame, m: DataFrame, roots: DataFrame) -> DataFrame:
    """Originals vote again together with the cards of their follow-ups; each source card has one vote."""
    groups = incidents.select("cid", "uid").join(roots, "uid", "left").select(
        "cid", F.coalesce("root_uid", "uid").alias("root_uid"))
    touched = roots.select("root_uid").distinct()
    ballots = m.join(groups, "cid").join(touched, "root_uid", "left_semi")
    votes = golden.consensus(ballots, "root_uid").select(
        F.col("gid").alias("uid"), F.col("amount_usd").alias("new_amount"), F.col("amount_text").alias("new_text"))
    out = incidents.join(votes, "uid", "left")
    changed = F.col("new_amount").isNotNull() & ~F.col("new_amount").eqNullSafe(F.col("amount_usd"))
    return (
        out.withColumn("amount_revised_from", F.when(changed, F.col("amount_usd")))
        .withColumn("amount_revised", changed)
        .withColumn("amount_text", F.when(changed & (F.coalesce("new_text", F.lit("")) != ""), F.col("new_text"))
                    .otherwise(F.col("amount_text")))
        .withColumn("amount_usd", F.when(changed, F.col("new_amount")).otherwise(F.col("amount_usd")))
        .drop("new_amount", "new_text")
    )
