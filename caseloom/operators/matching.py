"""Joins of cards and incidents with lists: new items, snapshots, blacklists, sanctions, labels, alerts, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from caseloom import fixed
from caseloom.functions import text as tx


def new_items(collected: DataFrame, items: DataFrame, limit: int | None = None) -> DataFrame:
    """Collected items not yet processed; pending ones count as unseen; one row per uid, first delivery kept."""
    done = items.where(F.coalesce("status", F.lit("")) != "pending").select("uid")
    others = [c for c in collected.columns if c not in ("uid", "arrival")]
    unseen = collected.join(done, "uid", "left_anti")
    # an aggregate with map-side combine instead of a window: copies of one item meet as one row per task
    first = unseen.groupBy("uid").agg(F.min(F.struct("arrival", *others)).alias("s")).select("uid", "s.*")
    return first.orderBy(F.desc("published_at"), "uid").limit(limit) if limit else first


def added(current: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a full list that the snapshot lacks; an empty snapshot is a baseline and adds nothing."""
    return current.dropDuplicates(keys).join(known.select(*keys), keys, "left_anti").where(known.limit(1).exists())


def blacklist_index(rows: DataFrame) -> DataFrame:
    """(key, sources, categories, labels): sets per canonical address from '|'-separated columns."""
    def words(column: str, cut: int | None = None) -> Column:
        parts = F.filter(F.split(F.coalesce(column, F.lit("")), r"\|"), lambda w: w != "")
        return F.transform(parts, lambda w: F.substring(w, 1, cut)) if cut else parts

    keyed = rows.where(F.trim("address") != "").select(
        tx.hex_key(F.trim("address")).alias("key"), words("sources").alias("sources"),
        words("categories").alias("categories"), words("labels", 60).alias("labels"))
    # distinct words before they are gathered: the sets hold words, not rows
    def tagged(kind: str) -> Column:
        return F.transform(kind, lambda w: F.struct(F.lit(kind).alias("kind"), w.alias("word")))

    kinds = F.concat(*[tagged(kind) for kind in ("sources", "categories", "labels")])
    long = keyed.select("key", F.explode(kinds).alias("w")).select("key", "w.*").distinct()

    def gathered(kind: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("word")))).alias(kind)

    return long.groupBy("key").agg(gathered("sources"), gathered("categories"), gathered("labels"))


def blacklist_hits(addresses: DataFrame, index: DataFrame) -> DataFrame:
    """Addresses with their hit lists: 6 sources, 6 categories, 4 labels."""
    return addresses.withColumn("key", tx.hex_key(F.col("address"))).join(index, "key").withColumns({
        "sources": F.slice("sources", 1, 6), "categories": F.slice("categories", 1, 6),
        "labels": F.slice("labels", 1, 4)})


def known_addresses(cards: DataFrame, addresses: DataFrame, sdn: DataFrame) -> DataFrame:
    """Per card and address: in how many other cards and sanctions entries it occurs, and one of each.

    Counted per address first, the card's own row then taken off, so a hot address stays one row.
    """
    own = addresses.join(cards.select("uid", "source", "project"), "uid").withColumn("low", F.lower("address"))
    per_card = own.groupBy("low", "uid", "source").agg(F.min("project").alias("project"), F.count("*").alias("n"))
    first = per_card.groupBy("low").agg(
        F.count("*").alias("cards"), F.min("uid").alias("u1"))
    second = per_card.join(first.select("low", "u1"), "low").where("uid <> u1").groupBy("low").agg(
        F.min("uid").alias("u2"))
    listed = sdn.groupBy(F.lower("address").alias("low")).agg(
        F.count("*").alias("sanctions"), F.min("entity_name").alias("entity"))
    out = per_card.join(first, "low").join(second, "low", "left").join(listed, "low", "left")
    official = F.col("source").startswith("ofac")
    return out.select(
        "uid", F.col("low").alias("address"), (F.col("cards") - 1).alias("other_cards"),
        F.when(F.col("u1") == F.col("uid"), F.col("u2")).otherwise(F.col("u1")).alias("first_other"),
        F.when(official, 0).otherwise(F.coalesce("sanctions", F.lit(0))).alias("sanctions"),
        F.when(~official, F.col("entity")).alias("entity"),
    ).where("other_cards > 0 or sanctions > 0")


def known_address_hits(cards: DataFrame, addresses: DataFrame, sdn: DataFrame) -> DataFrame:
    """(address, kind, ref, detail, role): each card and list entry of the addresses that are no card's alone.

    One row an occurrence, keyed by address: whoever shows a card's known addresses reads them from here.
    """
    own = addresses.join(cards.select("uid", "project"), "uid").groupBy(F.lower("address").alias("low"), "uid").agg(
        F.min("project").alias("detail"), F.min(F.struct(tx.role_rank(F.col("role")).alias("r"), "role"))["role"].alias("role"))
    listed = sdn.select(F.lower("address").alias("low"), F.col("entity_uid").alias("ref"), F.col("entity_name").alias("detail")).distinct()
    several = own.groupBy("low").agg(F.count("*").alias("n"))
    held = several.join(listed.select("low").distinct().withColumn("on_list", F.lit(True)), "low", "left").where("n > 1 or on_list").select("low")
    of_cards = own.join(held, "low", "left_semi").select(F.col("low").alias("address"), F.lit("card").alias("kind"), F.col("uid").alias("ref"), "detail", "role")
    of_lists = listed.join(several, "low", "left_semi").select(
        F.col("low").alias("address"), F.lit("sanction").alias("kind"), "ref", "detail", F.lit("sanctioned").alias("role"))
    return of_cards.unionByName(of_lists)


def attach_labels(addresses: DataFrame, labels: DataFrame) -> DataFrame:
    """Kind, type, label and flags of the address check next to each address."""
    plain = labels.select(tx.hex_key(F.col("address")).alias("key"), "kind", "ctype", "label", "tx_count", "scam",
                          "verified")
    out = addresses.withColumn("key", tx.hex_key(F.col("address"))).join(plain, "key", "left")
    empty = F.lit("")
    return out.withColumns({
        "kind": F.coalesce("kind", empty), "ctype": F.coalesce("ctype", empty), "label": F.coalesce("label", empty),
        "scam": F.coalesce("scam", F.lit(False)), "verified": F.coalesce("verified", F.lit(False))})


def alert_candidates(incidents: DataFrame, members: DataFrame, sent: DataFrame, channels: DataFrame) -> DataFrame:
    """(channel, incident) pairs none of whose member cards was announced on the channel.

    The channel list is configuration of a handful of rows, so each incident is expanded by it in place.
    """
    names = channels.select(F.collect_list(F.struct("channel", "min_amount", "max_per_run"))).scalar()
    wanted = incidents.select("uid", "incident_type", "amount_usd", F.explode(names).alias("c")).select(
        "uid", "incident_type", "amount_usd", "c.*")
    told = members.join(sent.select("channel", F.col("uid").alias("member")).distinct(), "member").select(
        "channel", "uid").distinct()
    return wanted.join(told, ["channel", "uid"], "left_anti")


def export_chain(chain: Column, address: Column) -> Column:
    c = F.upper(F.coalesce(chain, F.lit("")))
    return F.when(c.isin(fixed.EXPORT_EVM) | address.startswith("0x"), "ETH").when(c == "TRX", "TRON").otherwise(c)


def export_category(role: Column, incident_type: Column) -> Column:
    by_type = F.create_map(*[F.lit(x) for kv in fixed.ATTACKER_CATEGORY.items() for x in kv])
    by_role = F.create_map(*[F.lit(x) for kv in fixed.ROLE_CATEGORY.items() for x in kv])
    return F.coalesce(F.when(role == "attacker", by_type[incident_type]), by_role[role], F.lit("exploit"))


def address_export(addresses: DataFrame, cards: DataFrame) -> DataFrame:
    """Address rows with the url of their card."""
    return addresses.join(cards.select("uid", "url", "source", "project", "incident_date"), "uid", "left")


def blacklist_export(addresses: DataFrame, cards: DataFrame) -> DataFrame:
    """Addresses of relevant cards in the shared list format, one row per chain and address, newest incident first."""
    c = cards.where("relevant").where(~F.col("source").isin(fixed.EXPORT_EXCLUDED_SOURCES)).select(
        "uid", "source", "project", "title", "url", "incident_type", "incident_date", "published_at")
    out = addresses.where(F.col("role").isin(fixed.EXPORT_ROLES)).join(c, "uid").withColumns({
        "out_chain": export_chain(F.col("chain"), F.col("address")), "key": tx.hex_key(F.col("address"))})
    detail = F.concat_ws(" | ", "title", F.concat(F.lit("role="), "role"), F.when(F.col("note") != "", F.col("note")),
                         "url")
    newest = F.struct((-F.coalesce(F.unix_date("incident_date"), F.lit(-10_000_000))).alias("o"), "uid", "ord",
                      "address", "role", "incident_type", "source", "project", detail.alias("detail"),
                      F.coalesce("incident_date", "published_at").alias("ref_date"))
    return out.groupBy("out_chain", "key").agg(F.min(newest).alias("n")).select(
        "n.address", F.col("out_chain").alias("chain"),
        export_category(F.col("n.role"), F.col("n.incident_type")).alias("category"),
        F.concat(F.lit("news_"), F.regexp_replace("n.source", "rss:", "")).alias("source"),
        F.substring(F.coalesce("n.project", F.lit("")), 1, 80).alias("label"),
        F.regexp_replace(F.substring("n.detail", 1, 400), "\n", " ").alias("detail"), "n.ref_date")
