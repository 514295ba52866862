"""Cards from collected items: by rule, or with an enrichment row, plus the pending and backfill states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom import fixed
from caseloom.functions import text as tx
from caseloom.operators import extract
from caseloom.operators.golden import merge_addresses

NO_STRINGS = "array<string>"


def item_uid(source: Column, source_id: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", source, source_id).cast("binary")), 1, 16)


def item_text(cut: int | None = None) -> Column:
    """Title, hint and body as the rules read them."""
    blob = F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("hint", F.lit("")), F.coalesce("text", F.lit("")))
    return F.substring(blob, 1, cut) if cut else blob


def rule_cards(items: DataFrame) -> DataFrame:
    """Cards without enrichment.

    items: uid, title, hint, text, needs_enrichment, and the structured fields s_name, s_date, s_amount, s_chains, s_type.
    """
    gate = tx.is_relevant(item_text())
    s_name = F.coalesce("s_name", F.lit(""))
    return items.select(
        "uid", "title", (~F.col("needs_enrichment") | gate).alias("relevant"),
        F.coalesce("s_type", F.lit("other")).alias("incident_type"),
        F.when(s_name != "", s_name).otherwise(F.col("title")).alias("project"),
        F.col("s_date").alias("incident_date"), F.coalesce("s_chains", F.array().cast(NO_STRINGS)).alias("chains"),
        F.coalesce("s_amount", tx.max_amount(item_text())).alias("amount_usd"), F.lit(False).alias("enriched"),
        F.array_sort(extract.tx_hashes(item_text())).alias("tx_hashes"))


def enriched_cards(items: DataFrame, out: DataFrame) -> DataFrame:
    """Cards from items and their enrichment rows (an input table).

    out: uid, o_relevant, o_reason, o_type, o_project, o_date, o_chains, o_amount, o_summary_en, o_method_en.
    """
    j = items.join(out, "uid")
    kind = F.when(F.col("o_type").isin(fixed.INCIDENT_TYPES), F.col("o_type")).otherwise("other")
    date = F.coalesce("o_date", "s_date")
    stale = tx.is_stale(date, F.col("published_at"), kind)
    chains = F.when(F.size(F.coalesce("o_chains", F.array().cast(NO_STRINGS))) > 0, F.col("o_chains")).otherwise(
        F.coalesce("s_chains", F.array().cast(NO_STRINGS)))
    blob = F.concat_ws(" ", "title", "o_summary_en", "o_method_en", "text")
    found = F.when((F.size(chains) == 0) & kind.isin(fixed.ONCHAIN_ATTACK_TYPES), tx.chain_mentions(blob)).otherwise(chains)
    reason = (
        F.when(stale, "retrospective: the incident is more than a year older than the report")
        .when(F.col("o_relevant") & (kind == "other"), F.concat(F.lit("unclassified: "), F.coalesce("o_reason", F.lit(""))))
        .otherwise(F.col("o_reason")))
    return j.select(
        "uid", (F.col("o_relevant") & (kind != "other") & ~stale).alias("relevant"), reason.alias("relevance_reason"),
        kind.alias("incident_type"), F.when(F.coalesce("o_project", F.lit("")) != "", F.col("o_project")).otherwise(
            F.coalesce("s_name", F.lit(""))).alias("project"), date.alias("incident_date"), found.alias("chains"),
        F.coalesce("o_amount", "s_amount").alias("amount_usd"), F.lit(True).alias("enriched"))


def enriched_addresses(items: DataFrame, proposed: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Addresses proposed by enrichment that really occur in the item; unknown roles become 'unknown'.

    proposed: (uid, ord, address, chain, role, note).
    """
    p = proposed.withColumn("address", F.trim("address")).where("address <> ''").join(
        items.select("uid", item_text().alias("blob")), "uid")
    low = F.lower("address")
    kept = p.where(F.contains(F.lower("blob"), low) & ~low.isin([a.lower() for a in ignore or []] or [""]))
    return kept.select(
        "uid", "ord", tx.infer_chain(F.col("address"), F.col("chain")).alias("chain"), "address",
        F.when(F.col("role").isin(fixed.ROLES), F.col("role")).otherwise("unknown").alias("role"),
        F.coalesce("note", F.lit("")).alias("note"))


def card_addresses(given: DataFrame, proposed: DataFrame, found: DataFrame) -> DataFrame:
    """Addresses of enriched cards, (uid, ord, address, chain, role, note), one row a chain and address.

    The source's own come first, then those that enrichment proposed and the text bears out, then those found by pattern;
    a later mention only adds a role or note that is still missing. All three: (uid, ord, address, chain, role, note).
    """
    each = [rows.select("uid", F.struct(F.lit(rank).alias("rank"), F.col("ord").cast("long").alias("ord")).alias("at"), "address", "chain", "role", "note")
            for rank, rows in enumerate((given, proposed, found))]
    merged = merge_addresses(each[0].unionByName(each[1]).unionByName(each[2]), ["uid"], "at")
    place = Window.partitionBy("uid").orderBy("at", "chain", "address")  # a card's own addresses
    return merged.select("uid", F.row_number().over(place).cast("long").alias("ord"), "address", "chain", "role", "note")


def pending(items: DataFrame, out: DataFrame) -> DataFrame:
    """Items with their state: pending when enrichment was expected and is missing."""
    done = out.select("uid", F.lit(True).alias("done")).distinct()
    j = items.join(done, "uid", "left")
    waits = F.col("needs_enrichment") & F.col("done").isNull()
    return j.select("uid", F.when(waits, "pending").when(F.col("done"), "enriched").otherwise("rule_based").alias("status"))


def backfill_stamp(cards: DataFrame) -> DataFrame:
    """Past cards keep their own day as collected day; only structured or enriched ones stay relevant."""
    structured = F.col("s_type").isNotNull()
    return cards.withColumns({
        "coll_day": F.coalesce("incident_date", "published_at", "coll_day"),
        "tags": F.array_union("tags", F.array(F.lit("backfill"))),
        "relevant": F.when(structured, True).when(~F.col("enriched"), False).otherwise(F.col("relevant")),
    })
