"""Facets, series, statistics, rankings and briefings over incident rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from caseloom import fixed
from caseloom.functions import text as tx
from caseloom.operators.ranking import numbered
from caseloom.operators.rows import basis_date, list_key, list_order, range_bounds

FRESH = "followup_uid is null"


def _amount(extra: Column | None = None) -> Column:
    """Amount that counts: originals only, 0 when unknown."""
    cond = F.expr(FRESH) & (F.coalesce("amount_usd", F.lit(0.0)) != 0)
    return F.when(cond & extra if extra is not None else cond, F.col("amount_usd"))


def facets(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Counts by type, by every chain named, by source (once per incident), and in total."""
    own = rows.select(F.explode(F.concat(
        F.array(F.struct(F.lit("type").alias("facet"), F.col("type").alias("value")),
                F.struct(F.lit("total").alias("facet"), F.lit("all").alias("value"))),
        F.transform("chains", lambda c: F.struct(F.lit("chain").alias("facet"), c.alias("value"))),
    )).alias("f")).select("f.*")
    by_source = sources.select("uid", "source").where("source <> ''").distinct().join(
        rows.select("uid"), "uid", "left_semi").select(F.lit("source").alias("facet"), F.col("source").alias("value"))
    return own.unionByName(by_source).groupBy("facet", "value").agg(F.count("*").alias("n"))


def series_unit(span_days: int) -> str:
    return "day" if span_days <= 45 else "week" if span_days <= 400 else "month"


def bucket(day: Column, unit: str) -> Column:
    return day if unit == "day" else F.trunc(day, unit)


def timeseries(rows: DataFrame, top: int = 3, unit: str = "auto", basis: str = "event", **request) -> DataFrame:
    """Counts of the most frequent types per day, week or month of the range, zero-filled."""
    lo, hi = range_bounds(rows, **request)
    if unit == "auto":  # two dates decide the unit; nothing else comes to the driver
        bounds = rows.sparkSession.range(1).select(F.datediff(hi, lo).alias("span")).first()
        unit = series_unit(bounds["span"] + 1)
    chosen = rows.where((basis_date(basis) >= lo) & (basis_date(basis) <= hi))
    step = {"day": "1 day", "week": "7 day", "month": "1 month"}[unit]
    labels = F.sequence(bucket(lo, unit), bucket(hi, unit), F.expr(f"interval {step}"))
    counted = chosen.groupBy("type", bucket(basis_date(basis), unit).alias("label")).agg(F.count("*").alias("n"))
    totals = counted.groupBy("type").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "type").limit(top)
    # top types times labels of one request: a few thousand rows at most
    spine = totals.select("type", F.explode(labels).alias("label"))
    return spine.join(counted, ["type", "label"], "left").select(
        "type", "label", F.coalesce("n", F.lit(0)).alias("n"))


def totals(rows: DataFrame) -> DataFrame:
    legal = F.col("type").isin(fixed.LEGAL_TYPES)
    fresh = F.expr(FRESH)
    return rows.agg(
        F.count("*").alias("total_count"), F.count_if(fresh).alias("new_count"),
        (F.count("*") - F.count_if(fresh) + F.sum(F.when(fresh, F.coalesce("followup_count", F.lit(0))).otherwise(0)))
        .alias("followup_count"),
        F.count(_amount()).alias("known_amount_count"),
        (F.count_if(fresh) - F.count(_amount())).alias("unknown_amount_count"),
        F.coalesce(F.sum(_amount()), F.lit(0.0)).alias("total_amount"),
        F.coalesce(F.sum(_amount(~legal)), F.lit(0.0)).alias("loss_amount"),
        F.coalesce(F.sum(_amount(legal)), F.lit(0.0)).alias("legal_amount"),
        F.count_if(fresh & legal).alias("legal_count"),
    )


def address_count(rows: DataFrame, addresses: DataFrame) -> DataFrame:
    live = addresses.join(rows.select("uid"), "uid", "left_semi")
    return live.select(F.lower("address").alias("a")).distinct().agg(F.count("*").alias("addresses"))


def by_group(rows: DataFrame, key: Column) -> DataFrame:
    return rows.groupBy(key.alias("key")).agg(
        F.count("*").alias("count"), F.count_if(F.expr(FRESH)).alias("new"), F.count(_amount()).alias("known"),
        F.coalesce(F.sum(_amount()), F.lit(0.0)).alias("amount"))


def by_type(rows: DataFrame) -> DataFrame:
    return by_group(rows, F.col("type"))


def by_chain(rows: DataFrame) -> DataFrame:
    """By the first chain of an incident."""
    return by_group(rows, F.coalesce(F.get("chains", F.lit(0)), F.lit("unknown")))


def daily(rows: DataFrame, addresses: DataFrame, basis: str = "event", days=None, start=None, end=None) -> DataFrame:
    """One row per day of the range, at most 400 days back, and per observed day."""
    lo, hi = range_bounds(rows, days, start, end)
    chosen = rows.where((basis_date(basis) >= lo) & (basis_date(basis) <= hi)).withColumn("d", basis_date(basis))
    counted = chosen.groupBy("d").agg(
        F.count("*").alias("count"), F.count_if(F.expr(FRESH)).alias("new"),
        F.coalesce(F.sum(_amount()), F.lit(0.0)).alias("amount"), F.count_if("legal").alias("legal"))
    per_day = addresses.join(chosen.select("uid", "d"), "uid").select("d", F.lower("address").alias("a")).distinct()
    addressed = per_day.groupBy("d").agg(F.count("*").alias("addresses"))
    spine = rows.sparkSession.range(1).select(
        F.explode(F.sequence(F.greatest(lo, F.date_sub(hi, 400)), hi)).alias("d"))
    out = spine.join(counted, "d", "full").join(addressed, "d", "left")
    return out.select("d", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("count", "new", "amount", "legal", "addresses")])


def rebucket(series: DataFrame, span_days: int) -> DataFrame:
    unit = "month" if span_days > 200 else "week" if span_days > 60 else "day"
    return series.groupBy(bucket(F.col("d"), unit).alias("label")).agg(
        F.sum("amount").alias("amount"), F.sum("count").alias("count"))


def share_rank(groups: DataFrame) -> DataFrame:
    """Share of the new incidents and running share of the two largest; 'unknown' is listed last.

    Groups are types or chains, a few hundred rows, so one window over them is small.
    """
    live = groups.where("new > 0")
    total = live.select(F.sum("new")).scalar()
    order = Window.orderBy((F.col("key") == "unknown").cast("int"), F.desc("new"), F.desc("amount"), "key")
    by_size = Window.orderBy(F.desc("new"), F.desc("amount"), "key")
    running = F.sum("new").over(by_size.rowsBetween(Window.unboundedPreceding, 0))
    return live.select(
        "key", "new", F.row_number().over(order).cast("bigint").alias("position"),
        F.round(F.col("new") * 100.0 / total, 4).alias("share"),
        F.when(F.row_number().over(by_size) <= 2, F.round(running * 100.0 / total, 4)).alias("top_share"),
        ((F.col("new") >= 2) & (F.col("key") != "unknown")).alias("main"),
    )


def role_stats(rows: DataFrame, addresses: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Each address once with its best role: addresses, incidents and blacklisted addresses per role."""
    live = addresses.join(rows.select("uid"), "uid", "left_semi").select(
        "uid", F.lower("address").alias("low"), tx.hex_key(F.col("address")).alias("addr_key"),
        tx.role_rank(F.col("role")).alias("r"))
    listed = live.select("addr_key", "low").distinct().join(
        blacklist.select(F.col("key").alias("addr_key")), "addr_key", "left_semi").select(
        "low", F.lit(1).alias("listed")).distinct()
    best = live.groupBy("low").agg(F.min("r").alias("best")).join(listed, "low", "left")
    role = F.element_at(F.array(*[F.lit(r) for r in fixed.ROLES]), F.col("best") + 1)
    # incidents per role: distinct (role, incident) first, so no task holds all incidents of a role
    per_incident = live.select("uid", "low").join(best.select("low", "best"), "low").select("best", "uid").distinct()
    incidents = per_incident.groupBy("best").agg(F.count("*").alias("incidents"))
    return best.groupBy("best").agg(
        F.count("*").alias("addresses"), F.count("listed").alias("blacklisted")).join(incidents, "best").select(
        role.alias("role"), "addresses", "incidents", "blacklisted")


def address_list(rows: DataFrame, addresses: DataFrame, role=None, chain=None, q=None, kind=None, labels: DataFrame | None = None) -> DataFrame:
    """One row per address with best role, first note, incident count and the latest day it was seen.

    labels: (low, kind, ctype, label, tx_count), one row an address; an address without one is of kind 'unchecked'.
    """
    joined = addresses.join(rows.select("uid", "day", "incident_date", F.col("project")), "uid")
    if role:
        joined = joined.where(F.col("role") == role)
    if chain:
        joined = joined.where(F.lower("chain") == F.lower(tx.chain_name(F.lit(chain))))
    if q:
        needle = F.lit(q.strip().lower())
        joined = joined.where(F.contains(F.lower("address"), needle) | F.contains(F.lower("project"), needle))
    first = F.min(F.struct(list_key().alias("k"), "at", "address", "chain", "note", "project")).alias("f")
    per_incident = joined.groupBy(F.lower("address").alias("low"), "uid").agg(
        first, F.min(tx.role_rank(F.col("role"))).alias("r"), F.max("day").alias("day"))
    out = per_incident.groupBy("low").agg(
        F.min("f").alias("f"), F.min("r").alias("r"), F.max("day").alias("last_day"), F.count("*").alias("incidents"))
    names = F.element_at(F.array(*[F.lit(r) for r in fixed.ROLES]), F.col("r") + 1)
    out = out.select("low", "f.address", "f.chain", "f.note", "f.project", names.alias("role"), "last_day", "incidents")
    if labels is None:
        return out
    out = out.join(labels, "low", "left").withColumn("kind", F.coalesce("kind", F.lit("unchecked")))
    return out.where(F.col("kind") == kind) if kind else out


def address_counts(listed: DataFrame) -> DataFrame:
    """(facet, value, n) of an address list with labels: its addresses by role, chain and kind."""
    facets = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in ("role", "chain", "kind")])
    return listed.select(F.explode(facets).alias("f")).groupBy("f.facet", "f.value").agg(F.count("*").alias("n"))


def incident_order(sort: str = "day", direction: str | None = None) -> list[Column]:
    """Order of incident rows; numbers and dates descend by default, unknown amounts come last either way."""
    keys = {
        "amount": F.col("amount_usd"), "date": F.coalesce("event_date", "day"), "day": F.col("day"),
        "name": F.lower("project"), "type": F.col("type"),
        "chain": F.lower(F.coalesce(F.get("chains", F.lit(0)), F.lit("~"))), "sources": F.col("n_sources"),
    }
    return _order(keys[sort], sort, direction, "uid")


def sort_incidents(rows: DataFrame, sort: str = "day", direction: str | None = None) -> DataFrame:
    return rows.orderBy(*incident_order(sort, direction))


def sort_addresses(rows: DataFrame, sort: str, direction: str | None = None) -> DataFrame:
    keys = {
        "address": F.col("low"), "chain": F.lower("chain"), "role": F.col("role"), "incident": F.lower("project"),
        "day": F.col("last_day"), "kind": F.coalesce(F.col("kind"), F.lit("~")),
        "label": F.lower(F.when(F.coalesce("label", F.lit("")) == "", "~").otherwise(F.col("label"))),
        "tx": F.coalesce(F.col("tx_count"), F.lit(0)),
    }
    return rows.orderBy(*_order(keys[sort], sort, direction, "low"))


def _order(key: Column, sort: str, direction: str | None, tie: str) -> list[Column]:
    desc = direction == "desc" if direction in ("asc", "desc") else sort in ("amount", "date", "day", "sources", "tx")
    return [key.desc_nulls_last() if desc else key.asc_nulls_last(), F.asc(tie)]


def page(rows: DataFrame, number: int = 1, size: int = 20, largest: int = 200) -> DataFrame:
    size = max(1, min(size, largest))
    return rows.offset((max(1, number) - 1) * size).limit(size)


def top_amounts(rows: DataFrame, k: int = 10) -> DataFrame:
    return rows.where(_amount().isNotNull()).orderBy(F.desc("amount_usd"), "uid").limit(k)


def worth_alerting(incidents: DataFrame, channels: DataFrame) -> DataFrame:
    """(channel, incident) rows of at least the channel's minimum amount, unless their type is exempt.

    The channels go to the incidents: dealt by channel, all incidents of one would meet in one task.
    """
    amount = F.coalesce("amount_usd", F.lit(0.0))
    worth = (F.col("min_amount") == 0) | (amount >= F.col("min_amount")) | F.col("incident_type").isin(fixed.ALERT_EXEMPT_TYPES)
    return incidents.join(F.broadcast(channels), "channel").where(worth)


def top_alerts(incidents: DataFrame, channels: DataFrame) -> DataFrame:
    """Per channel the longest waiting, then largest unsent incidents that are worth it, at most max_per_run.

    incidents: (channel, uid, incident_type, amount_usd, and since where they queue); channels: (channel, min_amount,
    max_per_run), the configuration, read here: each channel is a top-k of its own.
    """
    if "min_amount" not in incidents.columns:
        incidents = worth_alerting(incidents, channels)
    since = [F.col("since")] if "since" in incidents.columns else []
    order = [*since, F.desc(F.coalesce("amount_usd", F.lit(0.0))), F.col("uid")]
    chosen = None
    for c in channels.orderBy("channel").collect():
        top = incidents.where(F.col("channel") == c["channel"]).orderBy(*order).limit(c["max_per_run"])
        chosen = top if chosen is None else chosen.unionByName(top)
    if chosen is None:
        chosen = incidents.where("false")
    return chosen.withColumn("position", F.row_number().over(Window.partitionBy("channel").orderBy(*order)))  # of max_per_run rows


def lookup(rows: DataFrame, addresses: DataFrame, sdn: DataFrame, blacklist: DataFrame, q: str) -> DataFrame:
    """Matches of an address: exact, or as a part of six characters or more."""
    needle = q.strip().lower()
    hit = F.lower("address") == needle
    if len(needle) >= 6:
        hit = hit | F.contains(F.lower("address"), F.lit(needle))
    keys = [F.col(c) for c in ("kind", "address", "ref", "detail")]
    cases = addresses.where(hit).join(rows.select("uid", "day", "incident_date", "project"), "uid").orderBy(
        *list_order(), "at").limit(200).select(
        F.lit("incident").alias("kind"), "address", F.col("uid").alias("ref"), F.col("project").alias("detail"))
    sanctioned = sdn.where(hit).orderBy("chain", "address").limit(50).select(
        F.lit("sanction").alias("kind"), "address", F.col("entity_uid").alias("ref"),
        F.col("entity_name").alias("detail"))
    listed = blacklist.where(F.col("key") == tx.hex_key(F.lit(q.strip()))).select(
        F.lit("blacklist").alias("kind"), F.col("key").alias("address"), F.array_join("sources", "|").alias("ref"),
        F.array_join("labels", "|").alias("detail"))
    hits = cases.unionByName(sanctioned).unionByName(listed).select(*keys)
    found = hits.agg((F.count("*") > 0).cast("string").alias("ref"))  # of the 250 rows above at most, and one
    return hits.unionByName(found.select(F.lit("found").alias("kind"), F.lit(needle).alias("address"), "ref", F.lit("").alias("detail")))


def suggest(rows: DataFrame, q: str, k: int = 10) -> DataFrame:
    """Distinct project names containing the text, newest first."""
    hits = rows.where(F.contains(F.lower("project"), F.lit(q.strip().lower())))
    first = hits.groupBy("project").agg(F.min(list_key()).alias("at"), F.max("day").alias("day"))
    return first.orderBy("at").limit(k).select("project", F.col("at.u").alias("uid"), "day")


def detail(rows: DataFrame, links: DataFrame, uid: str) -> DataFrame:
    """One incident; a follow-up answers with its original."""
    wanted = rows.sparkSession.range(1).select(F.lit(uid).alias("uid")).join(links, "uid", "left").select(
        F.coalesce("root_uid", "uid").alias("uid"))
    return rows.join(F.broadcast(wanted), "uid", "left_semi")  # one row


def source_runs(items: DataFrame) -> DataFrame:
    """(source, last_day, last_count, total): the last day each source was collected on, and what it gave."""
    per_day = items.groupBy("source", "coll_day").agg(F.count("*").alias("n"))
    return per_day.groupBy("source").agg(F.max("coll_day").alias("last_day"), F.max_by("n", "coll_day").alias("last_count"), F.sum("n").alias("total"))


def meta(rows: DataFrame, addresses: DataFrame, sources: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Totals of the whole table, one row; with items (coll_day, relevant) also the last day's collection."""
    head = _totals(rows, addresses, sources)
    if items is None:
        return head
    last = items.groupBy("coll_day").agg(F.count("*").alias("n"), F.count_if("relevant").alias("r")).select(
        F.max(F.struct("coll_day", "n", "r")).alias("run")).select("run.*")
    return head.join(last.select(F.col("coll_day").alias("last_run"), F.col("n").alias("last_collected"), F.col("r").alias("last_relevant")))


def _totals(rows: DataFrame, addresses: DataFrame, sources: DataFrame) -> DataFrame:
    head = rows.agg(
        F.count_distinct("day").alias("days"), F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        F.min("event_date").alias("first_event_day"), F.count("*").alias("rows_total"),
        F.count_if(F.expr(FRESH)).alias("new_total"))
    n_addresses = addresses.select(F.lower("address").alias("a")).distinct().select(F.count("*")).scalar()
    n_sources = sources.select("source").distinct().select(F.count("*")).scalar()
    return head.withColumn("addresses_total", n_addresses).withColumn("sources_total", n_sources)


def source_report(cards: DataFrame, known: DataFrame) -> DataFrame:
    """Collected and relevant cards per source; sources without any are listed with 0."""
    counts = cards.groupBy("source").agg(F.count("*").alias("collected"), F.count_if("relevant").alias("relevant"))
    return known.select("source").join(counts, "source", "full").select(
        "source", F.coalesce("collected", F.lit(0)).alias("collected"), F.coalesce("relevant", F.lit(0)).alias("relevant"))


def briefing(rows: DataFrame) -> DataFrame:
    """Per day: counts, sums and a headline."""
    legal = F.col("type").isin(fixed.LEGAL_TYPES)
    fresh = F.expr(FRESH)
    amount = F.coalesce("amount_usd", F.lit(0.0))
    major = fresh & ((amount >= fixed.MAJOR_AMOUNT) | (legal & (amount != 0)))
    out = rows.groupBy("day").agg(
        F.count_if(fresh).alias("new"), F.count_if(~fresh).alias("followups"), F.count_if(major).alias("major"),
        F.count_if(fresh & ~major).alias("minor"),
        F.sum(F.when(fresh & ~legal, amount).otherwise(0.0)).alias("loss"),
        F.sum(F.when(fresh & legal, amount).otherwise(0.0)).alias("legal"))
    return out.withColumn("headline", F.concat_ws(
        " · ", F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit(" briefing")),
        F.concat(F.col("new").cast("string"), F.lit(" new")),
        F.when(F.col("loss") != 0, F.concat(F.lit("loss "), money(F.col("loss")))),
        F.when(F.col("legal") != 0, F.concat(F.lit("enforcement "), money(F.col("legal")))),
        F.when(F.col("followups") != 0, F.concat(F.col("followups").cast("string"), F.lit(" follow-ups")))))


def money(v: Column) -> Column:
    def short(x: Column, digits: int) -> Column:
        return F.regexp_replace(F.round(x, digits).cast(f"decimal(20,{digits})").cast("string"), r"\.?0+$", "")

    return (
        F.when(v >= 1e9, F.concat(F.lit("$"), short(v / 1e9, 2), F.lit("B")))
        .when(v >= 1e6, F.concat(F.lit("$"), short(v / 1e6, 1), F.lit("M")))
        .when(v >= 1e3, F.concat(F.lit("$"), F.format_number(F.round(v / 1e3, 0), 0), F.lit("K")))
        .when(v.isNotNull(), F.concat(F.lit("$"), F.format_number(F.round(v, 0), 0)))
    )


def briefing_lines(rows: DataFrame) -> DataFrame:
    """The bullets of a day's briefing in order: major incidents by amount, then minor ones, then follow-ups."""
    legal = F.col("type").isin(fixed.LEGAL_TYPES)
    amount = F.coalesce("amount_usd", F.lit(0.0))
    section = F.when(~F.expr(FRESH), 3).when((amount >= fixed.MAJOR_AMOUNT) | (legal & (amount != 0)), 1).otherwise(2)
    line = F.concat_ws(" · ", F.col("project"), F.when(~legal, F.coalesce(F.get("chains", F.lit(0)), F.lit("chain n/a"))),
                       F.col("type"), F.coalesce(money(F.col("amount_usd")),
                                                 F.when(F.col("amount_text") != "", F.col("amount_text")),
                                                 F.lit("amount n/a")), F.date_format("event_date", "yyyy-MM-dd"))
    bullets = rows.select("day", "uid", section.alias("section"), (-amount).alias("less"), line.alias("line"))
    return numbered(bullets, ["day", "section"], ["less", "uid"], "position").drop("less")


def briefing_index(cards: DataFrame, rows: DataFrame) -> DataFrame:
    """Per month and day: headline, relevant and total cards."""
    heads = briefing(rows).select("day", "headline")
    return cards.groupBy(F.date_format("coll_day", "yyyy-MM").alias("month"), F.col("coll_day").alias("day")).agg(
        F.count_if("relevant").alias("relevant"), F.count("*").alias("total")).join(heads, "day", "left")


def briefing_of(rows: DataFrame, day: str = "latest") -> DataFrame:
    """Headline, bullets and rows, follow-ups included, of a day: (day, section, position, uid, line); section 0 is the headline, 9 a row."""
    wanted = rows.select(F.max("day")).scalar() if day == "latest" else F.lit(day).cast("date")
    here = rows.where(F.col("day") == wanted)
    head = briefing(here).select("day", F.lit(0).alias("section"), F.lit(1).cast("bigint").alias("position"), F.lit(None).cast("string").alias("uid"), F.col("headline").alias("line"))
    shown = here.select("day", F.lit(9).alias("section"), F.lit(None).cast("bigint").alias("position"), "uid", F.col("title").alias("line"))
    return head.unionByName(briefing_lines(here).select("day", "section", "position", "uid", "line")).unionByName(shown)


def backfill_years(cards: DataFrame) -> DataFrame:
    return cards.where("relevant").groupBy(F.year(F.coalesce("incident_date", "coll_day")).cast("bigint").alias("year")
                                           ).agg(F.count("*").alias("n"))


def latest_unique(cards: DataFrame, addresses: DataFrame, k: int = 15) -> DataFrame:
    """One card per project: enriched, most addresses, longest summary; the k newest."""
    name = F.when(F.coalesce("project", F.lit("")) != "", F.col("project")).otherwise(F.col("title"))
    counts = addresses.groupBy("uid").agg(F.count("*").alias("n_addr"))
    key = tx.group_key(name)
    ranked = cards.where("relevant").join(counts, "uid", "left").withColumn(
        "g", F.when(key == "", F.col("uid")).otherwise(key))
    best = ranked.groupBy("g").agg(F.min(F.struct(
        F.when(F.col("enriched"), 0).otherwise(1).alias("a"), (-F.coalesce("n_addr", F.lit(0))).alias("b"),
        (-F.length("summary_ko")).alias("c"), F.col("uid").alias("uid"),
        F.coalesce("incident_date", "published_at").alias("date"), name.alias("project"))).alias("s"))
    return best.select("g", "s.uid", "s.date", "s.project").orderBy(F.desc_nulls_last("date"), "uid").limit(k)
