"""Queries of list matching, set operations, state tables and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import fixed
from caseloom.functions import text as tx
from caseloom.operators import analytics as an
from caseloom.operators import matching, resolve, tables
from caseloom.plans import duck
from caseloom.plans.fixture import duck_text, load, read, spark_text
from caseloom.plans.q_quality import CATEGORY, OUT_CHAIN
from caseloom.plans.q_resolve import decisions
from caseloom.plans.q_rows import addresses as row_addresses
from caseloom.plans.q_rows import LABEL_MISSES, blacklist, flat, money_sql, sources
from caseloom.plans.q_rows import rows as incident_rows
from caseloom.plans.registry import cte, query
from caseloom.session import scratch_path


def collected(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries: every event once, every tenth again with another title."""
    base = load(spark, sf, "raw_events").select("uid", "source", "source_id", "published_at", "title", "n")
    again = base.where("n % 10 = 0").withColumn("title", F.lit("again"))
    return base.withColumn("arrival", F.lit(0)).unionByName(again.withColumn("arrival", F.lit(1)))


def items(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "raw_events").where("n % 4 = 0").select(
        "uid", F.when(F.col("n") % 8 == 0, "pending").otherwise("enriched").alias("status"))


@query("jn_new_items", """
  select uid, title, cast(published_at as varchar) as published_at from raw_events where n % 4 <> 0 or n % 8 = 0""")
def jn_new_items(spark, sf):
    return flat(matching.new_items(collected(spark, sf), items(spark, sf)).select("uid", "title", "published_at"))


def listed():
    return F.concat(F.lit("0x"), F.md5(F.concat_ws("-", F.col("user_id").cast("string"), "event_type")))


def list_drop(spark: SparkSession, sf: str, first: str, last: str) -> DataFrame:
    e = read(spark, sf, "events")
    day = F.col("ts").cast("date")
    return e.where((day >= first) & (day <= last)).select(listed().alias("value"))


cte("drops", "select concat('0x', md5(concat_ws('-', user_id, event_type))) as value, cast(ts as date) as d from events")


@query("jn_snapshot_new", """
  select distinct value from drops where value not in (select value from drops where d <= date '2024-01-04')""")
def jn_snapshot_new(spark, sf):
    """The whole list against the snapshot of its first days."""
    known = list_drop(spark, sf, "1900-01-01", "2024-01-04").distinct()
    return matching.added(list_drop(spark, sf, "1900-01-01", "2999-12-31"), known, ["value"])


@query("set_diff_snapshot", """
  select value from drops except select value from drops where d <= date '2024-01-02'""")
def set_diff_snapshot(spark, sf):
    """The whole list without its snapshot of the first two days."""
    return list_drop(spark, sf, "1900-01-01", "2999-12-31").distinct().join(
        list_drop(spark, sf, "1900-01-01", "2024-01-02"), "value", "left_anti")


@query("set_union_sources", """
  select uid, source, title from raw_events union all select uid, source, title from cards""")
def set_union_sources(spark, sf):
    def broken() -> DataFrame:
        return spark.read.schema("uid string").json(scratch_path(spark, "missing"))

    readers = {
        "events": lambda: load(spark, sf, "raw_events"), "broken": broken, "cards": lambda: load(spark, sf, "cards"),
    }
    out, errors = tables.union_sources(readers, ["uid", "source", "title"])
    assert list(errors) == ["broken"]
    return out


@query("set_union_arrays", """
  select uid, array_to_string(list_filter(u, lambda x, i: list_position(list_transform(u, lambda y: lower(y)), lower(x)) = i),
    '|') as merged
  from (select uid, list_concat(chains, actors, ['ethereum', 'BASE', 'Linea']) as u from cards)""")
def set_union_arrays(spark, sf):
    more = F.array(F.lit("ethereum"), F.lit("BASE"), F.lit("Linea"))
    return load(spark, sf, "cards").select(
        "uid", F.array_join(tx.union_ignore_case(F.col("chains"), F.col("actors"), more), "|").alias("merged"))


def split_sql(column: str) -> str:
    return (f"list_sort(list_distinct(list_filter(flatten(list(string_split({column}, '|'))), lambda w: w <> '')))")


cte("bindex", f"""
  select address as key, {split_sql('sources')} as sources, {split_sql('categories')} as categories,
    {split_sql('labels')} as labels from blacklist_rows group by address""")


@query("jn_blacklist", f"""
  select a.uid, a.ord, array_to_string(b.sources[1:6], '|') as sources, array_to_string(b.categories[1:6], '|')
    as categories, array_to_string(b.labels[1:4], '|') as labels
  from card_addresses a join bindex b on b.key = {duck.hex_key('a.address')}""")
def jn_blacklist(spark, sf):
    hits = matching.blacklist_hits(load(spark, sf, "card_addresses"), blacklist(spark, sf))
    return flat(hits.select("uid", "ord", "sources", "categories", "labels"))


cte("addr_cards", """
  select distinct c.uid, c.source, lower(a.address) as low from card_addresses a join cards c on c.uid = a.uid""")


@query("jn_known_address", """
  select * from (
    select a.uid, a.low as address, n.n - 1 as other_cards,
      case when n.u = a.uid then (select min(b.uid) from addr_cards b where b.low = a.low and b.uid <> a.uid) else n.u end
        as first_other,
      case when a.source like 'ofac%' then 0 else coalesce(s.n, 0) end as sanctions,
      case when a.source not like 'ofac%' then s.entity end as entity
    from addr_cards a join (select low, count(*) as n, min(uid) as u from addr_cards group by low) n on n.low = a.low
    left join (select lower(address) as low, count(*) as n, min(entity_name) as entity from sdn_snapshot group by 1) s
      on s.low = a.low) where other_cards > 0 or sanctions > 0""")
def jn_known_address(spark, sf):
    return flat(matching.known_addresses(load(spark, sf, "cards"), load(spark, sf, "card_addresses"),
                                         load(spark, sf, "sdn_snapshot")))


cte("own_hits", f"""
  select lower(a.address) as low, a.uid, min(c.project) as detail, arg_min(a.role, {duck.role_rank('a.role')}) as role
  from card_addresses a join cards c on c.uid = a.uid group by 1, 2""")
cte("list_hits", "select distinct lower(address) as low, entity_uid as ref, entity_name as detail from sdn_snapshot")


@query("jn_known_address_hits", """
  select low as address, 'card' as kind, uid as ref, detail, role from own_hits
  where low in (select low from own_hits group by low having count(*) > 1) or low in (select low from list_hits)
  union all select low, 'sanction', ref, detail, 'sanctioned' from list_hits where low in (select low from own_hits)""")
def jn_known_address_hits(spark, sf):
    return matching.known_address_hits(load(spark, sf, "cards"), load(spark, sf, "card_addresses"), load(spark, sf, "sdn_snapshot"))


@query("jn_labels", f"""
  select a.uid, a.ord, a.address, coalesce(l.kind, '') as kind, coalesce(l.ctype, '') as ctype,
    coalesce(l.label, '') as label, l.tx_count, cast(coalesce(l.scam, false) as bigint) as scam,
    cast(coalesce(l.verified, false) as bigint) as verified
  from card_addresses a left join (select * replace ({duck_text(LABEL_MISSES)} as address) from address_labels) l
    on l.address = {duck.hex_key('a.address')}""")
def jn_labels(spark, sf):
    labels = load(spark, sf, "address_labels").withColumn("address", F.expr(spark_text(LABEL_MISSES)))
    out = matching.attach_labels(load(spark, sf, "card_addresses"), labels)
    return flat(out.select("uid", "ord", "address", "kind", "ctype", "label", "tx_count", "scam", "verified"))


@query("jn_address_export", """
  select a.uid, a.ord, a.chain, a.address, a.role, c.source, c.project, cast(c.incident_date as varchar) as incident_date, c.url
  from card_addresses a left join (select * replace (case when k % 7 = 0 then concat('gone-', uid) else uid end as uid) from cards) c
    on c.uid = a.uid""")
def jn_address_export(spark, sf):
    """Addresses of every seventh card meet none."""
    cards = load(spark, sf, "cards").withColumn("uid", F.expr("case when k % 7 = 0 then concat('gone-', uid) else uid end"))
    out = matching.address_export(load(spark, sf, "card_addresses"), cards)
    return flat(out.select("uid", "ord", "chain", "address", "role", "source", "project", "incident_date", "url"))


cte("bexport", f"""
  select address, out_chain as chain, category, concat('news_', replace(source, 'rss:', '')) as source,
    substr(project, 1, 80) as label, substr(concat_ws(' | ', title, concat('role=', role),
      case when note <> '' then note end, url), 1, 400) as detail,
    cast(coalesce(incident_date, published_at) as varchar) as ref_date
  from (select a.*, c.* exclude (uid, k), {CATEGORY} as category, {OUT_CHAIN.replace('chain)', 'a.chain)').replace(
      'address', 'a.address')} as out_chain, row_number() over (partition by {OUT_CHAIN.replace('chain)', 'a.chain)')
      .replace('address', 'a.address')}, {duck.hex_key('a.address')}
      order by coalesce(incident_date, date '0001-01-01') desc, a.uid, a.ord) as rn
    from card_addresses a join cards c on c.uid = a.uid where c.relevant and a.role in {duck.words(fixed.EXPORT_ROLES)}
      and c.source not in {duck.words(fixed.EXPORT_EXCLUDED_SOURCES)}) where rn = 1""")


def exported(spark: SparkSession, sf: str) -> DataFrame:
    return matching.blacklist_export(load(spark, sf, "card_addresses"), load(spark, sf, "cards"))


@query("jn_blacklist_export", "select * from bexport")
def jn_blacklist_export(spark, sf):
    return flat(exported(spark, sf))




def writes(spark: SparkSession, sf: str) -> DataFrame:
    """Item writes: several per user, later ones with another status."""
    e = load(spark, sf, "raw_events")
    return e.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("uid"), F.col("n").alias("written"), "title",
        F.when(F.col("n") % 3 == 0, "pending").otherwise("enriched").alias("status"),
        F.col("published_at").alias("first_seen"))


LATEST = """
  select concat('u', user_id) as uid, max(n) as written, arg_max(title, n) as title,
    arg_max(case when n % 3 = 0 then 'pending' else 'enriched' end, n) as status,
    cast(min(published_at) as varchar) as first_seen from raw_events group by user_id"""


@query("win_latest_state", LATEST)
def win_latest_state(spark, sf):
    return flat(tables.latest_state(writes(spark, sf), "uid", "written"))


@query("snk_upsert_items", LATEST)
def snk_upsert_items(spark, sf):
    """Three batches of writes, the last one delivered twice; the log is then compacted."""
    path, small, w = scratch_path(spark, "items"), scratch_path(spark, "compacted"), writes(spark, sf)
    for n in (0, 1, 2, 2):
        tables.append_changes(path, w.where(f"written % 3 = {n}"), "uid", n)
    schema = "uid string, written bigint, title string, status string, first_seen date"
    tables.compacted(spark, path, schema, "uid", "written", small, parts=8)
    return flat(tables.changes_of(spark, small, schema))


@query("snk_replace_card", """
  select c.uid, cast(case when c.k % 10 = 0 then c.coll_day + 7 else c.coll_day end as varchar) as coll_day, a.chain, a.address,
    case when c.k % 2 = 0 then 'changed' else c.project end as project,
    case when c.k % 2 = 0 and a.ord = 1 then 'victim' else a.role end as role, '2024-01-01' as first_seen
  from card_addresses a join cards c on c.uid = a.uid where c.k % 14 <> 0 or a.ord <> 2""")
def snk_replace_card(spark, sf):
    """All cards stored, then every second one again: changed, some on another day, some without their second address.

    The others stay, and addresses keep their first sighting.
    """
    path = scratch_path(spark, "cards")
    cards = load(spark, sf, "cards").select("uid", "coll_day", "project", "k")
    a = load(spark, sf, "card_addresses").select("uid", "chain", "address", "role", "ord", "k")
    tables.replace_cards(spark, path, cards, a.drop("k").withColumn("first_seen", F.lit("2024-01-01").cast("date")))
    changed = cards.where("k % 2 = 0").withColumns({
        "project": F.lit("changed"), "coll_day": F.when(F.col("k") % 10 == 0, F.date_add("coll_day", 7)).otherwise(F.col("coll_day"))})
    again = a.where("k % 2 = 0 and (k % 14 <> 0 or ord <> 2)").withColumns({
        "role": F.when(F.col("ord") == 1, "victim").otherwise(F.col("role")), "first_seen": F.lit("2024-02-02").cast("date")}).drop("k")
    tables.replace_cards(spark, path, changed, again)
    stored = tables.stored_addresses(spark, path).select("uid", "chain", "address", "role", "first_seen")
    return flat(stored.join(tables.stored_cards(spark, path).select("uid", "coll_day", "project"), "uid"))


@query("snk_insert_absent", "select value, min(cast(d as varchar)) as first_seen from drops group by value")
def snk_insert_absent(spark, sf):
    path = scratch_path(spark, "snapshot")
    for first, last in (("2024-01-01", "2024-01-10"), ("2024-01-05", "2024-12-31")):
        day = F.col("ts").cast("date")
        e = read(spark, sf, "events").where((day >= first) & (day <= last))
        rows = e.groupBy(listed().alias("value")).agg(
            F.min(day).alias("first_seen"))
        tables.insert_absent(spark, path, rows, ["value"])
    return flat(spark.read.parquet(path))


@query("snk_cards_jsonl", """
  select uid, title, cast(incident_date as varchar) as incident_date, round(amount_usd, 2) as amount_usd,
    array_to_string(chains, '|') as chains from cards""")
def snk_cards_jsonl(spark, sf):
    path, cards = scratch_path(spark, "jsonl"), load(spark, sf, "cards").drop("k", "e")
    tables.write_jsonl(cards, path)
    back = spark.read.schema(cards.schema).json(path)
    return flat(back.select("uid", "title", "incident_date", "amount_usd", "chains"))


@query("snk_addresses_csv", """
  select a.chain, a.address, a.role, case when a.note <> '' then a.note end as note, c.source,
    case when c.project <> '' then c.project end as project, cast(c.incident_date as varchar) as incident_date, c.url
  from card_addresses a left join cards c on c.uid = a.uid""")
def snk_addresses_csv(spark, sf):
    path = scratch_path(spark, "csv")
    out = matching.address_export(load(spark, sf, "card_addresses"), load(spark, sf, "cards")).select(
        "chain", "address", "role", "note", "source", "project", "incident_date", "url")
    tables.write_csv(out, path)
    return spark.read.schema(", ".join(f"{c} string" for c in out.columns)).option("header", True).option(
        "escape", '"').csv(path)


@query("snk_sanctions_csv", """
  select chain, address, entity_uid, entity_name, programs, cast(first_seen as varchar) as first_seen from sdn_snapshot""")
def snk_sanctions_csv(spark, sf):
    path = scratch_path(spark, "csv")
    out = load(spark, sf, "sdn_snapshot").drop("p")
    tables.write_csv(out, path, F.asc("entity_name"))
    return spark.read.schema(", ".join(f"{c} string" for c in out.columns)).option("header", True).csv(path)


@query("snk_blacklist_csv", "select * replace (case when label <> '' then label end as label) from bexport")
def snk_blacklist_csv(spark, sf):
    path, out = scratch_path(spark, "csv"), exported(spark, sf)
    tables.write_csv(out, path)
    return spark.read.schema(", ".join(f"{c} string" for c in out.columns)).option("header", True).option(
        "escape", '"').csv(path)


@query("snk_archive", """
  select 'archive' as part, uid as key, strftime(day, '%Y-%m') as month, summary_en as content from rws
  union all select 'all', uid, strftime(day, '%Y-%m'), project from rws
  union all select 'addresses', concat(a.uid, '|', a.address), strftime(r.day, '%Y-%m'), concat(a.role, '|', a.note) from raddr a
    join rws r on r.uid = a.uid
  union all select 'recent', uid, strftime(day, '%Y-%m'), title from rws where day >= (select max(day) from rws) - 90
  union all select 'briefings', cast(day as varchar), strftime(day, '%Y-%m'), cast(count(*) filter (followup_uid is null) as varchar) from rws group by day
  union all select 'meta', 'rows_total', strftime(max(day), '%Y-%m'), cast(count(*) as varchar) from rws""")
def snk_archive(spark, sf):
    path, r = scratch_path(spark, "site"), incident_rows(spark, sf)
    a = row_addresses(spark, sf).drop("at", "addr_key")
    tables.write_archive(r, a, path, briefings=an.briefing(r), meta=an.meta(r, a, sources(spark, sf)))
    month = F.substring("day", 1, 7)
    parts = {
        "archive": ("uid string, month string, summary_en string", F.col("uid"), F.col("month"), F.col("summary_en")),
        "all": ("uid string, day string, project string", F.col("uid"), month, F.col("project")),
        "addresses": ("uid string, address string, day string, role string, note string", F.concat_ws("|", "uid", "address"), month,
                      F.concat_ws("|", "role", "note")),
        "recent": ("uid string, day string, title string", F.col("uid"), month, F.col("title")),
        "briefings": ("day string, new string", F.col("day"), month, F.col("new")),
        "meta": ("rows_total string, last_day string", F.lit("rows_total"), F.substring("last_day", 1, 7), F.col("rows_total")),
    }
    out = None
    for part, (schema, key, when, content) in parts.items():
        back = spark.read.schema(schema).json(f"{path}/{part}").select(
            F.lit(part).alias("part"), key.alias("key"), when.alias("month"), content.alias("content"))
        out = back if out is None else out.unionByName(back)
    return out


@query("snk_state", """
  select 'seen' as part, uid as key, cast(published_at as varchar) as detail from raw_events
  union all select 'sdn', address, entity_name from sdn_snapshot
  union all select 'source_runs', source, cast(max(coll_day) as varchar) from cards group by source
  union all select 'lists', value, cast(min(d) as varchar) from drops group by value
  union all select 'merge_decisions', concat(uid_a, '|', uid_b), cast(cast(same as int) as varchar) from accepted_pairs
  union all select 'alerts_sent', uid, case when k % 3 = 0 then 'chat' else 'mail' end from cards where k % 3 = 0 or k % 5 = 0""")
def snk_state(spark, sf):
    """The six state tables, written and read back."""
    path, day = scratch_path(spark, "state"), F.col("ts").cast("date")
    cards = load(spark, sf, "cards")
    accepted = resolve.accepted(decisions(spark, sf))
    state = {
        "seen": load(spark, sf, "raw_events").select(F.col("uid").alias("key"), F.col("published_at").cast("string").alias("detail")),
        "sdn": load(spark, sf, "sdn_snapshot").select(F.col("address").alias("key"), F.col("entity_name").alias("detail")),
        "source_runs": an.source_runs(cards).select(F.col("source").alias("key"), F.col("last_day").cast("string").alias("detail")),
        "lists": read(spark, sf, "events").groupBy(listed().alias("key")).agg(F.min(day).cast("string").alias("detail")),
        "merge_decisions": accepted.select(F.concat_ws("|", "uid_a", "uid_b").alias("key"), F.col("same").cast("int").cast("string").alias("detail")),
        "alerts_sent": cards.where("k % 3 = 0 or k % 5 = 0").select(
            F.col("uid").alias("key"), F.when(F.col("k") % 3 == 0, "chat").otherwise("mail").alias("detail")),
    }
    tables.write_state(state, path)
    out = None
    for name in state:
        one = spark.read.parquet(f"{path}/{name}").select(F.lit(name).alias("part"), "key", "detail")
        out = one if out is None else out.unionByName(one)
    return out


@query("snk_logs", "select uid, case when n % 2 = 0 then 'first' else 'second' end as run from raw_events")
def snk_logs(spark, sf):
    path, e = scratch_path(spark, "log"), load(spark, sf, "raw_events")
    tables.append_log(e.where("n % 2 = 0").select("uid", F.lit("first").alias("run")), path)
    tables.append_log(e.where("n % 2 = 1").select("uid", F.lit("second").alias("run")), path)
    return spark.read.schema("uid string, run string").json(path)


@query("snk_report_rows", f"""
  select cast(coll_day as varchar) as day, row_number() over (partition by coll_day order by
      coalesce(incident_date, published_at) desc nulls last, published_at desc nulls last, c.uid) as number, c.uid,
    case when coalesce(project, '') <> '' then project else title end as name, incident_type as type,
    cast(incident_date as varchar) as incident_date, array_to_string(chains, ', ') as chains,
    coalesce({money_sql('amount_usd')}, case when amount_text <> '' then amount_text end, 'unknown') as amount,
    coalesce(n.n, 0) as n_addresses, case when k % 3 = 0 then concat(source, ' +2') else source end as source,
    coalesce(s.n, 0) as n_seen
  from cards c left join (select uid, count(*) as n from card_addresses group by uid) n on n.uid = c.uid
  left join (select a.uid, count(*) as n from addr_cards a where a.low in (select low from addr_cards group by low
    having count(*) > 1) group by a.uid) s on s.uid = c.uid where relevant""")
def snk_report_rows(spark, sf):
    cards, a = load(spark, sf, "cards"), load(spark, sf, "card_addresses")
    merged = cards.where("k % 3 = 0").select("uid", F.lit(2).alias("n_merged"))
    known = matching.known_addresses(cards, a, load(spark, sf, "sdn_snapshot"))
    seen = known.where("other_cards > 0").groupBy("uid").agg(F.count("*").alias("n_seen"))
    return flat(tables.report_rows(cards, a, merged, seen))
