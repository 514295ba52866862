"""Queries of card building, quality flags, verdicts, audits and address repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import fixed
from caseloom.functions import text as tx
from caseloom.operators import cards as cd
from caseloom.operators import extract, matching
from caseloom.operators import quality as qa
from caseloom.plans import duck
from caseloom.plans.fixture import duck_text, load, misspelt, pick, spark_text
from caseloom.plans.q_rows import flat
from caseloom.plans.q_text import BLOB, NUM, SUBJECT, chains_sql, keyword_sql, money_list
from caseloom.plans.registry import cte, query
from caseloom.session import cut_lineage

# One expression text for both engines
OWN = "case when c.k % 3 <> 0 then concat(' ', c.title, ' lost $', cast(cast(coalesce(c.amount_usd, 0) " \
      "as bigint) as $STR), ' in all') else '' end"
TEXT = f"concat(a.text, {OWN})"

PATCHES = [
    "uid",
    "case k % 4 when 0 then incident_date - 1 when 1 then published_at + 5 when 3 then incident_date end as p_date",
    "case when k % 8 = 2 then '' when k % 2 = 0 then title else 'nowhere to be found' end as p_date_evidence",
    "case k % 5 when 0 then amount_usd + 100.0 when 1 then null when 2 then cast(6e9 as double) "
    "when 3 then amount_usd * 2 else amount_usd end as p_amount",
    "case when k % 7 = 0 then 'trading volume' when k % 7 = 1 then '' else '500 ETH' end as p_amount_text",
    "case when k % 5 = 1 then title else concat('lost $', cast(cast(coalesce(amount_usd, 0) as bigint) as $STR)) end "
    "as p_amount_evidence",
    "case k % 4 when 0 then $ARRAY('Solana', ' zzz ') when 1 then $ARRAY('qqq') when 2 then $ARRAY('Ethereum', 'tron') "
    "else $EMPTY end as p_chains",
    "case k % 6 when 0 then title when 1 then 'software developers' when 2 then concat(project, ' Labs') "
    "when 3 then 'Zebra Quux' when 4 then substr(title, 1, 9) else '' end as p_project",
    f"{pick('k % 3', ['scam_fraud', 'ransomware', 'not_a_type'])} as p_type",
    "case when k % 2 = 0 then title else 'no such phrase' end as p_type_evidence",
    "k % 9 <> 0 as p_relevant", "case when k % 18 = 0 then 'not about crypto' when k % 27 = 0 then '' else 'n' end as p_notes",
]
VERDICTS = [
    "uid",
    pick("k % 8", ["new_attack", "new_enforcement", "sanctions", "laundering_report", "exchange_self_report",
                   "court_procedure", "market_or_opinion", "other"]) + " as category",
    "k % 3 = 0 as is_new", "k % 10 <> 1 as crypto_involved", "k % 6 <> 2 as crypto_core", "k % 4 <> 0 as amount_is_loss",
    "(k % 7) / 10.0 + 0.4 as confidence",
]
FINDINGS = [
    pick("k % 4", ["not_incident", "wrong_amount", "wrong_type", "wrong_date"]) + " as kind", "uid",
    "case when k % 8 = 1 then 5.0 end as s_amount", pick("k % 5", ["scam_fraud", "ransomware", "nonsense", "other", None])
    + " as s_type", "published_at - cast(k % 5 - 2 as int) as s_date",
    pick("k % 3", ["court_procedure", "new_attack", "retrospective"]) + " as category",
    "(k % 6) / 20.0 + 0.75 as confidence",
    "case when k % 16 = 1 then 'no number' else concat('stated $', cast(cast(coalesce(amount_usd, 0) as bigint) as $STR)) "
    "end as evidence",
]


def shaped(df: DataFrame, exprs: list[str]) -> DataFrame:
    return df.selectExpr(*[spark_text(e) for e in exprs])


def shaped_cte(name: str, source: str, exprs: list[str]) -> None:
    cte(name, f"select {', '.join(duck_text(e) for e in exprs)} from {source}")


shaped_cte("patches", "cards", PATCHES)
shaped_cte("verdicts", "cards", VERDICTS)
shaped_cte("findings", "cards", FINDINGS)
cte("card_texts", f"""
  select c.uid, {duck_text(TEXT)} as text from cards c join articles a on a.d = c.k % (select max(d) + 1 from articles)""")


def card_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Every card has a text: the documents are dealt to the cards in turn."""
    c, a = load(spark, sf, "cards").alias("c"), load(spark, sf, "articles").alias("a")
    n = load(spark, sf, "articles").select(F.max("d") + 1).scalar()
    return c.withColumn("turn", F.col("k") % n).join(a, F.col("a.d") == F.col("turn")).select("c.uid", F.expr(spark_text(TEXT)).alias("text"))


WIDE = "(?i)(?:US\\$|\\$|USD\\s?)\\s?" + NUM + "\\s*(billion|million|thousand|bn|mn|[bmk])?\\b"
WORDS = "(?i)" + NUM + "\\s*(billion|million)\\s+(?:US\\s?)?dollars"


def values_sql(text: str) -> str:
    return f"list_filter(list_concat({money_list(text, WIDE)}, {money_list(text, WORDS)}), lambda v: v >= 100)"


def close_sql(a: str, b: str, tol: str = "0.05") -> str:
    return f"({a} > 0 and {b} > 0 and abs({a} - {b}) / greatest({a}, {b}) <= {tol})"


def stale_sql() -> str:
    return f"coalesce(incident_type in {duck.words(fixed.ATTACK_TYPES)} and published_at - incident_date > 365, false)"


LEGAL = duck.words(fixed.LEGAL_TYPES)
CHAINY = duck.words(fixed.ONCHAIN_ATTACK_TYPES)
cte("flagged", f"""
  select *, list_filter([
    case when {stale_sql()} then 'stale_reference' end, case when incident_date is null then 'no_incident_date' end,
    case when incident_date > published_at then 'date_after_published' end,
    case when not coalesce(incident_date > published_at, false) and incident_date > coll_day then 'date_after_collected' end,
    case when incident_date = coll_day and published_at < coll_day and incident_date <> published_at
      then 'date_is_collection_day' end,
    case when text <> '' and am <> 0 and am > 5e9 then 'amount_huge' end,
    case when text <> '' and am <> 0 and len(vals) > 0 and len(list_filter(vals, lambda v: {close_sql('am', 'v')})) = 0
      then 'amount_not_in_text' end,
    case when text <> '' and am = 0 and len(vals) > 0 and list_max(vals) >= 1000 and incident_type <> 'laundering_report'
      then 'amount_missing_but_text_has_money' end,
    case when len(chains) = 0 and incident_type in {CHAINY} then 'no_chain' end,
    case when titled then 'project_is_title' end,
    case when not titled and regexp_matches(pj, '{fixed.GENERIC_PROJECT}') then 'project_generic' end,
    case when not regexp_matches(concat_ws(' ', title, summary_ko, summary_en, attack_method, array_to_string(chains, ' '),
      array_to_string(tags, ' ')), '{fixed.CRYPTO_WORDS}') and not held then 'relevance_suspect' end,
    case when incident_type not in {LEGAL} and regexp_matches(title, '{fixed.LEGAL_WORDS}')
      and not regexp_matches(title, '{fixed.ATTACK_WORDS}') then 'type_maybe_legal' end,
    case when incident_type in {LEGAL} and regexp_matches(title, '{fixed.ATTACK_WORDS}')
      and not regexp_matches(concat_ws(' ', title, summary_en), '{fixed.LEGAL_WORDS}') then 'type_maybe_attack' end],
    lambda f: f is not null) as flags
  from (select c.*, coalesce(t.text, '') as text, coalesce(c.amount_usd, 0) as am, {values_sql("coalesce(t.text, '')")}
      as vals, lower(trim(project)) as pj, trim(project) = '' or lower(trim(project)) = lower(trim(title))
        or length(trim(project)) > 50 as titled,
      c.uid in (select uid from card_addresses) as held
    from cards c left join card_texts t on t.uid = c.uid)""")


def card_money(spark: SparkSession, sf: str) -> DataFrame:
    """The money facts of the cards' texts: each document is scanned once, each card's own sentence by itself."""
    articles = load(spark, sf, "articles")
    n = articles.select(F.max("d") + 1).scalar()
    docs = cut_lineage(qa.money_facts(articles, "d").select("d", F.col("money").alias("doc_money"), F.col("has_text").alias("doc_text")), "money")
    c = load(spark, sf, "cards").alias("c")
    own = c.withColumn("turn", F.col("k") % n).select("uid", "turn", F.expr(spark_text(OWN)).alias("text"))
    return qa.money_facts(own, "uid", "turn").join(docs, F.col("turn") == F.col("d")).select(
        "uid", (F.col("doc_text") | F.col("has_text")).alias("has_text"), F.concat("doc_money", "money").alias("money"))


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    return qa.qa_flags(load(spark, sf, "cards"), card_money(spark, sf), load(spark, sf, "card_addresses"))


@query("flt_stale_reference", f"select uid from cards where {stale_sql()}")
def flt_stale_reference(spark, sf):
    return load(spark, sf, "cards").where(
        tx.is_stale(F.col("incident_date"), F.col("published_at"), F.col("incident_type"))).select("uid")


@query("dq_flags", "select uid, array_to_string(flags, '|') as flags from flagged")
def dq_flags(spark, sf):
    return flat(flagged(spark, sf).select("uid", "flags"))


@query("agg_flag_counts", """
  select flag, count(*) as cards, count(distinct coll_day) as days from (select unnest(flags) as flag, coll_day from flagged)
  group by flag""")
def agg_flag_counts(spark, sf):
    return flat(qa.flag_counts(flagged(spark, sf)))


@query("set_flag_intersect", """
  select uid, array_to_string(list_filter(flags, lambda f: f in ('no_chain', 'amount_huge')), '|') as hit from flagged
  where len(list_intersect(flags, ['no_chain', 'amount_huge'])) > 0""")
def set_flag_intersect(spark, sf):
    wanted = F.array(F.lit("no_chain"), F.lit("amount_huge"))
    return flat(flagged(spark, sf).where(F.arrays_overlap("flags", wanted)).select(
        "uid", F.array_intersect("flags", wanted).alias("hit")))


@query("jn_label_semi", """
  select uid from flagged where len(list_intersect(flags, ['relevance_suspect', 'no_incident_date'])) > 0
    and uid not in (select uid from cards where k % 4 = 0)""")
def jn_label_semi(spark, sf):
    """Cards with a wanted flag that the review log does not hold yet."""
    reviewed = load(spark, sf, "cards").where("k % 4 = 0").select("uid")
    wanted = F.array(F.lit("relevance_suspect"), F.lit("no_incident_date"))
    return flagged(spark, sf).where(F.arrays_overlap("flags", wanted)).select("uid").join(reviewed, "uid", "left_anti")


LISTING = "case k % 4 when 0 then concat('https://x.example/hacks/?p=', cast(k as $STR)) " \
          "when 1 then 'https://x.example/incidents' when 2 then 'https://x.example/hacks/one' else url end"


@query("dq_listing_url", f"""
  select uid, cast(regexp_matches(split_part({duck_text(LISTING)}, '?', 1), '{fixed.LISTING_URL}') as bigint) as listing
  from cards""")
def dq_listing_url(spark, sf):
    return flat(load(spark, sf, "cards").select("uid", qa.is_listing(F.expr(spark_text(LISTING))).alias("listing")))


def plain(x: str) -> str:
    return f"lower(trim(regexp_replace({x}, '\\s+', ' ', 'g')))"


def bare(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9a-z가-힣$%.,]+', ' ', 'g')"


def backed(ev: str) -> str:
    return (f"coalesce(length({plain(ev)}) >= 6 and (contains(tn, {plain(ev)}) "
            f"or contains({bare('tn')}, trim({bare(plain(ev))}))), false)")


def share(w: str) -> str:
    return (f"(len({w}) = 0 or len(list_filter({w}, lambda v: contains(lower(text), lower(v)))) "
            f">= greatest(1, floor(len({w}) * 0.6)))")


def words_of(x: str) -> str:
    return f"regexp_extract_all({x}, '[A-Za-z0-9가-힣]{{3,}}')"


def generic(n: str) -> str:
    w = f"regexp_extract_all({n}, '[A-Za-z]+')"
    return (f"({n} = '' or (not regexp_matches({n}, '[A-Z0-9가-힣]') and len({w}) >= 2) or (len({w}) between 1 and 3 "
            f"and lower({w}[-1]) in {duck.words(fixed.GENERIC_LAST_WORDS)}))")


cte("pv0", f"""
  select c.*, p.* exclude (uid), coalesce(t.text, '') as text, {plain("coalesce(t.text, '')")} as tn,
    case when coalesce(c.project, '') <> '' then c.project else c.title end as nm
  from cards c join patches p on p.uid = c.uid left join card_texts t on t.uid = c.uid""")
cte("pv1", f"""
  select *, length(text) >= 400 and {share(words_of('nm'))} as ok_text, {values_sql('p_amount_evidence')} as evv,
    trim(p_project) as np,
    list_filter(list_transform(p_chains, lambda c: trim(c)), lambda c: c <> '') as nc from pv0""")
cte("pv2", f"""
  select *, case when not ok_text and p_amount is null and coalesce(amount_usd, 0) <> 0 then amount_usd else p_amount end
      as off, list_filter(nc, lambda c: contains(lower(text), lower(c)) or (lower(c) in {duck.words(qa.SHORT_CHAINS)}
      and contains(lower(text), substr(lower(c), 1, 3)))) as keep,
    case when ok_text then p_type else incident_type end as nt from pv1""")
cte("pv3", """
  select *, case when inflated then amount_usd else off end as na from (select *, coalesce(off >= 5e9 or (off is not null
    and regexp_matches(concat_ws(' ', p_notes, p_amount_text), '""" + fixed.NOT_LOSS_WORDS + """')), false) as inflated
  from pv2)""")
cte("pv4", f"""
  select *, p_date is not null and p_date is distinct from incident_date as date_new,
    coalesce(p_date > published_at, false) as late, {backed('p_date_evidence')} as date_ok,
    p_date is null and p_date_evidence = '' and coalesce(incident_date > published_at, false) as date_null,
    coalesce(na > 0 and not {close_sql('na', 'coalesce(amount_usd, 0)', '0.001')}, false) as amount_new,
    {backed('p_amount_evidence')} as amount_ok,
    coalesce(len(list_filter(evv, lambda v: {close_sql('na', 'v')})) > 0 or contains(regexp_replace(p_amount_evidence,
      '[^0-9]', '', 'g'), substr(cast(cast(round(na) as decimal(24, 0)) as varchar), 1, 4)), false) as agrees,
    len(nc) > 0 and list_transform(nc, lambda c: lower(c)) <> list_transform(chains, lambda c: lower(c)) as chains_new,
    np <> '' and np <> coalesce(project, '') and length(np) <= 60 and lower(np) <> lower(trim(title))
      and not {generic('np')} as project_new, {share(words_of('np'))} as project_ok,
    nt in {duck.words(fixed.INCIDENT_TYPES)} and nt <> incident_type as type_new, {backed('p_type_evidence')} as type_ok,
    ok_text and not p_relevant and relevant and coalesce(p_notes, '') <> '' as dropping,
    not regexp_matches(text, '{fixed.CRYPTO_WORDS}') as drop_ok from pv3""")
cte("pv5", """
  select *, date_new and not late and date_ok as date_set, amount_new and amount_ok and agrees as amount_set,
    not amount_new and na is null and coalesce(amount_usd, 0) <> 0 and p_amount_text <> '' and amount_ok and len(evv) = 0
      as amount_null, chains_new and len(keep) > 0 and keep <> chains as chains_set,
    project_new and project_ok as project_set, type_new and type_ok as type_set, dropping and drop_ok as drop_set
  from pv4""")


@query("dq_apply_verified", """
  select uid, cast(case when date_set then p_date when date_null then null else incident_date end as varchar)
      as incident_date,
    round(case when amount_set then na when amount_null then null else amount_usd end, 2) as amount_usd,
    case when (amount_set and p_amount_text <> '') or amount_null then substr(p_amount_text, 1, 80) else amount_text end
      as amount_text,
    array_to_string(case when chains_set then keep[1:5] else chains end, '|') as chains,
    case when project_set then np else project end as project,
    case when type_set then nt else incident_type end as incident_type, cast(relevant and not drop_set as bigint) as relevant,
    concat_ws('|', case when date_set then 'incident_date' end, case when date_null then 'incident_date→null' end,
      case when amount_set then 'amount_usd' end, case when amount_null then 'amount_usd→null' end,
      case when chains_set then 'chains' end, case when project_set then 'project' end,
      case when type_set then 'incident_type' end, case when drop_set then 'relevant→false' end) as changed,
    concat_ws('|', case when not ok_text then 'text' end, case when inflated then 'amount: volume' end,
      case when date_new and late then 'date: after publication' end,
      case when date_new and not late and not date_ok then 'date: no evidence' end,
      case when amount_new and not amount_set then 'amount: evidence mismatch' end,
      case when chains_new and len(keep) = 0 then 'chains: not in text' end,
      case when project_new and not project_set then 'project: not in text' end,
      case when type_new and not type_set then 'type: no evidence' end,
      case when dropping and not drop_set then 'relevant: text mentions crypto' end) as rejected from pv5""")
def dq_apply_verified(spark, sf):
    cards = load(spark, sf, "cards").withColumn("enrich_note", F.lit(""))
    return flat(qa.apply_verified(cards, shaped(load(spark, sf, "cards"), PATCHES), card_texts(spark, sf)))


cte("rv", f"""
  select *, case when stale then 'retrospective' when general then 'general_crime_no_crypto' when incidental
      then 'crypto_incidental' else cat0 end as category,
    case when stale or general or incidental then greatest(conf0, 0.9) else conf0 end as confidence,
    is_new and not (stale or general or incidental) as fresh from (
    select c.*, v.category as cat0, v.confidence as conf0, v.* exclude (uid, category, confidence), {stale_sql()} as stale,
      not crypto_involved or (v.category in ('new_enforcement', 'sanctions', 'laundering_report') and not regexp_matches(
        concat_ws(' ', title, summary_ko, summary_en, attack_method, text), '{fixed.CRYPTO_WORDS}')) as general,
      v.category in ('new_enforcement', 'sanctions') and not crypto_core as incidental
    from cards c join verdicts v on v.uid = c.uid left join card_texts t on t.uid = c.uid)""")


@query("dq_review_rules", f"""
  select uid, category, round(cast(confidence as double), 2) as confidence, cast(stays as bigint) as relevant,
    cast(out and relevant as bigint) as excluded, cast(not fresh and not gate as bigint) as low_confidence,
    cast(clear as bigint) as amount_cleared, round(case when clear then null else amount_usd end, 2) as amount_usd
  from (select *, relevant and not out as stays, not amount_is_loss and confidence >= 0.8
      and coalesce(amount_usd, 0) <> 0 and relevant and not out as clear from (
    select *, not fresh and gate as out from (select *, confidence >= 0.8 and category in
      {duck.words(fixed.EXCLUDE_CATEGORIES)} as gate from rv)))""")
def dq_review_rules(spark, sf):
    cards = load(spark, sf, "cards")
    verdicts = shaped(cards, VERDICTS).withColumn("confidence", F.col("confidence").cast("double"))
    return flat(qa.apply_review(cards, verdicts, card_texts(spark, sf)))


REASON = pick("k % 3", ["LLM 판정: other", "keyword", "relabel: stale_reference"])


@query("dq_review_restore", f"""
  select c.uid, v.category from (select *, {REASON} as reason from cards) c join verdicts v on v.uid = c.uid
  where not c.relevant and regexp_matches(reason, '{fixed.REVIEWED_REASON}') and v.is_new and v.confidence >= 0.8""")
def dq_review_restore(spark, sf):
    cards = load(spark, sf, "cards").withColumn("relevance_reason", F.expr(REASON))
    return qa.restore_reviewed(cards, shaped(load(spark, sf, "cards"), VERDICTS))


@query("dq_audit_apply", f"""
  select uid, case when a then 'relevant→false' when b then 'amount→null' when c then 'type' when d then 'date' end as change,
    case when a then category when c then s_type when d then cast(s_date as varchar) else '' end as value
  from (select f.uid, f.category, f.s_type, f.s_date, kind = 'not_incident' and category in
        {duck.words(fixed.EXCLUDE_CATEGORIES)} as a,
      kind = 'wrong_amount' and s_amount is null and coalesce(amount_usd, 0) <> 0 and incident_type not in {LEGAL}
        and len(list_filter({money_list('evidence', "(?i)\\$?\\s?" + NUM
          + "\\s*(K|M|B|million|billion|thousand)?\\b")}, lambda v: v > 0 and abs(v - amount_usd) / amount_usd <= 0.015)) > 0
        as b,
      kind = 'wrong_type' and s_type in {duck.words(fixed.INCIDENT_TYPES)} and s_type <> incident_type
        and incident_type = 'hack_exploit' and confidence >= 0.9 as c,
      kind = 'wrong_date' and s_date is not null and incident_date is null and coalesce(s_date <= published_at, true) as d,
      confidence from findings f join cards i on i.uid = f.uid) where confidence >= 0.85 and (a or b or c or d)""")
def dq_audit_apply(spark, sf):
    cards = load(spark, sf, "cards")
    return qa.audit_changes(cards, shaped(cards, FINDINGS))


@query("dq_audit_duplicates", """
  select distinct least(rep, uid) as uid_a, greatest(rep, uid) as uid_b from (
    select g.*, coalesce(min(uid) filter (is_rep) over (partition by gid), min(uid) over (partition by gid)) as rep,
      count(*) over (partition by gid) as n from (
      select cast(floor(k / 3.0) as bigint) as gid, uid, k % 3 = 1 as is_rep, (cast(floor(k / 3.0) as bigint) % 5) / 10.0 + 0.6
        as confidence from cards where relevant) g
    where confidence >= 0.85 and gid not in (select cast(floor(a.k / 3.0) as bigint) from cards a join cards b
      on b.uid = a.followup_uid and floor(a.k / 3.0) = floor(b.k / 3.0) where a.relevant and b.relevant))
  where n >= 2 and uid <> rep""")
def dq_audit_duplicates(spark, sf):
    cards = load(spark, sf, "cards").where("relevant")
    gid = F.floor(F.col("k") / 3).cast("bigint")
    groups = cards.select(gid.alias("gid"), "uid", (F.col("k") % 3 == 1).alias("is_rep"),
                          ((gid % 5) / 10 + 0.6).alias("confidence"))
    links = cards.where("followup_uid is not null").select("uid", F.col("followup_uid").alias("orig_uid"))
    return qa.audit_duplicates(cards, groups, links)


@query("dq_audit_listing", """
  select uid, case when coalesce(project, '') <> '' then project else title end as project, incident_type,
    cast(incident_date as varchar) as incident_date, cast(published_at as varchar) as published_at,
    round(amount_usd, 2) as amount_usd, substr(amount_text, 1, 40) as amount_text,
    array_to_string(chains[1:3], '|') as chains, array_to_string(list_sort(list_distinct(list_concat([source],
      case when k % 3 = 0 then ['rss:b'] else [] end))), '|') as sources,
    substr(case when summary_ko <> '' then summary_ko else summary_en end, 1, 160) as summary
  from cards where relevant and coll_day >= (select max(coll_day) from cards where relevant) - 30""")
def dq_audit_listing(spark, sf):
    cards = load(spark, sf, "cards").where("relevant")
    merged = cards.where("k % 3 = 0").select(F.col("uid").alias("rep_uid"), F.lit("rss:b").alias("source"))
    return flat(qa.audit_listing(cards, merged))


PROBE_ROWS = [
    "address", "c1 as chain", "case when p % 3 = 0 then 0 else z * 100 end as code", "cast(p % 7 as bigint) as nonce",
    "case when p % 2 = 0 then 0.5 else 0.0 end as balance",
], [
    "address", "c2 as chain", "case when p % 5 = 0 then z * 10 else 0 end as code", "cast(p % 4 as bigint) as nonce",
    "0.0 as balance",
]
cte("probes", " union all ".join(f"select {', '.join(p)} from probe_base" for p in PROBE_ROWS))
cte("hints", "select address, hint as chain, 0 as pos from probe_base where p % 2 = 0")
ORDER = "list_position(" + str(fixed.PROBE_ORDER) + ", p.chain)"
cte("chosen", f"""
  select address, chain, code, nonce as tx_count from (select p.*, row_number() over (partition by p.address order by
      case when h.pos is not null and (code > 0 or nonce > 0) then 1 when h.pos is not null then 2 when code > 0 then 3
        else 4 end,
      case when h.pos is not null then h.pos when code > 0 then {ORDER} else 0 end, nonce desc, balance desc, {ORDER}) as rn
    from probes p left join hints h on h.address = p.address and h.chain = p.chain
    where code > 0 or nonce > 0 or balance > 0) where rn = 1""")


def probes(spark: SparkSession, sf: str) -> DataFrame:
    base = load(spark, sf, "probe_base")
    one, two = (base.selectExpr(*p).withColumn("balance", F.col("balance").cast("double")) for p in PROBE_ROWS)
    return one.unionByName(two)


def chosen(spark: SparkSession, sf: str) -> DataFrame:
    hints = load(spark, sf, "probe_base").where("p % 2 = 0").selectExpr("address", "hint as chain", "0 as pos")
    return qa.pick_chain(probes(spark, sf), hints)


@query("dq_pick_chain", "select address, chain from chosen")
def dq_pick_chain(spark, sf):
    return chosen(spark, sf).select("address", "chain")


@query("dq_address_kind", """
  select case when p = 0 then '0x000000000000000000000000000000000000dead' else b.address end as address,
    case when p = 0 then 'system' when c.chain is null then case when p % 13 = 0 then 'unknown' else 'unfunded' end
    when c.code > 0 then 'contract' else 'eoa' end as kind, case when p = 0 then '' else coalesce(c.chain, '') end as chain,
    cast(case when p = 0 then 0 else coalesce(c.tx_count, 0) end as bigint) as tx_count
  from probe_base b left join chosen c on c.address = b.address""")
def dq_address_kind(spark, sf):
    known = load(spark, sf, "probe_base").select(
        F.when(F.col("p") == 0, fixed.BURN_ADDRESS).otherwise(F.col("address")).alias("address"),
        (F.col("p") % 13 == 0).alias("probe_failed"))
    formats = extract.address_formats(known).withColumnRenamed("chain", "form_chain")
    return qa.address_kind(formats.join(known, "address"), chosen(spark, sf))


def calls(spark: SparkSession, sf: str) -> DataFrame:
    """Call results of each part's address, one contract type per p % 12."""
    def word(value: str) -> str:
        return value.rjust(64, "0")

    def text(value: str) -> str:
        raw = value.encode().hex()
        return word("20") + word(f"{len(value):x}") + raw.ljust(-(-len(raw) // 64) * 64, "0")

    addr, other = word("ab" * 20), word("cd" * 20)
    sets = [
        {"getOwners": word("20") + word("2") + addr + other}, {"token0": addr, "token1": other, "fee": word("bb8")},
        {"token0": addr, "token1": other, "symbol": text("LP-AB")}, {"getPoolId": word("1")},
        {"UNDERLYING_ASSET_ADDRESS": addr}, {"asset": addr, "symbol": text("vTKN")},
        {"underlying": addr, "symbol": text("cTKN")}, {"factory": addr, "WETH": other},
        {"supportsInterface721": word("1")}, {"symbol": text("TKN"), "decimals": word("12")},
        {"implementation": addr}, {"symbol": word("0")},
    ]
    maps = [F.create_map(*[F.lit(x) for k, v in s.items() for x in (k, "0x" + v)]) for s in sets]
    base = load(spark, sf, "probe_base")
    return base.select("address", F.element_at(F.array(*maps), (F.col("p") % 12 + 1).cast("int")).alias("calls"),
                       F.lit(None).cast("string").alias("impl_slot"))


CTYPES = ["safe", "v3_pool", "lp_pool", "balancer_pool", "atoken", "vault", "ctoken", "router", "nft", "token", "proxy",
          "contract"]


@query("dq_contract_type", f"""
  select address, {pick('p % 12', CTYPES)} as ctype, case p % 12 when 2 then 'LP-AB' when 5 then 'vTKN' when 6 then 'cTKN'
    when 9 then 'TKN' else '' end as symbol, case when p % 12 = 10 then concat('0x', repeat('ab', 20)) end as impl
  from probe_base""")
def dq_contract_type(spark, sf):
    return qa.contract_types(calls(spark, sf))


EXPLORER = [
    misspelt("p % 4 = 1") + " as address", "p % 3 = 0 as e_contract", "case when p % 4 = 0 then upper(name) else '' end as e_name",
    "case when p % 6 = 0 then 'SYM' else '' end as e_token", "'Token name' as e_token_name",
    "case when p % 5 = 0 then 'Impl' else '' end as e_impl", "p % 7 = 0 as e_verified", "p % 19 = 0 as e_scam",
    "case when p % 10 = 0 then 'who.eth' else '' end as e_ens", "case when p % 2 = 0 then cast(p as bigint) end as e_tx",
]
LABEL_STATE = [
    "address", "kind", "ctype", "tx_count", "case when p % 2 = 0 then name else '' end as name",
    "case when p % 3 = 0 then 'S' else '' end as symbol", "'' as impl_name",
    "case when p % 8 = 0 then '0xabc' else '' end as delegated", "scam", "verified", "label",
]
shaped_cte("expl", "address_labels", EXPLORER)
shaped_cte("lstate", "address_labels", LABEL_STATE)
cte("lmerged", """
  select address, k2 as kind, case when gone then 'destroyed' else ctype end as ctype,
    case when k2 = 'eoa' and e_tx is not null then greatest(coalesce(tx_count, 0), e_tx) else tx_count end as tx_count,
    case when k2 = 'contract' and name = '' then substr(coalesce(case when e_name <> '' then e_name else e_token_name end, ''),
      1, 60) else name end as name,
    case when k2 = 'contract' and symbol = '' then coalesce(e_token, '') else symbol end as symbol,
    case when delegated <> '' and coalesce(e_impl, '') <> '' then e_impl when k2 = 'contract' and impl_name = ''
      then coalesce(e_impl, '') else impl_name end as impl_name, delegated, coalesce(e_ens, '') as ens,
    cast(scam or coalesce(e_scam, false) as bigint) as scam, cast(verified or coalesce(e_verified, false) as bigint)
      as verified, label
  from (select *, case when gone then 'contract' else kind end as k2 from (select l.*, e.* exclude (address),
      kind = 'eoa' and delegated = '' and coalesce(e_contract, false) and coalesce(tx_count, 0) >= 1 as gone
    from lstate l left join expl e on e.address = l.address))""")


def merged_labels(spark: SparkSession, sf: str) -> DataFrame:
    labels = load(spark, sf, "address_labels")
    return qa.merge_explorer(shaped(labels, LABEL_STATE), shaped(labels, EXPLORER))


@query("dq_explorer_merge", "select * exclude (label) from lmerged")
def dq_explorer_merge(spark, sf):
    return flat(merged_labels(spark, sf))


@query("dq_label", """
  select address, case when label <> '' then substr(label, 1, 40) when kind = 'system' then name
    when kind = 'contract' then case when ctype in ('lp_pool', 'v3_pool') and symbol <> '' then substr(symbol, 1, 30)
      when substr(case when name <> '' then name else symbol end, 1, 40) = '' and impl_name <> ''
        then substr(concat('proxy → ', impl_name), 1, 40)
      else substr(case when name <> '' then name else symbol end, 1, 40) end
    when ens <> '' then substr(ens, 1, 40)
    when delegated <> '' and impl_name <> '' then substr(concat('7702 → ', impl_name), 1, 40) else '' end as label
  from lmerged""")
def dq_label(spark, sf):
    entity = load(spark, sf, "address_labels").select("address", F.col("label").alias("entity"))
    return merged_labels(spark, sf).join(entity, "address").select(
        "address", qa.display_label(F.col("entity")).alias("label"))


FIXED = "case when p % 6 = 0 then address end as fixed"
PROBED = duck.case_map("lower(trim(a.chain))", fixed.PROBE_CHAIN_ALIAS, "trim(a.chain)")
TAGS = duck.case_map("ctype", fixed.CONTRACT_LABEL, "null")
cte("repaired", f"""
  select uid, ord, old_address, action, case when refixed then fixed else old_address end as address,
    case when rechain then l_chain else chain end as chain, case when infra then 'unknown' else role end as role,
    case when infra and not contains(note, tag) then case when note = '' then concat('컨트랙트(', tag, ')')
      else concat(note, ' · 컨트랙트(', tag, ')') end else note end as note,
    concat_ws('|', case when action <> 'keep' then action end, case when action = 'keep' and refixed then 'case_fixed' end,
      case when action = 'keep' and rechain then 'chain' end, case when action = 'keep' and infra then 'role' end) as changes
  from (select a.uid, a.ord, a.address as old_address, a.chain, a.role, a.note, l.chain as l_chain, {TAGS} as tag, l.fixed,
      case when l.kind = 'txhash' then 'tx_hash_moved' when l.kind = 'invalid' then 'invalid_removed'
        when l.kind = 'unfunded' and not l.rpc_failed and regexp_matches(a.note, '{fixed.TX_NOTE}')
          then 'truncated_tx_removed'
        when l.kind = 'unfunded' and not l.rpc_failed and regexp_matches(a.note, '{fixed.PHANTOM_NOTE}')
          then 'phantom_contract_removed' else 'keep' end as action,
      coalesce(l.fixed <> a.address, false) as refixed,
      l.kind in ('eoa', 'contract', 'wallet') and l.chain <> '' and {PROBED} <> l.chain as rechain,
      l.kind = 'contract' and l.ctype in {duck.words(fixed.INFRA_TYPES)} and a.role = 'attacker' as infra
    from card_addresses a left join (select *, {FIXED} from address_labels) l
      on l.address = {duck.hex_key('a.address')})""")


def repaired(spark: SparkSession, sf: str) -> DataFrame:
    labels = load(spark, sf, "address_labels").selectExpr("*", FIXED, "address as key")
    return qa.repair_addresses(load(spark, sf, "card_addresses"), labels)


@query("dq_apply_addresses", "select * from repaired")
def dq_apply_addresses(spark, sf):
    return flat(repaired(spark, sf).drop("implied_chain"))


cte("owners", f"""
  select key, arg_min(role, row(k, ord)) as role from (select *, {duck.hex_key('address')} as key from card_addresses)
  group by key""")


@query("dq_address_review", """
  select l.address as key, unnest(list_filter([case when scam then 'scam' end,
    case when kind = 'contract' and ctype = 'destroyed' then 'destroyed' end,
    case when kind = 'eoa' and role = 'attacker' and p % 3 = 0 then 'idle_attacker' end,
    case when kind = 'system' then 'system' end,
    case when kind = 'contract' and role = 'attacker' and verified and ctype in ('token', 'router', 'safe', 'proxy')
      then 'verified_attacker' end], lambda f: f is not null)) as finding
  from address_labels l join owners o on o.key = l.address""")
def dq_address_review(spark, sf):
    labels = load(spark, sf, "address_labels").withColumn("key", F.col("address")).withColumn(
        "tx_count", F.when(F.col("p") % 3 == 0, 0).otherwise(F.lit(1)))
    owners = load(spark, sf, "card_addresses").groupBy(tx.hex_key(F.col("address")).alias("key")).agg(
        F.min(F.struct("k", "ord", "role"))["role"].alias("role"))
    return qa.address_review(labels, owners)


@query("dq_recheck_due", f"""
  select distinct {duck.hex_key('a.address')} as key from card_addresses a left join
    (select * replace ({duck_text(misspelt("p % 10 = 0"))} as address) from address_labels) l on l.address = {duck.hex_key('a.address')}
  where l.kind is null or l.kind in ('unknown', 'unfunded')""")
def dq_recheck_due(spark, sf):
    labels = load(spark, sf, "address_labels").withColumn("key", F.expr(spark_text(misspelt("p % 10 = 0"))))
    return qa.recheck_due(load(spark, sf, "card_addresses"), labels)


@query("agg_kind_counts", """
  select kind, case when kind = 'contract' then ctype else '' end as ctype, count(*) as n from address_labels group by all""")
def agg_kind_counts(spark, sf):
    ctype = F.when(F.col("kind") == "contract", F.col("ctype")).otherwise("")
    return load(spark, sf, "address_labels").groupBy("kind", ctype.alias("ctype")).agg(F.count("*").alias("n"))


ITEMS = [
    "uid", "title", "hint", "text", "needs_enrichment", "case when d % 6 = 0 then concat('S', cast(d as $STR)) end as s_name",
    "case when d % 3 = 0 then date '2024-02-01' + cast(d % 40 as int) end as s_date",
    "case when d % 5 = 0 then cast(d * 1000 as double) end as s_amount",
    "case when d % 7 = 0 then $ARRAY('Ethereum') else $EMPTY end as s_chains",
    "case when d % 2 = 1 then 'rug_pull' end as s_type", "date '2024-03-01' + cast(d % 20 as int) as published_at", "d",
]
OUT = [
    "uid", "d % 5 <> 0 as o_relevant", "'because' as o_reason", pick("d % 4", ["hack_exploit", "other", "scam_fraud", "bogus"])
    + " as o_type", "case when d % 3 = 0 then '' else concat('P', cast(d as $STR)) end as o_project",
    "case when d % 8 = 0 then date '2022-01-01' end as o_date",
    "case when d % 9 = 0 then $ARRAY('Solana', 'Base') else $EMPTY end as o_chains",
    "case when d % 10 = 0 then 77.0 end as o_amount", "'on polygon today' as o_summary_en", "'x' as o_method_en", "d",
]
shaped_cte("items_in", "articles", ITEMS)
RETURNED = ["case when d % 4 = 0 then uid else concat('gone-', uid) end as uid"]
shaped_cte("enrich_out", "articles", OUT)
shaped_cte("returned", "articles", RETURNED)


def items_in(spark: SparkSession, sf: str) -> DataFrame:
    return shaped(load(spark, sf, "articles"), ITEMS)


def enrich_out(spark: SparkSession, sf: str) -> DataFrame:
    return shaped(load(spark, sf, "articles"), OUT)


MAXED = money_list(BLOB, "(?i)\\$\\s?" + NUM + "\\s*(billion|million|thousand|bn|mn|[bmk])?\\b")


@query("prj_build_card_rule", f"""
  select uid, cast(not needs_enrichment or (regexp_matches({BLOB}, '{keyword_sql(SUBJECT)}')
      and regexp_matches({BLOB}, '{keyword_sql(fixed.CRIME_KEYWORDS)}')) as bigint) as relevant,
    coalesce(s_type, 'other') as incident_type, coalesce(s_name, title) as project,
    cast(s_date as varchar) as incident_date, array_to_string(s_chains, '|') as chains,
    round(coalesce(s_amount, list_max({MAXED})), 2) as amount_usd,
    array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all({BLOB},
      '(?:^|[^0-9a-zA-Z])(0x[a-fA-F0-9]{{64}})(?:[^0-9a-zA-Z]|$)', 1), lambda h: lower(h)))), '|') as tx_hashes
  from items_in""")
def prj_build_card_rule(spark, sf):
    return flat(cd.rule_cards(items_in(spark, sf)).drop("title", "enriched"))


cte("enrich_blob", """
  select i.uid, concat_ws(' ', i.title, o.o_summary_en, o.o_method_en, i.text) as text
  from items_in i join enrich_out o on o.uid = i.uid""")
cte("blob_chains", chains_sql("enrich_blob"))


@query("prj_build_card_enriched", f"""
  select uid, cast(o_relevant and kind <> 'other' and not stale as bigint) as relevant, kind as incident_type,
    case when o_project <> '' then o_project else coalesce(s_name, '') end as project,
    cast(dt as varchar) as incident_date,
    case when len(ch) = 0 and kind in {CHAINY} then found else array_to_string(ch, '|') end as chains,
    round(coalesce(o_amount, s_amount), 2) as amount_usd
  from (select *, coalesce(kind in {duck.words(fixed.ATTACK_TYPES)} and published_at - dt > 365, false) as stale from (
    select i.*, o.* exclude (uid, d), coalesce(o_date, s_date) as dt,
      case when o_type in {duck.words(fixed.INCIDENT_TYPES)} then o_type else 'other' end as kind,
      case when len(o_chains) > 0 then o_chains else s_chains end as ch, b.chains as found
    from items_in i join enrich_out o on o.uid = i.uid join blob_chains b on b.uid = i.uid))""")
def prj_build_card_enriched(spark, sf):
    return flat(cd.enriched_cards(items_in(spark, sf), enrich_out(spark, sf)).select(
        "uid", "relevant", "incident_type", "project", "incident_date", "chains", "amount_usd"))


def proposed(spark: SparkSession, sf: str) -> DataFrame:
    a = load(spark, sf, "articles")
    return extract.address_candidates(a).where("form = 'evm'").select(
        "uid", F.col("pos").alias("ord"), F.when(F.col("pos") % 2 == 0, F.lower("address")).otherwise(
            F.concat(F.substring("address", 1, 40), F.lit("zz"))).alias("address"),
        F.lit("bsc").alias("chain"), F.lit("thief").alias("role"), F.lit("n").alias("note"))


@query("prj_enriched_addresses", """
  select uid, 'BSC' as chain, lower(a) as address, 'unknown' as role from (select uid, regexp_extract_all(text,
    '(?:^|[^0-9a-zA-Z])(0x[a-fA-F0-9]{40})(?:[^0-9a-zA-Z]|$)', 1)[1] as a from articles) where a is not null""")
def prj_enriched_addresses(spark, sf):
    """Every second proposed address is not in its text and falls away."""
    out = cd.enriched_addresses(load(spark, sf, "articles"), proposed(spark, sf))
    return out.select("uid", "chain", "address", "role")


@query("prj_pending", """
  select i.uid, case when i.needs_enrichment and o.uid is null then 'pending' when o.uid is not null then 'enriched'
    else 'rule_based' end as status from items_in i left join returned o on o.uid = i.uid""")
def prj_pending(spark, sf):
    """Results came back for every fourth article, and for others that aren't here."""
    return cd.pending(items_in(spark, sf), shaped(load(spark, sf, "articles"), RETURNED))


@query("prj_backfill_stamp", """
  select uid, cast(coalesce(incident_date, published_at, coll_day) as varchar) as coll_day,
    cast(case when k % 3 = 0 then true when not enriched then false else relevant end as bigint) as relevant,
    array_to_string(list_concat(tags, ['backfill']), '|') as tags from cards""")
def prj_backfill_stamp(spark, sf):
    cards = load(spark, sf, "cards").withColumn("s_type", F.when(F.col("k") % 3 == 0, "rug_pull"))
    return flat(cd.backfill_stamp(cards).select("uid", "coll_day", "relevant", "tags"))


CATEGORY = (
    f"coalesce(case when role = 'attacker' then {duck.case_map('incident_type', fixed.ATTACKER_CATEGORY, 'null')} end, "
    f"{duck.case_map('role', fixed.ROLE_CATEGORY, 'null')}, 'exploit')"
)
OUT_CHAIN = (
    f"case when upper(chain) in {duck.words(fixed.EXPORT_EVM)} or starts_with(address, '0x') then 'ETH' "
    "when upper(chain) = 'TRX' then 'TRON' else upper(chain) end"
)


@query("prj_category_map", f"""
  select a.uid, a.ord, {CATEGORY} as category, {OUT_CHAIN} as chain from card_addresses a join cards c on c.uid = a.uid""")
def prj_category_map(spark, sf):
    j = load(spark, sf, "card_addresses").join(load(spark, sf, "cards").select("uid", "incident_type"), "uid")
    return j.select("uid", "ord", matching.export_category(F.col("role"), F.col("incident_type")).alias("category"),
                    matching.export_chain(F.col("chain"), F.col("address")).alias("chain"))
