"""Queries of entity resolution, golden records and follow-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import fixed
from caseloom.functions import text as tx
from caseloom.operators import follow, golden, plausible, resolve
from caseloom.plans import duck
from caseloom.plans.fixture import load
from caseloom.plans.registry import cte, query
from caseloom.session import cut_lineage, passing_steps


def decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Verdicts on each card and the first one of its entity group on its day, and of its entity on any day."""
    cards = load(spark, sf, "cards").selectExpr("k", "e", "e % 40 as g", "uid", "coll_day")

    def with_first(*keys: str) -> DataFrame:
        first = cards.groupBy(*keys).agg(F.min_by("uid", "k").alias("other"))
        return cards.join(first, list(keys)).select("k", "uid", "other")

    pairs = with_first("coll_day", "g").unionByName(with_first("e"))
    return pairs.where("other <> uid").select(
        F.when(F.col("k") % 4 == 0, F.col("uid")).otherwise(F.col("other")).alias("uid_a"),
        F.when(F.col("k") % 4 == 0, F.col("other")).otherwise(F.col("uid")).alias("uid_b"),
        (F.col("k") % 3 != 0).alias("same"), ((F.col("k") % 6) / 10 + 0.5).alias("confidence"),
        F.col("k").alias("decided_at"),
    )


cte("decisions", """
  select case when k % 4 = 0 then uid else other end as uid_a, case when k % 4 = 0 then other else uid end as uid_b,
    k % 3 <> 0 as same, (k % 6) / 10.0 + 0.5 as confidence, k as decided_at
  from (select k, uid, first_value(uid) over (partition by coll_day, e % 40 order by k) as other from cards
        union all
        select k, uid, first_value(uid) over (partition by e order by k) as other from cards)
  where other <> uid""")
cte("accepted_pairs", """
  select a as uid_a, b as uid_b, arg_max(yes, row(decided_at, yes)) as same
  from (select least(uid_a, uid_b) as a, greatest(uid_a, uid_b) as b, same and confidence >= 0.8 as yes, decided_at
        from decisions) group by all""")
cte("prof", duck.profile("cards"))
cte("share_keys", """
  select c.uid, c.coll_day as scope, concat('a:', lower(a.address)) as key
  from card_addresses a join cards c on c.uid = a.uid where c.relevant and a.role <> 'victim'
  union
  select uid, coll_day, concat('t:', lower(unnest(tx_hashes))) from cards where relevant""")
cte("merge_pairs", f"""
  select a.uid as u, b.uid as v from prof a join prof b on a.scope = b.scope and a.uid < b.uid
  where {duck.same('a', 'b')}
  union
  select a.uid, b.uid from share_keys a join share_keys b on a.scope = b.scope and a.key = b.key and a.uid < b.uid
  union
  select a.uid, b.uid from accepted_pairs d join prof a on a.uid = d.uid_a join prof b on b.uid = d.uid_b
  where d.same and a.scope = b.scope and {duck.plausible('a', 'b')}""")
cte("closure", """
  select uid, uid as o from prof
  union
  select c.uid, e.o from closure c join (select u, v as o from merge_pairs union select v, u from merge_pairs) e
    on e.u = c.o""")
cte("comp", "select uid, min(o) as cid from closure group by uid")
cte("memb", f"""
  select c.*, comp.cid, row_number() over (partition by comp.cid order by c.enriched desc, {duck.source_rank('c.source')},
      coalesce(n.n, 0) desc, length(c.summary_ko) + length(c.summary_en) desc, c.uid) as rk
  from cards c join comp on comp.uid = c.uid
  left join (select uid, count(*) as n from card_addresses group by uid) n on n.uid = c.uid""")


def vote_ctes(prefix: str, rows: str) -> None:
    """Running-mean clusters of the amounts of each group; rows has gid and the card columns."""
    cte(f"{prefix}_in", f"""
      select *, row_number() over (partition by gid order by amount_usd) as i from (
        select gid, amount_usd, count(*) as n,
          max(case when list_contains(tags, 'rekt_leaderboard') then -99 else
            -({duck.source_rank('source')} + case when source in {duck.words(fixed.SOURCE_PRIORITY)} then 0 else 1 end)
            end) as trust,
          max(coalesce(published_at, date '0001-01-01')) as latest,
          arg_min(coalesce(amount_text, ''), row(-datediff('day', date '0001-01-01',
            coalesce(published_at, date '0001-01-01')), case when coalesce(amount_text, '') <> '' then 0 else 1 end, uid))
            as pick_text,
          min(row(-datediff('day', date '0001-01-01', coalesce(published_at, date '0001-01-01')),
            case when coalesce(amount_text, '') <> '' then 0 else 1 end)) as pick_key
        from ({rows}) where coalesce(amount_usd, 0) <> 0 group by gid, amount_usd)""")
    cte(f"{prefix}_walk", f"""
      select gid, i, n as m, amount_usd * n as total, 1 as cl from {prefix}_in where i = 1
      union all
      select r.gid, r.i,
        case when abs(r.amount_usd - w.total / w.m) / (w.total / w.m) <= 0.05 then w.m + r.n else r.n end,
        case when abs(r.amount_usd - w.total / w.m) / (w.total / w.m) <= 0.05 then w.total + r.amount_usd * r.n
          else r.amount_usd * r.n end,
        case when abs(r.amount_usd - w.total / w.m) / (w.total / w.m) <= 0.05 then w.cl else w.cl + 1 end
      from {prefix}_walk w join {prefix}_in r on r.gid = w.gid and r.i = w.i + 1""")
    cte(f"{prefix}_vote", f"""
      select gid, amount_usd, pick_text as amount_text from (
        select *, row_number() over (partition by gid order by cn desc, ct desc, clat desc, cl) as best from (
          select gid, cl, sum(n) as cn, max(trust) as ct, max(latest) as clat,
            arg_min(amount_usd, row(pick_key, amount_usd)) as amount_usd,
            arg_min(pick_text, row(pick_key, amount_usd)) as pick_text, sum(sum(n)) over (partition by gid) as votes
          from {prefix}_in join {prefix}_walk using (gid, i) group by gid, cl) where votes >= 2) where best = 1""")


vote_ctes("gold", "select cid as gid, * from memb")
cte("gold_chains", """
  select cid, list(value order by rk, pos) as chains from (
    select cid, lower(value) as low, arg_min(value, row(rk, pos)) as value, min(row(rk, pos))[1] as rk,
      min(row(rk, pos))[2] as pos
    from (select cid, rk, unnest(chains) as value, generate_subscripts(chains, 1) as pos from memb)
    where value <> '' group by cid, lower(value)) group by cid""")
cte("gold_actors", """
  select cid, list(value order by rk, pos) as actors from (
    select cid, lower(value) as low, arg_min(value, row(rk, pos)) as value, min(row(rk, pos))[1] as rk,
      min(row(rk, pos))[2] as pos
    from (select cid, rk, unnest(actors) as value, generate_subscripts(actors, 1) as pos from memb)
    where value <> '' group by cid, lower(value)) group by cid""")
cte("gold_sets", """
  select cid, list_sort(list_distinct(flatten(list(tags)))) as tags,
    list_sort(list_distinct(flatten(list(tx_hashes)))) as tx_hashes from memb group by cid""")
cte("gold", """
  select m.cid, m.uid, m.source, m.source_id, m.url, m.title, m.published_at, m.coll_day, m.incident_type, m.project,
    coalesce(m.incident_date, x.min_date) as incident_date,
    coalesce(v.amount_usd, m.amount_usd, x.max_amount) as amount_usd,
    case when v.gid is not null then v.amount_text when m.amount_usd is null and m.amount_text = '' then
      coalesce(x.any_text, '') else m.amount_text end as amount_text,
    coalesce(c.chains, []) as chains, coalesce(a.actors, []) as actors, s.tags, s.tx_hashes, m.enriched,
    case when m.summary_ko <> '' then m.summary_ko else coalesce(x.sko, '') end as summary_ko,
    case when m.summary_en <> '' then m.summary_en else coalesce(x.sen, '') end as summary_en,
    case when m.attack_method <> '' then m.attack_method else coalesce(x.met, '') end as attack_method,
    x.n_members, true as relevant
  from memb m
  join (select cid, count(*) as n_members, min(incident_date) as min_date, max(amount_usd) as max_amount,
      arg_min(amount_text, rk) filter (amount_text <> '') as any_text,
      arg_min(summary_ko, rk) filter (summary_ko <> '') as sko, arg_min(summary_en, rk) filter (summary_en <> '') as sen,
      arg_min(attack_method, rk) filter (attack_method <> '') as met from memb group by cid) x on x.cid = m.cid
  left join gold_vote v on v.gid = m.cid left join gold_chains c on c.cid = m.cid
  left join gold_actors a on a.cid = m.cid join gold_sets s on s.cid = m.cid
  where m.rk = 1""")
cte("gold_addr", f"""
  select cid, arg_min(address, o) as address, arg_min(chain, o) as chain,
    coalesce(arg_min(role, o) filter (role <> 'unknown'), 'unknown') as role,
    coalesce(arg_min(note, o) filter (note <> ''), '') as note
  from (select m.cid, a.*, row(m.rk, a.ord) as o from card_addresses a join memb m on m.uid = a.uid)
  group by cid, upper(chain), {duck.hex_key('address')}""")
cte("gprof", duck.profile("gold"))
cte("gkeys", """
  select g.uid, g.coll_day as scope, concat('a:', lower(a.address)) as key
  from gold_addr a join gold g on g.cid = a.cid where a.role <> 'victim'
  union
  select uid, coll_day, concat('t:', lower(unnest(tx_hashes))) from gold""")
cte("follow_hits", f"""
  select a.uid, b.uid as orig, b.scope as orig_day, b.ref, b.pub, 0 as judged
  from (select *, scope - cast(unnest(generate_series(1, 14)) as int) as back from gprof) a
  join gprof b on b.scope = a.back where {duck.same('a', 'b')}
  union
  select a.uid, b.uid, b.scope, p.ref, p.pub, 0 from gkeys a join gkeys b on a.key = b.key
    and b.scope between a.scope - 14 and a.scope - 1 join gprof p on p.uid = b.uid
  union
  select a.uid, b.uid, b.scope, b.ref, b.pub, 1
  from (select uid_a, uid_b from accepted_pairs where same union select uid_b, uid_a from accepted_pairs where same) d
  join gprof a on a.uid = d.uid_a join gprof b on b.uid = d.uid_b
  where b.scope between a.scope - 14 and a.scope - 1 and {duck.plausible('a', 'b')}""")
cte("follow_links", """
  select uid, orig, orig_day from (select *, row_number() over (partition by uid order by judged, orig_day,
    coalesce(ref, date '0001-01-01') desc, coalesce(pub, date '0001-01-01') desc, orig) as rn from follow_hits)
  where rn = 1""")
cte("follow_up", """
  select uid, orig as root, 1 as depth from follow_links
  union
  select f.uid, l.orig, f.depth + 1 from follow_up f join follow_links l on l.uid = f.root""")
cte("follow_roots", "select uid, arg_max(root, depth) as root from follow_up group by uid")
vote_ctes("rev", """
  select coalesce(r.root, g.uid) as gid, m.* from memb m join gold g on g.cid = m.cid
  left join follow_roots r on r.uid = g.uid
  where coalesce(r.root, g.uid) in (select root from follow_roots)""")


class Resolved:
    """The tables of one resolution run over the derived cards."""

    def __init__(self, spark: SparkSession, sf: str):
        self.cards = load(spark, sf, "cards")
        self.addresses = load(spark, sf, "card_addresses")
        self.decisions = decisions(spark, sf)

    def comp(self) -> DataFrame:
        edges = resolve.merge_edges(self.cards, self.addresses, self.decisions)
        return resolve.components(self.cards.where("relevant"), edges)

    def members(self) -> DataFrame:
        return golden.members(self.cards, self.addresses, self.comp())

    @passing_steps()
    def written_members(self) -> DataFrame:
        return cut_lineage(self.members(), "members", lasting=1)

    def build(self):
        """Members, golden records and their addresses; members are materialised once for the steps that share them."""
        m = self.written_members()
        with passing_steps():
            g = cut_lineage(golden.golden_records(m), "golden", lasting=1)
        return m, g, golden.golden_addresses(m, self.addresses)

    def followed(self):
        """Members, golden records, their addresses and the links between them, which are written once for who reads them.

        Verdicts are asked for by merging and by linking, so they are written as well.
        """
        self.decisions = cut_lineage(self.decisions, "decisions")
        m, g, a = self.build()
        with passing_steps():
            links = cut_lineage(follow.followup_links(g, a, self.decisions, golden.golden_tx(m), "cid"), "links", lasting=1)
        return m, g, a, links


@query("jn_shared_key", """
  select distinct strftime(scope, '%Y-%m-%d') as coll_day, hub, uid from (
    select uid, scope, min(uid) over (partition by scope, key) as hub from share_keys) where hub <> uid""")
def jn_shared_key(spark, sf):
    cards, addresses = load(spark, sf, "cards"), load(spark, sf, "card_addresses")
    edges = resolve.shared_key_edges(cards, addresses)
    days = cards.select("uid", F.date_format("coll_day", "yyyy-MM-dd").alias("coll_day"))
    return edges.select(F.col("a").alias("hub"), F.col("b").alias("uid")).join(days, "uid").select(
        "coll_day", "hub", "uid")


cte("name_runs", """
  select uid, min(uid) over (partition by scope, norm, fam, run) as hub from (
    select *, sum(gap) over (partition by scope, norm, fam order by ref, uid) as run from (
      select *, case when ref - lag(ref) over (partition by scope, norm, fam order by ref, uid) <= 14 then 0 else 1 end
        as gap from prof where length(norm) >= 4 and ref is not null))""")
cte("amount_cells", """
  select scope, norm, pub, amount, min(uid) as rep from prof
  where length(norm) >= 4 and amount > 0 and pub is not null group by all""")
cte("amount_next", """
  select a.rep as r1, arg_min(b.rep, b.amount) as r2, a.amount as x, min(b.amount) as y
  from amount_cells a join amount_cells b on a.scope = b.scope and a.norm = b.norm and abs(a.pub - b.pub) <= 7
    and (b.amount > a.amount or (b.amount = a.amount and a.pub <> b.pub))
  group by a.scope, a.norm, a.pub, a.amount, a.rep, b.pub""")


@query("jn_name_exact", """
  select 'name' as rule, hub as uid_a, uid as uid_b from name_runs where hub <> uid
  union
  select 'amount', least(r1, r2), greatest(r1, r2) from amount_next where (y - x) / y <= 0.05 and r1 <> r2
  union
  select 'amount', hub, uid from (select p.uid, c.rep as hub from prof p join amount_cells c using (scope, norm, pub, amount))
  where hub <> uid""")
def jn_name_exact(spark, sf):
    p = resolve.profile_table(load(spark, sf, "cards"))
    name = resolve.star(resolve.name_runs(p), ["key"]).select(F.lit("name").alias("rule"), "a", "b")
    amount = resolve.name_amount_links(p).unionByName(resolve.star(resolve.amount_cells(p), ["key"]))
    return name.unionByName(amount.select(F.lit("amount").alias("rule"), "a", "b")).distinct().toDF("rule", "uid_a", "uid_b")


cte("norms", f"select distinct scope, norm, grams, len(grams) as ng from prof where norm not in {duck.words(fixed.GENERIC_NAMES)}")
cte("wordsets", f"""
  select distinct scope, array_to_string(toks, ' ') as ts, toks from prof
  where norm not in {duck.words(fixed.GENERIC_NAMES)} and len(toks) > 0""")


@query("jn_name_fuzzy", f"""
  select cast(a.scope as varchar) as scope, 'prefix' as rule, a.norm as name_a, b.norm as name_b from norms a join norms b
    on a.scope = b.scope and length(a.norm) >= 4 and length(a.norm) < length(b.norm) and starts_with(b.norm, a.norm)
  union all
  select cast(a.scope as varchar), 'trigram', a.norm, b.norm from norms a join norms b on a.scope = b.scope and a.norm < b.norm
    and a.ng >= 0.6 * b.ng and b.ng >= 0.6 * a.ng and {duck.jaccard('a.grams', 'b.grams')} >= 0.6
  union all
  select cast(a.scope as varchar), 'words', a.ts, b.ts from wordsets a join wordsets b on a.scope = b.scope and len(a.toks) < len(b.toks)
    and len(list_intersect(a.toks, b.toks)) = len(a.toks)""")
def jn_name_fuzzy(spark, sf):
    pairs = resolve.name_pairs(resolve.profile_table(load(spark, sf, "cards")), ["scope"])
    return pairs.withColumn("scope", F.col("scope").cast("string")).toDF("scope", "rule", "name_a", "name_b")


cte("release_cells", """
  select scope, source, amount, title_l, tgrams, pub, min(uid) as rep from prof
  where fam = 'legal' and pub is not null group by all""")


@query("jn_legal_release", f"""
  select distinct least(a.rep, b.rep) as uid_a, greatest(a.rep, b.rep) as uid_b
  from release_cells a join release_cells b on a.scope = b.scope and a.source = b.source
    and a.amount is not distinct from b.amount and abs(a.pub - b.pub) <= 7 and a.rep < b.rep
  where {duck.jaccard('a.tgrams', 'b.tgrams')} >= 0.5
  union
  select c.rep, p.uid from prof p join release_cells c on p.scope = c.scope and p.source = c.source
    and p.amount is not distinct from c.amount and p.title_l = c.title_l and p.pub = c.pub
  where p.fam = 'legal' and p.uid <> c.rep""")
def jn_legal_release(spark, sf):
    p = resolve.profile_table(load(spark, sf, "cards"))
    edges = resolve.release_links(p).unionByName(resolve.star(resolve.release_cells(p), ["key"]))
    return edges.distinct().toDF("uid_a", "uid_b")


@query("jn_plausible_pairs", f"""
  select distinct a.uid as uid_a, b.uid as uid_b from (select distinct least(uid_a, uid_b) as uid_a,
    greatest(uid_a, uid_b) as uid_b from decisions) d
  join prof a on a.uid = d.uid_a join prof b on b.uid = d.uid_b where {duck.plausible('a', 'b')}""")
def jn_plausible_pairs(spark, sf):
    pairs = decisions(spark, sf).select(F.least("uid_a", "uid_b").alias("uid_a"),
                                        F.greatest("uid_a", "uid_b").alias("uid_b")).distinct()
    return resolve.plausible_pairs(load(spark, sf, "cards"), pairs).select("uid_a", "uid_b")


cte("pl_in", "select * from prof where fam <> 'legal'")
cte("pl_stand", """
  select p.*, c.chain, unnest(list_filter([case when inc is not null then concat('i ', cast(inc as varchar)) end,
      case when pub is not null then concat(case when inc is null then 'p0 ' else 'p1 ' end, cast(pub as varchar)) end], lambda s: s is not null)) as slot
  from pl_in p, lateral (select unnest(list_distinct(p.lchains)) as chain) c""")
cte("pl_seek", """
  select p.*, c.chain, s.slot from pl_in p, lateral (select unnest(list_distinct(p.lchains)) as chain) c,
    lateral (select concat('i ', cast(p.inc + cast(o as int) as varchar)) as slot from generate_series(0, 3) as g(o) where p.inc is not null
      union all select concat('p0 ', cast(p.pub + cast(o as int) as varchar)) from generate_series(0, 3) as g(o) where p.inc is null and p.pub is not null
      union all select concat('p1 ', cast(p.pub + cast(o as int) as varchar)) from generate_series(-3, 3) as g(o) where p.inc is null and p.pub is not null) s""")
cte("pl_pairs", f"""
  select a.uid as one, b.uid as other, a.chain, b.slot, a.amount as x, b.amount as y, a.toks as xt, b.toks as yt, b.norm as name,
    {duck.jaccard('a.grams', 'b.grams')} >= 0.3 as alike
  from pl_seek a join pl_stand b on a.slot = b.slot and a.chain = b.chain""")
cte("pl_members", """
  select concat_ws('|', 'a', slot, chain, cast(cast(floor(log2(amount)) as int) as varchar)) as cell, uid, amount from pl_stand where amount > 0
  union all
  select concat_ws('|', t, slot, chain, w), uid, null from (select distinct uid, slot, chain, amount, unnest(toks) as w from pl_stand),
    (values ('w'), ('W')) as k(t) where t = 'w' or amount is null
  union all
  select concat_ws('|', t, slot, chain, norm), uid, null from pl_stand, (values ('n'), ('N')) as k(t) where t = 'n' or amount is null
  union all
  select concat_ws('|', 'l', cast(pub as varchar), w), uid, null from (select uid, pub, unnest(words) as w from prof where fam = 'legal' and pub is not null)""")
cte("pl_placed", "select cell, uid, row_number() over (partition by cell order by amount, uid) as place from pl_members")
cte("pl_met", """
  select one, concat_ws('|', 'a', slot, chain, cast(cast(floor(log2(y)) as int) as varchar)) as cell, other from pl_pairs
  where x > 0 and y > 0 and x / y between 0.5 and 2.0
  union
  select one, concat_ws('|', case when x is null then 'w' else 'W' end, slot, chain, w), other from (
    select *, unnest(list_intersect(xt, yt)) as w from pl_pairs where x is null or y is null)
  union
  select one, concat_ws('|', case when x is null then 'n' else 'N' end, slot, chain, name), other from pl_pairs where (x is null or y is null) and alike
  union
  select a.uid, concat_ws('|', 'l', cast(b.pub as varchar), a.w), b.uid
  from (select uid, pub, unnest(words) as w from prof where fam = 'legal') a join (select uid, pub, unnest(words) as w from prof where fam = 'legal') b
    on a.w = b.w and b.pub - a.pub between 0 and 5""")


@query("jn_plausible_reach", """
  select m.one as uid, m.cell, min(p.place) as first, max(p.place) as last, count(*) filter (m.other <> m.one) as n
  from pl_met m join pl_placed p on p.cell = m.cell and p.uid = m.other group by m.one, m.cell having n > 0""")
def jn_plausible_reach(spark, sf):
    """All doubtful pairs, generated: of each card, the ranges of the cells it is plausible with."""
    _, reach = plausible.plausible_reach(load(spark, sf, "cards"))
    return reach


@query("jn_decisions", "select uid_a, uid_b, cast(same as int) as same from accepted_pairs")
def jn_decisions(spark, sf):
    return resolve.accepted(decisions(spark, sf)).select("uid_a", "uid_b", F.col("same").cast("int").alias("same"))


@query("agg_components", "select uid, cid from comp")
def agg_components(spark, sf):
    return Resolved(spark, sf).comp()


@query("win_representative", """
  select cid, any_value(uid) filter (rk = 1) as uid, count(*) as n_members from memb group by cid""")
def win_representative(spark, sf):
    return golden.representative(Resolved(spark, sf).members())


GOLD_COLS = """uid, source, project, title, incident_type, strftime(incident_date, '%Y-%m-%d') as incident_date,
  round(amount_usd, 2) as amount_usd, amount_text, array_to_string(chains, '|') as chains,
  array_to_string(actors, '|') as actors, array_to_string(tags, '|') as tags, array_to_string(tx_hashes, '|') as txs,
  cast(n_members as bigint) as n_members, summary_en, attack_method"""


def flat_gold(g: DataFrame, *more: str | Column) -> DataFrame:
    return g.select(
        "uid", "source", "project", "title", "incident_type",
        F.date_format("incident_date", "yyyy-MM-dd").alias("incident_date"),
        F.round("amount_usd", 2).alias("amount_usd"), "amount_text", F.array_join("chains", "|").alias("chains"),
        F.array_join("actors", "|").alias("actors"), F.array_join("tags", "|").alias("tags"),
        F.array_join("tx_hashes", "|").alias("txs"), "n_members", "summary_en", "attack_method", *more)


MERGED_COLS = ["uid", "source", "url", "title", "published_at", "merged_into", "place"]


@query("agg_golden_record", f"""
  select {GOLD_COLS}, url, strftime(published_at, '%Y-%m-%d') as published_at, cast(null as varchar) as merged_into,
    cast(0 as bigint) as place from gold
  union all by name
  select m.uid, m.source, m.url, m.title, strftime(m.published_at, '%Y-%m-%d') as published_at, r.uid as merged_into,
    cast(m.rk - 1 as bigint) as place from memb m join memb r on r.cid = m.cid and r.rk = 1 where m.rk > 1""")
def agg_golden_record(spark, sf):
    """Each incident's record, at place 0, and below it the cards merged into it, best-ranked first."""
    m = Resolved(spark, sf).written_members()
    published = F.date_format("published_at", "yyyy-MM-dd")
    g = golden.golden_records(m)
    records = flat_gold(g, "url", published.alias("published_at"), F.lit(None).cast("string").alias("merged_into"), F.lit(0).cast("bigint").alias("place"))
    merged = golden.merged_from(m).withColumns({"published_at": published, "place": F.col("place").cast("bigint")}).select(*MERGED_COLS)
    return records.unionByName(merged, allowMissingColumns=True)


@query("agg_merge_addresses", "select cid, address, chain, role, note from gold_addr")
def agg_merge_addresses(spark, sf):
    r = Resolved(spark, sf)
    return golden.golden_addresses(r.members(), r.addresses).drop("at")


vote_ctes("ent", "select e as gid, * from cards")


@query("agg_consensus_amount", "select gid, round(amount_usd, 2) as amount_usd, amount_text from ent_vote")
def agg_consensus_amount(spark, sf):
    """Votes per entity over all its cards, resolution aside."""
    return golden.consensus(load(spark, sf, "cards"), "e").withColumn("amount_usd", F.round("amount_usd", 2))


@query("jn_followup", "select uid, orig as orig_uid, strftime(orig_day, '%Y-%m-%d') as orig_day from follow_links")
def jn_followup(spark, sf):
    _, _, _, links = Resolved(spark, sf).followed()
    return links.select("uid", "orig_uid", F.date_format("orig_day", "yyyy-MM-dd").alias("orig_day"))


@query("win_first_match", "select uid, root as root_uid from follow_roots")
def win_first_match(spark, sf):
    """Each follow-up with the first report at the end of its chain of earliest matches."""
    _, _, _, links = Resolved(spark, sf).followed()
    return follow.followup_roots(links)


@query("agg_amount_revision", """
  select g.uid, round(g.amount_usd, 2) as amount_revised_from, round(v.amount_usd, 2) as amount_usd,
    case when v.amount_text <> '' then v.amount_text else g.amount_text end as amount_text
  from gold g join rev_vote v on v.gid = g.uid where v.amount_usd is distinct from g.amount_usd""")
def agg_amount_revision(spark, sf):
    m, g, _, links = Resolved(spark, sf).followed()
    revised = follow.revise_amounts(g, m, follow.followup_roots(links))
    return revised.where("amount_revised").select(
        "uid", F.round("amount_revised_from", 2).alias("amount_revised_from"),
        F.round("amount_usd", 2).alias("amount_usd"), "amount_text")


@query("win_role_priority", f"""
  select address, arg_min(role, {duck.role_rank('role')}) as role from
    (select lower(address) as address, role from card_addresses) group by address""")
def win_role_priority(spark, sf):
    a = load(spark, sf, "card_addresses").select(F.lower("address").alias("address"), "role")
    return a.groupBy("address").agg(F.min_by("role", tx.role_rank(F.col("role"))).alias("role"))


@query("incident_stats", """
  select g.incident_type as key, count(*) as count, count(*) filter (coalesce(v.amount_usd, g.amount_usd, 0) <> 0) as known,
    round(sum(coalesce(v.amount_usd, g.amount_usd, 0)), 2) as amount
  from gold g left join rev_vote v on v.gid = g.uid where g.uid not in (select uid from follow_roots)
  group by g.incident_type""")
def incident_stats(spark, sf):
    """From cards to answers: resolve, merge, link follow-ups, revise amounts, count new incidents and losses per type."""
    m, g, _, links = Resolved(spark, sf).followed()
    roots = follow.followup_roots(links)
    originals = follow.revise_amounts(g, m, roots).join(roots.select("uid"), "uid", "left_anti")
    amount = F.coalesce("amount_usd", F.lit(0.0))
    return originals.groupBy(F.col("incident_type").alias("key")).agg(
        F.count("*").alias("count"), F.count_if(amount != 0).alias("known"), F.round(F.sum(amount), 2).alias("amount"))
