"""Queries of the operators, each over its whole table, and the SQL that states their results where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import (
    bpe, collocations, kd_search, learned_ann, lexical, mixing, near_dedup, packing, quality, substring_dedup, token_counts, url_filter, warc_fixity)
from caseloom.llm.frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(oracle: str | None = None):
    """Register a query under its function's name; oracle is DuckDB SQL over the given tables."""
    def keep(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn
    return keep


@query()
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    scored = quality.scored(docs, quality.learnt(docs, labels))
    return scored.selectExpr(
        "doc_id", "coalesce(crc32(cast(doc_id as string)) % 5 = 0, false) as held_out", "score",
        f"cast(score >= {quality.THRESHOLD} as int) as predicted")


@query()
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    judged = url_filter.judged(pages, url_filter.learnt(url_filter.labelled_urls(pages, labels)))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


@query(r"""
with t as (select doc_id, text, regexp_extract(text, '^\s*', 0) as lead from documents),
p as (select doc_id, string_split(regexp_replace(substr(text, length(lead) + 1), '([.!?]+["'')\]]*\s+|\s*\n\s*)', concat('\1', chr(1)), 'g'), chr(1)) as parts, lead from t),
q as (select doc_id, unnest(parts) as part, generate_subscripts(parts, 1) as i, lead from p),
z as (select doc_id, i, case when i = 1 then concat(lead, part) else part end as part, trim(regexp_replace(lower(part), '\s+', ' ', 'g')) as norm
  from q where part <> '' or i = 1),
r as (select *, concat(norm, chr(10), lead(norm) over (partition by doc_id order by i)) as pair, lead(norm) over (partition by doc_id order by i) is not null as whole from z),
f as (select pair, min(row(doc_id, i)) as first from r where whole group by pair having count(*) > 1),
l as (select r.doc_id, r.i from r join f on f.pair = r.pair where r.whole and row(r.doc_id, r.i) <> f.first),
c as (select doc_id, i from l union select doc_id, i + 1 from l),
g as (select doc_id, i, i - row_number() over (partition by doc_id order by i) as g from c),
n as (select g.*, sum(len(string_split(z.norm, ' '))) over (partition by g.doc_id, g.g) as words from g join z on z.doc_id = g.doc_id and z.i = g.i),
gone as (select doc_id, i from n where words >= 25)
select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text, coalesce(m.n, 0)::integer as removed_sentences
from documents d left join (select z.doc_id, string_agg(z.part, '' order by z.i) as text from z anti join gone on gone.doc_id = z.doc_id and gone.i = z.i
  group by z.doc_id) k on k.doc_id = d.doc_id
left join (select doc_id, count(*) as n from gone group by doc_id) m on m.doc_id = d.doc_id
""")
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup.cleaned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "text", "removed_sentences")


@query()
def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op3_substring_dedup, with passages of 50 words that hold no two whole sentences."""
    cleaned = substring_dedup.cleaned(table(spark, sf_dir, "documents").select("doc_id", "text"), passage=substring_dedup.PASSAGE)
    return cleaned.select("doc_id", "text", "removed_spans")


@query()
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encoded(docs, tokenizer_file("byte_bpe_50k.json")))


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.from_sentencepiece(tokenizer_file("piece_bpe_32k.model"))
    return token_counts.counted(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary).drop("text")


HUNDREDTH = "vec_id % 100 = 0"  # the stated query set

WHOLE = "list_transform(embedding, lambda x: floor(1024 * x::double))"
USABLE = "embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"


@query(f"""
with v as (select vec_id, {WHOLE} as w from embeddings where vec_id is not null and {USABLE}),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.w, c.w)::bigint as score
  from v q, v c where q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10
""")
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_search.top_k(table(spark, sf_dir, "embeddings"), HUNDREDTH)


@query()
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.epochs(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", mixing.n_tokens().alias("n_tokens"), "weight", "copies")


@query(r"""
with recursive w as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, case when len(w) >= 5 then list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from w),
x as (select doc_id, unnest(s) as g from s),
n as (select doc_id, len(s) as n from s),
met as (select a.doc_id as u, b.doc_id as v, count(*) as c from x a join x b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as (select u, v from met join n p on p.doc_id = u join n q on q.doc_id = v where 100 * c >= 85 * (p.n + q.n - c)),
closure as (select doc_id, doc_id as o from s union
  select c.doc_id, e.o from closure c join (select u, v as o from links union select v, u from links) e on e.u = c.o)
select s.doc_id, len(s.s) as n_shingles, c.component_id, c.component_id = s.doc_id as kept
from s join (select doc_id, min(o) as component_id from closure group by doc_id) c on c.doc_id = s.doc_id
""")
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query()
def op9_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_ann.nearest(table(spark, sf_dir, "embeddings"), HUNDREDTH)


DAMAGED, LOST = "page_id % 97 = 5", "page_id % 101 = 7"  # rot planted in the second replica, at every size


@query(f"""
with p as (select page_id, coalesce(url, '') as url, coalesce(html, '') as html from pages),
h as (select *, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
    || chr(13) || chr(10) || 'Content-Type: application/http;msgtype=response' || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) as head from p),
r as (select page_id, page_id // 1000 as file, strlen(head) + strlen(html) + 4 as length,
    sha256('00' || sha256(head) || sha256(html)) as first_record,
    sha256('00' || sha256(head) || sha256(case when {DAMAGED} then translate(html, 'e', 'x') else html end)) as second_record
  from h),
o as (select *, coalesce(sum(length) over (partition by file order by page_id, first_record rows between unbounded preceding and 1 preceding), 0)::bigint as "offset" from r),
l as (select file, "offset", sha256(first_record) as first_hash, case when {LOST} then null else sha256(second_record) end as second_hash from o)
select file, ("offset" // 65536) * 65536 as range_start, "offset", case when second_hash is null then 'missing' else 'altered' end as status,
  first_hash, second_hash
from l where first_hash is distinct from second_hash
""")
def op10_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of the pages' archive against a replica of it with altered and lost records."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    rotten = pages.withColumn("html", F.when(F.expr(DAMAGED), F.translate("html", "e", "x")).otherwise(F.col("html")))
    replica = warc_fixity.archived(rotten).where(~F.coalesce(F.expr(LOST), F.lit(False)))
    return warc_fixity.audit(warc_fixity.archived(pages), replica)


@query()
def op11_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.digests(packing.packed(docs, tokenizer_file("byte_bpe_50k.json")))


@query(r"""
with t as (select coalesce(lang, 'und') as lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as x from documents),
p as (select lang, unnest(regexp_extract_all(x, '[^.,;:!?\x0A-\x0D]+')) as piece from t),
w as (select row_number() over () as id, lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from p),
u as (select id, lang, unnest(ws) as w1, generate_subscripts(ws, 1) as i from w),
g as (select lang, w1, lead(w1) over piece as w2, lead(w1, 2) over piece as w3 from u window piece as (partition by id order by i)),
f1 as (select lang, w1, count(*)::hugeint as f from g group by all),
f2 as (select lang, w1, w2, count(*)::hugeint as f from g where w2 is not null group by all having count(*) >= 10),
f3 as (select lang, w1, w2, w3, count(*)::hugeint as f from g where w3 is not null group by all having count(*) >= 10),
n as (select lang, sum(f)::bigint as n from f1 group by lang),
s as (select c.lang, w1 || ' ' || c.w2 as phrase, c.f as a, x.f as l, y.f as r, 1 as cut, (1000000 * c.f * c.f) // (x.f * y.f) as score,
    (select max(f) from f3 where f3.lang = c.lang and (f3.w1 = c.w1 and f3.w2 = c.w2 or f3.w2 = c.w1 and f3.w3 = c.w2)) as longer
  from f2 c join f1 x using (lang, w1) join (select lang, w1 as w2, f from f1) y using (lang, w2)
  union all
  select c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, x.f, y.f, 1, (1000000 * c.f * c.f) // (x.f * y.f), null
  from f3 c join f1 x on x.lang = c.lang and x.w1 = c.w1 join f2 y on y.lang = c.lang and y.w1 = c.w2 and y.w2 = c.w3
  union all
  select c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, x.f, y.f, 2, (1000000 * c.f * c.f) // (x.f * y.f), null
  from f3 c join f2 x on x.lang = c.lang and x.w1 = c.w1 and x.w2 = c.w2 join f1 y on y.lang = c.lang and y.w1 = c.w3),
b as (select *, row_number() over (partition by lang, phrase order by score, cut) as nth from s),
r as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from b
  where nth = 1 and (longer is null or 100 * longer < 50 * a))
select r.lang, rank, phrase, a::bigint as a, l::bigint as l, r.r::bigint as r, n.n, score::bigint as score
from r join n on n.lang = r.lang where rank <= 2000
""")
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


LEXICAL_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                 r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")


@query(f"""
with d as (select row_number() over () as node, doc_id, {LEXICAL_TERMS} as ts from documents where text is not null),
h as (select node, doc_id, len(ts) as n, ts from d where len(ts) > 0),
s as (select count(*)::bigint as docs, sum(n)::bigint as length from h),
i as (select row_number() over () as q, item_id, {LEXICAL_TERMS} as ts from (select distinct item_id, text from benchmark where text is not null)),
a as (select q, t, count(*) as times from (select q, unnest(ts) as t from i) group by q, t),
f as (select node, t, count(*)::bigint as tf from (select node, unnest(ts) as t from h) where t in (select t from a) group by node, t),
w as (select t, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from f, s group by t, docs),
e as (select a.q, f.node, sum(a.times * w.w * ((1000000000 * f.tf) // (1000 * f.tf + 8 * (25 + (75 * h.n * s.docs) // s.length))))::bigint as score
  from a join f on f.t = a.t join w on w.t = a.t join h on h.node = f.node, s group by a.q, f.node),
r as (select i.item_id, row_number() over (partition by e.q order by e.score desc, h.doc_id)::integer as rank, h.doc_id, e.score
  from e join h on h.node = e.node join i on i.q = e.q where e.score > 0 and h.doc_id is not null)
select item_id, rank, doc_id, score from r where rank <= 10
""")
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
