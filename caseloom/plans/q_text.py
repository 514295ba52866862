"""Queries of the text jobs and of each text rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom import fixed
from caseloom.functions import text as tx
from caseloom.operators import extract
from caseloom.plans import duck
from caseloom.plans.fixture import load, read
from caseloom.plans.q_rows import flat
from caseloom.plans.registry import cte, query

NUM = "([0-9][0-9,]*(?:\\.[0-9]+)?)"


def scaled(number: str, unit: str) -> str:
    arms = " ".join(f"when '{u}' then {v!r}" for u, v in tx.UNITS.items())
    return f"cast(replace({number}, ',', '') as double) * cast((case lower({unit}) {arms} else 1.0 end) as double)"


def money_list(text: str, pattern: str, number: int = 1, unit: int = 2) -> str:
    n = f"regexp_extract_all({text}, '{pattern}', {number})"
    u = f"regexp_extract_all({text}, '{pattern}', {unit})"
    return f"list_transform(list_zip({n}, {u}), lambda z: {scaled('z[1]', 'z[2]')})"


def keyword_sql(words: list[str]) -> str:
    parts = []
    for w in words:
        word = w.lower()
        if word.endswith("*"):
            parts.append(word[:-1])
        else:
            parts.append(word + "(?:s|es|ed|ing|er|ers)?(?:[^\\p{L}\\p{N}_]|$)")
    return "(?i)(?:^|[^\\p{L}\\p{N}_])(?:" + "|".join(parts) + ")"


SUBJECT = fixed.CRYPTO_KEYWORDS + fixed.CHAIN_KEYWORDS
BLOB = "concat_ws(chr(10), title, hint, text)"


@query("page_text")
def page_text(spark, sf):
    return extract.page_texts(read(spark, sf, "pages"))


@query("txt_html_text")
def txt_html_text(spark, sf):
    texts = extract.page_texts(read(spark, sf, "pages"), selectors=("article", "main"), drop=("^Credit:",))
    return texts.select("url", "body", F.length("body").cast("bigint").alias("n_chars"))


@query("txt_html_meta")
def txt_html_meta(spark, sf):
    return extract.page_texts(read(spark, sf, "pages")).select("url", "title", "published", "description")


@query("txt_fragment_text")
def txt_fragment_text(spark, sf):
    return read(spark, sf, "pages").select("page_id", extract.fragment_text(F.col("html")).alias("text"))


MENTION_SQL = f"""
  select distinct uid, 'address' as kind, concat('ETH:', arg_min(a, i)) as value from (
    select uid, a, i from (select uid, unnest(regexp_extract_all(text,
      '(?:^|[^0-9a-zA-Z])(0x[a-fA-F0-9]{{40}})(?:[^0-9a-zA-Z]|$)', 1)) as a,
      generate_subscripts(regexp_extract_all(text, '(?:^|[^0-9a-zA-Z])(0x[a-fA-F0-9]{{40}})(?:[^0-9a-zA-Z]|$)', 1), 1)
        as i from articles)) group by uid, lower(a)"""
cte("article_money", f"""
  select uid, list_filter(list_concat({money_list('text', "(?i)(?:US\\$|\\$|USD\\s?)\\s?" + NUM
      + "\\s*(billion|million|thousand|bn|mn|[bmk])?\\b")},
    {money_list('text', "(?i)" + NUM + "\\s*(billion|million)\\s+(?:US\\s?)?dollars")}), lambda v: v >= 100) as v
  from articles""")


@query("txt_addresses", MENTION_SQL.replace("'address' as kind, concat('ETH:', arg_min(a, i)) as value",
                                            "'ETH' as chain, arg_min(a, i) as address"))
def txt_addresses(spark, sf):
    return extract.addresses(load(spark, sf, "articles")).select("uid", "chain", "address")


@query("txt_tx_hashes", """
  select uid, array_to_string(list_distinct(list_transform(regexp_extract_all(text,
    '(?:^|[^0-9a-zA-Z])(0x[a-fA-F0-9]{64})(?:[^0-9a-zA-Z]|$)', 1), lambda h: lower(h))), '|') as txs from articles""")
def txt_tx_hashes(spark, sf):
    return load(spark, sf, "articles").select(
        "uid", F.array_join(extract.tx_hashes(F.col("text")), "|").alias("txs"))


@query("txt_keyword_any", f"""
  select uid, cast(regexp_matches({BLOB}, '{keyword_sql(SUBJECT)}') as bigint) as hit from articles""")
def txt_keyword_any(spark, sf):
    blob = F.concat_ws("\n", "title", "hint", "text")
    return flat(load(spark, sf, "articles").select("uid", tx.has_keyword(blob, SUBJECT).alias("hit")))


def first_sql(words: list[str]) -> str:
    arms = "|".join(
        w.lower() + "(?:s|es|ed|ing|er|ers)?" for w in words)
    return "(?i)(?:^|[^\\p{L}\\p{N}_])(" + arms + ")(?:[^\\p{L}\\p{N}_]|$)"


LATIN_CRIME = [w for w in fixed.CRIME_KEYWORDS if not w.endswith("*")]


@query("txt_keyword_first", f"""
  select uid, regexp_extract({BLOB}, '{first_sql(LATIN_CRIME)}', 1) as hit from articles""")
def txt_keyword_first(spark, sf):
    blob = F.concat_ws("\n", "title", "hint", "text")
    return load(spark, sf, "articles").select("uid", tx.first_keyword(blob, LATIN_CRIME).alias("hit"))


@query("txt_keyword_hit", f"""
  select uid, cast(regexp_matches({BLOB}, '{keyword_sql(SUBJECT)}')
    and regexp_matches({BLOB}, '{keyword_sql(fixed.CRIME_KEYWORDS)}') as bigint) as relevant from articles""")
def txt_keyword_hit(spark, sf):
    blob = F.concat_ws("\n", "title", "hint", "text")
    return flat(load(spark, sf, "articles").select("uid", tx.is_relevant(blob).alias("relevant")))


@query("relevance", f"""
  select uid, cast(regexp_matches({BLOB}, '{keyword_sql(SUBJECT)}')
    and regexp_matches({BLOB}, '{keyword_sql(fixed.CRIME_KEYWORDS)}') as bigint) as relevant from articles""")
def relevance(spark, sf):
    return flat(extract.relevance(load(spark, sf, "articles")).select("uid", "relevant"))


CHAIN_WORDS = [c for c in fixed.CHAIN_KEYWORDS if len(c) >= 3]


def chains_sql(table: str) -> str:
    """First three chain names of each text of a table (uid, text), by position."""
    return f"""
  select a.uid, coalesce(string_agg(w, '|' order by p, w) filter (rn <= 3), '') as chains from {table} a left join (
    select *, row_number() over (partition by uid order by p, w) as rn from (
      select uid, w, strpos(lower(text), regexp_extract(lower(text),
          concat('(?:^|[^a-z0-9])(', w, ')(?:[^a-z0-9]|$)'), 0)) + case when regexp_matches(lower(text),
          concat('^(', w, ')(?:[^a-z0-9]|$)')) then -1 else 0 end as p
      from {table}, (select unnest({CHAIN_WORDS}) as w)
      where regexp_matches(lower(text), concat('(?:^|[^a-z0-9])', w, '(?:[^a-z0-9]|$)')))) h on h.uid = a.uid
  group by a.uid"""


@query("txt_chain_mentions", chains_sql("articles"))
def txt_chain_mentions(spark, sf):
    return load(spark, sf, "articles").select(
        "uid", F.array_join(tx.chain_mentions(F.col("text")), "|").alias("chains"))


MONEY_BOTH = ("(?i)(?:US\\$|\\$|USD\\s?)\\s?" + NUM + "\\s*(billion|million|thousand|bn|mn|[bmk])?\\b"
              "|" + NUM + "\\s*(billion|million)\\s+(?:US\\s?)?dollars")
TX_SQL = "(?:^|[^0-9a-zA-Z])(0x[a-fA-F0-9]{64})(?:[^0-9a-zA-Z]|$)"
cte("mention_money", f"""
  select uid, list_filter(list_transform(list_zip({', '.join(f"regexp_extract_all(text, '{MONEY_BOTH}', {g})" for g in (1, 2, 3, 4))}),
    lambda z: case when z[1] <> '' then {scaled('z[1]', 'z[2]')} else {scaled('z[3]', 'z[4]')} end), lambda v: v >= 100) as v from articles""")
cte("mention_chains", f"select uid, string_split(chains, '|') as w from ({chains_sql('articles')}) where chains <> ''")


@query("mentions", f"""
  select uid, 'address' as kind, arg_min(a, i) as value, concat('ETH:', lower(a)) as norm, min(i) - 1 as pos from (
    select uid, unnest(m) as a, generate_subscripts(m, 1) as i from (select uid, regexp_extract_all(text,
      '(?:^|[^0-9a-zA-Z])(0x[a-fA-F0-9]{{40}})(?:[^0-9a-zA-Z]|$)', 1) as m from articles)) group by uid, lower(a)
  union all select uid, 'tx', h, h, row_number() over (partition by uid order by min(i)) - 1 from (
    select uid, lower(unnest(m)) as h, generate_subscripts(m, 1) as i from (
      select uid, regexp_extract_all(text, '{TX_SQL}', 1) as m from articles)) group by uid, h
  union all select uid, 'money', n, n, min(i) - 1 from (select uid, cast(cast(unnest(v) as decimal(20, 0)) as varchar) as n,
    generate_subscripts(v, 1) as i from mention_money) group by uid, n
  union all select uid, 'chain', unnest(w), unnest(w), generate_subscripts(w, 1) - 1 from mention_chains
  union all select uid, 'date', arg_min(d, i), n, min(i) - 1 from (select *, cast(case when regexp_matches(d, '^[0-9]')
      then try_cast(d as date) else cast(try_strptime(d, ['%B %d, %Y', '%b %d, %Y']) as date) end as varchar) as n from (
    select uid, unnest(m) as d, generate_subscripts(m, 1) as i from (
      select uid, regexp_extract_all(text, '{extract.DAY_FORM}', 1) as m from articles))) where n is not null group by uid, n""")
def mentions(spark, sf):
    return flat(extract.mentions(load(spark, sf, "articles")))


@query("txt_infer_chain", f"""
  select address, hint, case when length(address) = 42 and starts_with(address, '0x') then
      case when upper(hint) in {duck.words(fixed.EVM_HINTS)} then upper(hint) else 'ETH' end
    when starts_with(address, 'T') and length(address) = 34 then 'TRX'
    when lower(address) like 'bc1%' or address[1] in ('1', '3') then 'BTC'
    when lower(address) like 'ltc1%' or address[1] in ('L', 'M') then 'LTC'
    when address[1] = '4' and length(address) = 95 then 'XMR' when hint <> '' then upper(hint) else 'UNKNOWN' end as chain
  from (select distinct case p % 6 when 0 then address when 1 then concat('T', substr(address, 1, 33))
      when 2 then concat('bc1', substr(address, 3)) when 3 then concat('L', substr(address, 3))
      when 4 then concat('4', address, address, '0123456789') else substr(address, 3) end as address, chain as hint
    from card_addresses)""")
def txt_infer_chain(spark, sf):
    shaped = load(spark, sf, "card_addresses").selectExpr(
        "case p % 6 when 0 then address when 1 then concat('T', substr(address, 1, 33)) "
        "when 2 then concat('bc1', substr(address, 3)) when 3 then concat('L', substr(address, 3)) "
        "when 4 then concat('4', address, address, '0123456789') else substr(address, 3) end as address",
        "chain as hint").distinct()
    return shaped.withColumn("chain", tx.infer_chain(F.col("address"), F.col("hint")))


@query("txt_address_validate")
def txt_address_validate(spark, sf):
    """Formats of all card and list addresses, some cut or respelled."""
    a = load(spark, sf, "card_addresses").selectExpr(
        "case p % 5 when 0 then substr(address, 1, 30) when 1 then concat('bc1q', lower(substr(address, 3, 38))) "
        "when 2 then concat('0xAbC', substr(address, 6)) when 3 then concat(address, substr(address, 3, 24)) "
        "else address end as address")
    return extract.address_formats(a)


@query("address_check", """
  select distinct address, 'evm' as family, 1 as valid, case when address <> lower(address) then lower(address) end as fixed
  from card_addresses""")
def address_check(spark, sf):
    out = extract.address_formats(load(spark, sf, "card_addresses"))
    return out.select("address", "family", F.col("valid").cast("int").alias("valid"), "fixed")


@query("txt_amount_max", f"""
  select uid, list_max({money_list('text', "(?i)\\$\\s?" + NUM + "\\s*(billion|million|thousand|bn|mn|[bmk])?\\b")})
    as amount from articles""")
def txt_amount_max(spark, sf):
    return flat(load(spark, sf, "articles").select("uid", tx.max_amount(F.col("text")).alias("amount")))


@query("txt_money_values", """
  select uid, cast(len(v) as bigint) as n, round(coalesce(list_sum(v), 0), 2) as total from article_money""")
def txt_money_values(spark, sf):
    v = tx.money_values(F.col("text"))
    total = F.aggregate(v, F.lit(0.0), lambda a, b: a + b)
    return flat(load(spark, sf, "articles").select("uid", F.size(v).alias("n"), total.alias("total")))


@query("txt_mentions_amount", f"""
  select uid, cast(len(list_filter({money_list('text', "(?i)\\$?\\s?" + NUM
      + "\\s*(K|M|B|million|billion|thousand)?\\b")},
    lambda v: v > 0 and abs(v - a) / a <= 0.015)) > 0 as bigint) as stated
  from (select uid, text, case d % 3 when 0 then 12550000.0 when 1 then 3450000.0 else 74900.0 end as a from articles)""")
def txt_mentions_amount(spark, sf):
    amount = F.expr("cast(case d % 3 when 0 then 12550000.0 when 1 then 3450000.0 else 74900.0 end as double)")
    return flat(load(spark, sf, "articles").select("uid", tx.states_amount(F.col("text"), amount).alias("stated")))


@query("txt_loss_amount", f"""
  select uid, {scaled('n', 'u')} as amount from (
    select uid, nullif(regexp_extract(text, '\\$\\s*([0-9,]+(?:\\.[0-9]+)?)', 1), '') as n,
      regexp_extract(text, '\\$\\s*[0-9,]+(?:\\.[0-9]+)?\\s*([KkMmBb])(?:[^A-Za-z]|$)', 1) as u0,
      case when regexp_extract(text, '\\$\\s*([0-9,]+(?:\\.[0-9]+)?)', 0) || regexp_extract(substr(text,
          strpos(text, regexp_extract(text, '\\$\\s*[0-9,]+(?:\\.[0-9]+)?', 0))
          + length(regexp_extract(text, '\\$\\s*[0-9,]+(?:\\.[0-9]+)?', 0))), '^\\s*[KkMmBb](?:[^A-Za-z]|$)', 0) <> ''
        then regexp_extract(substr(text, strpos(text, regexp_extract(text, '\\$\\s*[0-9,]+(?:\\.[0-9]+)?', 0))
          + length(regexp_extract(text, '\\$\\s*[0-9,]+(?:\\.[0-9]+)?', 0))), '^\\s*([KkMmBb])(?:[^A-Za-z]|$)', 1)
        else '' end as u
    from articles)""")
def txt_loss_amount(spark, sf):
    return load(spark, sf, "articles").select("uid", tx.loss_amount(F.col("text")).alias("amount"))


@query("txt_date_normalize", """
  select event_id, case when event_id % 9 < 8 then strftime(ts, '%Y-%m-%d') end as day from events""")
def txt_date_normalize(spark, sf):
    """Event times in eight spellings, and one unreadable."""
    ts = F.col("ts").cast("timestamp")
    n = F.col("event_id") % 9
    spelled = (
        F.when(n == 0, F.unix_timestamp(ts).cast("string")).when(n == 1, F.unix_millis(ts).cast("string"))
        .when(n == 2, F.concat(F.lit("$D"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
        .when(n == 3, F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")).when(n == 4, F.date_format(ts, "MMMM d, yyyy"))
        .when(n == 5, F.date_format(ts, "EEEE, MMMM d, yyyy")).when(n == 6, F.date_format(ts, "yyyy-MM-dd"))
        .when(n == 7, F.date_format(ts, "d MMM yyyy")).otherwise(F.lit("soon")))
    return read(spark, sf, "events").select("event_id", tx.to_day(spelled).cast("string").alias("day"))


@query("txt_clean", """
  select uid, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(text,
      concat(chr(160), chr(8239), chr(8201), chr(8209), chr(8208), chr(8722)), '   ---'),
    '\\$\\s*([0-9][0-9,]*(?:\\.[0-9]+)?)\\s*[Kk]([^A-Za-z]|$)', '$\\1K\\2', 'g'),
    '\\$\\s*([0-9][0-9,]*(?:\\.[0-9]+)?)\\s*[Mm]([^A-Za-z]|$)', '$\\1M\\2', 'g'),
    '\\$\\s*([0-9][0-9,]*(?:\\.[0-9]+)?)\\s*[Bb]([^A-Za-z]|$)', '$\\1B\\2', 'g'),
    '([0-9])\\s*×', '\\1x', 'g'), '[ \\t]{2,}', ' ', 'g')) as text from articles""")
def txt_clean(spark, sf):
    return load(spark, sf, "articles").select("uid", tx.clean(F.col("text")).alias("text"))


NAME = "case when coalesce(project, '') <> '' then project else title end"
def card_name():
    return F.expr(NAME)


@query("txt_name_normalize", f"select uid, {duck.norm(NAME)} as norm from cards")
def txt_name_normalize(spark, sf):
    return load(spark, sf, "cards").select("uid", tx.normalize_name(card_name()).alias("norm"))


@query("txt_name_tokens", f"select uid, array_to_string({duck.toks(NAME)}, ' ') as tokens from cards")
def txt_name_tokens(spark, sf):
    return load(spark, sf, "cards").select("uid", F.array_join(tx.name_tokens(card_name()), " ").alias("tokens"))


@query("txt_trigrams", f"""
  select norm, array_to_string(list_sort({duck.grams('norm')}), '|') as grams
  from (select distinct {duck.norm(NAME)} as norm from cards)""")
def txt_trigrams(spark, sf):
    norms = load(spark, sf, "cards").select(tx.normalize_name(card_name()).alias("norm")).distinct()
    return norms.withColumn("grams", F.array_join(F.array_sort(tx.trigrams(F.col("norm"))), "|"))


GROUP_SQL = (
    "substr(regexp_replace(regexp_replace(lower(" + NAME + "), '\\b(" + "|".join(fixed.GROUP_KEY_STOP)
    + ")\\b', ' ', 'g'), '[^a-z0-9가-힣]+', '', 'g'), 1, 40)"
)


@query("txt_group_key", f"select uid, {GROUP_SQL} as group_key from cards")
def txt_group_key(spark, sf):
    return load(spark, sf, "cards").select("uid", tx.group_key(card_name()).alias("group_key"))


@query("txt_legal_words", "select uid, array_to_string(list_sort(words), ' ') as words from prof")
def txt_legal_words(spark, sf):
    words = tx.legal_words(F.col("project"), F.col("title"), F.array_join(F.slice("actors", 1, 5), " "))
    return load(spark, sf, "cards").where("relevant").select("uid", F.array_join(words, " ").alias("words"))


@query("txt_url_key", f"select uid, {duck.url_key('url')} as url_key from cards")
def txt_url_key(spark, sf):
    return load(spark, sf, "cards").select("uid", tx.url_key(F.col("url")).alias("url_key"))


@query("name_keys", f"""
  select *, count(*) over (partition by kind, value) as rarity from (
  select uid, 'norm' as kind, {duck.norm(NAME)} as value from cards
  union all select uid, 'group', {GROUP_SQL} from cards
  union all select uid, 'url', {duck.url_key('url')} from cards
  union all select uid, 'word', unnest({duck.toks(NAME)}) from cards
  union all select uid, 'trigram', unnest({duck.grams('norm')}) from (select uid, {duck.norm(NAME)} as norm from cards))""")
def name_keys(spark, sf):
    return extract.name_keys(load(spark, sf, "cards"))


PHRASE = """case d % 4 when 0 then lower(substr(text, 1, 60)) when 1 then replace(substr(text, 5, 40), ' ', ' — ')
  when 2 then concat(substr(text, 1, 20), 'zzz') else substr(text, 1, 4) end"""


def bare(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9a-z가-힣$%.,]+', ' ', 'g')"


def plain(x: str) -> str:
    return f"lower(trim(regexp_replace({x}, '\\s+', ' ', 'g')))"


EVIDENCE = f"""
  select uid, cast(length(ev) >= 6 and (contains(t, ev) or contains({bare('t')}, trim({bare('ev')}))) as bigint) as found
  from (select uid, {plain('text')} as t, {plain(PHRASE)} as ev from articles)"""


@query("txt_evidence_in_text", EVIDENCE)
def txt_evidence_in_text(spark, sf):
    found = tx.evidence_in_text(F.expr(PHRASE), F.col("text"))
    return flat(load(spark, sf, "articles").select("uid", found.alias("found")))


@query("evidence", EVIDENCE.replace("select uid, cast(", "select uid, 'project' as field, cast(", 1))
def evidence(spark, sf):
    texts = load(spark, sf, "articles")
    patches = texts.select("uid", F.lit("project").alias("field"), F.expr(PHRASE).alias("phrase"))
    return flat(extract.evidence(patches, texts))


WORD_NAME = "concat(substr(text, 1, 12), ' ', case when d % 2 = 0 then 'Zebra Quux' else 'Nowhere' end, ' ', feed)"


@query("txt_text_mentions", f"""
  select uid, cast(length(text) >= 400 and (len(w) = 0 or len(list_filter(w, lambda v: contains(lower(text), lower(v))))
    >= greatest(1, floor(len(w) * 0.6))) as bigint) as mentioned
  from (select uid, text, regexp_extract_all({WORD_NAME}, '[A-Za-z0-9가-힣]{{3,}}') as w from articles)""")
def txt_text_mentions(spark, sf):
    return flat(load(spark, sf, "articles").select(
        "uid", tx.text_mentions(F.expr(WORD_NAME), F.col("text")).alias("mentioned")))


GENERIC_NAME = """case k % 5 when 0 then project when 1 then lower(title) when 2 then concat(project, ' users')
  when 3 then 'software developers' else concat(project, ' ') end"""


@query("txt_generic_name", f"""
  select uid, cast(n = '' or (not regexp_matches(n, '[A-Z0-9가-힣]') and len(w) >= 2)
    or (len(w) between 1 and 3 and lower(w[-1]) in {duck.words(fixed.GENERIC_LAST_WORDS)}) as bigint) as generic
  from (select uid, n, regexp_extract_all(n, '[A-Za-z]+') as w from (select uid, trim({GENERIC_NAME}) as n from cards))""")
def txt_generic_name(spark, sf):
    return flat(load(spark, sf, "cards").select("uid", tx.is_generic_name(F.expr(GENERIC_NAME)).alias("generic")))


LABEL_LIST = "[" + ", ".join("{'k': '" + k + "', 'v': '" + v + "'}" for k, v in fixed.METHOD_LABELS) + "]"


@query("txt_method_glossary", f"""
  select uid, case when lower(attack_method) in ('', 'unknown', 'n/a', '-') then '' else array_to_string(
    list_filter(h, lambda x, i: list_position(h, x) = i)[1:2], '·') end as label
  from (select uid, attack_method, list_transform(list_filter({LABEL_LIST},
    lambda r: contains(lower(attack_method), r.k)), lambda r: r.v) as h from cards)""")
def txt_method_glossary(spark, sf):
    return load(spark, sf, "cards").select("uid", tx.method_label(F.col("attack_method")).alias("label"))


@query("txt_script_ratio", """
  select uid, cast(length(trim(summary_ko)) < 25 or length(regexp_replace(b, '[^가-힣]', '', 'g')) * 1.0
    / greatest(1, length(b)) < 0.2 as bigint) as needed
  from (select uid, summary_ko, regexp_replace(trim(summary_ko), '\\s+', '', 'g') as b from cards)""")
def txt_script_ratio(spark, sf):
    return flat(load(spark, sf, "cards").select("uid", tx.needs_hangul_summary(F.col("summary_ko")).alias("needed")))


@query("txt_severity_tier", """
  select uid, case when coalesce(amount_usd, 0) <= 0 then '' when amount_usd >= 1e8 then 'S' when amount_usd >= 1e7 then 'A'
      when amount_usd >= 1e6 then 'B' when amount_usd >= 1e5 then 'C' else 'D' end as tier,
    case when incident_type = 'sanctions_designation' then 'sanction' when incident_type = 'law_enforcement_action'
      then 'legal' when coalesce(amount_usd, 0) >= 1e7 then 'high' when coalesce(amount_usd, 0) >= 1e6 then 'medium'
      else 'low' end as severity,
    cast(case when coalesce(amount_usd, 0) >= 5e8 then 5 when amount_usd >= 1e8 then 4 when amount_usd >= 1e7 then 3
      when amount_usd >= 1e6 then 2 when amount_usd > 0 then 1 else 0 end as bigint) as threat from cards""")
def txt_severity_tier(spark, sf):
    a = F.col("amount_usd")
    return load(spark, sf, "cards").select(
        "uid", tx.severity_tier(a).alias("tier"), tx.alert_severity(F.col("incident_type"), a).alias("severity"),
        tx.threat_level(a).cast("bigint").alias("threat"))
