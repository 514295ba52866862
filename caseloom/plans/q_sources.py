"""Queries of the readers: Spark lands payload files derived from the given tables, the reader reads them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.plans.fixture import load, read
from caseloom.plans.q_rows import flat
from caseloom.plans.registry import query
from caseloom.session import scratch_path
from caseloom.sources import readers

ITEM_COLS = ["source", "source_id", "uid", "url", "title", "published_at", "s_name", "s_amount", "s_type", "tags"]


def landed(spark: SparkSession, df: DataFrame, fmt: str, **options) -> str:
    path = scratch_path(spark, fmt)
    df.write.format(fmt).options(**options).save(path)
    return path


RECORD_SQL = """case k % 4 when 0 then 'Private Key Compromise' when 1 then 'Rugpull' when 2 then 'Protocol Logic' else '' end"""
TECH_SQL = "case k % 3 when 0 then 'Phishing' when 1 then attack_method else '' end"


@query("src_json_records", f"""
  select 'defillama' as source, concat(title, '|', cast(published_at as varchar)) as source_id,
    substr(sha1(concat('defillama|', title, '|', cast(published_at as varchar))), 1, 16) as uid,
    case when k % 2 = 0 then url else 'https://example.org/incidents' end as url,
    concat(title, ' — ', cls, case when tech <> '' then concat(' (', tech, ')') else '' end) as title,
    cast(published_at as varchar) as published_at, title as s_name, round(amount_usd, 2) as s_amount,
    case when contains(lower(concat(cls, chr(10), tech)), 'social engineering') then 'phishing_social_engineering'
      when contains(lower(concat(cls, chr(10), tech)), 'phishing') then 'phishing_social_engineering'
      when contains(lower(concat(cls, chr(10), tech)), 'rug pull') or contains(lower(cls), 'rugpull') then 'rug_pull'
      when contains(lower(concat(cls, chr(10), tech)), 'key compromise') then 'private_key_compromise'
      else 'hack_exploit' end as s_type,
    concat_ws('|', nullif(cls, ''), nullif(tech, '')) as tags
  from (select *, {RECORD_SQL} as cls, {TECH_SQL} as tech from cards where published_at >= date '1995-01-01')""")
def src_json_records(spark, sf):
    records = load(spark, sf, "cards").selectExpr(
        "title as name", "cast(unix_date(published_at) as bigint) * 86400 as date", "amount_usd as amount", "chains as chain",
        f"{RECORD_SQL} as classification", f"{TECH_SQL} as technique", "case when k % 2 = 0 then url else 'n/a' end as source")
    path = landed(spark, records, "json")
    return flat(readers.json_records(spark, path, since="1995-01-01", multi_line=False).select(*ITEM_COLS))


@query("src_rss")
def src_rss(spark, sf):
    a = load(spark, sf, "articles")
    url = F.concat(F.lit("https://feed.example/"), F.col("uid"))
    feed = a.select(
        F.concat("title", F.lit(" exploit of a crypto wallet | TRM Labs")).alias("title"),
        F.concat(url, F.lit("?utm_source=x&ref=y")).alias("link"),
        F.lit("Tue, 05 Mar 2024 10:00:00 GMT").alias("pubDate"), F.col("hint").alias("description"),
        F.array("feed", "lang").alias("category"))
    path = landed(spark, feed, "xml", rootTag="rss", rowTag="item")
    pages = a.select(url.alias("url"), F.concat(
        F.lit("<html><body><article><p>"), "text", F.lit("</p></article></body></html>")).alias("html"))
    return flat(readers.rss(spark, path, "trm", since="2024-01-01", pages=pages).select(*ITEM_COLS, "text"))


@query("src_press_json")
def src_press_json(spark, sf):
    a = load(spark, sf, "articles")
    release = F.struct(
        F.col("uid").alias("uuid"), F.concat(F.lit("https://press.example/"), "uid").alias("url"),
        F.lit("1709632800").alias("date"), F.concat("title", F.lit(" &amp; others")).alias("title"),
        F.concat(F.lit("<p>"), "text", F.lit("</p><ul><li>bitcoin</li></ul>")).alias("body"), F.col("hint").alias("teaser"),
        F.col("uid").alias("number"), F.array(F.struct(F.col("feed").alias("name"))).alias("component"))
    pages = a.groupBy(F.floor(F.col("d") / 50).alias("page")).agg(F.collect_list(release).alias("results")).drop("page")
    return flat(readers.press_json(spark, landed(spark, pages, "json"), since="2024-01-01").select(*ITEM_COLS, "text"))


@query("src_sanctions_xml", """
  select entity_uid, entity_name, programs, chain, address from (
    select cast(p_partkey as varchar) as entity_uid, concat('First ', p_name) as entity_name,
      concat(p_brand, '|', p_type) as programs, case p_partkey % 4 when 0 then 'BTC' when 1 then 'ETH' when 2 then 'ETH'
        else 'OPTIMISM' end as chain, concat('0x', md5(cast(p_partkey as varchar)), '01234567') as address, p_partkey
    from part)""")
def src_sanctions_xml(spark, sf):
    code = F.element_at(F.array(*[F.lit(c) for c in ("XBT", "ETH", "USDT", "OP")]), (F.col("p_partkey") % 4 + 1).cast("int"))
    address = F.concat(F.lit("0x"), F.md5(F.col("p_partkey").cast("string")), F.lit("01234567"))
    ids = F.array(
        F.struct(F.concat(F.lit("Digital Currency Address - "), code).alias("idType"), address.alias("idNumber")),
        F.struct(F.lit("Passport").alias("idType"), F.lit("123").alias("idNumber")))
    entries = read(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("uid"), F.lit("First").alias("firstName"), F.col("p_name").alias("lastName"),
        F.struct(F.array("p_brand", "p_type").alias("program")).alias("programList"), F.struct(ids.alias("id")).alias("idList"))
    path = landed(spark, entries, "xml", rootTag="sdnList", rowTag="sdnEntry")
    return flat(readers.sanctions_xml(spark, path))


@query("src_sanctions_notice", """
  select source_id, line, entity, programs, chain, address from (
    select cast(p_partkey as varchar) as source_id, 1 as line, concat(upper(p_name), case when p_partkey % 3 = 0 then
        ' (amended)' else '' end) as entity, 'DPRK3|RUSSIA' as programs, 'BTC' as chain,
      concat('1', md5(cast(p_partkey as varchar))) as address from part
    union all
    select cast(p_partkey as varchar), 1, concat(upper(p_name), case when p_partkey % 3 = 0 then ' (amended)' else '' end),
      'DPRK3|RUSSIA', 'TRX', concat('T', substr(md5(cast(p_partkey as varchar)), 1, 30), 'abc') from part
    union all
    select cast(p_partkey as varchar), 3, 'DOE, John', '', 'XMR', concat('4', md5(p_name)) from part)""")
def src_sanctions_notice(spark, sf):
    h = F.md5(F.col("p_partkey").cast("string"))
    old = F.when(F.col("p_partkey") % 3 == 0, F.lit("OLD NAME; Digital Currency Address - XBT 1old [X] -to- ")).otherwise("")
    text = F.concat(
        F.lit("The following changes have been made\n"), old, F.upper("p_name"),
        F.lit(" (a.k.a. X), Moscow; [RUSSIA] [DPRK3] Digital Currency Address - XBT 1"), h,
        F.lit("; Digital Currency Address - USDT T"), F.substring(h, 1, 30), F.lit("abc;\nno address here\n"),
        F.lit("DOE, John, DOB 1990; Digital Currency Address - XMR 4"), F.md5("p_name"))
    texts = read(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("source_id"), text.alias("text"))
    return flat(readers.notice_addresses(texts))


@query("src_markdown_catalog", """
  select 'defihacklabs' as source, concat(strftime(od, '%Y%m%d'), '|', name0) as source_id, strftime(od, '%Y-%m-%d')
    as published_at, name0 as s_name, cast(e % 900 + 1 as double) * 1000 as s_amount, concat('src/test/', h, '.sol') as url
  from (select cast(o_orderdate as date) as od, cast(floor(o_custkey / 5.0) as bigint) as e,
    substr(md5(cast(cast(floor(o_custkey / 5.0) as bigint) as varchar)), 1, 8) as h, concat('Proto ', o_orderkey) as name0
    from orders)""")
def src_markdown_catalog(spark, sf):
    o = read(spark, sf, "orders")
    e = F.floor(F.col("o_custkey") / 5).cast("bigint")
    block = F.concat(
        F.lit("### "), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(" Proto "), F.col("o_orderkey").cast("string"),
        F.lit(" - Price Manipulation - oracle\n### Lost: $"), ((e % 900) + 1).cast("string"), F.lit("K and more\n[poc](../../src/test/"),
        F.substring(F.md5(e.cast("string")), 1, 8), F.lit(".sol)\n\n"))
    path = landed(spark, o.select(block.alias("value")), "text", lineSep="\n")
    items = readers.markdown_catalog(spark, path)
    return flat(items.select("source", "source_id", "published_at", "s_name", "s_amount", "url"))


@query("src_poc_header", """
  select cast(p_partkey as varchar) as path, line, role, chain, address from (
    select p_partkey, 1 as line, 'attacker' as role, concat('0x', md5(cast(p_partkey as varchar)), '00000000') as address from part
    union all select p_partkey, 2, 'victim', concat('0x', md5(p_name), '00000000') from part) x
  join (select p_partkey as pk, case when p_partkey % 3 = 0 then 'BSC' when p_partkey % 3 = 1 then 'Arbitrum' else 'ETH' end
    as chain from part) c on c.pk = x.p_partkey""")
def src_poc_header(spark, sf):
    key = F.col("p_partkey")
    code = F.concat(
        F.lit("// SPDX\n// Attacker: 0x"), F.md5(key.cast("string")), F.lit("00000000\n// Vulnerable: 0x"), F.md5("p_name"),
        F.lit("00000000 tx 0x"), F.sha2("p_name", 256), F.lit("\nimport 'x';\n\n* more\ncontract A {\n// Attacker: 0x"),
        F.md5("p_brand"), F.lit("11111111\n"),
        F.when(key % 3 == 0, 'vm.createSelectFork("bsc", 1);').when(key % 3 == 1, "see arbiscan.io/tx").otherwise("none"))
    files = read(spark, sf, "part").select(key.cast("string").alias("path"), code.alias("content"))
    out = readers.header_addresses(readers.code_headers(files))
    return flat(out.select("path", "line", "role", "chain", "address"))


def day_pages(spark: SparkSession, sf: str, entry) -> DataFrame:
    """Pages of list entries, fifty cards each at most."""
    page = F.floor(F.col("k") / 50).alias("page")
    return load(spark, sf, "cards").groupBy(page).agg(F.concat_ws("\n", F.collect_list(entry)).alias("body")).select(
        F.concat(F.lit("https://list.example/"), F.col("page").cast("string")).alias("url"),
        F.concat(F.lit("<html><body><ul>"), "body", F.lit("</ul></body></html>")).alias("html"))


@query("src_html_list", """
  select 'slowmist' as source, concat(cast(published_at as varchar), '|', title) as source_id, url,
    cast(published_at as varchar) as published_at, title as s_name, cast(k % 1000 as double) as s_amount,
    case when contains(lower(attack_method), 'social') or contains(lower(attack_method), 'phishing')
      then 'phishing_social_engineering' when contains(lower(attack_method), 'private key') then 'private_key_compromise'
      else 'hack_exploit' end as s_type from cards where published_at is not null""")
def src_html_list(spark, sf):
    entry = F.concat(
        F.lit("<li><span class='time'>"), F.coalesce(F.col("published_at").cast("string"), F.lit("soon")),
        F.lit("</span><h3><em>Hacked target:</em> "), "title",
        F.lit("</h3><p><span>Description of the event:</span> story</p><p><span>Amount of loss:</span> $ "),
        (F.col("k") % 1000).cast("string"), F.lit(" <span>Attack method:</span> "), "attack_method",
        F.lit("</p><p class='link-reference'><a href='"), "url", F.lit("'>ref</a></p></li>"))
    items = readers.html_list(day_pages(spark, sf, entry))
    return flat(items.select("source", "source_id", "url", "published_at", "s_name", "s_amount", "s_type"))


@query("src_message_feed", """
  select cast(k as varchar) as source_id, title, cast(published_at as varchar) as published_at, '1 ETH stolen' as last_line
  from (select k, title, published_at from cards where published_at is not null)""")
def src_message_feed(spark, sf):
    k = F.col("k").cast("string")
    entry = F.concat(
        F.lit("<div class='tgme_widget_message_wrap x'><div data-post='chan/"), k,
        F.lit("'><div class='tgme_widget_message_text js'>"), "title", F.lit("<br/>1 ETH stolen</div><time datetime='"),
        F.coalesce(F.col("published_at").cast("string"), F.lit("")), F.lit("T10:00:00+00:00'>x</time></div></div>"))
    pages = day_pages(spark, sf, entry)
    items = readers.message_feed(pages.unionByName(pages))  # every page landed twice
    return flat(items.select("source_id", "title", "published_at", F.element_at(F.split("text", "\n"), -1).alias("last_line")))


@query("src_embedded_json", """
  select 'ranked' as part, concat('/s', o_orderkey) as source_id,
    strftime(o_orderdate + interval 20 year, '%Y-%m-%d') as published_at,
    round(o_totalprice, 2) as s_amount, 'hack_exploit' as s_type from orders
  union all
  select 'payload', concat('s', o_orderkey), strftime(o_orderdate, '%Y-%m-%d'), round(o_totalprice, 2),
    case o_orderkey % 3 when 0 then 'rug_pull' when 1 then 'private_key_compromise' else 'hack_exploit' end from orders""")
def src_embedded_json(spark, sf):
    o = read(spark, sf, "orders")
    slug = F.concat(F.lit("s"), F.col("o_orderkey").cast("string"))
    group = F.floor(F.col("o_orderkey") / 50)
    row = F.struct(slug.alias("slug"), F.concat(F.lit("T - "), slug).alias("title"), F.struct(
        F.date_format(F.add_months("o_orderdate", 240), "M/d/yyyy").alias("date"), F.col("o_totalprice").cast("string").alias("amount")).alias("rekt"))
    ranked = o.groupBy(group).agg(F.to_json(F.struct(F.struct(F.struct(
        F.collect_list(row).alias("leaderboard")).alias("pageProps")).alias("props"))).alias("j")).select(
        F.lit("u").alias("url"), F.concat(F.lit('<script id="__NEXT_DATA__" type="x">'), "j", F.lit("</script>")).alias("html"))
    category = F.element_at(F.array(F.lit("Rug Pull"), F.lit("Private Key"), F.lit("Logic")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    item = F.struct(slug.alias("name"), slug.alias("slug"), F.concat(F.lit("$D"), F.date_format("o_orderdate", "yyyy-MM-dd"))
                    .alias("hackedAt"), F.col("o_totalprice").alias("amount"), F.struct(category.alias("name")).alias("category"))
    blob = F.concat(F.lit('{"projectSummaries":'), F.to_json(F.collect_list(item)), F.lit("}"))
    quoted = F.concat(F.lit('"'), F.replace(F.replace(blob, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    pushed = o.groupBy(group).agg(quoted.alias("q")).select(
        F.lit("u").alias("url"), F.concat(F.lit("<script>self.__next_f.push([1,"), "q", F.lit("])</script>")).alias("html"))
    cols = ["source_id", "published_at", "s_amount", "s_type"]
    one = readers.ranked_list(ranked).select(F.lit("ranked").alias("part"), *cols)
    return flat(one.unionByName(readers.payload_list(pushed).select(F.lit("payload").alias("part"), *cols)))


@query("src_article")
def src_article(spark, sf):
    """The given pages, each with a date line added in its body."""
    pages = read(spark, sf, "pages").withColumn("html", F.replace(
        "html", F.lit("</h1>"), F.lit("</h1><time>March 5, 2024</time>")))
    return flat(readers.articles(pages).select("source_id", "title", "published_at", "text", "hint", "tags"))


@query("src_flat_list", "select distinct lower(address) as address from card_addresses")
def src_flat_list(spark, sf):
    a = load(spark, sf, "card_addresses")
    junk = F.array(F.lit("0x12"), F.lit("not an address"))
    files = a.groupBy(F.floor(F.col("k") / 200)).agg(F.to_json(F.concat(F.collect_list("address"), junk)).alias("value"))
    path = landed(spark, files.select("value"), "text")
    return readers.flat_list(spark, path, array_per_line=True)


@query("src_blacklist_csv", """
  select key, array_to_string(list_sort(list_distinct(list_concat(sources, ['extra']))), '|') as sources,
    array_to_string(categories, '|') as categories, array_to_string(list_sort(list_distinct(list_concat(labels,
      ['theme']))), '|') as labels from bindex""")
def src_blacklist_csv(spark, sf):
    rows = load(spark, sf, "blacklist_rows")
    one = landed(spark, rows.drop("z"), "csv", header=True)
    other = rows.select("address", F.lit("extra").alias("source"), F.lit("theme").alias("entity_theme"))
    two = landed(spark, other, "csv", header=True)
    return flat(readers.blacklist_csv(spark, [one, two]))


@query("src_cards_jsonl", """
  select uid, title, cast(incident_date as varchar) as incident_date, round(amount_usd, 2) as amount_usd,
    array_to_string(tags, '|') as tags from cards""")
def src_cards_jsonl(spark, sf):
    cards = load(spark, sf, "cards").drop("k", "e")
    good = cards.select(F.to_json(F.struct(*cards.columns, F.lit(1).alias("unknown_key"))).alias("value"))
    bad = cards.select(F.concat(F.lit('{"uid": '), F.col("uid"), F.lit(", broken")).alias("value"))
    path = landed(spark, good.unionByName(bad), "text")
    out = readers.cards_jsonl(spark, path, cards.schema)
    return flat(out.select("uid", "title", "incident_date", "amount_usd", "tags"))
