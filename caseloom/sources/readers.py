"""Readers of landed payloads: files in, item rows out, nothing else.

Every reader returns the columns of ITEM; addresses and transactions a source states come from a second function. All
take `since` and keep what was published on or after it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from html import unescape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom import fixed
from caseloom.functions import html as hp
from caseloom.functions import text as tx
from caseloom.operators import extract, matching
from caseloom.operators.cards import item_uid
from caseloom.operators.ranking import running_sum

ITEM = {
    "source": "string", "source_id": "string", "uid": "string", "url": "string", "title": "string",
    "published_at": "date", "text": "string", "hint": "string", "s_name": "string", "s_date": "date",
    "s_amount": "double", "s_amount_text": "string", "s_chains": "array<string>", "s_type": "string",
    "s_method": "string", "s_summary": "string", "tags": "array<string>", "needs_enrichment": "boolean",
}


def to_items(df: DataFrame, source: str, since: str | None = None) -> DataFrame:
    """Complete a reader's columns to the item contract."""
    out = df.withColumn("source", F.lit(source))
    out = out.withColumn("uid", item_uid(F.col("source"), F.col("source_id")))
    for name, kind in ITEM.items():
        value = F.col(name) if name in out.columns else F.lit(None)
        out = out.withColumn(name, value.cast(kind))
    out = out.select(*ITEM)
    return out.where(F.col("published_at") >= F.lit(since).cast("date")) if since else out.where("published_at is not null")


def _present(*words: Column) -> Column:
    return F.filter(F.array(*words), lambda w: F.coalesce(w, F.lit("")) != "")


# --- records -------------------------------------------------------------------------------------------------------
RECORD = ("name string, date string, amount double, chain array<string>, classification string, technique string, "
          "source string, returnedFunds double")


def json_records(spark: SparkSession, path: str, since=None, source="defillama", multi_line=True,
                 fallback_url="https://example.org/incidents") -> DataFrame:
    """Structured incidents: a JSON array per file, or one object per line."""
    r = spark.read.schema(RECORD).option("multiLine", multi_line).json(path)
    cls, tech = F.trim(F.coalesce("classification", F.lit(""))), F.trim(F.coalesce("technique", F.lit("")))
    seconds = F.when(F.col("date").rlike(r"^\d{1,11}$"), F.timestamp_seconds(F.col("date").try_cast("bigint")).cast("date"))
    day = F.coalesce(seconds, tx.to_day(F.col("date")))
    url = F.trim(F.coalesce("source", F.lit("")))
    method = F.when((cls != "") & (tech != ""), F.concat(cls, F.lit(" — "), tech)).otherwise(F.concat(cls, tech))
    return to_items(r.select(
        F.concat_ws("|", "name", day.cast("string")).alias("source_id"),
        F.when(url.startswith("http"), url).otherwise(fallback_url).alias("url"),
        F.concat(F.col("name"), F.lit(" — "), cls, F.when(tech != "", F.concat(F.lit(" ("), tech, F.lit(")"))).otherwise(""))
        .alias("title"), day.alias("published_at"), F.lit("").alias("text"), F.col("name").alias("s_name"),
        day.alias("s_date"), F.col("amount").alias("s_amount"), F.col("chain").alias("s_chains"),
        tx.type_by_rules(F.concat_ws("\n", cls, tech), fixed.RECORD_TYPE_RULES, "hack_exploit").alias("s_type"),
        method.alias("s_method"), _present(cls, tech).alias("tags"), F.lit(False).alias("needs_enrichment"),
    ), source, since)


# --- XML -----------------------------------------------------------------------------------------------------------
def xml_records(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """The elements of a name in XML files, read in splits: text up to each end tag, parsed from its start tag on.

    Where text alone can't tell the elements apart (a start or end tag inside a comment or CDATA, an element inside one of
    its name, an empty element, a blank in an end tag), the file is read whole by Spark's reader, which takes one task a file.
    """
    start, apart = rf"<{tag}[\s>/]", r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
    pieces = spark.read.option("lineSep", f"</{tag}>").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    bare = F.regexp_replace("value", apart, "")
    starts = F.regexp_count("value", F.lit(start))
    marked = F.contains("value", F.lit("<!--")) | F.contains("value", F.lit("<![CDATA["))
    astray = F.when(marked, (starts != F.regexp_count(bare, F.lit(start))) | bare.rlike(r"<!--|<!\[CDATA\[")).otherwise(False)
    unclear = (starts > 1) | astray | F.col("value").rlike(rf"</{tag}\s|<{tag}(?:\s[^<>]*)?/>")
    files = [r["file"] for r in pieces.where(unclear).select("file").distinct().collect()]
    clear = pieces.where(starts == 1)
    if files:
        clear = clear.where(~F.col("file").isin(files))
    text = F.concat(F.regexp_extract("value", rf"(?s){start}.*", 0), F.lit(f"</{tag}>"))
    out = clear.select(F.from_xml(text, schema).alias("r")).select("r.*")
    return out.unionByName(spark.read.schema(schema).option("rowTag", tag).format("xml").load(files)) if files else out


# --- feeds ---------------------------------------------------------------------------------------------------------
RSS_ITEM = "title string, link string, pubDate string, description string, category array<string>"


def rss(spark: SparkSession, path: str, source: str, since=None, pages: DataFrame | None = None,
        site_names: tuple[str, ...] = ("TRM Labs", "Chainalysis"), require_keywords=True) -> DataFrame:
    """Feed entries, with the text of their landed article pages (url, html) where there is one."""
    e = xml_records(spark, path, "item", RSS_ITEM)
    link = F.regexp_replace(F.regexp_replace(F.coalesce("link", F.lit("")), r"[?&](utm_[a-z]+|ref|source)=[^&#]*", ""),
                            "[?&]+$", "")
    title = F.regexp_replace(F.trim("title"), r"\s*\|\s*(" + "|".join(map(re.escape, site_names)) + r")\s*$", "")
    e = e.select(link.alias("url"), title.alias("title"), tx.to_day(F.col("pubDate")).alias("published_at"),
                 F.trim(F.coalesce("description", F.lit(""))).alias("summary"), F.col("category").alias("tags"))
    if require_keywords:  # cheap gate before any page is joined
        e = e.where(tx.is_relevant(F.concat_ws("\n", "title", "summary")))
    if pages is not None:
        texts = extract.page_texts(pages, selectors=("article", "main")).select("url", "body", "description")
        e = e.join(texts, "url", "left")
    else:
        e = e.withColumns({"body": F.lit(""), "description": F.lit("")})
    if require_keywords:  # the gate on the whole entry, article text included
        e = e.where(tx.is_relevant(F.concat_ws("\n", "title", "summary", "body")))
    body, about = F.coalesce("body", F.lit("")), F.coalesce("description", F.lit(""))
    return to_items(e.select(
        F.when(F.col("url") != "", F.col("url")).otherwise(F.col("title")).alias("source_id"), "url", "title",
        "published_at", F.when(body != "", body).otherwise(F.col("summary")).alias("text"),
        F.when(about != "", about).otherwise(F.col("summary")).alias("hint"), "tags",
        F.lit(True).alias("needs_enrichment")), source, since)


PRESS = ("results array<struct<uuid: string, url: string, date: string, title: string, body: string, teaser: string, "
         "number: string, component: array<struct<name: string>>>>")


@F.udf(T.StringType(), useArrow=False)
def unescaped(value: str | None) -> str:
    return unescape(value or "").strip()


def press_json(spark: SparkSession, path: str, since=None, source="doj") -> DataFrame:
    """Paged dump of press releases with HTML bodies; strict words and the general gate must both hit."""
    r = spark.read.schema(PRESS).json(path).select(F.explode("results").alias("r")).select("r.*")
    r = r.withColumn("published_at", tx.to_day(F.col("date")))
    if since:  # before the bodies are parsed
        r = r.where(F.col("published_at") >= F.lit(since).cast("date"))
    r = r.withColumns({"title": unescaped("title"), "teaser": unescaped("teaser"), "body": extract.fragment_text("body")})
    blob = F.concat_ws("\n", "title", "teaser", "body")
    kept = r.where(tx.has_keyword(blob, fixed.PRESS_KEYWORDS) & tx.is_relevant(blob))
    return to_items(kept.select(
        F.coalesce("uuid", "url").alias("source_id"), "url", "title", "published_at", F.col("body").alias("text"),
        F.col("teaser").alias("hint"), F.transform("component", lambda c: c["name"]).alias("tags"),
        F.lit(True).alias("needs_enrichment")), source, since)


# --- sanctions -----------------------------------------------------------------------------------------------------
SDN_ENTRY = ("uid string, firstName string, lastName string, programList struct<program: array<string>>, "
             "idList struct<id: array<struct<idType: string, idNumber: string>>>")
MARK = "Digital Currency Address"


def currency_chain(code: Column, address: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in fixed.CURRENCY_CHAIN.items() for x in kv])
    chain = F.coalesce(F.try_element_at(table, F.upper(code)), F.upper(code))
    return F.when(chain.isin("USDT", "USDC"), tx.infer_chain(address, chain)).otherwise(chain)


def sanctions_xml(spark: SparkSession, path: str) -> DataFrame:
    """(entity_uid, entity_name, programs, chain, address) of a full sanctions list."""
    e = xml_records(spark, path, "sdnEntry", SDN_ENTRY)
    rows = e.select(
        F.trim("uid").alias("entity_uid"),
        F.trim(F.concat_ws(" ", F.trim(F.coalesce("firstName", F.lit(""))), F.trim(F.coalesce("lastName", F.lit("")))))
        .alias("entity_name"), F.coalesce("programList.program", F.array().cast("array<string>")).alias("programs"),
        F.explode("idList.id").alias("i"))
    held = rows.where(F.col("i.idType").startswith(MARK) & (F.trim("i.idNumber") != ""))
    code, address = F.trim(F.regexp_replace("i.idType", "^[^-]*-", "")), F.trim("i.idNumber")
    return held.select("entity_uid", "entity_name", "programs", currency_chain(code, address).alias("chain"),
                       address.alias("address"))


def notice_addresses(texts: DataFrame) -> DataFrame:
    """texts(source_id, text) -> (source_id, line, entity, programs, chain, address).

    One entity per line; of an amended entry 'OLD -to- NEW' only NEW counts and the name is marked.
    """
    lines = texts.select("source_id", F.posexplode(F.split("text", "\n")).alias("line", "s")).where(
        F.contains("s", F.lit(MARK)))
    amended = F.contains("s", F.lit(" -to- "))
    new = F.when(amended, F.regexp_replace("s", r"^(?s).*?( -to- )", "")).otherwise(F.col("s"))
    lines = lines.withColumns({"amended": amended, "s": new})
    head = F.split("s", r"\s\(|;", 2)[0]
    parts = F.transform(F.split(head, ","), lambda p: F.trim(p))
    name = F.when(F.size(parts) > 2, F.array_join(F.slice(parts, 1, 2), ", ")).otherwise(F.trim(head))
    name = F.substring(F.regexp_replace(name, "^[ ,]+|[ ,]+$", ""), 1, 80)
    pattern = MARK + r"\s*-\s*([A-Z0-9]+)\s+([A-Za-z0-9]+)"
    pairs = F.arrays_zip(F.regexp_extract_all("s", F.lit(pattern), F.lit(1)).alias("code"),
                         F.regexp_extract_all("s", F.lit(pattern), F.lit(2)).alias("address"))
    out = lines.select(
        "source_id", F.col("line").cast("bigint").alias("line"),
        F.concat(name, F.when(F.col("amended"), " (amended)").otherwise("")).alias("entity"),
        F.array_sort(F.array_distinct(F.regexp_extract_all("s", F.lit(r"\[([A-Z0-9\-]+)\]"), F.lit(1)))).alias("programs"),
        F.explode(pairs).alias("p"))
    return out.select("source_id", "line", "entity", "programs", currency_chain(F.col("p.code"), F.col("p.address"))
                      .alias("chain"), F.col("p.address").alias("address"))


# --- catalogues ----------------------------------------------------------------------------------------------------
def catalog_blocks(files: DataFrame, since=None, source="defihacklabs") -> DataFrame:
    """files(content) -> items: blocks under '### YYYYMMDD name - technique' headings, plus code_path."""
    blocks = files.select(F.explode(F.split("content", r"(?m)(?=^### \d{8} )")).alias("b"))
    head = r"^### (\d{8}) (.+?) - (.+)"
    blocks = blocks.where(F.col("b").rlike(r"^### \d{8} .+? - .+")).select(
        "b", *[F.trim(F.regexp_extract("b", head, i)).alias(n) for i, n in ((1, "ymd"), (2, "name"), (3, "tech"))],
        F.trim(F.regexp_extract("b", r"(?m)^### Lost:\s*(.+)$", 1)).alias("lost"),
        F.regexp_extract("b", r"\]\((?:\.\./)*(src/test/[^)]+\.sol)\)", 1).alias("code_path"))
    day = F.try_to_timestamp("ymd", F.lit("yyyyMMdd")).cast("date")
    items = blocks.select(
        F.concat_ws("|", "ymd", "name").alias("source_id"), F.col("code_path").alias("url"),
        F.concat_ws(" — ", "name", "tech").alias("title"), day.alias("published_at"),
        F.concat(F.col("name"), F.lit(" — "), "tech", F.lit("\nLost: "), "lost").alias("text"),
        F.concat(F.col("tech"), F.lit(". Lost: "), "lost").alias("hint"), F.col("name").alias("s_name"),
        day.alias("s_date"), tx.loss_amount(F.col("lost")).alias("s_amount"), F.col("lost").alias("s_amount_text"),
        F.lit("hack_exploit").alias("s_type"), F.col("tech").alias("s_method"), F.array(F.lit(source)).alias("tags"),
        F.lit(True).alias("needs_enrichment"))
    return to_items(items, source, since)


def catalog_sections(spark: SparkSession, path: str) -> DataFrame:
    """(content) of each dated section of catalogue files, however long a file is.

    Files are read by lines, in as many splits as their sizes ask for. A line's section is the number of dated headings
    up to it in its file, a running count over ranges of lines; only the lines of one section meet in a task.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"), "value", F.col("value").rlike(r"^### \d{8} ").cast("int").alias("head"))
    held = running_sum(lines, ["file"], ["start", "line"], "head", "section").where("section > 0")
    own = F.array_sort(F.collect_list(F.struct("start", "line", "value")))
    return held.groupBy("file", "section").agg(F.array_join(F.transform(own, lambda x: x["value"]), "\n").alias("content")).select("content")


def markdown_catalog(spark: SparkSession, path: str, since=None) -> DataFrame:
    return catalog_blocks(catalog_sections(spark, path), since)


def code_headers(files: DataFrame) -> DataFrame:
    """files(path, content) -> (path, line, role, address, tx, chains): what leading comments of code files state."""
    lines = F.split("content", "\n")
    marks = F.transform(lines, lambda s: F.when(F.trim(s).rlike(r"^(//|/\*|\*|pragma)|^$"), "c").when(
        F.trim(s).startswith("import"), "i").otherwise("x"))
    text_marks = F.array_join(marks, "")
    length = F.length(F.regexp_extract(text_marks, "^(?:c[ci]*)?", 0))
    fork = F.create_map(*[F.lit(x) for kv in fixed.FORK_CHAIN.items() for x in kv])
    names = F.regexp_extract_all("content", F.lit(r'createSelectFork\(\s*"([A-Za-z0-9_-]+)"'), F.lit(1))
    by_fork = F.array_distinct(F.array_compact(F.transform(names, lambda n: F.try_element_at(fork, F.lower(n)))))
    domains = F.array(*[F.when(F.contains("content", F.lit(d)), F.lit(c)) for d, c in fixed.EXPLORER_CHAIN.items()])
    by_domain = F.array_distinct(F.array_compact(domains))
    chains = F.when(F.size(by_fork) > 0, by_fork).otherwise(by_domain)
    heads = files.select("path", chains.alias("chains"), F.slice(lines, F.lit(1), length).alias("lines"))
    each = heads.select("path", "chains", F.posexplode("lines").alias("line", "s"))
    low = F.lower("s")
    role = (
        F.when(F.contains(low, F.lit("attacker")) | F.contains(low, F.lit("exploiter")), "attacker")
        .when(F.contains(low, F.lit("victim")) | F.contains(low, F.lit("vulnerable")), "victim").otherwise("unknown"))
    return each.select(
        "path", "chains", F.col("line").cast("bigint").alias("line"), role.alias("role"),
        F.regexp_extract_all("s", F.lit(r"0x[a-fA-F0-9]{40}(?![a-fA-F0-9]{24})"), F.lit(0)).alias("addresses"),
        F.transform(F.regexp_extract_all("s", F.lit(r"0x[a-fA-F0-9]{64}"), F.lit(0)), lambda t: F.lower(t)).alias("txs"),
        F.trim(F.substring(F.regexp_replace(F.split("s", ":")[0], r"^\s*//\s*", ""), 1, 60)).alias("note"))


def header_addresses(headers: DataFrame) -> DataFrame:
    chain = F.coalesce(F.get("chains", F.lit(0)), F.lit("ETH"))
    return headers.select("path", "line", "role", "note", chain.alias("chain"), F.explode("addresses").alias("address"))


# --- pages ---------------------------------------------------------------------------------------------------------
def _per_page(pages: DataFrame, schema: str, rows_of: Callable[[hp.Element, str], list[tuple]]) -> DataFrame:
    """One pass over pages(url, html): each page yields rows, of the columns of schema after url.

    Pages go through a plain Python function, a hundred at a time: an Arrow batch holds ten thousand, with all their rows.
    """
    own = schema.removeprefix("url string, ")
    rows = F.udf(lambda html: rows_of(hp.parse(html), html or ""), f"array<struct<{own}>>", useArrow=False)
    return pages.select("url", F.explode(rows("html")).alias("_r")).select("url", "_r.*")


def _list_entries(root: hp.Element, _: str) -> list[tuple]:
    out = []
    for li in root.all("li"):
        time = li.first("span.time")
        if time:
            heading, link = li.first("h3"), li.first("p.link-reference")
            anchor = link.first("a") if link else None
            out.append((time.text(strip=True), heading.text(" ", strip=True) if heading else "",
                        [p.text(" ", strip=True) for p in li.all("p")], anchor.attrs.get("href", "") if anchor else ""))
    return out


def html_list(pages: DataFrame, since=None, source="slowmist") -> DataFrame:
    """Server-rendered list of incidents: date, target, description, loss, method, reference."""
    rows = _per_page(pages, "url string, time string, heading string, paragraphs array<string>, ref string", _list_entries)
    def first(pattern: str) -> Column:
        hits = F.filter(F.transform("paragraphs", lambda p: F.regexp_extract(p, pattern, 1)), lambda v: v != "")
        return F.trim(F.coalesce(F.get(hits, F.lit(-1) + F.size(hits)), F.lit("")))

    r = rows.select(
        tx.to_day(F.col("time")).alias("published_at"),
        F.when(F.col("heading") == "", "Unknown").otherwise(F.regexp_replace("heading", r"^Hacked target:\s*", "")).alias("name"),
        first(r"^Description of the event:\s*(.*)$").alias("about"),
        first(r"Amount of loss:\s*(.+?)(?:\s+Attack method:|$)").alias("loss"),
        first(r"Attack method:\s*(.+)$").alias("method"), "ref", F.col("url").alias("page"))
    return to_items(r.select(
        F.concat_ws("|", F.col("published_at").cast("string"), "name").alias("source_id"),
        F.when(F.col("ref") != "", F.col("ref")).otherwise(F.col("page")).alias("url"),
        F.when(F.col("method") != "", F.concat_ws(" — ", "name", "method")).otherwise(F.col("name")).alias("title"),
        "published_at", F.concat_ws("\n", "name", "loss", "method", "about").alias("text"), F.col("about").alias("hint"),
        F.col("name").alias("s_name"), F.col("published_at").alias("s_date"),
        tx.loss_amount(F.col("loss"), with_unit=False).alias("s_amount"), F.col("loss").alias("s_amount_text"),
        tx.type_by_rules(F.col("method"), fixed.LIST_TYPE_RULES, "hack_exploit").alias("s_type"),
        F.col("method").alias("s_method"), _present(F.col("method")).alias("tags"),
        F.lit(True).alias("needs_enrichment")), source, since)


def _messages(root: hp.Element, _: str) -> list[tuple]:
    out = []
    for wrap in root.all("div"):
        if "tgme_widget_message_wrap" not in (wrap.attrs.get("class") or "").split():
            continue
        post = next((n.attrs["data-post"] for n in wrap.walk() if "data-post" in n.attrs), "")
        time, body = wrap.first("time"), wrap.first(".tgme_widget_message_text")
        out.append((post.rsplit("/", 1)[-1], time.attrs.get("datetime", "") if time else "",
                    body.text("\n", strip=True) if body else ""))
    return out


def message_feed(pages: DataFrame, since=None, source="zachxbt") -> DataFrame:
    """Channel pages -> one item per message id that passes the keyword gate."""
    rows = _per_page(pages, "url string, mid string, time string, text string", _messages)
    r = rows.where(F.col("mid").rlike(r"^\d+$") & (F.col("text") != "")).where(
        tx.has_keyword(F.col("text"), fixed.MESSAGE_KEYWORDS))
    # pages overlap, so a message may be landed more than once
    r = r.groupBy("mid").agg(F.min(F.struct("url", "time", "text")).alias("m")).select("mid", "m.*")
    title = F.substring(F.regexp_replace(F.split("text", "\n")[0], r"\s+", " "), 1, 100)
    return to_items(r.select(
        F.col("mid").alias("source_id"), F.concat_ws("/", "url", "mid").alias("url"), title.alias("title"),
        tx.to_day(F.col("time")).alias("published_at"), "text", F.col("text").alias("hint"),
        F.array(F.lit("telegram")).alias("tags"), F.lit(True).alias("needs_enrichment")), source, since)


RANKED = ("props struct<pageProps: struct<leaderboard: array<struct<slug: string, title: string, date: string, "
          "excerpt: string, tags: array<string>, rekt: struct<date: string, amount: string, audit: string>>>>>")


def ranked_list(pages: DataFrame, since=None, source="rekt") -> DataFrame:
    """Leaderboard embedded as JSON in a page script."""
    script = F.regexp_extract("html", r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)
    rows = pages.select(F.from_json(script, RANKED).alias("j")).select(
        F.explode("j.props.pageProps.leaderboard").alias("r")).select("r.*")
    slug = F.concat(F.lit("/"), F.regexp_replace(F.coalesce("slug", F.lit("")), "^/+|/+$", ""))
    day = tx.leaderboard_day(F.col("rekt.date"))
    tags = F.filter(F.coalesce("tags", F.array().cast("array<string>")), lambda t: t != "")
    name = F.trim(F.coalesce(F.get(tags, F.lit(0)), F.split("title", r"\s+[-–]\s+")[0]))
    return to_items(rows.where(slug != "/").select(
        slug.alias("source_id"), slug.alias("url"), F.trim("title").alias("title"),
        F.when(day.isNotNull(), F.coalesce(tx.leaderboard_day(F.col("date")), day)).alias("published_at"),
        F.lit("").alias("text"), F.trim("excerpt").alias("hint"), name.alias("s_name"), day.alias("s_date"),
        F.nullif(F.col("rekt.amount").try_cast("double"), F.lit(0.0)).alias("s_amount"),
        F.lit("hack_exploit").alias("s_type"),
        F.array_sort(F.array_union(tags, F.array(F.lit(fixed.LEADERBOARD_TAG)))).alias("tags"),
        F.lit(False).alias("needs_enrichment")), source, since)


SUMMARIES = ("array<struct<name: string, slug: string, hackedAt: string, amount: double, category: struct<name: string>, "
             "category2: struct<name: string>, exploitedFund: struct<lastUpdatedAt: string, destinations: array<string>, "
             "links: array<struct<type: struct<slug: string>, value: string>>>>>")


def payload_array(html: str, name: str) -> str | None:
    """JSON array of a name inside the string chunks a page pushes to its client."""
    chunks = re.findall(r'self\.__next_f\.push\(\[1,("(?:[^"\\]|\\.)*")\]\)', html or "", re.S)
    blob = "".join(json.loads(c, strict=False) for c in chunks)
    at = blob.find(f'"{name}":')
    if at < 0:
        return None
    try:
        found, _ = json.JSONDecoder().raw_decode(blob, blob.index("[", at))
    except ValueError:
        return None
    return json.dumps(found)


@F.udf(T.StringType(), useArrow=False)
def project_payload(html: str | None) -> str | None:
    return payload_array(html, "projectSummaries")


def summary_rows(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode(F.from_json(project_payload("html"), SUMMARIES)).alias("r")).select("r.*")


def payload_list(pages: DataFrame, since=None, source="lumos") -> DataFrame:
    """Incident list pushed as payload chunks in page scripts."""
    r = summary_rows(pages)
    hacked, updated = tx.to_day(F.col("hackedAt")), tx.to_day(F.col("exploitedFund.lastUpdatedAt"))
    cat, cat2 = F.coalesce("category.name", F.lit("")), F.coalesce("category2.name", F.lit(""))
    low = F.lower(cat)
    kind = (
        F.when(F.contains(low, F.lit("rug")), "rug_pull")
        .when(F.contains(low, F.lit("key")) | F.contains(low, F.lit("hijack")), "private_key_compromise")
        .otherwise("hack_exploit"))
    out = r.select(
        F.coalesce("slug", "name").alias("source_id"), F.col("slug").alias("url"), F.concat_ws(" — ", "name", cat).alias("title"),
        F.coalesce(updated, hacked).alias("published_at"), F.greatest(hacked, updated).alias("newest"),
        F.lit("").alias("text"), F.col("name").alias("s_name"), hacked.alias("s_date"), F.col("amount").alias("s_amount"),
        kind.alias("s_type"), F.concat_ws(" / ", F.nullif(cat, F.lit("")), F.nullif(cat2, F.lit(""))).alias("s_method"),
        _present(cat, cat2).alias("tags"), F.lit(False).alias("needs_enrichment"))
    if since:
        out = out.where(F.col("newest") >= F.lit(since).cast("date"))
    return to_items(out, source)


def payload_links(pages: DataFrame) -> DataFrame:
    """(source_id, kind, role, value) stated by the payload list."""
    roles = F.create_map(*[F.lit(x) for kv in fixed.LINK_ROLES.items() for x in kv])
    links = summary_rows(pages).select(F.coalesce("slug", "name").alias("source_id"),
                                       F.explode("exploitedFund.links").alias("l"))
    slug, value = F.lower(F.coalesce("l.type.slug", F.lit(""))), F.trim(F.coalesce("l.value", F.lit("")))
    return links.where(value != "").select(
        "source_id", F.when(F.contains(slug, F.lit("tx")), "tx").otherwise("address").alias("kind"),
        F.coalesce(F.try_element_at(roles, slug), F.lit("unknown")).alias("role"), value.alias("value"))


def _article(drop: tuple[str, ...]) -> Callable[[hp.Element, str], list[tuple]]:
    def rows(root: hp.Element, html: str) -> list[tuple]:
        time = root.first("time")
        when = time.text(" ", strip=True) if time else ""
        if not when:
            found = re.search(r"[A-Z][a-z]+day, [A-Z][a-z]+ \d{1,2}, \d{4}", html)
            when = found.group(0) if found else hp.published(root)
        tags = sorted({a.text(" ", strip=True) for a in root.all("a") if a.attrs.get("href", "").startswith("/?tag=")})
        head = (hp.title(root), when, tags, hp.description(root))
        return [(*head, hp.page_text(root, ("article", "main"), drop))]
    return rows


def articles(pages: DataFrame, since=None, source="rekt", drop: tuple[str, ...] = (), title_prefix="") -> DataFrame:
    """Article pages -> items with title, date, tags, text and description."""
    rows = _per_page(pages, "url string, title string, time string, tags array<string>, about string, text string",
                     _article(drop))
    return to_items(rows.select(
        F.col("url").alias("source_id"), "url", F.trim(F.regexp_replace("title", "^" + re.escape(title_prefix), ""))
        .alias("title"), tx.to_day(F.col("time")).alias("published_at"), "text", F.col("about").alias("hint"), "tags",
        F.lit(True).alias("needs_enrichment")), source, since)


# --- lists ---------------------------------------------------------------------------------------------------------
def flat_addresses(values: DataFrame) -> DataFrame:
    """Distinct 0x addresses, lower case, among the strings of column a."""
    a = F.col("a")
    return values.where(a.startswith("0x") & (F.length(a) == 42)).select(F.lower(F.trim(a)).alias("address")).distinct()


def flat_list(spark: SparkSession, path: str, array_per_line: bool = False) -> DataFrame:
    """Addresses of landed JSON arrays of strings: one array per file, or one per line."""
    lists = spark.read.text(path, wholetext=not array_per_line)
    return flat_addresses(lists.select(F.explode(F.from_json("value", "array<string>")).alias("a")))


def blacklist_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """CSV files with differing column names -> one set of sources, categories and labels per address."""
    variants = {"sources": ["sources", "source"], "categories": ["categories", "category"],
                "labels": ["labels", "label", "entity_theme", "jurisdiction"]}
    merged = None
    for path in paths:  # a handful of configured files
        df = spark.read.option("header", True).csv(path)
        columns = [F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in names if c in df.columns], F.lit("")).alias(to)
                   for to, names in variants.items()]
        part = df.select(F.coalesce("address", F.lit("")).alias("address"), *columns)
        merged = part if merged is None else merged.unionByName(part)
    return matching.blacklist_index(merged)


def cards_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Cards restored from JSON Lines; malformed lines are skipped, unknown keys ignored."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
