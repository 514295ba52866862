"""Readers by name; feeds and press dumps on hand-made rows; a long catalogue in many splits."""

import datetime as dt
import json
import re

import pytest

from caseloom.sources import readers, registry

FEED = """<?xml version="1.0"?><rss><channel><title>news</title>
<item><title>Wallet hack drains bitcoin | TRM Labs</title><link>https://n.example/a?utm_source=x&amp;ref=y</link>
<pubDate>Tue, 05 Mar 2024 10:00:00 GMT</pubDate><description> A crypto exchange was hacked </description><category>one</category><category>two</category></item>
<item><title>Gardening tips</title><link>https://n.example/b</link><pubDate>Tue, 05 Mar 2024 10:00:00 GMT</pubDate><description>Roses</description></item>
<item><title>Old bitcoin theft</title><link>https://n.example/c?id=7&amp;source=z</link><pubDate>Mon, 02 Jan 2023 10:00:00 GMT</pubDate><description>stolen crypto</description></item>
<item><title>Bitcoin exploit without a page</title><link></link><pubDate>2024-04-01</pubDate></item>
</channel></rss>"""
PRESS = [{"results": [
    {"uuid": "r1", "url": "https://p.example/1", "date": "1709632800", "title": "Man sentenced &amp; fined for cryptocurrency fraud", "teaser": "<b>Bitcoin</b> scheme",
     "body": "<p>A man was sentenced for laundering bitcoin stolen in a hack.</p><ul><li>prison</li></ul>", "number": "24-1", "component": [{"name": "USAO"}, {"name": "CRM"}]},
    {"uuid": None, "url": "https://p.example/2", "date": "1709632800", "title": "Cryptocurrency exchange founder indicted for bitcoin theft", "teaser": "", "body": "<p>He stole bitcoin.</p>",
     "number": "24-2", "component": []},
    {"uuid": "r3", "url": "https://p.example/3", "date": "1709632800", "title": "Road works", "teaser": "", "body": "<p>A road.</p>", "number": "24-3", "component": []}]}]


def test_feed_entries_by_name(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(FEED, encoding="utf-8")
    pages = spark.createDataFrame([("https://n.example/a", "<html><body><article><p>The whole story of the wallet hack.</p></article></body></html>")], "url string, html string")
    got = {r.source_id: r for r in registry.read(spark, "rss", str(tmp_path), source="trm", since="2024-01-01", pages=pages).collect()}
    assert set(got) == {"https://n.example/a", "Bitcoin exploit without a page"}
    a = got["https://n.example/a"]
    assert (a.title, a.published_at, a.hint, a.tags) == ("Wallet hack drains bitcoin", dt.date(2024, 3, 5), "A crypto exchange was hacked", ["one", "two"])
    assert a.text == "The whole story of the wallet hack." and a.source == "trm" and a.needs_enrichment
    every = registry.read(spark, "rss", str(tmp_path), source="trm", require_keywords=False).collect()
    assert {r.source_id for r in every} == {"https://n.example/a", "https://n.example/b", "https://n.example/c?id=7", "Bitcoin exploit without a page"}


def test_a_feed_passes_both_gates(spark, tmp_path):
    """The gate holds on title and summary before pages are joined, and again with the article's text."""
    (tmp_path / "feed.xml").write_text(FEED, encoding="utf-8")
    pages = spark.createDataFrame([("https://n.example/a", "<html><body><article><p>The whole story.</p></article></body></html>")], "url string, html string")

    def gates(**options):
        plan = registry.read(spark, "rss", str(tmp_path), source="trm", pages=pages, **options)._jdf.queryExecution().analyzed().toString()
        return re.findall(r"Filter \(RLIKE\(coalesce\(concat_ws\(\n, ([^)]*)\)", plan)

    assert [re.sub(r"#\d+", "", columns) for columns in gates()] == ["title, summary, body", "title, summary"]
    assert not gates(require_keywords=False)


def test_press_releases_by_name(spark, tmp_path):
    (tmp_path / "press.json").write_text("\n".join(json.dumps(p) for p in PRESS), encoding="utf-8")
    got = {r.source_id: r for r in registry.read(spark, "press_json", str(tmp_path)).collect()}
    assert set(got) == {"r1", "https://p.example/2"}
    r = got["r1"]
    assert r.title == "Man sentenced & fined for cryptocurrency fraud" and r.published_at == dt.date(2024, 3, 5) and r.tags == ["USAO", "CRM"]
    assert "laundering bitcoin" in r.text and "<p>" not in r.text and r.source == "doj"
    assert registry.read(spark, "press_json", str(tmp_path), since="2024-03-06").count() == 0


def test_a_long_catalogue_is_read_by_many_tasks(spark, tmp_path):
    sections = [f"### 2024{1 + i % 12:02d}{1 + i % 28:02d} Name {i} - Reentrancy\n### Lost: ${i}K and more\n" + "some line of text\n" * (i % 40)
                + f"[poc](../../src/test/f{i}.sol)\n\n" for i in range(3000)]
    (tmp_path / "catalogue.md").write_text("# Catalogue\n\nintroduction\n" + "".join(sections), encoding="utf-8")
    (tmp_path / "other.md").write_text(sections[0].replace("Name 0", "Another") + "### Lost: nothing", encoding="utf-8")
    whole = readers.catalog_blocks(spark.read.text(str(tmp_path), wholetext=True).withColumnRenamed("value", "content"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        assert spark.read.text(str(tmp_path / "catalogue.md")).rdd.getNumPartitions() >= 8
        items = registry.read(spark, "markdown_catalog", str(tmp_path))
        assert sorted(map(str, items.collect())) == sorted(map(str, whole.collect())) and items.count() == 3001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_configured_sources_and_unknown_names(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "feed.xml").write_text(FEED, encoding="utf-8")
    (tmp_path / "list").mkdir()
    (tmp_path / "list" / "a.md").write_text("### 20240105 Orbit - Oracle\n### Lost: $5K\n", encoding="utf-8")
    items, errors = registry.collect_items(spark, [
        ("rss", str(tmp_path / "feed"), {"source": "trm"}), ("markdown_catalog", str(tmp_path / "list"), {}), ("html_list", str(tmp_path / "absent"), {}),
        ("no_such_reader", str(tmp_path), {})])
    assert {r.source for r in items.collect()} == {"trm", "defihacklabs"}
    assert len(errors) == 2 and any("no reader" in e for e in errors.values())
    assert len(registry.READERS) == 16
    with pytest.raises(ValueError):
        registry.read(spark, "nothing", "x")


def test_a_worker_holds_few_pages_and_their_rows(spark):
    """Two thousand pages of fifty rows with 2 KB each: the rows of all pages would take 200 MB of a worker."""
    def resident(_, html):
        with open("/proc/self/statm") as f:
            held = int(f.read().split()[1]) * 4096 / 1e6
        return [(held, html[3:4] * 2000 + str(i)) for i in range(50)]

    pages = spark.range(0, 2000, 1, 1).selectExpr("cast(id as string) as url", "concat('<p>', id, '</p>') as html")
    rows = readers._per_page(pages, "url string, mb double, text string", resident)
    got = rows.selectExpr("count(*) as n", "count(distinct url) as pages", "max(mb) - min(mb) as grown").first()
    assert (got.n, got.pages) == (100_000, 2000) and got.grown < 60


def entry_of(i, note=""):
    return (f"  <sdnEntry kind='x'>\n <uid> {i} </uid><lastName>A &amp; B {i} é</lastName>{note}<programList><program>P{i % 3}</program><program>Q</program></programList>\n"
            f"<idList><id><idType>Digital Currency Address - ETH</idType><idNumber>0x{i:040x}</idNumber></id><id><idType>Passport</idType><idNumber>1</idNumber></id></idList></sdnEntry>\n")


def test_a_long_sanctions_list_is_read_by_many_tasks(spark, tmp_path):
    """One file: a task read it whole before."""
    (tmp_path / "sdn.xml").write_text("<?xml version=\"1.0\"?>\n<sdnList xmlns='http://x'><head><n>1</n></head>\n" + "".join(
        entry_of(i, "<!-- note --><remarks><![CDATA[a < b]]></remarks>" if i % 7 == 0 else "") for i in range(4000)) + "</sdnList>\n", encoding="utf-8")
    whole = spark.read.schema(readers.SDN_ENTRY).option("rowTag", "sdnEntry").format("xml").load(str(tmp_path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        found = readers.xml_records(spark, str(tmp_path), "sdnEntry", readers.SDN_ENTRY)
        assert found.rdd.getNumPartitions() >= 8
        assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect())) and found.count() == 4000
        assert readers.sanctions_xml(spark, str(tmp_path)).count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_tags_that_are_no_elements(spark, tmp_path):
    odd = ["<!-- <sdnEntry><uid>91</uid></sdnEntry> -->", "<!-- </sdnEntry> -->", "<note><![CDATA[<sdnEntry> ]]></note>", "<sdnEntry/>", "<sdnEntry id='1' />",
           "<sdnEntry><uid>92</uid></sdnEntry >", "<!-- <sdnEntry> -->", "<sdnEntryOther><uid>93</uid></sdnEntryOther>"]
    for n, text in enumerate([*odd, ""]):
        (tmp_path / f"{n}.xml").write_text(f"<sdnList>{entry_of(2 * n)}{text}{entry_of(2 * n + 1)}</sdnList>", encoding="utf-8")
    whole = spark.read.schema(readers.SDN_ENTRY).option("rowTag", "sdnEntry").format("xml").load(str(tmp_path))
    found = readers.xml_records(spark, str(tmp_path), "sdnEntry", readers.SDN_ENTRY)
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect())) and whole.count() >= 18
