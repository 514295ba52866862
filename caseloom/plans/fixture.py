"""Incident tables derived from the given TPC-H-like tables.

The given tables hold no wallets, money or crime words, so each incident table is a chain of select lists over one
of them. The same text runs in Spark (selectExpr) and, for the result check, in DuckDB (nested selects).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from caseloom import fixed
from caseloom.session import spread


def pick(index: str, values: list[str | None]) -> str:
    """SQL case that returns the index-th literal."""
    arms = " ".join(
        f"when {i} then " + ("null" if v is None else "'" + v.replace("'", "''") + "'") for i, v in enumerate(values)
    )
    return f"case {index} {arms} end"


def compact(*items: str) -> str:
    """SQL array of the non-null ones of one or two scalars."""
    if len(items) == 1:
        return f"case when {items[0]} is null then $EMPTY else $ARRAY({items[0]}) end"
    a, b = items
    return (
        f"case when {a} is null and {b} is null then $EMPTY when {b} is null then $ARRAY({a}) "
        f"when {a} is null then $ARRAY({b}) else $ARRAY({a}, {b}) end"
    )


SOURCES = fixed.SOURCE_PRIORITY + ["rss:a", "other"]

CARDS = [
    [
        "o_orderkey as k", "cast(floor(o_custkey / 5.0) as bigint) as e", "cast(o_orderdate as date) as od",
        "o_totalprice as price",
    ],
    [
        "k", "e", "od", "price",
        "substr(md5(cast(e as $STR)), 1, 8) as h",
        "case when k % 7 = 0 then case when k % 21 = 0 then 'sanctions_designation' else 'law_enforcement_action' end "
        f"when k % 97 = 0 then 'other' else {pick('e % 6', fixed.ATTACK_TYPES)} end as incident_type",
        f"case when k % 49 = 0 then 'doj' else {pick('k % 13', SOURCES)} end as source",
        "case when k % 53 = 0 then null else od + cast(k % 9 as int) end as published_at",
        "cast(date_trunc('week', od + cast(k % 9 as int)) as date) as coll_day",
    ],
    [
        "k", "e", "od", "price", "h", "incident_type", "source", "published_at", "coll_day",
        "case when k % 41 = 0 then concat('e', substr(h, 1, 7), 'z') when k % 37 = 0 then concat('e', h, ' vault') "
        f"else concat('e', h, {pick('k % 4', ['', ' Finance', ' DAO', 'swap'])}) end as name0",
    ],
    [
        "k", "e", "incident_type", "source", "published_at", "coll_day", "name0",
        "substr(sha1(concat('src', cast(k % 13 as $STR), '|', cast(k as $STR))), 1, 16) as uid",
        "concat('https://news.example/', cast(k % 13 as $STR), '/', cast(cast(floor(k / 2.0) as bigint) as $STR), "
        "case when k % 4 = 0 then '?ref=x' when k % 4 = 1 then '/' else '' end) as url",
        "case when k % 49 = 0 then concat('Nationwide takedown of fraud network announced by office ', "
        "cast(k % 10 as $STR)) else concat(name0, ' ', "
        + pick("k % 6", [
            "exploit drains wallet funds", "loses funds in hack", "operator sentenced for crypto fraud",
            "indicted over token scheme", "update on stolen assets", "reports incident",
        ]) + ") end as title",
        "case when k % 31 = 0 or k % 49 = 0 then '' when k % 101 = 0 then 'Unknown' "
        "when k % 103 = 0 then 'scamsniffer' else name0 end as project",
        "case when k % 17 = 0 then null when k % 59 = 0 then od - 400 when k % 61 = 0 then od + 30 "
        "else od end as incident_date",
        "case when k % 23 = 0 or k % 49 = 0 then null when k % 71 = 0 then 0.0 "
        "when k % 3 = 0 then round(cast(price * 1000 as double), 2) "
        "else round(cast(1000.0 * (e % 900 + 1) * (1 + (k % 4) * 0.01) as double), 2) end as amount_usd",
        "case when k % 46 = 0 then '1,200 ETH' when k % 5 = 0 then concat('$', cast(e % 900 as $STR), 'K') "
        "else '' end as amount_text",
        pick("k % 6", ["eth", "BNB Chain", "trx", "multichain", "Base", None]) + " as chain1",
        pick("k % 10", ["Ethereum", "polygon", "ETH", None, None, None, None, None, None, "Zora"]) + " as chain2",
        "case when k % 3 = 0 then concat('Actor ', cast(e % 50 as $STR)) end as actor1",
        "case when k % 5 = 0 then concat('ACTOR ', cast(e % 50 as $STR)) end as actor2",
        "case when k % 29 = 0 then 'rekt_leaderboard' end as tag1",
        "case when k % 2 = 0 then concat('tag', cast(k % 3 as $STR)) end as tag2",
        "case when k % 50 < 2 then concat('0x', $SHA256(cast(cast(floor(k / 2.0) as bigint) as $STR))) end as tx1",
        "k % 5 <> 0 as enriched",
        "k % 11 <> 0 as relevant",
        "case when k % 8 = 0 then '' when k % 8 < 4 then concat(name0, ' 거래소에서 가상자산이 탈취되어 수사가 진행 중이다') "
        "else concat('DB: ', name0, ' (', cast(k as $STR), ') loss of funds, 손실') end as summary_ko",
        "case when k % 9 = 0 then '' else concat('Funds were taken from ', name0, ' by an unknown party.') end "
        "as summary_en",
        pick("k % 7", [
            "Oracle manipulation via flash loan", "Private key compromise", "", "Reentrancy", "unknown",
            "Phishing and social engineering", "Business logic flaw",
        ]) + " as attack_method",
    ],
    [
        "uid", "source", "cast(k as $STR) as source_id", "url", "title", "published_at", "coll_day", "relevant",
        "incident_type", "project", "incident_date", compact("chain1", "chain2") + " as chains", "amount_usd",
        "amount_text", compact("actor1", "actor2") + " as actors", compact("tag1", "tag2") + " as tags",
        compact("tx1") + " as tx_hashes", "enriched", "summary_ko", "summary_en", "attack_method",
        "case when k % 10 in (3, 6) then substr(sha1(concat('src', cast((k - 3) % 13 as $STR), '|', "
        "cast(k - 3 as $STR))), 1, 16) end as followup_uid",
        "k", "e",
    ],
]

UID_OF = (
    "substr(sha1(concat('src', cast({k} % 13 as $STR), '|', cast({k} as $STR))), 1, 16)"
)
HEX40 = "substr(concat(md5(concat('p', cast({p} as $STR))), md5(concat('q', cast({p} as $STR)))), 1, 40)"

CARD_ADDRESSES = [
    [
        UID_OF.format(k="l_orderkey") + " as uid",
        "l_orderkey as k",
        "cast(l_linenumber as bigint) as ord",
        "case when l_linenumber = 2 then concat('0x', upper(" + HEX40.format(p="l_partkey") + ")) "
        "else concat('0x', " + HEX40.format(p="l_partkey") + ") end as address",
        pick("l_suppkey % 4", ["ETH", "BSC", "eth", "TRX"]) + " as chain",
        pick("(l_linenumber + l_suppkey) % 5", fixed.ROLES) + " as role",
        "case when l_returnflag = 'N' then '' when l_partkey % 9 = 0 then 'attack tx' "
        "when l_partkey % 9 = 1 then 'exploit contract' else l_returnflag end as note",
        "l_linenumber as ln", "l_partkey as p", "l_suppkey as s",
    ],
]

#: Lists hold an address for every part; most are spelled from a number that no card uses, so that they match nothing.
BLACKLIST = [
    [
        "concat('0x', " + HEX40.format(p="(case when p_size % 7 = 0 then p_partkey else -p_partkey end)") + ") as address",
        "case when p_partkey % 3 = 0 then concat(p_brand, '|', p_type) else p_brand end as sources",
        "case when p_partkey % 2 = 0 then concat(p_type, '|scam') else p_type end as categories",
        "concat(p_name, '|', p_type) as labels",
        "case when p_partkey % 2 = 0 then 'ETH' else 'TRON' end as chain",
        "p_size as z",
    ],
]

SDN = [
    [
        "case when p_partkey % 3 = 0 then 'TRX' else 'ETH' end as chain",
        "concat('0x', " + HEX40.format(p="(case when p_partkey % 40 = 0 then p_partkey else -p_partkey end)") + ") as address",
        "cast(p_partkey as $STR) as entity_uid",
        "upper(p_name) as entity_name",
        "concat(p_brand, ',', p_type) as programs",
        "date '2024-01-01' + cast(p_partkey % 30 as int) as first_seen",
        "p_partkey as p",
    ],
]

LABELS = [
    [
        "concat('0x', " + HEX40.format(p="p_partkey") + ") as address",
        pick("p_size % 8", ["eoa", "contract", "contract", "unfunded", "invalid", "txhash", "system", "unknown"])
        + " as kind",
        "case when p_size % 8 in (1, 2) then "
        + pick("p_partkey % 10", fixed.INFRA_TYPES + ["contract"]) + " else '' end as ctype",
        "'evm' as family",
        "case when p_partkey % 4 = 0 then 'BSC' when p_partkey % 4 = 1 then 'Ethereum' else '' end as chain",
        "cast(p_size as bigint) as tx_count",
        "case when p_partkey % 7 = 0 then p_name else '' end as label",
        "p_partkey % 11 = 0 as scam",
        "p_partkey % 5 = 0 as verified",
        "case when p_size % 8 = 4 then 'bech32_checksum' else '' end as reason",
        "p_partkey % 13 = 0 as rpc_failed",
        "p_name as name",
        "p_partkey as p",
    ],
]

PROBES = [
    [
        "concat('0x', " + HEX40.format(p="p_partkey") + ") as address",
        "p_partkey as p",
        "p_size as z",
        pick("p_partkey % 11", fixed.PROBE_ORDER) + " as c1",
        pick("(p_partkey + 3) % 11", fixed.PROBE_ORDER) + " as c2",
        pick("(p_partkey + p_size) % 11", fixed.PROBE_ORDER) + " as hint",
    ],
]

ARTICLES = [
    [
        "doc_id as d", "text as body", "lang", "source as feed",
    ],
    [
        "d", "feed", "lang",
        "substr(sha1(concat('doc|', cast(d as $STR))), 1, 16) as uid",
        "case when d % 4 = 0 then body else concat(body, "
        + pick("d % 6", [
            " Attackers drained $12.5 million in Ethereum from the bridge; loss about US$ 3,400,000 on 2024-03-05.",
            " The exploit cost $320 M and 1.2 billion dollars of tokens on BNB Chain.",
            " A hacker stole USD 75,000 worth of crypto, $56.9BNB and $900k from wallet holders on Solana.",
            " 가상자산 해킹으로 $2,000,000 상당의 코인이 탈취되었다 (tron, polygon).",
            " Phishing attacks on wallets took $40 bn; the whether report definition stays plain.",
            " Court sentenced the scammer, seizing bitcoin and $15 thousand in stablecoins.",
        ])
        + ", ' Sent to 0x', " + HEX40.format(p="d")
        + ", ' and 0x', upper(" + HEX40.format(p="d + 1") + "), ' tx 0x', $SHA256(cast(d as $STR)), '.') end as text",
        "concat('Case ', cast(d as $STR), case when d % 3 = 0 then ' wallet theft' else ' notes' end) as title",
        "case when d % 5 = 0 then 'Hackers exploit exchange' else '' end as hint",
        "d % 2 = 0 as needs_enrichment",
    ],
]

RAW_EVENTS = [
    [
        "event_type as source", "cast(event_id as $STR) as source_id", "cast(ts as date) as published_at",
        "substr(sha1(concat(event_type, '|', cast(event_id as $STR))), 1, 16) as uid",
        "concat('event ', cast(event_id as $STR)) as title", "event_id as n", "user_id", "value",
    ],
]

TABLES: dict[str, tuple[str, list[list[str]], str | None]] = {
    "cards": ("orders", CARDS, None),
    "card_addresses": ("lineitem", CARD_ADDRESSES, None),
    "blacklist_rows": ("part", BLACKLIST, None),
    "sdn_snapshot": ("part", SDN, None),
    "address_labels": ("part", LABELS, None),
    "probe_base": ("part", PROBES, None),
    "articles": ("documents", ARTICLES, None),
    "raw_events": ("events", RAW_EVENTS, None),
}

SPARK_TOKENS = {
    "$STR": "string", "$EMPTY": "cast(array() as array<string>)", "$ARRAY": "array",
}
DUCK_TOKENS = {
    "$STR": "varchar", "$EMPTY": "cast([] as varchar[])", "$ARRAY": "list_value",
}


def misspelt(rows: str) -> str:
    """The address of a part, for the given rows spelled from a number that no card uses, so that it meets nothing."""
    return f"case when {rows} then concat('0x', {HEX40.format(p='-p')}) else address end"


def spark_text(sql: str) -> str:
    for token, text in SPARK_TOKENS.items():
        sql = sql.replace(token, text)
    return _sha(sql, lambda arg: f"sha2({arg}, 256)")


def duck_text(sql: str) -> str:
    for token, text in DUCK_TOKENS.items():
        sql = sql.replace(token, text)
    return _sha(sql, lambda arg: f"sha256({arg})")


def _sha(sql: str, render) -> str:
    while (start := sql.find("$SHA256(")) >= 0:
        depth, pos = 1, start + len("$SHA256(")
        begin = pos
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[pos], 0)
            pos += 1
        sql = sql[:start] + render(sql[begin:pos - 1]) + sql[pos:]
    return sql


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An incident table as a Spark DataFrame; Catalyst collapses the select chain and prunes the scan."""
    table, stages, where = TABLES[name]
    df = spread(read(spark, sf_dir, table))
    for stage in stages:
        df = df.selectExpr(*[spark_text(item) for item in stage])
    return df.where(where) if where else df


def duck_cte(name: str) -> str:
    """The same table as a DuckDB common table expression body."""
    table, stages, where = TABLES[name]
    sql = table
    for depth, stage in enumerate(stages):
        items = ", ".join(duck_text(item) for item in stage)
        sql = f"select {items} from {sql if depth == 0 else '(' + sql + ')'}"
    return f"select * from ({sql}) where {where}" if where else sql


def names_in(sql: str) -> set[str]:
    return set(re.findall(r"[a-z_][a-z_0-9]*", sql))
