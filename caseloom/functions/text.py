"""Column expressions over text: keywords, money, dates, chains, names, evidence."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom import fixed

# fixed values: money forms
MONEY = r"(?i)\$\s?([\d][\d,]*(?:\.\d+)?)\s*(billion|million|thousand|bn|mn|[bmk])?\b"
MONEY_WIDE = (
    r"(?i)(?:US\$|\$|USD\s?)\s?([\d][\d,]*(?:\.\d+)?)\s*(billion|million|thousand|bn|mn|[bmk])?\b"
    r"|([\d][\d,]*(?:\.\d+)?)\s*(billion|million)\s+(?:US\s?)?dollars"
)
MONEY_LOOSE = r"(?i)\$?\s?(\d[\d,]*(?:\.\d+)?)\s*(K|M|B|million|billion|thousand)?\b"
LOSS = r"\$\s*([\d,]+(?:\.\d+)?)\s*(?:([KkMmBb])(?![A-Za-z]))?"
UNITS = {"b": 1e9, "bn": 1e9, "billion": 1e9, "m": 1e6, "mn": 1e6, "million": 1e6, "k": 1e3, "thousand": 1e3}

# fixed values: free date forms tried in turn, after a leading weekday is dropped
DATE_FORMATS = [
    "yyyy/M/d", "M/d/yyyy", "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy", "MMMM d, yyyy",
    "MMM d, yyyy", "d MMMM yyyy", "yyyyMMdd",
]


def keyword_pattern(words: list[str]) -> str:
    """One pattern for a keyword list: whole words with common endings; a trailing * matches any ending."""
    clean_words = [w.strip().lower() for w in words if w.strip()]
    whole = [re.escape(w) for w in clean_words if not w.endswith("*")]
    open_ended = [re.escape(w[:-1]) for w in clean_words if w.endswith("*")]
    # one leading boundary for all, so most positions of a text are left after one test
    parts = ["(?:" + "|".join(whole) + r")(?:s|es|ed|ing|er|ers)?\b"] if whole else []
    return r"(?iU)\b(?:" + "|".join(parts + open_ended) + ")" if clean_words else r"(?!x)x"


def _tree(words: list[str]) -> str:
    """A pattern of the words by their common beginnings, so that a place in a text is left after its first letters."""
    heads: dict[str, list[str]] = {}
    for w in dict.fromkeys(words):
        heads.setdefault(w[:1], []).append(w[1:])
    ends = heads.pop("", None)
    parts = [re.escape(head) + _tree(rest) for head, rest in heads.items()]
    if not parts:
        return ""
    return "(?:" + "|".join(parts) + ")" + ("?" if ends else "") if ends or len(parts) > 1 else parts[0]


def keyword_test(words: list[str]) -> str:
    """A pattern that finds something where keyword_pattern does, though not always the same keyword of several."""
    clean_words = [w.strip().lower() for w in words if w.strip()]
    whole = [w for w in clean_words if not w.endswith("*")]
    open_ended = [w[:-1] for w in clean_words if w.endswith("*")]
    if "" in open_ended:
        return keyword_pattern(words)
    open_ended = [w for w in open_ended if not any(w != v and w.startswith(v) for v in open_ended)]
    parts = ["(?:" + _tree(whole) + r")(?:s|es|ed|ing|er|ers)?\b"] if whole else []
    return r"(?iU)\b(?:" + "|".join(parts + ([_tree(open_ended)] if open_ended else [])) + ")" if clean_words else r"(?!x)x"


def has_keyword(text: Column, words: list[str]) -> Column:
    return F.coalesce(text, F.lit("")).rlike(keyword_test(words))


def first_keyword(text: Column, words: list[str]) -> Column:
    return F.regexp_extract(F.coalesce(text, F.lit("")), "(" + keyword_pattern(words) + ")", 1)


def is_relevant(text: Column, crypto=None, chains=None, crime=None) -> Column:
    """A crypto or chain word, and a crime word."""
    subject = (crypto or fixed.CRYPTO_KEYWORDS) + (chains or fixed.CHAIN_KEYWORDS)
    return has_keyword(text, subject) & has_keyword(text, crime or fixed.CRIME_KEYWORDS)


def _scaled(number: Column, unit: Column) -> Column:
    value = F.regexp_replace(number, ",", "").try_cast("double")
    low = F.lower(unit)
    factor = reduce(lambda acc, kv: F.when(low == kv[0], F.lit(kv[1])).otherwise(acc), UNITS.items(), F.lit(1.0))
    return value * factor


def _all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(group))


def _money(text: Column, pattern: str, number: int = 1, unit: int = 2) -> Column:
    return F.zip_with(_all(text, pattern, number), _all(text, pattern, unit), _scaled)


def max_amount(text: Column) -> Column:
    """The largest $ amount stated in the text."""
    return F.array_max(F.filter(_money(text, MONEY), lambda v: v.isNotNull()))


def money_values(text: Column) -> Column:
    """All money mentions of at least 100, also US$, USD and 'N million dollars'."""
    plain, words = _money(text, MONEY_WIDE, 1, 2), _money(text, MONEY_WIDE, 3, 4)
    return F.filter(F.zip_with(plain, words, lambda a, b: F.coalesce(a, b)), lambda v: v >= 100)


def states_amount(text: Column, amount: Column) -> Column:
    """Whether the text states this amount within 1.5%."""
    near = F.exists(_money(text, MONEY_LOOSE), lambda v: (v > 0) & (F.abs(v - amount) / amount <= 0.015))
    return F.coalesce((amount != 0) & near, F.lit(False))


def loss_amount(text: Column, with_unit: bool = True) -> Column:
    """The first $ amount; a unit letter counts only when no letter follows it."""
    pattern = LOSS if with_unit else r"\$\s*([\d,]+(?:\.\d+)?)()"
    text = F.coalesce(text, F.lit(""))
    return _scaled(F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2))


def close(a: Column, b: Column, tolerance: float) -> Column:
    return (a > 0) & (b > 0) & (F.abs(a - b) / F.greatest(a, b) <= tolerance)


def to_day(value: Column) -> Column:
    """Epoch seconds or milliseconds, ISO text or free date text as DATE; NULL when unreadable."""
    s = F.regexp_replace(F.trim(value.cast("string")), r"^\$D", "")
    free = F.regexp_replace(s, r"^[A-Za-z]+day,?\s+|^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun),\s*", "")
    tries = [
        F.when(s.rlike(r"^\d{10}$"), F.timestamp_seconds(s.try_cast("bigint")).cast("date")),
        F.when(s.rlike(r"^\d{13}$"), F.timestamp_millis(s.try_cast("bigint")).cast("date")),
        F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(s, 1, 10).try_cast("date")),
    ]
    tries += [F.try_to_timestamp(free, F.lit(fmt)).cast("date") for fmt in DATE_FORMATS]
    return F.coalesce(*tries)


def leaderboard_day(value: Column) -> Column:
    """M/D/YY or M/D/YYYY."""
    pattern = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})\s*$"
    m, d, y = (F.regexp_extract(value, pattern, i).try_cast("int") for i in (1, 2, 3))
    y = F.when(y < 100, y + 2000).otherwise(y)
    return F.when((y >= 2009) & (y <= 2100), F.try_make_timestamp(y, m, d, F.lit(0), F.lit(0), F.lit(0)).cast("date"))


def clean(text: Column) -> Column:
    """Odd blanks and hyphens made plain, '$320 M' -> '$320M', '300 ×' -> '300x', runs of blanks squeezed."""
    s = F.translate(text, "\u00a0\u202f\u2009\u2011\u2010\u2212", "   ---")
    s = F.regexp_replace(s, r"\$\s*(\d[\d,]*(?:\.\d+)?)\s*[Kk](?![A-Za-z])", r"\$$1K")
    s = F.regexp_replace(s, r"\$\s*(\d[\d,]*(?:\.\d+)?)\s*[Mm](?![A-Za-z])", r"\$$1M")
    s = F.regexp_replace(s, r"\$\s*(\d[\d,]*(?:\.\d+)?)\s*[Bb](?![A-Za-z])", r"\$$1B")
    s = F.regexp_replace(s, r"(\d)\s*×", "$1x")
    return F.trim(F.regexp_replace(s, r"[ \t]{2,}", " "))


def chain_mentions(text: Column, names: list[str] | None = None, limit: int = 3) -> Column:
    """Chain names found in the text, by first position."""
    words = [n.rstrip("*") for n in names or fixed.CHAIN_KEYWORDS]
    known = F.array(*[F.lit(w) for w in words if len(w) >= 3])

    def ranked(low: Column) -> Column:
        # a plain search first; the bounded pattern runs only for names that occur at all
        there = F.filter(known, lambda n: F.contains(low, F.lower(n)))
        placed = F.transform(there, lambda n: F.struct(F.regexp_instr(
            low, F.concat(F.lit(r"(?<![a-z0-9])\Q"), F.lower(n), F.lit(r"\E(?![a-z0-9])"))).alias("at"), n.alias("name")))
        found = F.array_sort(F.filter(placed, lambda h: h["at"] > 0))
        return F.slice(F.array_distinct(F.transform(found, lambda h: h["name"])), 1, limit)

    # the lower-case text is bound once
    return F.transform(F.array(F.lower(F.coalesce(text, F.lit("")))), ranked)[0]


# what is not a-z0-9가-힣 or a blank, and not a-z0-9가-힣, as ranges: a negated class takes ten times as long
UNNAMED = r"[\x00-\x1F!-/:-`{-\x{ABFF}\x{D7A4}-\x{10FFFF}]+"
UNKEYED = r"[\x00-/:-`{-\x{ABFF}\x{D7A4}-\x{10FFFF}]+"


def normalize_name(name: Column) -> Column:
    n = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"\(.*?\)", " ")
    words = F.split(F.regexp_replace(n, UNNAMED, " "), " +")
    joined = F.array_join(F.filter(words, lambda w: ~w.isin(fixed.NAME_STOP)), "")
    return F.regexp_replace(joined, "^(.{3,})(?:" + "|".join(fixed.NAME_SUFFIXES) + ")$", "$1")


def name_tokens(name: Column) -> Column:
    """Sorted distinct words of a name, without stop words and single letters."""
    words = F.split(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), UNNAMED, " "), " +")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(fixed.NAME_STOP))))


def trigrams(text: Column) -> Column:
    padded = F.concat(F.lit("  "), text, F.lit(" "))
    return F.array_distinct(
        F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(padded, i, F.lit(3)))
    )


def jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def group_key(name: Column) -> Column:
    s = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"\b(" + "|".join(fixed.GROUP_KEY_STOP) + r")\b", " ")
    return F.substring(F.regexp_replace(s, UNKEYED, ""), 1, 40)


def legal_words(*texts: Column) -> Column:
    """Distinctive Latin words of four letters or more."""
    blob = F.concat_ws(" \n", *texts)
    words = F.transform(_all(blob, r"[A-Za-z][A-Za-z0-9]{3,}", 0), lambda w: F.lower(w))
    return F.array_sort(F.array_except(words, F.array(*[F.lit(w) for w in fixed.LEGAL_STOP])))


def url_key(url: Column) -> Column:
    return F.regexp_replace(F.substring_index(F.coalesce(url, F.lit("")), "?", 1), "/+$", "")


UNQUOTED = r"[\x00-#&-+\-/:-`{-\x{ABFF}\x{D7A4}-\x{10FFFF}]+"  # not 0-9a-z가-힣$%.,; a negated class takes ten times as long


def plain_text(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " ")))


def bare_text(plain: Column) -> Column:
    return F.regexp_replace(plain, UNQUOTED, " ")


def evidence_in_text(evidence: Column, text: Column, plain: Column | None = None, bare: Column | None = None) -> Column:
    """Whether the evidence phrase (six characters or more) occurs in the text, punctuation aside.

    plain, bare: the text's forms, for a caller who asks several times of one text and has made them once.
    """
    ev = plain_text(evidence)
    tx = plain_text(text) if plain is None else plain
    return (F.length(ev) >= 6) & (F.contains(tx, ev) | F.contains(bare_text(tx) if bare is None else bare, F.trim(bare_text(ev))))


def _share_of_words(words: Column, low: Column) -> Column:
    hits = F.size(F.filter(words, lambda w: F.contains(low, F.lower(w))))
    return hits >= F.greatest(F.lit(1), F.floor(F.size(words) * 0.6).cast("int"))


def text_mentions(name: Column, text: Column, low: Column | None = None) -> Column:
    """Whether a text of 400 characters or more contains 60% of the name's words.

    low: the text in lower case, for a caller who has made it once; else it is made for every word.
    """
    long_enough = F.length(F.coalesce(text, F.lit(""))) >= 400
    return long_enough & name_in_text(name, text, low)


def name_in_text(name: Column, text: Column, low: Column | None = None) -> Column:
    words = _all(name, r"[A-Za-z0-9가-힣]{3,}", 0)
    return (F.size(words) == 0) | _share_of_words(words, F.lower(F.coalesce(text, F.lit(""))) if low is None else low)


def is_generic_name(name: Column) -> Column:
    n = F.trim(F.coalesce(name, F.lit("")))
    words = _all(n, "[A-Za-z]+", 0)
    last = F.lower(F.element_at(words, -1))
    return F.when(n == "", True).otherwise(
        (~n.rlike("[A-Z0-9가-힣]") & (F.size(words) >= 2))
        | (F.coalesce(last.isin(fixed.GENERIC_LAST_WORDS), F.lit(False)) & (F.size(words) <= 3))
    )


def method_label(text: Column) -> Column:
    """Up to two labels of an attack method phrase, by rule order."""
    t = F.lower(F.coalesce(text, F.lit("")))
    rules = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in fixed.METHOD_LABELS])
    labels = F.transform(F.filter(rules, lambda r: F.contains(t, r["k"])), lambda r: r["v"])
    joined = F.array_join(F.slice(F.array_distinct(labels), 1, 2), "·")
    return F.when(F.trim(t).isin("", "unknown", "n/a", "-"), F.lit("")).otherwise(joined)


def needs_hangul_summary(summary: Column) -> Column:
    s = F.trim(F.coalesce(summary, F.lit("")))
    body = F.regexp_replace(s, r"\s+", "")
    hangul = F.length(F.regexp_replace(body, "[^가-힣]", ""))
    return (F.length(s) < 25) | (hangul / F.greatest(F.lit(1), F.length(body)) < 0.2)


def severity_tier(amount: Column) -> Column:
    return (
        F.when(F.coalesce(amount, F.lit(0.0)) <= 0, "")
        .when(amount >= 1e8, "S").when(amount >= 1e7, "A").when(amount >= 1e6, "B").when(amount >= 1e5, "C")
        .otherwise("D")
    )


def alert_severity(incident_type: Column, amount: Column) -> Column:
    a = F.coalesce(amount, F.lit(0.0))
    return (
        F.when(incident_type == "sanctions_designation", "sanction")
        .when(incident_type == "law_enforcement_action", "legal")
        .when(a >= 1e7, "high").when(a >= 1e6, "medium").otherwise("low")
    )


def threat_level(loss: Column) -> Column:
    return (
        F.when(loss >= 5e8, 5).when(loss >= 1e8, 4).when(loss >= 1e7, 3).when(loss >= 1e6, 2).when(loss > 0, 1)
        .otherwise(0)
    )


def family(incident_type: Column) -> Column:
    return F.when(incident_type.isin(fixed.LEGAL_TYPES), "legal").otherwise("attack")


def days_apart(a: Column, b: Column) -> Column:
    return F.abs(F.datediff(a, b))


def is_stale(incident_date: Column, published_at: Column, incident_type: Column) -> Column:
    """An attack reported more than a year after it happened."""
    return F.coalesce(
        incident_type.isin(fixed.ATTACK_TYPES) & (F.datediff(published_at, incident_date) > fixed.STALE_DAYS),
        F.lit(False),
    )


def source_rank(source: Column) -> Column:
    """0 for the most trusted source; feeds and others come last."""
    ranks = F.create_map(*[F.lit(x) for i, s in enumerate(fixed.SOURCE_PRIORITY) for x in (s, i)])
    n = len(fixed.SOURCE_PRIORITY)
    return F.coalesce(ranks[source], F.when(source.startswith("rss:"), F.lit(n)).otherwise(F.lit(n + 1)))


def role_rank(role: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for i, r in enumerate(fixed.ROLES) for x in (r, i)])
    return F.coalesce(ranks[role], F.lit(9))


def chain_name(chain: Column, alias: dict[str, str] | None = None) -> Column:
    """Display name of a chain; '' when the word is not a chain."""
    table = F.create_map(*[F.lit(x) for kv in (alias or fixed.CHAIN_ALIAS).items() for x in kv])
    plain = F.trim(F.coalesce(chain, F.lit("")))
    return F.coalesce(F.try_element_at(table, F.lower(plain)), plain)


def chain_names(chains: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(chains, lambda c: chain_name(c)), lambda c: c != ""))


def union_ignore_case(*arrays: Column) -> Column:
    """Ordered union of arrays; the first spelling of a value stays."""
    start = F.array().cast("array<string>")
    return F.aggregate(F.concat(*arrays), start, lambda acc, x: F.when(
        (x == "") | F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.array_append(acc, x)))


def address_key(address: Column) -> Column:
    """Comparison form of an address: families without case in lower case."""
    a = F.trim(address)
    caseless = reduce(lambda x, y: x | y, [F.lower(a).startswith(p) for p in fixed.CASELESS_PREFIXES])
    return F.when(caseless, F.lower(a)).otherwise(a)


def hex_key(address: Column) -> Column:
    return F.when(address.startswith("0x"), F.lower(address)).otherwise(address)


def infer_chain(address: Column, hint: Column) -> Column:
    h, low, first = F.upper(F.coalesce(hint, F.lit(""))), F.lower(address), F.substring(address, 1, 1)
    return (
        F.when(address.startswith("0x") & (F.length(address) == 42),
               F.when(h.isin(fixed.EVM_HINTS), h).otherwise("ETH"))
        .when(address.startswith("T") & (F.length(address) == 34), "TRX")
        .when(low.startswith("bc1") | first.isin("1", "3"), "BTC")
        .when(low.startswith("ltc1") | first.isin("L", "M"), "LTC")
        .when(address.startswith("4") & (F.length(address) == 95), "XMR")
        .when(h != "", h).otherwise("UNKNOWN")
    )


def type_by_rules(text: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """Incident type by substring rules; the last matching rule wins."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = F.lit(default)
    for phrase, incident_type in rules:
        out = F.when(F.contains(low, F.lit(phrase)), incident_type).otherwise(out)
    return out
