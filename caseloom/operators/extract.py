"""Text jobs: pages to texts, texts to mentions, relevance tags, name keys, evidence and address formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom import fixed
from caseloom.functions import html as hp
from caseloom.functions import text as tx
from caseloom.functions.checksums import base58, bech32, eip55
from caseloom.session import cut_lineage, spread

# fixed values: address forms, each between non-alphanumeric neighbours
EDGE_L, EDGE_R = r"(?<![0-9a-zA-Z])", r"(?![0-9a-zA-Z])"
B58 = "[1-9A-HJ-NP-Za-km-z]"
ADDRESS_FORMS = [
    ("ETH", "evm", r"0x[a-fA-F0-9]{40}"),
    ("TRX", "trx", f"T{B58}{{33}}"),
    ("BTC", "btc", f"[13]{B58}{{25,34}}"),
    ("BTC", "bech32", r"(?i:bc1[qpzry9x8gf2tvdw0s3jn54khce6mua7l]{6,90})"),
    ("LTC", "ltc", f"[LM]{B58}{{26,33}}"),
    ("LTC", "bech32", r"(?i:ltc1[qpzry9x8gf2tvdw0s3jn54khce6mua7l]{6,90})"),
    ("XMR", "xmr", f"4[0-9AB]{B58}{{93}}"),
    ("SOL", "sol", f"{B58}{{32,44}}"),
]
TX_FORM = EDGE_L + r"0x[a-fA-F0-9]{64}" + EDGE_R
BARE_TX_FORM = EDGE_L + r"[a-fA-F0-9]{64}" + EDGE_R
# fixed values: version bytes of base58check families
VERSIONS = {"trx": [0x41], "btc": [0x00, 0x05], "ltc": [0x30, 0x32, 0x05]}

TEXT_SCHEMA = "url string, title string, published string, description string, body string"


def page_texts(pages: DataFrame, selectors: tuple[str, ...] = (), drop: tuple[str, ...] = ()) -> DataFrame:
    """pages(url, html) -> texts; one pass over each page inside its own partition, a hundred pages at a time in Python."""
    def read(html: str | None) -> tuple[str, str, str, str]:
        root = hp.parse(html)
        return hp.title(root), hp.published(root), hp.description(root), hp.page_text(root, selectors, drop)

    # an array of one keeps the function from being called for each column of its result
    texts = F.udf(lambda html: [read(html)], f"array<struct<{TEXT_SCHEMA.removeprefix('url string, ')}>>", useArrow=False)
    return pages.select("url", F.explode(texts("html")).alias("_t")).select("url", "_t.*")


@F.udf(T.StringType(), useArrow=False)
def fragment_text(html: str | None) -> str:
    return hp.fragment_text(html)


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(" + pattern + ")"), F.lit(1))


def address_candidates(texts: DataFrame, hints: Column | None = None) -> DataFrame:
    """(uid, form, chain, address, pos) of every address-like string, unchecked."""
    text = F.col("text")
    solana = F.contains(F.lower(text), F.lit("solana"))
    if hints is not None:
        solana = solana | F.exists(hints, lambda h: F.upper(h) == "SOL")
    def listed(rank: int, chain: str, form: str, hits: Column) -> Column:
        return F.transform(hits, lambda a, n: F.struct(
            F.lit(form).alias("form"), F.lit(chain).alias("chain"), a.alias("address"),
            (n + rank * 1_000_000).alias("pos")))

    forms = []
    for rank, (chain, form, pattern) in enumerate(ADDRESS_FORMS):
        hits = _found(text, EDGE_L + pattern + EDGE_R)
        if form == "sol":
            hits = F.when(solana, hits).otherwise(F.array().cast("array<string>"))
        forms.append(listed(rank, chain, form, hits))
    return texts.select("uid", F.explode(F.concat(*forms)).alias("c")).select("uid", "c.*")


def addresses(texts: DataFrame, hints: Column | None = None) -> DataFrame:
    """(uid, chain, address, pos): checked addresses, one per chain and canonical form.

    Forms without a checksum pass at once; base58 strings are decoded once per distinct string and joined back. What
    looks like an address is written, as it is read three times: texts are searched once.
    """
    found = cut_lineage(address_candidates(texts, hints), "candidates")
    plain = found.where(F.col("form").isin("evm", "bech32", "xmr")).select("uid", "chain", "address", "pos")
    coded = found.where(~F.col("form").isin("evm", "bech32", "xmr"))
    checked = coded.select("address").distinct().withColumn("b", base58(F.col("address")))
    good = F.lit(False)
    for form, versions in VERSIONS.items():
        good = good | ((F.col("form") == form) & F.col("b.ok") & F.col("b.version").isin(versions))
    a = F.col("address")
    mixed = a.rlike("[0-9]") & a.rlike("[A-Z]") & a.rlike("[a-z]")
    other = (a.startswith("T") & (F.length(a) == 34)) | (a.rlike("^[13LM]") & (F.col("b.size") == 25))
    good = good | ((F.col("form") == "sol") & mixed & ~other)
    kept = coded.join(checked, "address").where(good).select("uid", "chain", "address", "pos")
    first = F.min(F.struct("pos", "address")).alias("f")
    return plain.unionByName(kept).groupBy("uid", "chain", tx.hex_key(F.col("address")).alias("key")).agg(first).select(
        "uid", "chain", "f.address", "f.pos")


def tx_hashes(text: Column, bare: bool = False) -> Column:
    hits = _found(text, TX_FORM)
    if bare:
        hits = F.concat(hits, _found(text, BARE_TX_FORM))
    return F.array_distinct(F.transform(hits, lambda h: F.lower(h)))


# fixed value: a day written in a text, as year-month-day or as month name, day, year
DAY_FORM = r"(?:^|[^0-9A-Za-z-])([0-9]{4}-[0-9]{2}-[0-9]{2}|[A-Z][a-z]{2,8} [0-9]{1,2}, [0-9]{4})(?:[^0-9A-Za-z-]|$)"


def mentions(texts: DataFrame) -> DataFrame:
    """texts(uid, text) -> (uid, kind, value, norm, pos): addresses, transactions, money, chains, days.

    norm is the form a mention is compared by, one row each; value the first spelling and pos its place among the
    mentions of that kind, from 0.
    """
    texts = spread(texts)
    by_address = addresses(texts).select(
        "uid", F.lit("address").alias("kind"), F.concat(F.col("chain"), F.lit(":"), tx.hex_key(F.col("address"))).alias("norm"),
        F.struct((F.col("pos") % 1_000_000).cast("int").alias("pos"), F.col("address").alias("value")).alias("s"))

    def several(kind: str, values: Column, norm=None) -> Column:
        return F.transform(values, lambda v, i: F.struct(
            F.lit(kind).alias("kind"), (norm(v) if norm else v).cast("string").alias("norm"),
            F.struct(i.alias("pos"), v.cast("string").alias("value")).alias("s")))

    t = F.col("text")
    days = F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(DAY_FORM), F.lit(1))
    rest = texts.select("uid", F.explode(F.concat(
        several("tx", tx_hashes(t)), several("chain", tx.chain_mentions(t)),
        several("money", F.transform(tx.money_values(t), lambda v: v.cast("decimal(20,0)"))), several("date", days, tx.to_day),
    )).alias("m")).select("uid", "m.*").where("norm is not null")
    first = by_address.unionByName(rest).groupBy("uid", "kind", "norm").agg(F.min("s").alias("s"))
    return first.select("uid", "kind", "s.value", "norm", "s.pos")


def relevance(texts: DataFrame) -> DataFrame:
    """(uid, crypto_hit, crime_hit, relevant)."""
    blob = F.concat_ws("\n", "title", "hint", "text")
    subject = fixed.CRYPTO_KEYWORDS + fixed.CHAIN_KEYWORDS
    tagged = spread(texts).select("uid", tx.first_keyword(blob, subject).alias("crypto_hit"),
                          tx.first_keyword(blob, fixed.CRIME_KEYWORDS).alias("crime_hit"))
    return tagged.withColumn("relevant", (F.col("crypto_hit") != "") & (F.col("crime_hit") != ""))


def name_keys(cards: DataFrame) -> DataFrame:
    """(uid, kind, value, rarity): the keys a card's name is compared by, and how many cards have each."""
    name = F.when(F.coalesce("project", F.lit("")) != "", F.col("project")).otherwise(F.col("title"))
    norm = tx.normalize_name(name)

    def several(kind: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    keys = F.concat(
        several("norm", F.array(norm)), several("group", F.array(tx.group_key(name))),
        several("word", tx.name_tokens(name)), several("trigram", tx.trigrams(norm)),
        several("url", F.array(tx.url_key(F.col("url")))))
    rows = cards.select("uid", F.explode(keys).alias("k")).select("uid", "k.*")
    return rows.join(rows.groupBy("kind", "value").agg(F.count("*").alias("rarity")), ["kind", "value"]).select("uid", "kind", "value", "rarity")


def address_formats(found: DataFrame) -> DataFrame:
    """address -> (family, valid, fixed, reason, chain) of each distinct address."""
    a = F.col("address")
    low = F.lower(a)
    hrp = F.regexp_extract(low, r"^([a-z]{2,10})1[0-9a-z]{30,80}$", 1)
    cosmos = F.create_map(*[F.lit(x) for kv in fixed.COSMOS_HRP.items() for x in kv])
    family = (
        F.when(a.rlike(r"^0x[0-9a-fA-F]{64}$"), "tx").when(a.rlike(r"^0x[0-9a-fA-F]{40}$"), "evm")
        .when(a.rlike(r"(?i)^bc1[0-9a-z]{25,87}$"), "btc_bech32").when(a.rlike(f"^[13]{B58}{{25,34}}$"), "btc")
        .when(a.rlike(f"^T{B58}{{33}}$"), "tron").when(hrp.isin(list(fixed.COSMOS_HRP)), "cosmos")
        .when(a.rlike(f"^[48][0-9AB]{B58}{{93}}$"), "xmr").when(a.rlike(f"^{B58}{{32,44}}$"), "sol").otherwise("other")
    )
    d = found.select(F.trim("address").alias("address")).distinct().withColumn("f", family)
    d = d.withColumns({
        "b58": base58(F.when(F.col("f").isin("btc", "tron", "sol"), a)),
        "b32": bech32(F.when(F.col("f").isin("btc_bech32", "cosmos"), low)),
        "sum": eip55(F.when(F.col("f") == "evm", low)),
    })
    f, body = F.col("f"), F.substring(a, 3, 64)
    one_case = (body == F.lower(body)) | (body == F.upper(body))
    valid = (
        F.when(f == "evm", True).when(f.isin("btc_bech32", "cosmos"), F.col("b32"))
        .when(f == "btc", F.col("b58.ok") & F.col("b58.version").isin(0, 5))
        .when(f == "tron", F.col("b58.ok") & (F.col("b58.version") == 0x41))
        .when(f == "sol", F.col("b58.size") == 32).when(f == "xmr", True).otherwise(False)
    )
    spelled = (
        F.when((f == "evm") & (body != F.lower(body)) & (one_case | (F.col("sum") != a)), low)
        .when(f.isin("btc_bech32", "cosmos") & F.col("b32") & (a != low), low)
    )
    reason = (
        F.when(f == "tx", "tx_hash").when((f == "evm") & ~one_case & (F.col("sum") != a), "eip55_mismatch")
        .when(f.isin("btc_bech32", "cosmos") & ~F.col("b32"), "bech32_checksum")
        .when(f.isin("btc", "tron") & ~valid, "base58_checksum").when((f == "sol") & ~valid, "base58_len")
        .when(f == "other", "unknown_format").otherwise("")
    )
    chain = (
        F.when(f.isin("btc", "btc_bech32"), "Bitcoin").when(f == "tron", "Tron").when(f == "cosmos", cosmos[hrp])
        .when(f == "xmr", "Monero").when(f == "sol", "Solana").otherwise("")
    )
    shown = F.when(f == "tx", "evm").when(f == "btc_bech32", "btc").otherwise(f)
    return d.select("address", shown.alias("family"), valid.alias("valid"), spelled.alias("fixed"),
                    reason.alias("reason"), chain.alias("chain"))


def field_evidence(patches: DataFrame, texts: DataFrame) -> DataFrame:
    """(uid, field, found): whether the text bears a proposed date, amount, type or project out.

    patches: (uid, p_date_evidence, p_amount, p_amount_evidence, p_type_evidence, p_project). A date or type needs its
    phrase in the text; an amount its phrase and the amount itself; a project most of its words, and to be a name.
    """
    j = patches.join(texts.select("uid", "text"), "uid", "left").withColumn("text", F.coalesce("text", F.lit("")))
    j = j.withColumns({"_plain": tx.plain_text(F.col("text")), "_low": F.lower("text")})  # forms of a text, made once
    j = j.withColumn("_bare", tx.bare_text(F.col("_plain")))
    text = F.col("text")

    def backed(column: str) -> Column:
        return tx.evidence_in_text(F.col(column), text, F.col("_plain"), F.col("_bare"))

    found = {
        "date": backed("p_date_evidence"),
        "amount": backed("p_amount_evidence") & tx.states_amount(text, F.col("p_amount")),
        "type": backed("p_type_evidence"),
        "project": tx.text_mentions(F.col("p_project"), text, F.col("_low")) & ~tx.is_generic_name(F.col("p_project")),
    }
    each = [F.struct(F.lit(k).alias("field"), F.coalesce(v, F.lit(False)).alias("found")) for k, v in found.items()]
    return j.select("uid", F.explode(F.array(*each)).alias("f")).select("uid", "f.*")


def evidence(patches: DataFrame, texts: DataFrame) -> DataFrame:
    """(uid, field, found): whether the phrase given for a field occurs in the text."""
    return patches.join(texts.select("uid", "text"), "uid", "left").select(
        "uid", "field", F.coalesce(tx.evidence_in_text(F.col("phrase"), F.col("text")), F.lit(False)).alias("found"))
