"""Data quality: flags, evidence-gated patches, review verdicts, audit findings and address repair, as joins of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import fixed
from caseloom.functions import text as tx
from caseloom.session import spread

# fixed values: chains whose first letters count as a mention
SHORT_CHAINS = ["ethereum", "bsc", "bitcoin", "tron", "solana"]


def _flags(*pairs: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in pairs]))


def _known(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0.0)) != 0


def money_facts(texts: DataFrame, *key: str) -> DataFrame:
    """(key, has_text, money) of texts (key, text): what the flags read of a text, for texts that many cards share.

    A text is scanned once, here; the facts of a text in pieces are those of its pieces, `money` end to end.
    """
    text = F.coalesce("text", F.lit(""))
    return spread(texts.select(*key, "text")).select(*key, (text != "").alias("has_text"), tx.money_values(text).alias("money"))


def qa_flags(cards: DataFrame, texts: DataFrame, addresses: DataFrame) -> DataFrame:
    """Cards with their quality flags; texts: (uid, text) or, by money_facts, (uid, has_text, money); addresses: (uid, ...)."""
    held = addresses.select("uid", F.lit(True).alias("has_address")).distinct()
    facts = texts if "money" in texts.columns else money_facts(texts, "uid")
    facts = facts.select("uid", "has_text", F.col("money").alias("stated_money"))
    c = spread(cards.join(facts, "uid", "left").join(held, "uid", "left"))
    idt, pub, day, amount = F.col("incident_date"), F.col("published_at"), F.col("coll_day"), F.col("amount_usd")
    title, kind = F.coalesce("title", F.lit("")), F.col("incident_type")
    values = F.coalesce("stated_money", F.array().cast("array<double>"))
    stated = F.exists(values, lambda v: F.coalesce(tx.close(amount, v, fixed.AMOUNT_TOLERANCE), F.lit(False)))
    has_text, has_values = F.coalesce("has_text", F.lit(False)), F.size(values) > 0
    project = F.lower(F.trim(F.coalesce("project", F.lit(""))))
    plain_title = F.lower(F.trim(title))
    titled = (project == "") | (project == plain_title) | (F.length(project) > 50)
    blob = F.concat_ws(" ", title, "summary_ko", "summary_en", "attack_method", "chains", "tags")
    head = F.concat_ws(" ", title, F.coalesce("summary_en", F.lit("")))
    legal = kind.isin(fixed.LEGAL_TYPES)
    after_pub = F.coalesce(idt > pub, F.lit(False))
    flags = _flags(
        (tx.is_stale(idt, pub, kind), "stale_reference"), (idt.isNull(), "no_incident_date"),
        (after_pub, "date_after_published"), (~after_pub & (idt > day), "date_after_collected"),
        ((idt == day) & (pub < day) & (idt != pub), "date_is_collection_day"),
        (has_text & _known(amount) & (amount > fixed.HUGE_AMOUNT), "amount_huge"),
        (has_text & _known(amount) & has_values & ~stated, "amount_not_in_text"),
        (has_text & ~_known(amount) & has_values & (F.array_max(values) >= 1000) & (kind != "laundering_report"),
         "amount_missing_but_text_has_money"),
        ((F.size("chains") == 0) & kind.isin(fixed.ONCHAIN_ATTACK_TYPES), "no_chain"),
        (titled, "project_is_title"), (~titled & project.rlike(fixed.GENERIC_PROJECT), "project_generic"),
        (F.col("has_address").isNull() & ~blob.rlike(fixed.CRYPTO_WORDS), "relevance_suspect"),
        (~legal & title.rlike(fixed.LEGAL_WORDS) & ~title.rlike(fixed.ATTACK_WORDS), "type_maybe_legal"),
        (legal & title.rlike(fixed.ATTACK_WORDS) & ~head.rlike(fixed.LEGAL_WORDS), "type_maybe_attack"),
    )
    return c.withColumn("flags", flags).drop("has_text", "stated_money")


def flag_counts(flagged: DataFrame) -> DataFrame:
    """Cards per flag, with the days they fall on."""
    return flagged.select(F.explode("flags").alias("flag"), "coll_day").groupBy("flag", "coll_day").agg(
        F.count("*").alias("n")).groupBy("flag").agg(F.sum("n").alias("cards"), F.count("*").alias("days"))


def is_listing(url: Column) -> Column:
    return F.substring_index(F.coalesce(url, F.lit("")), "?", 1).rlike(fixed.LISTING_URL)


def apply_verified(cards: DataFrame, patches: DataFrame, texts: DataFrame) -> DataFrame:
    """Cards after proposed patches: a field changes only with evidence; changed and rejected list what happened.

    patches: (uid, p_date, p_date_evidence, p_amount, p_amount_text, p_amount_evidence, p_chains, p_project, p_type,
    p_type_evidence, p_relevant, p_notes).
    """
    c = cards.join(patches, "uid").join(texts.select("uid", "text"), "uid", "left")
    name = F.when(F.coalesce("project", F.lit("")) != "", F.col("project")).otherwise(F.col("title"))
    empty, text = F.lit(""), F.coalesce("text", F.lit(""))
    amount, pub, idt = F.col("amount_usd"), F.col("published_at"), F.col("incident_date")
    # every phrase is looked for once, in forms of the text made once
    c = c.withColumns({"_plain": tx.plain_text(text), "_low": F.lower(text)})
    c = c.withColumns({"ok_text": tx.text_mentions(name, text, F.col("_low")), "_bare": tx.bare_text(F.col("_plain"))})
    c = c.withColumn("_in_project", tx.name_in_text(F.col("p_project"), text, F.col("_low")))
    c = c.withColumns({f"_in_{p}": tx.evidence_in_text(F.col(f"p_{p}_evidence"), text, F.col("_plain"), F.col("_bare")) for p in ("date", "amount", "type")})
    ok = F.col("ok_text")
    notes = F.concat_ws(" ", F.coalesce("p_notes", empty), F.coalesce("p_amount_text", empty))
    offered = F.when(~ok & F.col("p_amount").isNull() & _known(amount), amount).otherwise(F.col("p_amount"))
    inflated = F.coalesce((offered >= fixed.HUGE_AMOUNT) | (offered.isNotNull() & notes.rlike(fixed.NOT_LOSS_WORDS)),
                          F.lit(False))
    c = c.withColumns({"inflated": inflated, "new_a": F.when(inflated, amount).otherwise(offered)})
    cleared = F.contains(F.coalesce("enrich_note", empty), F.lit("not a loss"))
    new_a = F.when(cleared, amount).otherwise(F.col("new_a"))

    def backed(column: str) -> Column:
        return F.col(column.replace("p_", "_in_").removesuffix("_evidence"))

    no = F.lit(False)
    new_d = F.col("p_date")
    date_new = new_d.isNotNull() & F.coalesce(new_d != idt, F.lit(True))
    late = F.coalesce(new_d > pub, no)
    date_set = date_new & ~late & backed("p_date_evidence")
    date_null = new_d.isNull() & (F.col("p_date_evidence") == "") & F.coalesce(idt > pub, no)

    evidence = F.coalesce("p_amount_evidence", empty)
    ev_values = tx.money_values(evidence)
    digits = F.regexp_replace(evidence, r"[^\d]", "")
    first4 = F.substring(F.round(new_a, 0).cast("decimal(24,0)").cast("string"), 1, 4)
    amount_new = F.coalesce(
        (new_a > 0) & ~tx.close(new_a, F.coalesce(amount, F.lit(0.0)), 0.001), no)
    agrees = F.exists(ev_values, lambda v: tx.close(new_a, v, fixed.AMOUNT_TOLERANCE)) | F.contains(digits, first4)
    amount_set = amount_new & backed("p_amount_evidence") & F.coalesce(agrees, no)
    amount_null = (
        ~amount_new & new_a.isNull() & _known(amount) & (F.coalesce("p_amount_text", empty) != "")
        & backed("p_amount_evidence") & (F.size(ev_values) == 0)
    )

    low_text = F.col("_low")
    asked = F.filter(F.transform(F.coalesce("p_chains", F.array().cast("array<string>")), lambda x: F.trim(x)),
                     lambda x: x != "")

    def lower_all(a: Column) -> Column:
        return F.transform(a, lambda x: F.lower(x))

    keep = F.filter(asked, lambda x: F.contains(low_text, F.lower(x)) | (
        F.lower(x).isin(SHORT_CHAINS) & F.contains(low_text, F.substring(F.lower(x), 1, 3))))
    chains_new = (F.size(asked) > 0) & (lower_all(asked) != lower_all(F.col("chains")))
    chains_set = chains_new & (F.size(keep) > 0) & (keep != F.col("chains"))

    new_p = F.trim(F.coalesce("p_project", empty))
    project_new = (
        (new_p != "") & (new_p != F.coalesce("project", empty)) & (F.length(new_p) <= 60)
        & (F.lower(new_p) != F.lower(F.trim(F.coalesce("title", empty)))) & ~tx.is_generic_name(new_p)
    )
    project_set = project_new & F.col("_in_project")

    new_t = F.when(ok, F.col("p_type")).otherwise(F.col("incident_type"))
    type_new = new_t.isin(fixed.INCIDENT_TYPES) & (new_t != F.col("incident_type"))
    type_set = type_new & backed("p_type_evidence")

    drop = ok & ~F.col("p_relevant") & F.col("relevant") & (F.coalesce("p_notes", empty) != "")
    drop_set = drop & ~text.rlike(fixed.CRYPTO_WORDS)

    changed = _flags(
        (date_set, "incident_date"), (date_null, "incident_date→null"), (amount_set, "amount_usd"),
        (amount_null, "amount_usd→null"), (chains_set, "chains"), (project_set, "project"),
        (type_set, "incident_type"), (drop_set, "relevant→false"))
    rejected = _flags(
        (~ok, "text"), (F.col("inflated"), "amount: volume"), (date_new & late, "date: after publication"),
        (date_new & ~late & ~backed("p_date_evidence"), "date: no evidence"),
        (amount_new & ~amount_set, "amount: evidence mismatch"),
        (chains_new & (F.size(keep) == 0), "chains: not in text"), (project_new & ~project_set, "project: not in text"),
        (type_new & ~type_set, "type: no evidence"), (drop & ~drop_set, "relevant: text mentions crypto"))
    new_text = F.when((amount_set & (F.coalesce("p_amount_text", empty) != "")) | amount_null,
                      F.substring("p_amount_text", 1, 80)).otherwise(F.col("amount_text"))
    return c.select(
        "uid", F.when(date_set, new_d).when(date_null, None).otherwise(idt).alias("incident_date"),
        F.when(amount_set, new_a).when(amount_null, None).otherwise(amount).alias("amount_usd"),
        new_text.alias("amount_text"), F.when(chains_set, F.slice(keep, 1, 5)).otherwise(F.col("chains")).alias("chains"),
        F.when(project_set, new_p).otherwise(F.col("project")).alias("project"),
        F.when(type_set, new_t).otherwise(F.col("incident_type")).alias("incident_type"),
        (F.col("relevant") & ~drop_set).alias("relevant"), changed.alias("changed"), rejected.alias("rejected"))


def apply_review(cards: DataFrame, verdicts: DataFrame, texts: DataFrame) -> DataFrame:
    """Cards after review verdicts; fixed rules override a verdict, and only sure exclusions count.

    verdicts: (uid, category, is_new, crypto_involved, crypto_core, amount_is_loss, confidence).
    """
    c = cards.join(verdicts, "uid").join(texts.select("uid", "text"), "uid", "left")
    blob = F.concat_ws(" ", "title", "summary_ko", "summary_en", "attack_method", "text")
    cat = F.col("category")
    stale = tx.is_stale(F.col("incident_date"), F.col("published_at"), F.col("incident_type"))
    general = ~F.col("crypto_involved") | (
        cat.isin("new_enforcement", "sanctions", "laundering_report") & ~blob.rlike(fixed.CRYPTO_WORDS))
    incidental = cat.isin("new_enforcement", "sanctions") & ~F.col("crypto_core")
    ruled = stale | general | incidental
    c = c.withColumns({
        "final": F.when(stale, "retrospective").when(general, "general_crime_no_crypto")
        .when(incidental, "crypto_incidental").otherwise(cat),
        "sure": F.when(ruled, F.greatest("confidence", F.lit(0.9))).otherwise(F.col("confidence")),
        "fresh": F.col("is_new") & ~ruled,
    })
    enough = F.col("sure") >= fixed.MIN_VERDICT_CONFIDENCE
    exclude = ~F.col("fresh") & enough & F.col("final").isin(fixed.EXCLUDE_CATEGORIES)
    stays = F.col("relevant") & ~exclude
    clear = ~F.col("amount_is_loss") & enough & _known(F.col("amount_usd")) & stays
    return c.select(
        "uid", F.col("final").alias("category"), F.col("sure").alias("confidence"), stays.alias("relevant"),
        (exclude & F.col("relevant")).alias("excluded"), (~F.col("fresh") & ~(
            enough & F.col("final").isin(fixed.EXCLUDE_CATEGORIES))).alias("low_confidence"), clear.alias("amount_cleared"),
        F.when(clear, None).otherwise(F.col("amount_usd")).alias("amount_usd"))


def restore_reviewed(cards: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Cards excluded earlier by a rule or verdict that a sure verdict re-admits."""
    again = cards.where(~F.col("relevant") & F.col("relevance_reason").rlike(fixed.REVIEWED_REASON))
    return again.join(verdicts, "uid").where(
        F.col("is_new") & (F.col("confidence") >= fixed.MIN_VERDICT_CONFIDENCE)).select("uid", "category")


def audit_changes(incidents: DataFrame, findings: DataFrame) -> DataFrame:
    """(uid, change, value): findings of a cross audit that pass their gates.

    findings: (kind, uid, s_amount, s_type, s_date, category, confidence, evidence).
    """
    f = findings.join(incidents.select("uid", "amount_usd", "incident_type", "incident_date", "published_at"), "uid")
    sure = F.col("confidence") >= fixed.MIN_AUDIT_CONFIDENCE
    kind, itype = F.col("kind"), F.col("incident_type")
    not_incident = (kind == "not_incident") & F.col("category").isin(fixed.EXCLUDE_CATEGORIES)
    amount = (
        (kind == "wrong_amount") & F.col("s_amount").isNull() & _known(F.col("amount_usd"))
        & ~itype.isin(fixed.LEGAL_TYPES) & tx.states_amount(F.col("evidence"), F.col("amount_usd")))
    wrong_type = (
        (kind == "wrong_type") & F.col("s_type").isin(fixed.INCIDENT_TYPES) & (F.col("s_type") != itype)
        & (itype == "hack_exploit") & (F.col("confidence") >= fixed.MIN_AUDIT_TYPE_CONFIDENCE))
    date = (
        (kind == "wrong_date") & F.col("s_date").isNotNull() & F.col("incident_date").isNull()
        & F.coalesce(F.col("s_date") <= F.col("published_at"), F.lit(True)))
    change = F.when(not_incident, "relevant→false").when(amount, "amount→null").when(wrong_type, "type").when(date, "date")
    value = F.when(not_incident, F.col("category")).when(wrong_type, F.col("s_type")).when(
        date, F.col("s_date").cast("string")).otherwise("")
    return f.where(sure & change.isNotNull()).select("uid", change.alias("change"), value.alias("value"))


def audit_duplicates(incidents: DataFrame, groups: DataFrame, links: DataFrame) -> DataFrame:
    """(uid_a, uid_b) decisions from sure duplicate groups whose members are not linked as follow-ups already.

    groups: (gid, uid, is_rep, confidence); links: (uid, orig_uid).
    """
    g = groups.where(F.col("confidence") >= fixed.MIN_AUDIT_CONFIDENCE).join(incidents.select("uid"), "uid", "left_semi")
    inside = g.join(links, "uid").join(
        g.select("gid", F.col("uid").alias("orig_uid")), ["gid", "orig_uid"]).select("gid").distinct()
    free = g.join(inside, "gid", "left_anti")
    rep = free.groupBy("gid").agg(
        F.coalesce(F.min(F.when(F.col("is_rep"), F.col("uid"))), F.min("uid")).alias("rep"), F.count("*").alias("n"))
    return free.join(rep.where("n >= 2"), "gid").where("uid <> rep").select(
        F.least("rep", "uid").alias("uid_a"), F.greatest("rep", "uid").alias("uid_b")).distinct()


def audit_listing(incidents: DataFrame, merged: DataFrame, days: int = 30) -> DataFrame:
    """Compact listing of the last days of incidents; merged: (rep_uid, source)."""
    last = incidents.select(F.max("coll_day")).scalar()
    recent = incidents.where(F.col("coll_day") >= F.date_sub(last, days))
    n = merged.join(recent.select(F.col("uid").alias("rep_uid")), "rep_uid", "left_semi").select(
        "rep_uid", "source").distinct().groupBy("rep_uid").agg(F.array_sort(F.collect_list("source")).alias("others"))
    name = F.when(F.coalesce("project", F.lit("")) != "", F.col("project")).otherwise(F.col("title"))
    summary = F.when(F.coalesce("summary_ko", F.lit("")) != "", F.col("summary_ko")).otherwise(F.col("summary_en"))
    return recent.join(n, recent.uid == n.rep_uid, "left").select(
        "uid", name.alias("project"), "incident_type", "incident_date", "published_at", "amount_usd",
        F.substring("amount_text", 1, 40).alias("amount_text"), F.slice("chains", 1, 3).alias("chains"),
        F.array_sort(F.array_union(F.array("source"), F.coalesce("others", F.array().cast("array<string>"))))
        .alias("sources"), F.substring(summary, 1, 160).alias("summary"))


def pick_chain(probes: DataFrame, hints: DataFrame) -> DataFrame:
    """(address, chain): the chain an address is active on; hinted chains first, then chains with code, then activity.

    probes: (address, chain, code, nonce, balance); hints: (address, chain, pos).
    """
    active = probes.where("code > 0 or nonce > 0 or balance > 0").join(hints, ["address", "chain"], "left")
    order = F.create_map(*[F.lit(x) for i, c in enumerate(fixed.PROBE_ORDER) for x in (c, i)])
    at = F.coalesce(order[F.col("chain")], F.lit(99))
    hinted, used = F.col("pos").isNotNull(), (F.col("code") > 0) | (F.col("nonce") > 0)
    level = F.when(hinted & used, 1).when(hinted, 2).when(F.col("code") > 0, 3).otherwise(4)
    place = F.when(hinted, F.col("pos")).when(F.col("code") > 0, at).otherwise(0)
    best = F.struct(level.alias("l"), place.alias("p"), (-F.col("nonce")).alias("n"), (-F.col("balance")).alias("b"),
                    at.alias("a"), "chain", "code", F.col("nonce").alias("tx_count"))
    return active.groupBy("address").agg(F.min(best).alias("s")).select("address", "s.chain", "s.code", "s.tx_count")


def code_size(code: Column) -> Column:
    """Bytes of contract code; the 23 bytes of a delegated account count as none."""
    n = F.floor((F.length(code) - 2) / 2).cast("bigint")
    hexed = F.lower(F.coalesce(code, F.lit("")))
    return F.when(~hexed.startswith("0x") | (F.length(hexed) <= 2), 0).when(delegate(code).isNotNull(), 0).otherwise(n)


def delegate(code: Column) -> Column:
    """Address an account delegates to, if any."""
    hexed = F.lower(F.coalesce(code, F.lit("")))
    is_delegated = hexed.startswith("0xef0100") & (F.floor((F.length(hexed) - 2) / 2) == 23)
    return F.when(is_delegated, F.concat(F.lit("0x"), F.substring(hexed, 9, 40)))


def address_kind(formats: DataFrame, chosen: DataFrame) -> DataFrame:
    """(address, kind, chain): from the address form, and for 0x addresses from the chosen chain.

    formats: (address, family, valid, reason, form_chain, probe_failed); chosen: (address, chain, code, tx_count).
    """
    low = F.lower("address")
    system = (low == fixed.ZERO_ADDRESS) | (low == fixed.BURN_ADDRESS) | low.rlike("^0x0{39}[1-9]$")
    j = formats.join(chosen, "address", "left")
    kind = (
        F.when(F.col("reason") == "tx_hash", "txhash").when((F.col("family") == "evm") & system, "system")
        .when(~F.col("valid"), "invalid").when(F.col("family") != "evm", "wallet")
        .when(F.col("chain").isNull(), F.when(F.col("probe_failed"), "unknown").otherwise("unfunded"))
        .when(F.col("code") > 0, "contract").otherwise("eoa")
    )
    return j.select("address", kind.alias("kind"), F.coalesce("chain", "form_chain", F.lit("")).alias("chain"),
                    F.coalesce("tx_count", F.lit(0)).cast("bigint").alias("tx_count"))


def _call(name: str) -> Column:
    return F.try_element_at("calls", F.lit(name))


def _word_address(name: Column) -> Column:
    """Address held in the first 32-byte word."""
    body = F.substring(name, 3, 64)
    return F.when(body.rlike("^0{24}[0-9a-fA-F]{40}$") & ~body.rlike("^0{64}$"),
                  F.concat(F.lit("0x"), F.lower(F.substring(body, 25, 40))))


def _word_nonzero(name: Column) -> Column:
    body = F.substring(name, 3, 64)
    return F.coalesce(body.rlike("^[0-9a-fA-F]{64}$") & ~body.rlike("^0{64}$"), F.lit(False))


def _word_small(name: Column) -> Column:
    """First word as a number when it fits 60 bits."""
    body = F.substring(name, 3, 64)
    return F.when(body.rlike("^0{49}[0-9a-fA-F]{15}$"), F.conv(body, 16, 10).cast("bigint"))


def _string(name: Column) -> Column:
    """ABI string, or a zero-padded 32-byte one."""
    body = F.substring(name, 3, 1_000_000)
    offset = F.conv(F.substring(body, 49, 16), 16, 10).cast("bigint") * 2
    size = F.conv(F.substring(body, (offset + 49).cast("int"), F.lit(16)), 16, 10).cast("bigint") * 2
    long = F.substring(body, (offset + 65).cast("int"), size.cast("int"))
    short = F.regexp_replace(body, "(00)+$", "")
    picked = F.when(F.length(body) == 64, short).otherwise(long)
    return F.coalesce(F.trim(F.try_to_binary(picked, F.lit("hex")).cast("string")), F.lit(""))


def contract_types(calls: DataFrame) -> DataFrame:
    """(address, ctype, symbol, impl) from call results: calls = map of call name to hex; impl_slot = storage word."""
    pool = _word_address(_call("token0")).isNotNull() & _word_address(_call("token1")).isNotNull()
    fee = _word_small(_call("fee"))
    symbol = _string(_call("symbol"))
    impl = F.coalesce(_word_address(F.col("impl_slot")), _word_address(_call("implementation")))
    owners = F.conv(F.substring(_call("getOwners"), 67 + 48, 16), 16, 10).cast("bigint")
    has_owners = F.coalesce((F.length(_call("getOwners")) >= 130) & (owners > 0), F.lit(False))
    ctype = (
        F.when(has_owners & _word_address(_call("token0")).isNull(), "safe")
        .when(pool, F.when((fee > 0) & (fee < 1_000_000), "v3_pool").otherwise("lp_pool"))
        .when(_word_nonzero(_call("getPoolId")), "balancer_pool")
        .when(_word_address(_call("UNDERLYING_ASSET_ADDRESS")).isNotNull(), "atoken")
        .when(_word_address(_call("asset")).isNotNull() & (symbol != ""), "vault")
        .when(_word_address(_call("underlying")).isNotNull() & (symbol != ""), "ctoken")
        .when(_word_address(_call("factory")).isNotNull() & _word_address(_call("WETH")).isNotNull(), "router")
        .when(_word_small(_call("supportsInterface721")) == 1, "nft")
        .when((symbol != "") & (_word_small(_call("decimals")) <= 36), "token")
        .when(impl.isNotNull(), "proxy").otherwise("contract")
    )
    return calls.select("address", ctype.alias("ctype"), F.substring(symbol, 1, 24).alias("symbol"), impl.alias("impl"))


def merge_explorer(labels: DataFrame, explorer: DataFrame) -> DataFrame:
    """Address labels with what an explorer says; names given by the explorer fill gaps only.

    explorer: (address, e_contract, e_name, e_token, e_token_name, e_impl, e_verified, e_scam, e_ens, e_tx).
    """
    j = labels.join(explorer, "address", "left")
    no = F.lit(False)
    gone = (
        (F.col("kind") == "eoa") & (F.coalesce("delegated", F.lit("")) == "") & F.coalesce("e_contract", no)
        & (F.coalesce("tx_count", F.lit(0)) >= 1))
    kind = F.when(gone, "contract").otherwise(F.col("kind"))
    is_contract = kind == "contract"

    def fill(column: str, other: Column, cut: int) -> Column:
        own = F.coalesce(column, F.lit(""))
        return F.when(is_contract & (own == ""), F.substring(F.coalesce(other, F.lit("")), 1, cut)).otherwise(own)

    e_name = F.when(F.coalesce("e_name", F.lit("")) != "", F.col("e_name")).otherwise(F.col("e_token_name"))
    delegated_impl = (F.coalesce("delegated", F.lit("")) != "") & (F.coalesce("e_impl", F.lit("")) != "")
    return j.select(
        "address", kind.alias("kind"), F.when(gone, "destroyed").otherwise(F.col("ctype")).alias("ctype"),
        F.when((kind == "eoa") & F.col("e_tx").isNotNull(), F.greatest(F.coalesce("tx_count", F.lit(0)), "e_tx"))
        .otherwise(F.col("tx_count")).alias("tx_count"),
        fill("name", e_name, 60).alias("name"), fill("symbol", F.col("e_token"), 24).alias("symbol"),
        F.when(delegated_impl, F.substring("e_impl", 1, 60)).otherwise(fill("impl_name", F.col("e_impl"), 60))
        .alias("impl_name"),
        F.coalesce("delegated", F.lit("")).alias("delegated"), F.coalesce("e_ens", F.lit("")).alias("ens"),
        (F.coalesce("scam", no) | F.coalesce("e_scam", no)).alias("scam"),
        (F.coalesce("verified", no) | F.coalesce("e_verified", no)).alias("verified"))


def display_label(entity: Column) -> Column:
    """One line for an address: entity, else contract name or symbol, else its implementation, else its name service."""
    empty = F.lit("")
    name, symbol, impl = (F.coalesce(c, empty) for c in ("name", "symbol", "impl_name"))
    named = F.substring(F.when(name != "", name).otherwise(symbol), 1, 40)
    contract = (
        F.when(F.col("ctype").isin("lp_pool", "v3_pool") & (symbol != ""), F.substring(symbol, 1, 30))
        .when((named == "") & (impl != ""), F.substring(F.concat(F.lit("proxy → "), impl), 1, 40)).otherwise(named))
    return (
        F.when(F.coalesce(entity, empty) != "", F.substring(entity, 1, 40)).when(F.col("kind") == "system", name)
        .when(F.col("kind") == "contract", contract).when(F.coalesce("ens", empty) != "", F.substring("ens", 1, 40))
        .when((F.coalesce("delegated", empty) != "") & (impl != ""),
              F.substring(F.concat(F.lit("7702 → "), impl), 1, 40)).otherwise(empty))


def repair_addresses(addresses: DataFrame, labels: DataFrame) -> DataFrame:
    """Card addresses with the action the address check asks for and the values after it.

    labels: (key, kind, ctype, family, chain, fixed, reason, rpc_failed). action: keep, or the reason of removal.
    """
    lab = labels.select("key", "kind", "ctype", "family", F.col("chain").alias("l_chain"), "fixed", "reason", "rpc_failed")
    j = addresses.withColumn("key", tx.hex_key(F.col("address"))).join(lab, "key", "left")
    note = F.coalesce("note", F.lit(""))
    dead = (F.col("kind") == "unfunded") & (F.col("family") == "evm") & ~F.col("rpc_failed")
    action = (
        F.when(F.col("kind") == "txhash", "tx_hash_moved").when(F.col("kind") == "invalid", "invalid_removed")
        .when(dead & note.rlike(fixed.TX_NOTE), "truncated_tx_removed")
        .when(dead & note.rlike(fixed.PHANTOM_NOTE), "phantom_contract_removed").otherwise("keep"))
    named = tx.chain_name(F.col("chain"), fixed.PROBE_CHAIN_ALIAS)
    live = F.col("kind").isin("eoa", "contract", "wallet")
    rechain = live & (F.coalesce("l_chain", F.lit("")) != "") & (named != F.col("l_chain"))
    infra = (F.col("kind") == "contract") & F.col("ctype").isin(fixed.INFRA_TYPES) & (F.col("role") == "attacker")
    labels_map = F.create_map(*[F.lit(x) for kv in fixed.CONTRACT_LABEL.items() for x in kv])
    tag = F.concat(F.lit("컨트랙트("), labels_map[F.col("ctype")], F.lit(")"))
    new_note = F.when(F.coalesce(infra, F.lit(False)) & ~F.contains(note, labels_map[F.col("ctype")]),
                      F.when(note == "", tag).otherwise(F.concat(note, F.lit(" · "), tag))).otherwise(note)
    refixed = F.coalesce((F.coalesce("fixed", F.lit("")) != "") & (F.col("fixed") != F.col("address")), F.lit(False))
    no = F.lit(False)
    return j.select(
        "uid", "ord", F.col("address").alias("old_address"), action.alias("action"),
        F.when(refixed, F.col("fixed")).otherwise(F.col("address")).alias("address"),
        F.when(F.coalesce(rechain, no), F.col("l_chain")).otherwise(F.col("chain")).alias("chain"),
        F.when(F.coalesce(infra, no), "unknown").otherwise(F.col("role")).alias("role"), new_note.alias("note"),
        F.array_compact(F.array(
            F.when(action != "keep", action), F.when((action == "keep") & refixed, "case_fixed"),
            F.when((action == "keep") & F.coalesce(rechain, no), "chain"),
            F.when((action == "keep") & F.coalesce(infra, no), "role"))).alias("changes"),
        F.when((action == "keep") & live & F.col("family").isin("btc", "tron", "cosmos", "sol"), F.col("l_chain"))
        .alias("implied_chain"))


def apply_repairs(cards: DataFrame, repaired: DataFrame) -> DataFrame:
    """Cards with what the repair of their addresses gives them: hashes that stood among the addresses, implied chains.

    repaired: the rows of repair_addresses. New entries follow the card's own, in the order of its addresses; a chain that
    the card names in any spelling is not added again.
    """
    def gathered(kind: str, value: Column, rows: Column) -> DataFrame:
        found = repaired.where(rows).select("uid", value.alias("v"), "ord").groupBy("uid", "v").agg(F.min("ord").alias("ord"))
        return found.groupBy("uid").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "v"))), lambda x: x["v"]).alias(kind))

    moved = gathered("moved", F.col("old_address"), F.col("action") == "tx_hash_moved")
    implied = gathered("implied", F.col("implied_chain"), F.coalesce("implied_chain", F.lit("")) != "")
    none = F.array().cast("array<string>")
    hashes, chains = F.coalesce("tx_hashes", none), F.coalesce("chains", none)
    named = F.transform(chains, lambda c: tx.chain_name(c))
    return cards.join(moved, "uid", "left").join(implied, "uid", "left").withColumns({
        "tx_hashes": F.concat(hashes, F.array_except(F.coalesce("moved", none), hashes)),
        "chains": F.concat(chains, F.array_except(F.coalesce("implied", none), named))}).drop("moved", "implied")


def repair_log(repaired: DataFrame) -> DataFrame:
    """(uid, ord, change, before, after): one row for each thing a repair changed."""
    implied = F.when(F.coalesce("implied_chain", F.lit("")) != "", F.concat(F.lit("implies "), F.col("implied_chain")))
    each = F.explode(F.array_compact(F.concat("changes", F.array(implied)))).alias("change")
    return repaired.select("uid", "ord", each, F.col("old_address").alias("before"), F.when(F.col("action") == "keep", F.col("address")).alias("after"))


def address_review(labels: DataFrame, owners: DataFrame) -> DataFrame:
    """(address, finding): labels a person should look at; owners: (key, role) of the card each address belongs to."""
    j = labels.join(owners, "key")
    name = F.lower(F.coalesce("name", F.lit("")))
    attacker = F.col("role") == "attacker"
    official = (
        (F.col("kind") == "contract") & attacker & F.col("verified") & ~name.isin("", "exploit", "attack")
        & F.col("ctype").isin("token", "router", "safe", "proxy"))
    findings = _flags(
        (F.col("scam"), "scam"), ((F.col("kind") == "contract") & (F.col("ctype") == "destroyed"), "destroyed"),
        ((F.col("kind") == "eoa") & attacker & (F.coalesce("tx_count", F.lit(0)) == 0), "idle_attacker"),
        (F.col("kind") == "system", "system"), (official, "verified_attacker"))
    return j.select("key", F.explode(findings).alias("finding"))


def recheck_due(addresses: DataFrame, labels: DataFrame, force: bool = False) -> DataFrame:
    """Distinct addresses whose label is missing, unknown or unfunded."""
    keys = addresses.select(tx.hex_key(F.col("address")).alias("key")).distinct()
    j = keys.join(labels.select("key", "kind"), "key", "left")
    return j.where(F.lit(force) | F.col("kind").isNull() | F.col("kind").isin("unknown", "unfunded")).select("key")
