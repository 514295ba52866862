"""DuckDB renderings of the text rules, used only to state expected results."""

from __future__ import annotations

from caseloom import fixed


def words(items: list[str]) -> str:
    return "(" + ", ".join("'" + i.replace("'", "''") + "'" for i in items) + ")"


def norm(x: str) -> str:
    n = f"regexp_replace(regexp_replace(lower(coalesce({x}, '')), '\\(.*?\\)', ' ', 'g'), '[^a-z0-9가-힣 ]+', ' ', 'g')"
    joined = (
        f"array_to_string(list_filter(string_split({n}, ' '), lambda w: w not in {words(fixed.NAME_STOP)}), '')"
    )
    return f"regexp_replace({joined}, '^(.{{3,}})(?:{'|'.join(fixed.NAME_SUFFIXES)})$', '\\1')"


def toks(x: str) -> str:
    n = f"regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9가-힣 ]+', ' ', 'g')"
    return (
        f"list_sort(list_distinct(list_filter(string_split({n}, ' '), "
        f"lambda w: length(w) > 1 and w not in {words(fixed.NAME_STOP)})))"
    )


def grams(x: str) -> str:
    return (
        f"list_distinct(list_transform(generate_series(1, length({x}) + 1), "
        f"lambda i: substr(concat('  ', {x}, ' '), i, 3)))"
    )


def jaccard(a: str, b: str) -> str:
    c = f"len(list_intersect({a}, {b}))"
    return f"({c} * 1.0 / (len({a}) + len({b}) - {c}))"


def case_map(x: str, table: dict[str, str], default: str) -> str:
    arms = " ".join(f"when '{k}' then '{v}'" for k, v in table.items())
    return f"case {x} {arms} else {default} end"


def source_rank(x: str) -> str:
    arms = " ".join(f"when '{s}' then {i}" for i, s in enumerate(fixed.SOURCE_PRIORITY))
    return f"(case {x} {arms} else case when {x} like 'rss:%' then 11 else 12 end end)"


def role_rank(x: str) -> str:
    return "(case " + x + " " + " ".join(f"when '{r}' then {i}" for i, r in enumerate(fixed.ROLES)) + " else 9 end)"


def chain_name(x: str) -> str:
    return case_map(f"lower(trim({x}))", fixed.CHAIN_ALIAS, f"trim({x})")


def chain_names(x: str) -> str:
    """Distinct display names in order of first appearance."""
    named = f"list_filter(list_transform({x}, lambda c: {chain_name('c')}), lambda c: c <> '')"
    return f"list_filter({named}, lambda c, i: list_position({named}, c) = i)"


def fam(x: str) -> str:
    return f"case when {x} in {words(fixed.LEGAL_TYPES)} then 'legal' else 'attack' end"


def names_match(a: str, b: str) -> str:
    g = words(fixed.GENERIC_NAMES)
    return f"""({a}.norm not in {g} and {b}.norm not in {g} and (
      {a}.norm = {b}.norm
      or (least(length({a}.norm), length({b}.norm)) >= 4
          and (starts_with({a}.norm, {b}.norm) or starts_with({b}.norm, {a}.norm)))
      or (len({a}.toks) > 0 and len({b}.toks) > 0
          and len(list_intersect({a}.toks, {b}.toks)) = least(len({a}.toks), len({b}.toks)))
      or {jaccard(a + '.grams', b + '.grams')} >= 0.6))"""


def dates_fit(a: str, b: str) -> str:
    return f"""(case when {a}.inc is not null and {b}.inc is not null then
      abs({a}.inc - {b}.inc) <= 3 or (({a}.lb or {b}.lb) and abs({a}.inc - {b}.inc) <= 14)
      or ({a}.fam = 'legal' and coalesce(abs({a}.pub - {b}.pub) <= 7, true))
      else coalesce(abs({a}.pub - {b}.pub) <= 14, true) end)"""


def same(a: str, b: str) -> str:
    """The same-incident rules, shared keys aside."""
    return f"""(
      coalesce({a}.amount is not null and {b}.amount is not null and {a}.norm = {b}.norm and length({a}.norm) >= 4
        and abs({a}.pub - {b}.pub) <= 7
        and abs({a}.amount - {b}.amount) / greatest({a}.amount, {b}.amount) <= 0.05, false)
      or ({a}.fam = {b}.fam and (
        coalesce({a}.fam = 'legal' and {a}.source = {b}.source and {a}.amount is not distinct from {b}.amount
          and abs({a}.pub - {b}.pub) <= 7 and {jaccard(a + '.tgrams', b + '.tgrams')} >= 0.5, false)
        or coalesce({a}.norm = {b}.norm and length({a}.norm) >= 4 and abs({a}.ref - {b}.ref) <= 14, false)
        or ({dates_fit(a, b)} and {names_match(a, b)}))))"""


def plausible(a: str, b: str) -> str:
    alike = (
        f"(len(list_intersect({a}.toks, {b}.toks)) > 0 or {jaccard(a + '.grams', b + '.grams')} >= 0.3)"
    )
    return f"""({a}.fam = {b}.fam and case when {a}.fam = 'legal' then
        coalesce(abs({a}.pub - {b}.pub) <= 5, false) and len(list_intersect({a}.words, {b}.words)) > 0
      else coalesce(abs({a}.inc - {b}.inc) <= 3, abs({a}.pub - {b}.pub) <= 3, false)
        and len(list_intersect({a}.lchains, {b}.lchains)) > 0
        and coalesce({a}.amount / {b}.amount between 0.5 and 2.0, {alike}) end)"""


def profile(table: str, where: str = "relevant") -> str:
    name = "case when coalesce(project, '') <> '' then project else title end"
    stop = words(fixed.LEGAL_STOP)
    blob = (
        "concat_ws(chr(10), project, title, array_to_string(actors[1:5], ' '))"
    )
    return f"""select *, {grams('norm')} as grams, {grams('title_l')} as tgrams from (
      select uid, source, coll_day as scope, {fam('incident_type')} as fam, incident_date as inc, published_at as pub,
        coalesce(incident_date, published_at) as ref, list_contains(tags, 'rekt_leaderboard') as lb,
        case when amount_usd <> 0 then amount_usd end as amount, lower(coalesce(title, '')) as title_l,
        {norm(name)} as norm, {toks(name)} as toks, list_transform(chains, lambda c: lower(c)) as lchains,
        list_distinct(list_filter(list_transform(regexp_extract_all({blob}, '[A-Za-z][A-Za-z0-9]{{3,}}'),
          lambda w: lower(w)), lambda w: w not in {stop})) as words
      from {table} where {where})"""


def url_key(x: str) -> str:
    return f"rtrim(split_part(coalesce({x}, ''), '?', 1), '/')"


def hex_key(x: str) -> str:
    return f"case when starts_with({x}, '0x') then lower({x}) else {x} end"


def address_key(x: str) -> str:
    hits = " or ".join(f"starts_with(lower(trim({x})), '{p}')" for p in fixed.CASELESS_PREFIXES)
    return f"case when {hits} then lower(trim({x})) else trim({x}) end"
