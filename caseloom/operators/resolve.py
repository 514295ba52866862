"""Entity resolution: which cards of one collected day describe the same incident.

No rule compares all cards of a group. Cards with equal rule inputs collapse into cells, members of a cell hang on its
smallest uid (a star), and only cells meet. Every edge set below has the connectivity of the full pair relation with a
number of edges linear in its input, apart from truly similar names and titles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from caseloom import fixed
from caseloom.functions import text as tx
from caseloom.session import cut_lineage, passing_steps, spread

SKETCH = 65536
PAIRED = 16


def profiles(cards: DataFrame, *more: str | Column) -> DataFrame:
    """Relevant cards with the inputs of the same-incident rules, and more columns of theirs; scope = collected day."""
    name = F.when(F.coalesce(F.col("project"), F.lit("")) != "", F.col("project")).otherwise(F.col("title"))
    return (
        cards.where("relevant")
        .withColumn("name", name)
        .select(
            "uid", "source", F.col("coll_day").alias("scope"), tx.family(F.col("incident_type")).alias("fam"),
            F.col("incident_date").alias("inc"), F.col("published_at").alias("pub"),
            F.coalesce("incident_date", "published_at").alias("ref"),
            F.array_contains("tags", fixed.LEADERBOARD_TAG).alias("lb"),
            F.when(F.col("amount_usd") != 0, F.col("amount_usd")).alias("amount"),
            F.lower(F.coalesce("title", F.lit(""))).alias("title"), "name",
            tx.normalize_name(F.col("name")).alias("norm"), tx.name_tokens(F.col("name")).alias("toks"), *more,
        )
    )


def profile_table(cards: DataFrame) -> DataFrame:
    """Profiles as a written table: every rule reads them, none computes them again."""
    return cut_lineage(profiles(spread(cards)), "profiles")


def star(members: DataFrame, keys: list[str]) -> DataFrame:
    """Edges (a, b) from the smallest uid of each key to its other members.

    A key with a null connects none. One shuffle by a 16-byte digest of the key, one sort; the pass over it holds one row, so a hot key costs no memory.
    """
    said = [F.col(k).cast("string") for k in keys]
    digest = F.substring(F.unhex(F.sha2(F.concat_ws("\u0001", *said).cast("binary"), 256)), 1, 16)
    sorted_ = Window.partitionBy("_k").orderBy("uid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = members.dropna(subset=keys).select(digest.alias("_k"), "uid").withColumn("a", F.first("uid").over(sorted_))
    return first.where("a <> uid").select("a", F.col("uid").alias("b")).distinct()


def shared_keys(cards: DataFrame, addresses: DataFrame, tx_rows: DataFrame | None = None) -> DataFrame:
    """(scope, key, uid) of every address, victims aside, and transaction hash of a relevant card; a card may give a key twice.

    tx_rows: (uid, tx), where hashes are a table of their own; else they are read off the cards.
    """
    live = cards.where("relevant").select("uid", F.col("coll_day").alias("scope"), "tx_hashes")
    by_address = (
        addresses.where(F.col("role") != "victim")
        .select("uid", F.concat(F.lit("a:"), F.lower("address")).alias("key"))
        .join(live.select("uid", "scope"), "uid")
    )
    if tx_rows is None:
        tx_rows = live.select("uid", F.explode("tx_hashes").alias("tx"))
    by_tx = tx_rows.join(live.select("uid", "scope"), "uid").select(
        "uid", F.concat(F.lit("t:"), F.lower("tx")).alias("key"), "scope")
    return by_address.unionByName(by_tx)


def shared_key_edges(cards: DataFrame, addresses: DataFrame) -> DataFrame:
    return star(shared_keys(cards, addresses), ["scope", "key"])


def keyed(df: DataFrame, rule: str, *cols: str) -> DataFrame:
    """(key, uid): membership of a card in a group that a rule connects as a whole."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in cols]
    return df.select(F.concat_ws("\u0001", F.lit(rule), *parts).alias("key"), "uid")


def name_runs(p: DataFrame) -> DataFrame:
    """Equal name of four letters or more, same family, dates at most 14 days apart, as (key, uid).

    Days of one (scope, name, family) form runs with gaps of at most 14 days; a run is connected.
    """
    named = p.where((F.length("norm") >= 4) & F.col("ref").isNotNull())
    keys = ["scope", "norm", "fam"]
    by_day = Window.partitionBy(*keys).orderBy("ref")
    starts = F.when(F.datediff("ref", F.lag("ref").over(by_day)) <= fixed.FOLLOWUP_DAYS, 0).otherwise(1)
    runs = named.select(*keys, "ref").distinct().withColumn("_new", starts).select(
        *keys, "ref", F.sum("_new").over(by_day).alias("run"))
    return keyed(named.select(*keys, "ref", "uid").join(runs, [*keys, "ref"]), "run", *keys, "run")


def amount_bin(amount: Column) -> Column:
    """Logarithmic bins a little wider than the tolerance: close amounts lie in the same or the next bin."""
    return F.floor(F.log(amount) / F.log(F.lit(1 / (1 - 1.02 * fixed.AMOUNT_TOLERANCE)))).cast("bigint")


def amount_named(p: DataFrame) -> DataFrame:
    return p.where((F.length("norm") >= 4) & (F.col("amount") > 0) & F.col("pub").isNotNull())


def amount_cells(p: DataFrame) -> DataFrame:
    return keyed(amount_named(p), "amount", "scope", "norm", "pub", "amount")


def name_amount_links(p: DataFrame) -> DataFrame:
    """Equal name, amounts within 5% of the larger, published at most 7 days apart, any family; between cells.

    Each amount is linked to the next amount at or above it on each day within reach; amounts lying between two
    linked ones are within tolerance of both, so this keeps the components. One sorted pass, no pair expansion.
    """
    keys = ["scope", "norm", "pub", "amount"]
    cells = amount_named(p).groupBy(*keys).agg(F.min("uid").alias("rep"))
    several = cells.groupBy("scope", "norm").agg(F.count("*").alias("n")).where("n > 1")  # a cell alone meets none
    cells = cells.join(several.select("scope", "norm"), ["scope", "norm"], "left_semi").withColumn("bin", amount_bin(F.col("amount")))
    reach = F.explode(F.sequence(F.lit(-7), F.lit(7)))
    seekers = (
        cells.withColumn("o", reach).withColumn("day", F.date_add("pub", F.col("o")))
        # a seeker on its own day stands before the equal amount, which is itself; elsewhere behind it
        .select("scope", "norm", "day", "bin", "amount", "rep", F.when(F.col("o") == 0, 0).otherwise(2).alias("pos"))
    )
    targets = cells.select(
        "scope", "norm", F.col("pub").alias("day"), F.explode(F.array(F.col("bin"), F.col("bin") - 1)).alias("bin"),
        "amount", "rep", F.lit(1).alias("pos"),
    )
    above = (
        Window.partitionBy("scope", "norm", "day", "bin").orderBy(F.desc("amount"), "pos")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    target = F.when(F.col("pos") == 1, F.struct("amount", "rep"))
    linked = (
        seekers.unionByName(targets).withColumn("to", F.last(target, ignorenulls=True).over(above))
        .where("pos <> 1 and to is not null")
        .where((F.col("to.amount") - F.col("amount")) / F.col("to.amount") <= fixed.AMOUNT_TOLERANCE)
    )
    pairs = linked.select(F.least("rep", "to.rep").alias("a"), F.greatest("rep", "to.rep").alias("b"))
    return pairs.where("a <> b").distinct()


def rarity(items: DataFrame, token: str) -> DataFrame:
    """Token counts in 65,536 hash buckets: a sketch of fixed size, hence safe to broadcast.

    Prefix filtering needs any one total order of tokens; rare-first order only makes it fast.
    """
    bucket = F.pmod(F.xxhash64(token), F.lit(SKETCH))
    return items.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_n"))


def rare_first(sets: DataFrame, key: list[str], items: str) -> DataFrame:
    """Each set's items ordered rarest first, as arrays, next to its key."""
    rows = sets.select(*key, F.explode(items).alias("_t")).withColumn("_bucket", F.pmod(F.xxhash64("_t"), F.lit(SKETCH)))
    counted = rows.join(F.broadcast(rarity(rows, "_t")), "_bucket")
    ordered = F.array_sort(F.collect_list(F.struct("_n", "_t")))
    return counted.groupBy(*key).agg(F.transform(ordered, lambda s: s["_t"]).alias("items"))


def jaccard_pairs(sets: DataFrame, group: list[str], ident: str, items: str, threshold: float) -> DataFrame:
    """Pairs of sets in a group with Jaccard similarity of at least threshold (a half or more), by prefix filtering.

    The smaller set of a pair is found through its index prefix, the larger one through its probe prefix; both follow
    from the smallest overlap such a pair can have, so no pair is lost. Sets of 4 to PAIRED items meet by two items of
    prefixes one longer: a pair that must share two items shares two there. Lists of such keys stay short where lists
    of single trigrams grow with the data.
    """
    t = threshold
    made = rare_first(sets, [*group, ident], items).withColumns({"n": F.size("items"), "_i": F.monotonically_increasing_id()})
    s = cut_lineage(made, "sets")  # read four times; sets meet by their numbers
    n = F.col("n")
    index_len = n - F.ceil(n * (2 * t / (1 + t)) - 1e-9) + 1
    probe_len = n - F.ceil(n * t - 1e-9) + 1

    def side(length: Column, tag: str, single: Column, paired: Column) -> DataFrame:
        one = F.transform(F.slice("items", F.lit(1), length.cast("int")), lambda x: F.xxhash64(*group, x))
        head = F.slice("items", F.lit(1), (length + 1).cast("int"))
        two = F.flatten(F.transform(head, lambda x, i: F.transform(
            F.slice(head, i + 2, F.size(head)), lambda y: F.xxhash64(*group, x, y))))
        none = F.array().cast("array<bigint>")
        keys = F.concat(F.when(single, one).otherwise(none), F.when(paired, two).otherwise(none))
        return s.select(F.col("_i").alias(f"i_{tag}"), n.alias(f"n_{tag}"), F.explode(keys).alias("_k"))

    small = side(index_len, "a", (n < 4) | (n > PAIRED), n.between(4, PAIRED))
    # the larger set of a pair has at most 1 / t times the items of the smaller one
    large = side(probe_len, "b", (n * t <= 3 + 1e-9) | (n > PAIRED), (n >= 4) & (n * t <= PAIRED + 1e-9))
    candidates = (
        small.join(large, "_k")
        .where("n_a < n_b or (n_a = n_b and i_a < i_b)")
        .where(F.col("n_a") >= F.col("n_b") * t - 1e-9)
        .select("i_a", "i_b").distinct()
    )
    sa, sb = [s.select(F.col("_i").alias(f"i_{tag}"), F.col(ident).alias(f"id_{tag}"), F.col("items").alias(f"_i{tag}"),
                       F.struct(*group).alias(f"_g{tag}")) for tag in ("a", "b")]
    return (
        candidates.join(sa, "i_a").join(sb, "i_b").where("_ga = _gb")  # a key is a hash, so another group's may equal it
        .where(tx.jaccard(F.col("_ia"), F.col("_ib")) >= t).select("_ga.*", "id_a", "id_b")
    )


@passing_steps()
def name_pairs(p: DataFrame, group: list[str]) -> DataFrame:
    """Matching pairs of distinct names of one group (the days that can meet) as (*group, rule, a, b).

    Names are compared as normalised strings (prefix, trigrams) and as word sets (subset), each distinct value once.
    """
    valid = p.where(~F.col("norm").isin(fixed.GENERIC_NAMES))
    norms = valid.select(*group, "norm").distinct()
    # a name is a prefix of another when it equals one of the other's prefixes: an equality join, true pairs only
    heads = norms.where("length(norm) > 4").select(
        F.struct(*group).alias("_gb"), F.col("norm").alias("b"), F.explode(F.transform(
            F.sequence(F.lit(4), F.length("norm") - 1), lambda n: F.xxhash64(*group, F.substring("norm", F.lit(1), n)))).alias("_k"))
    whole = norms.where("length(norm) >= 4").select(F.struct(*group).alias("_ga"), F.col("norm").alias("a"), F.xxhash64(*group, "norm").alias("_k"))
    prefix = heads.join(whole, "_k").where("_ga = _gb and length(a) < length(b) and startswith(b, a)").select(
        "_ga.*", F.lit("prefix").alias("rule"), "a", "b")

    grams = norms.withColumn("grams", tx.trigrams(F.col("norm")))
    similar = jaccard_pairs(grams, group, "norm", "grams", fixed.NAME_JACCARD).select(
        *group, F.lit("trigram").alias("rule"), F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")
    )

    # a word set lies inside another when both of its rarest words do; single words join on that word
    sets = valid.where(F.size("toks") > 0).select(*group, "toks").distinct()
    sets = sets.withColumn("ts", F.array_join("toks", " "))
    ranked = cut_lineage(rare_first(sets, [*group, "ts"], "toks"), "sets")
    words = ranked.select(*group, "ts", "items", F.posexplode("items").alias("i", "w"))
    all_pairs = words.select(
        *group, "ts", "w", F.explode(F.concat(F.array(F.lit("")), F.filter("items", lambda v: v != F.col("w")))).alias("v")
    )
    probe = all_pairs.select(*group, F.col("ts").alias("b"), F.concat_ws(" ", "w", "v").alias("k"))
    small = ranked.select(
        *group, F.col("ts").alias("a"), F.col("items").alias("_ia"),
        F.concat_ws(" ", F.col("items")[0], F.coalesce(F.get("items", F.lit(1)), F.lit(""))).alias("k"),
    )
    subset = (
        small.join(probe, [*group, "k"]).where("a <> b")
        .where(F.size(F.array_except("_ia", F.split("b", " "))) == 0)
        .select(*group, F.lit("words").alias("rule"), "a", "b").distinct()
    )
    # each rule is written by itself: one plan of all three takes a driver's memory many times over
    return reduce(DataFrame.unionByName, [cut_lineage(part, "names", lasting=1) for part in (prefix, similar, subset)])


def name_nodes(p: DataFrame, *more: str) -> DataFrame:
    """Each card under its normalised name and under its word set."""
    valid = p.where(~F.col("norm").isin(fixed.GENERIC_NAMES))
    cols = ["scope", "fam", "inc", "pub", "lb", "uid", *more]
    by_norm = valid.select(F.concat(F.lit("n:"), F.col("norm")).alias("node"), *cols)
    by_words = valid.where(F.size("toks") > 0).select(
        F.concat(F.lit("w:"), F.array_join("toks", " ")).alias("node"), *cols
    )
    return by_norm.unionByName(by_words)


def both_ways(pairs: DataFrame, group: list[str]) -> DataFrame:
    """Both directions of the matching name pairs of a group, as nodes."""
    kind = F.when(F.col("rule") == "words", "w:").otherwise("n:")
    one = pairs.select(*group, F.concat(kind, "a").alias("x"), F.concat(kind, "b").alias("y"))
    return one.unionByName(one.select(*group, F.col("y").alias("x"), F.col("x").alias("y"))).distinct()


def node_pairs(pairs: DataFrame, nodes: DataFrame, group: list[str]) -> DataFrame:
    """Both directions of the matching name pairs of a group, and every node with itself."""
    itself = nodes.select(*group, F.col("node").alias("x"), F.col("node").alias("y")).distinct()
    return both_ways(pairs, group).unionByName(itself)


def date_cells(nodes: DataFrame) -> DataFrame:
    """Cards of one name, family and dates; they are the same incident."""
    return keyed(nodes, "dates", "scope", "fam", "node", "inc", "pub", "lb")


#: Distance in days up to which two date classes fit, and whether only legal cards do.
CLASS_REACH = [("i", "i", 3), ("lb", "i", 14), ("lp", "lp", 7), ("ip", "p", 14)]
CLASS_OPEN = [("lq", "li"), ("none", "all"), ("noinc", "nopub")]


def date_classes() -> Column:
    """The classes a date cell belongs to; the date rule holds between all cards of two classes that fit, or of none.

    Incident dates meet by day (i), of a leaderboard from further (lb); legal cards with both meet by publication (lp, li,
    and lq without one); where an incident date is missing, publication dates decide (ip against p), or nothing does.
    """
    no_inc, no_pub, legal = F.col("inc").isNull(), F.col("pub").isNull(), F.col("fam") == "legal"

    def one(tag: str, when: Column, day: Column | None = None) -> Column:
        return F.when(when, F.struct(F.lit(tag).alias("tag"), (F.lit(0) if day is None else F.unix_date(day)).alias("day")))

    inc, pub = F.col("inc"), F.col("pub")
    return F.array_compact(F.array(
        one("i", ~no_inc, inc), one("lb", ~no_inc & F.col("lb"), inc), one("lp", legal & ~no_inc & ~no_pub, pub),
        one("ip", no_inc & ~no_pub, pub), one("p", ~no_pub, pub), one("lq", legal & ~no_inc & no_pub), one("li", legal & ~no_inc),
        one("none", no_inc & no_pub), one("all", F.lit(True)), one("noinc", no_inc), one("nopub", no_pub)))


def class_reach() -> Column:
    """The classes that a class fits, as an array; a pair of names is given in both directions, so one of them is enough."""
    near = [F.when(F.col("tag") == t, F.transform(F.sequence(F.lit(-days), F.lit(days)), lambda o: F.struct(
        F.lit(u).alias("tag"), (F.col("day") + o).alias("day")))) for t, u, days in CLASS_REACH]
    free = [F.when(F.col("tag") == t, F.array(F.struct(F.lit(u).alias("tag"), F.lit(0).alias("day")))) for t, u in CLASS_OPEN]
    return F.coalesce(*near, *free)


def dates_fit(x: str, y: str, fam: str = "fam") -> Column:
    """The date rule between two sides of a pair."""
    di = tx.days_apart(F.col(f"inc_{x}"), F.col(f"inc_{y}"))
    dp = tx.days_apart(F.col(f"pub_{x}"), F.col(f"pub_{y}"))
    with_inc = (
        (di <= 3) | ((F.col(f"lb_{x}") | F.col(f"lb_{y}")) & (di <= 14))
        | ((F.col(fam) == "legal") & F.coalesce(dp <= 7, F.lit(True)))
    )
    return F.when(di.isNotNull(), with_inc).otherwise(F.coalesce(dp <= 14, F.lit(True)))


def fuzzy_links(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Matching names with compatible dates, between date cells.

    Two classes of dates that fit, of two names that match, connect all their cells: so a class that meets any other
    becomes a star, and stars are linked by one edge. Edges number the cells and the days that meet, not the pairs of
    cells. Names with one cell and no other name to match are left out first.
    """
    dates = ["inc", "pub", "lb"]
    cells = nodes.groupBy("scope", "fam", "node", *dates).agg(F.min("uid").alias("rep"))
    others = pairs.where("x <> y").select("scope", "x", "y").distinct()
    named = others.select("scope", F.col("x").alias("node")).distinct()
    several = cells.groupBy("scope", "fam", "node").agg(F.count("*").alias("n")).where("n > 1").select("scope", "fam", "node")
    within = several.select("scope", "fam", F.col("node").alias("x"), F.col("node").alias("y"))
    busy = cells.join(named, ["scope", "node"], "left_semi").select("scope", "fam", "node").unionByName(several).distinct()
    placed = cut_lineage(
        cells.join(busy, ["scope", "fam", "node"], "left_semi").withColumn("_c", F.explode(date_classes()))
        .select("scope", "fam", "node", "_c.tag", "_c.day", "rep"), "classes")
    key = ["scope", "fam", "node", "tag", "day"]
    hubs = placed.groupBy(*key).agg(F.min("rep").alias("hub"))
    fams = hubs.select("scope", "fam", F.col("node").alias("x")).distinct()
    met = within.unionByName(others.join(fams, ["scope", "x"]).select("scope", "fam", "x", "y"))
    seek = hubs.withColumn("_r", F.explode(class_reach())).select(
        "scope", "fam", F.col("node").alias("x"), F.struct("tag", "day").alias("cx"), F.col("hub").alias("hub_x"), "_r.tag", "_r.day")
    held = hubs.select("scope", "fam", F.col("node").alias("y"), "tag", "day", F.col("hub").alias("hub_y"))
    linked = cut_lineage(seek.join(met, ["scope", "fam", "x"]).join(held, ["scope", "fam", "y", "tag", "day"]), "met")
    sides = linked.select("scope", "fam", F.col("x").alias("node"), "cx.tag", "cx.day").unionByName(
        linked.select("scope", "fam", F.col("y").alias("node"), "tag", "day")).distinct()
    stars = placed.join(sides, key, "left_semi").join(hubs, key).select(F.col("hub").alias("x"), F.col("rep").alias("y"))
    edges = linked.select(F.col("hub_x").alias("x"), F.col("hub_y").alias("y")).unionByName(stars)
    return edges.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def releases(p: DataFrame) -> DataFrame:
    """Legal cards with the source and amount a press release is known by."""
    amount = F.coalesce(F.col("amount").cast("string"), F.lit(""))
    return p.where("fam = 'legal' and pub is not null and source <> ''").select(
        F.concat_ws("|", F.col("scope").cast("string"), "source", amount).alias("release"), "title", "pub", "uid")


def release_cells(p: DataFrame) -> DataFrame:
    return keyed(releases(p), "release", "release", "title", "pub")


def with_grams(titles: DataFrame, group: list[str]) -> DataFrame:
    """Titles with trigrams, without the groups that hold one title only."""
    several = titles.groupBy(*group).agg(F.count("*").alias("n")).where("n > 1").select(*group)
    return titles.join(several, group, "left_semi").withColumn("grams", tx.trigrams(F.col("title")))


def release_links(p: DataFrame) -> DataFrame:
    """A press release issued again within 7 days: same source, same amount, alike title; between cells."""
    cells = releases(p).groupBy("release", "title", "pub").agg(F.min("uid").alias("rep"))
    titles = cells.select("release", "title").distinct()
    alike = jaccard_pairs(with_grams(titles, ["release"]), ["release"], "title", "grams", fixed.TITLE_JACCARD)
    same = titles.select("release", F.col("title").alias("id_a"), F.col("title").alias("id_b"))
    a, b = [cells.select("release", F.col("title").alias(f"id_{t}"), F.col("pub").alias(f"pub_{t}"),
                         F.col("rep").alias(f"rep_{t}")) for t in ("a", "b")]
    # publication days meet by date, at most 15 per cell
    reach = F.explode(F.transform(F.sequence(F.lit(-7), F.lit(7)), lambda o: F.date_add("pub_a", o)))
    met = (
        a.join(alike.unionByName(same), ["release", "id_a"]).withColumn("pub_b", reach)
        .join(b, ["release", "id_b", "pub_b"]).where("rep_a <> rep_b")
    )
    return met.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()


@passing_steps()
def merge_edges(cards: DataFrame, addresses: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """All edges between cards of one collected day; their components are the incidents.

    Each kind of edge is written by itself: plans stay short, and one kind's steps are done when the next begins.
    """
    p = profile_table(cards)
    nodes = name_nodes(p)
    pairs = cut_lineage(both_ways(name_pairs(p, ["scope"]), ["scope"]), "names")
    groups = (
        keyed(shared_keys(cards, addresses), "share", "scope", "key")
        .unionByName(name_runs(p)).unionByName(amount_cells(p)).unionByName(release_cells(p))
        .unionByName(date_cells(nodes))
    )
    kinds = [star(groups, ["key"]), name_amount_links(p), release_links(p), fuzzy_links(nodes, pairs)]
    if decisions is not None:
        kinds.append(decided_edges(cards, decisions))
    return reduce(DataFrame.unionByName, [cut_lineage(kind, "edges", lasting=1) for kind in kinds])


def sides(cards: DataFrame) -> DataFrame:
    """Rule inputs of the sides of a pair."""
    return profiles(
        cards, F.transform("chains", lambda c: F.lower(c)).alias("chains"),
        tx.legal_words(F.col("project"), F.col("title"), F.array_join(F.slice("actors", 1, 5), " ")).alias("words"))


def sided(inputs: DataFrame, tag: str) -> DataFrame:
    return inputs.select(*[F.col(c).alias(f"{c}_{tag}") for c in inputs.columns])


def plausible(fam: str = "fam_a") -> Column:
    """Whether a pair is worth an outside verdict."""
    di, dp = tx.days_apart(F.col("inc_a"), F.col("inc_b")), tx.days_apart(F.col("pub_a"), F.col("pub_b"))
    legal = (dp <= 5) & F.arrays_overlap("words_a", "words_b")
    ratio = F.col("amount_a") / F.col("amount_b")
    alike = F.arrays_overlap("toks_a", "toks_b") | (
        tx.jaccard(tx.trigrams(F.col("norm_a")), tx.trigrams(F.col("norm_b"))) >= 0.3
    )
    attack = (
        F.coalesce(di <= 3, dp <= 3)
        & F.arrays_overlap("chains_a", "chains_b")
        & F.coalesce((ratio >= 0.5) & (ratio <= 2.0), alike)
    )
    return F.coalesce(
        (F.col("fam_a") == F.col("fam_b")) & F.when(F.col(fam) == "legal", legal).otherwise(attack), F.lit(False)
    )


def plausible_pairs(cards: DataFrame, pairs: DataFrame, days: tuple[int, int] | None = None) -> DataFrame:
    """Given pairs (uid_a, uid_b) with rule inputs joined, kept when plausible.

    Verdicts arrive as a table, so only pairs that have one are looked at: equality joins, no pair generation. The inputs
    are made and written once for both sides; pairs meet their families and days first, and only what is left meets names
    and words. days: how many collected days a lies behind b, at least and at most.
    """
    inputs = cut_lineage(sides(cards).drop("source", "ref", "lb", "title", "name"), "sides")
    short, wide = inputs.select("uid", "fam", "scope"), inputs.drop("fam", "scope")
    met = pairs.join(sided(short, "a"), "uid_a").join(sided(short, "b"), "uid_b").where("fam_a = fam_b")
    if days:
        met = met.where(F.datediff("scope_a", "scope_b").between(*days))
    return met.join(sided(wide, "a"), "uid_a").join(sided(wide, "b"), "uid_b").where(plausible())


def accepted(decisions: DataFrame) -> DataFrame:
    """One row per sorted pair; a verdict counts only when same and sure enough."""
    sorted_pair = decisions.select(
        F.least("uid_a", "uid_b").alias("uid_a"), F.greatest("uid_a", "uid_b").alias("uid_b"),
        (F.col("same") & (F.col("confidence") >= fixed.MIN_VERDICT_CONFIDENCE)).alias("same"), "decided_at",
    )
    return sorted_pair.groupBy("uid_a", "uid_b").agg(F.max_by("same", F.struct("decided_at", "same")).alias("same"))


def decided_edges(cards: DataFrame, decisions: DataFrame) -> DataFrame:
    yes = accepted(decisions).where("same").select("uid_a", "uid_b")
    return plausible_pairs(cards, yes, (0, 0)).select(
        F.col("uid_a").alias("a"), F.col("uid_b").alias("b")
    )


def components(vertices: DataFrame, edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(uid, cid): smallest uid of the connected component, by alternating star contraction.

    Each round is two aggregations with map-side combine; its result is written to the shared folder, so the plan stays
    short and a lost executor costs one round at most.
    """
    e = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    for _ in range(max_rounds):
        e = cut_lineage(_small_star(_large_star(e)))
        after = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return vertices.select("uid").join(e.withColumnRenamed("u", "uid"), "uid", "left").select(
        "uid", F.coalesce("v", "uid").alias("cid")
    )


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.withColumnRenamed("m", "v")).distinct()
