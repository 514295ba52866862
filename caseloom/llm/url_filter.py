"""URL filters: block and allow rules, and gradient-boosted trees on lexical features for the rest; DataFrame functions only.

Features of a url: lengths, path depth, digit ratio, character entropy, parameter counts, and for its host's top level,
its host's last two labels and its path's file suffix the smoothed share of bad labels among labelled urls. Trees are
grown level by level from histograms: one aggregate over (node, feature, bin) a level, whose result has at most
2^depth * features * bins rows whatever the data. All labelled urls are learnt from.

Defined cases. Null url or one without `://`: host and path empty, no rule fits, the trees judge it. Rows whose label is
null or neither 0 nor 1 aren't learnt from. Without labelled urls the trees allow everything. Null page_id, repeated
rows and other columns pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.frames import free_name
from caseloom.session import cut_lineage

BINS, DEPTH, TREES, RATE, RIDGE, LEAST = 32, 3, 12, 0.3, 1.0, 20.0
PRIOR = 20.0  # labelled urls that the general share counts for in a suffix's share


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str  # host, then path

    @property
    def host(self) -> str:
        return self.text.partition("/")[0].lower()

    @property
    def path(self) -> str:
        return "".join(self.text.partition("/")[1:])


RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/"))

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def first_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as a number; null if none does."""
    found = F.lit(None).cast("int")
    for k, rule in sorted(enumerate(rules), key=lambda r: (len(r[1].text), r[1].text)):  # the last, longest test is outermost
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(k)).otherwise(found)
    return found


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(F.length(whole), F.lit(1))


def _count(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def _entropy(text: Column) -> Column:
    """Bits a character."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    each = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    share = F.transform(each, lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.aggregate(share, F.lit(0.0), lambda total, p: total - p * F.log2(p))


#: Suffixes whose share of bad labels is a feature.
SUFFIXES = ("top", "domain", "file")


def lexical(pages: DataFrame, url: str, host: str, path: str) -> tuple[dict[str, Column], dict[str, Column]]:
    """Numeric features by name, and suffixes by name."""
    u, h, p = F.coalesce(F.col(url), F.lit("")), F.col(host), F.col(path)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    numbers = {
        "length": F.length(u), "host_length": F.length(h), "path_length": F.length(p), "depth": _count(p, "/"), "labels": _count(h, "."),
        "digits": _share(F.length(F.regexp_replace(u, r"[^0-9]", "")), u), "marks": _share(F.length(F.regexp_replace(u, r"[0-9A-Za-z]", "")), u),
        "entropy": _entropy(u), "parameters": F.when(query != "", _count(query, "&") + 1).otherwise(0), "fragment": _count(u, "#"),
    }
    suffixes = {
        "top": F.regexp_extract(h, r"([^.]*)$", 1), "domain": F.regexp_extract(h, r"([^.]*\.?[^.]*)$", 1),
        "file": F.regexp_extract(p, r"(\.[^./]*)$", 1),
    }
    return {k: v.cast("double") for k, v in numbers.items()}, suffixes


@dataclass
class Trees:
    """base + sum of leaves; a split is (feature, threshold): left when the feature is at most the threshold."""

    names: list[str]
    base: float
    splits: list[dict[int, tuple[str, float]]] = field(default_factory=list)
    leaves: list[dict[int, float]] = field(default_factory=list)

    def node(self, tree: int, feature) -> Column:
        """Number of the node a row reaches: 1 for the root, 2n and 2n + 1 below n."""
        def below(n: int) -> Column:
            if n not in self.splits[tree]:
                return F.lit(n)
            name, at = self.splits[tree][n]
            return F.when(feature(name) <= F.lit(at), below(2 * n)).otherwise(below(2 * n + 1))

        return below(1)

    def margin(self, feature) -> Column:
        total = F.lit(self.base)
        for tree, leaves in enumerate(self.leaves):
            def below(n: int, tree=tree, leaves=leaves) -> Column:
                if n not in self.splits[tree]:
                    return F.lit(leaves[n])
                name, at = self.splits[tree][n]
                return F.when(feature(name) <= F.lit(at), below(2 * n)).otherwise(below(2 * n + 1))

            total = total + below(1)
        return total


def grown(rows: DataFrame, names: list[str], label: str = "y") -> Trees:
    """Logistic boosting on rows(label 0/1, names double) that are cheap to read again, such as a written table."""
    stats = rows.agg(F.count(label).alias("n"), F.avg(label).alias("mean"), *[
        F.percentile_approx(name, [k / BINS for k in range(1, BINS)], 1000).alias(name) for name in names]).first()
    if not stats["n"]:
        return Trees(names, -10.0)
    mean = min(max(float(stats["mean"]), 1e-4), 1 - 1e-4)
    trees = Trees(names, math.log(mean / (1 - mean)))
    cuts = {name: sorted(set(stats[name] or [])) for name in names}
    for _ in range(TREES):
        trees.splits.append({})
        open_nodes = {1}
        sides: dict[int, tuple] = {}  # gradient, curvature and rows of each node
        for depth in range(DEPTH):
            sums = _histogram(rows, trees, cuts, label)
            fresh = set()
            for n in open_nodes & set(sums):
                sides.setdefault(n, _totals(sums[n]))
                if best := _best_split(sums[n], cuts):
                    trees.splits[-1][n] = best[:2]
                    sides[2 * n], sides[2 * n + 1] = best[2:]
                    fresh |= {2 * n, 2 * n + 1}
            open_nodes = fresh
            if not fresh:
                break
        trees.leaves.append({n: -RATE * g / (h + RIDGE) for n, (g, h, _) in sides.items() if n not in trees.splits[-1]})
        trees.leaves[-1].setdefault(1, 0.0)
    return trees


def _histogram(rows: DataFrame, trees: Trees, cuts: dict[str, list[float]], label: str) -> dict[int, dict[str, dict[int, tuple]]]:
    """Sums of gradient and curvature by node, feature and bin."""
    def bin_of(name: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(c) for c in cuts[name]]), lambda cut: cut < F.col(name)))

    p = 1 / (1 + F.exp(-trees.margin(F.col)))
    binned = F.array(*[F.struct(F.lit(k).alias("f"), bin_of(name).alias("b")) for k, name in enumerate(trees.names) if cuts[name]])
    flat = rows.select(trees.node(len(trees.splits) - 1, F.col).alias("node"), (p - F.col(label)).alias("g"), (p * (1 - p)).alias("h"), F.explode(binned).alias("x"))
    out: dict = {}
    for r in flat.groupBy("node", "x.f", "x.b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("n")).collect():
        out.setdefault(r["node"], {}).setdefault(trees.names[r["f"]], {})[r["b"]] = (r["g"], r["h"], r["n"])
    return out


def _totals(sums: dict[str, dict[int, tuple]]) -> tuple[float, float, int]:
    any_feature = sums[min(sums)]
    return tuple(sum(v[k] for v in any_feature.values()) for k in range(3))


def _best_split(sums: dict[str, dict[int, tuple]], cuts: dict[str, list[float]]) -> tuple | None:
    """(feature, threshold, left totals, right totals) of the split that gains most."""
    g, h, n = _totals(sums)
    best, where = 1e-6, None
    for name in sorted(sums):
        gl = hl = nl = 0.0
        for b, at in enumerate(cuts[name]):
            dg, dh, dn = sums[name].get(b, (0.0, 0.0, 0))
            gl, hl, nl = gl + dg, hl + dh, nl + dn
            if nl < LEAST or n - nl < LEAST:
                continue
            gain = gl * gl / (hl + RIDGE) + (g - gl) ** 2 / (h - hl + RIDGE) - g * g / (h + RIDGE)
            if gain > best * (1 + 1e-9) + 1e-9:
                best, where = gain, (name, float(at), (gl, hl, nl), (g - gl, h - hl, n - nl))
    return where


@dataclass
class UrlModel:
    trees: Trees
    shares: dict[str, DataFrame]  # suffix, share of bad labels; one table a kind of suffix
    general: float


def _with_shares(rows: DataFrame, suffixes: dict[str, Column], shares: dict[str, DataFrame], general: float, names: dict[str, str]) -> DataFrame:
    for kind in SUFFIXES:
        key = free_name(rows, f"{kind}_suffix")
        known = shares[kind].select(F.col("suffix").alias(key), F.col("share").alias(names[kind]))
        rows = rows.join(known, suffixes[kind] == F.col(key), "left").drop(key)
        rows = rows.withColumn(names[kind], F.coalesce(F.col(names[kind]), F.lit(general)))
    return rows


def learnt(urls: DataFrame) -> UrlModel:
    """A model from urls(url, bad); bad is 1 for urls to block."""
    rows = urls.where("bad in (0, 1)").select(F.col("url").cast("string").alias("url"), F.col("bad").cast("int").alias("y"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    numbers, suffixes = lexical(rows, "url", "host", "path")
    rows = cut_lineage(rows.select("y", "host", "path", *[c.alias(n) for n, c in numbers.items()]), "urls")
    general = rows.agg(F.avg("y").alias("m")).first()["m"] or 0.0
    shares = {
        kind: cut_lineage(rows.groupBy(suffixes[kind].alias("suffix")).agg(
            ((F.sum("y") + PRIOR * general) / (F.count("*") + PRIOR)).alias("share")), f"suffix_{kind}")
        for kind in SUFFIXES}
    names = {kind: f"{kind}_share" for kind in SUFFIXES}
    train = cut_lineage(_with_shares(rows, suffixes, shares, general, names).drop("host", "path"), "train")
    return UrlModel(grown(train, [*numbers, *names.values()]), shares, general)


def judged(pages: DataFrame, model: UrlModel, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """pages with host, path, rule, verdict and score (of the trees), under names that pages leaves free."""
    host, path, rule, verdict, score = (free_name(pages, n) for n in ("host", "path", "rule", "verdict", "score"))
    rows = pages.withColumns({host: host_of(F.col("url").cast("string")), path: path_of(F.col("url").cast("string"))})
    numbers, suffixes = lexical(rows, "url", host, path)
    inside = {n: free_name(rows, f"url_{n}") for n in numbers}
    names = {kind: free_name(rows, f"url_{kind}_share") for kind in SUFFIXES}
    rows = _with_shares(rows.withColumns({inside[n]: c for n, c in numbers.items()}), suffixes, model.shares, model.general, names)
    place = inside | {f"{kind}_share": names[kind] for kind in SUFFIXES}
    number = first_rule(F.col(host), F.col(path), rules)
    texts, verdicts = F.array(*[F.lit(r.text) for r in rules]), F.array(*[F.lit(r.verdict) for r in rules])
    p = 1 / (1 + F.exp(-model.trees.margin(lambda n: F.col(place[n]))))
    by_trees = F.when(p >= threshold, "block").otherwise("allow")
    return rows.select(
        *[F.col(c) for c in pages.columns], host, path, F.when(number.isNotNull(), texts[number]).alias(rule),
        F.when(number.isNotNull(), verdicts[number]).otherwise(by_trees).alias(verdict), p.alias(score))


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad) of pages that hold a labelled document: the first number of a page's path is the document's id."""
    number = F.regexp_extract(path_of(F.col("url").cast("string")), r"/([0-9]{1,18})(?:[^0-9]|$)", 1)
    marked = labels.where("quality is not null or toxic is not null").groupBy("doc_id").agg(
        F.max(((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int")).alias("bad"))
    known = pages.select("url", F.when(number != "", number.cast("long")).alias("doc_id"))
    return known.join(marked, "doc_id").select("url", "bad")
