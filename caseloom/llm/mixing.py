"""Mixing sources to target weights by temperature, with DataFrame functions only.

Source shares of tokens are raised to an exponent in [0, 1] and normalised. The exponent is bisected: the smallest one
at which no source is repeated more than `max_epochs` times under the budget, or the one at which the weights reach a
target entropy; every pass over the source table makes `STEPS` halvings at once. The weights times the budget are token
quotas. Each source's documents are dealt by hash into blocks of about `block_tokens`, anew for every epoch; an epoch
takes the blocks in their hashed order, so a quota is a number of whole epochs, then whole blocks, then the documents
of one block in hashed order until the quota is met. Prefix sums run over blocks, and over the documents of one block,
never over all documents of a source.

Defined cases. Null source: a source of its own. Null or empty text: 0 tokens, taken in every whole epoch and with the
block it falls into. Rows that share an id and a text are taken or left together. Without tokens at all every row is
taken once. Other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.frames import free_name
from caseloom.session import cut_lineage

STEPS, PASSES = 4, 10  # 40 halvings of [0, 1]
BLOCK_TOKENS, BLOCK_ROWS = 1 << 16, 1 << 12  # of a block on average, whichever is met first


@dataclass(frozen=True)
class Mix:
    """budget: tokens to take, as a share of all tokens; one of max_epochs and entropy (nats) sets the exponent."""

    budget: float = 1.0
    max_epochs: float | None = 2.0
    entropy: float | None = None
    block_tokens: int = BLOCK_TOKENS
    seed: int = 11


def n_tokens(text: str | Column = "text") -> Column:
    """White-space separated words of a text."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def weighed(sources: DataFrame, mix: Mix) -> DataFrame:
    """sources(source, tokens) with weight and quota, and the exponent that gave them; sources without tokens weigh nothing."""
    live = sources.where("tokens > 0")
    total = live.agg(F.sum("tokens").alias("t")).first()["t"]
    if not total:
        return sources.withColumns({"exponent": F.lit(1.0), "weight": F.lit(0.0), "quota": F.lit(0.0)})
    share = F.col("tokens") / F.lit(float(total))
    exponent = _bisected(live.select("tokens", share.alias("p")), float(total), mix)
    power = F.when(F.col("tokens") > 0, F.pow(share, F.lit(exponent))).otherwise(0.0)
    norm = sources.agg(F.sum(power).alias("z")).first()["z"]
    return sources.withColumns({
        "exponent": F.lit(exponent), "weight": F.round(power / F.lit(norm), 12),
        "quota": F.round(power / F.lit(norm) * F.lit(float(total) * mix.budget), 3)})


def _bisected(shares: DataFrame, total: float, mix: Mix) -> float:
    """The smallest exponent in [0, 1] that meets the limit; both measures fall as it grows."""
    low, high, parts = 0.0, 1.0, 2**STEPS

    def too_flat(at: float) -> list[Column]:
        power = F.pow("p", F.lit(at))
        z = F.sum(power)
        if mix.entropy is not None:  # entropy of p^a / z is log z - a * sum(p^a log p) / z
            return [F.log(z) - F.lit(at) * F.sum(power * F.log("p")) / z > F.lit(mix.entropy)]
        return [F.max(power / F.col("tokens")) / z * F.lit(total * mix.budget) > F.lit(mix.max_epochs)]

    if mix.entropy is None and mix.max_epochs is None:
        return 1.0
    for _ in range(PASSES):
        points = [low + (high - low) * k / parts for k in range(parts)]
        row = shares.agg(*[c.alias(f"c{k}") for k, at in enumerate(points) for c in too_flat(at)]).first()
        flat = [k for k in range(parts) if row[k]]
        if not flat:
            return low
        low, high = points[flat[-1]], points[flat[-1] + 1] if flat[-1] + 1 < parts else high
    return high


def epochs(docs: DataFrame, mix: Mix = Mix(), source: str = "source", copies: str = "copies", weight: str = "weight") -> DataFrame:
    """docs with two more columns: the weight of the row's source and the times the row is taken."""
    copies, weight, ident, key = (free_name(docs, n) for n in (copies, weight, "mix_id", "mix_source"))
    narrow = cut_lineage(docs.select(F.col(source).alias("source"), same_row_of(docs).alias("ident"), n_tokens().alias("tokens")), "tokens")
    sources = cut_lineage(narrow.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), "sources")
    live = F.col("tokens") > 0
    targets = cut_lineage(weighed(sources, mix).select(
        "source", "weight",
        F.when(live, F.floor(F.col("quota") / F.col("tokens"))).otherwise(1).cast("int").alias("whole"),
        F.when(live, F.col("quota") - F.floor(F.col("quota") / F.col("tokens")) * F.col("tokens")).otherwise(0.0).alias("rest"),
        F.ceil(F.greatest(F.col("tokens") / mix.block_tokens, F.col("docs") / BLOCK_ROWS, F.lit(1))).alias("blocks")), "targets")

    place = F.xxhash64(F.lit(mix.seed), "whole", "ident")
    block = F.pmod(place, F.col("blocks"))
    dealt = narrow.join(targets.where("rest > 0").withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "source", "rest", "tokens", place.alias("place"), block.alias("block"))
    by_block = dealt.groupBy("source", "block").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    through = F.sum("tokens").over(Window.partitionBy("source").orderBy("block"))
    cut = by_block.withColumn("left", F.col("rest") - (through - F.col("tokens"))).where("left > 0 and left <= tokens").select(
        "source", F.col("block").alias("cut_block"), "left")
    cut = cut_lineage(cut, "cuts")
    edge = dealt.join(cut.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("cut_block")))
    before = F.sum("tokens").over(Window.partitionBy("source").orderBy("place")) - F.col("tokens")
    last = edge.withColumn("before", before).where("before < left").groupBy("source", "cut_block").agg(F.max("place").alias("cut_place"))
    limits = cut_lineage(targets.join(last.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left").select(
        F.col("source").alias(key), "weight", "whole", "blocks", "cut_block", "cut_place"), "limits")

    limits = limits.select(key, F.struct("weight", "whole", "blocks", "cut_block", "cut_place").alias(ident))
    joined = docs.join(limits, docs[source].eqNullSafe(limits[key]))
    part = {n: limits[ident][n] for n in ("whole", "blocks", "cut_block", "cut_place")}
    spot = F.xxhash64(F.lit(mix.seed), part["whole"], same_row_of(docs))
    slot = F.pmod(spot, part["blocks"])
    more = (slot < part["cut_block"]) | ((slot == part["cut_block"]) & (spot <= part["cut_place"]))
    return joined.select(*[docs[c] for c in docs.columns], limits[ident]["weight"].alias(weight),
                         (part["whole"] + F.coalesce(more, F.lit(False)).cast("int")).alias(copies))


def same_row_of(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"], docs["text"])


def mixed(docs: DataFrame, mix: Mix = Mix(max_epochs=1.0, budget=0.9), source: str = "source") -> DataFrame:
    """Pipeline form: rows of docs, each as many times as it is taken."""
    copies, weight = free_name(docs, "copies"), free_name(docs, "weight")
    taken = epochs(docs, mix, source, copies, weight).where(F.col(copies) > 0)
    repeat = free_name(docs, "epoch")
    return taken.withColumn(repeat, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(docs.columns)
