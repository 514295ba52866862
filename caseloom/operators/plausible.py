"""Pairs of cards worth an outside verdict, generated without expanding a busy chain or word into pairs.

The pairs of the rule may grow with the square of a busy day, so they are given as ranges. Cards stand in cells, sorted;
a row of `reach` says that its card is plausible with every card of a cell from place `first` to `last`, itself aside.
Rows grow with cards times their chains or words times the days in reach. A pair may lie in several ranges; `pairs`
expands them, for a caller who has chosen cards or cells.

Cells of attacks hold one slot and one chain. A slot is a day of the incident (`i`), or a publication day of cards
without (`p0`) and with (`p1`) an incident date, as the rule compares incident dates where both sides have one.
Inside, by amount: one power of two, sorted by amount, as a ratio between a half and two is a range there. Where a side
has no amount, by shared word of the name, or by name where names are alike in trigrams; cells with a capital letter hold
the cards without amount only. (Amounts are losses, above zero; a negative one meets nothing.) Cells of legal cards hold one publication day and one word.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions import text as tx
from caseloom.functions.alike import alike
from caseloom.operators.ranking import numbered, running_sum
from caseloom.operators.resolve import profiles
from caseloom.session import cut_lineage, passing_steps, spread

NEAR_DAYS, LEGAL_DAYS, NAME_ALIKE, RATIO = 3, 5, 0.3, 2.0
WINDOW_DAYS = 4 * NEAR_DAYS  # a card stands in one or two windows of these, and looks into one for each day
BLOCK = 8192  # names that one task compares with as many


def _inputs(cards: DataFrame) -> DataFrame:
    """Rule inputs of the relevant cards, written once."""
    cards = spread(cards)
    more = cards.select(
        "uid", F.array_distinct(F.transform("chains", lambda c: F.lower(c))).alias("chains"),
        tx.legal_words(F.col("project"), F.col("title"), F.array_join(F.slice("actors", 1, 5), " ")).alias("words"))
    p = profiles(cards).select("uid", "fam", "inc", "pub", "amount", "norm", "toks")
    return cut_lineage(p.join(more, "uid"), "inputs")


def _slot(kind: str, day: Column) -> Column:
    return F.concat(F.lit(kind), F.date_format(day, "yyyy-MM-dd"))


def _days(day: str, before: int, after: int) -> Column:
    return F.transform(F.sequence(F.lit(-before), F.lit(after)), lambda o: F.date_add(F.col(day), o))


def _standing(attacks: DataFrame) -> DataFrame:
    """The slots a card stands in: (.., slot)."""
    own = F.array_compact(F.array(
        F.when(F.col("inc").isNotNull(), _slot("i", F.col("inc"))),
        F.when(F.col("pub").isNotNull(), _slot("p", F.col("pub"))),
    ))
    slots = F.transform(own, lambda s: F.when(s.startswith("p"), F.concat(
        F.when(F.col("inc").isNull(), F.lit("p0 ")).otherwise(F.lit("p1 ")), F.substring(s, 2, 10))).otherwise(
        F.concat(F.lit("i "), F.substring(s, 2, 10))))
    return attacks.withColumn("slot", F.explode(slots))


def _seeking(attacks: DataFrame) -> DataFrame:
    """The slots a card looks into: (.., slot, own). Later ones of its own kind suffice, as the other side looks back.

    own: whether it stands there itself; whoever counts the cards of a cell leaves it out by that, without a look at the members.
    """
    def slots(kind: str, days: Column) -> Column:
        return F.transform(days, lambda d: _slot(kind, d))

    by_inc = slots("i ", _days("inc", 0, NEAR_DAYS))
    by_pub = F.concat(slots("p0 ", _days("pub", 0, NEAR_DAYS)), slots("p1 ", _days("pub", NEAR_DAYS, NEAR_DAYS)))
    none = F.array().cast("array<string>")
    sought = attacks.withColumn("slot", F.explode(F.when(F.col("inc").isNotNull(), by_inc).when(F.col("pub").isNotNull(), by_pub).otherwise(none)))
    stands = F.when(F.col("inc").isNotNull(), _slot("i ", F.col("inc"))).otherwise(_slot("p0 ", F.col("pub")))
    return sought.withColumn("own", F.col("slot") == stands)


def _key(kind: str, *parts: str | Column) -> Column:
    return F.concat_ws("|", F.lit(kind), *parts).alias("cell")


def _power(amount: Column) -> Column:
    return F.floor(F.log2(amount)).cast("int")


def _by_amount(standing: DataFrame, seeking: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (cell, uid, amount) and reach (uid, cell, first, last, own) of cards with amounts.

    Places come from running counts of the members below a half and up to twice a card's amount, so its own lies between.
    """
    held = F.col("amount") > 0
    members = standing.where(held).select(_key("a", "slot", "chain", _power(F.col("amount")).cast("string")), "uid", "amount")
    low, high = F.col("amount") / RATIO, F.col("amount") * RATIO
    asked = seeking.where(held).select("uid", "slot", "chain", "own", _power(F.col("amount")).alias("power"), low.alias("low"), high.alias("high"), F.explode(
        F.sequence(_power(low), _power(high))).alias("bin")).select(
        "uid", "low", "high", (F.col("own") & (F.col("bin") == F.col("power"))).alias("own"), _key("a", "slot", "chain", F.col("bin").cast("string")))
    asked = asked.join(members.select("cell").distinct(), "cell", "left_semi")
    none = F.lit(None).cast("string")
    points = members.select("cell", F.col("amount").alias("at"), F.lit(1).alias("pos"), none.alias("uid"), F.lit(False).alias("own"), F.lit(1).alias("one")).unionByName(
        asked.select("cell", F.col("low").alias("at"), F.lit(0).alias("pos"), "uid", "own", F.lit(0).alias("one"))).unionByName(
        asked.select("cell", F.col("high").alias("at"), F.lit(2).alias("pos"), "uid", "own", F.lit(0).alias("one")))
    counted = running_sum(points, ["cell"], ["at", "pos", "uid"], "one", "below").where("uid is not null")
    reach = counted.groupBy("uid", "cell").agg(
        (F.max(F.when(F.col("pos") == 0, F.col("below"))) + 1).alias("first"), F.max(F.when(F.col("pos") == 2, F.col("below"))).alias("last"),
        F.max("own").alias("own"))
    return members, reach.where("first <= last")


def _whole(members: DataFrame, asked: DataFrame) -> DataFrame:
    """Reach of cards that look for whole cells, (uid, cell, own)."""
    sizes = members.groupBy("cell").agg(F.count("*").alias("last"))
    return asked.join(sizes, "cell").select("uid", "cell", F.lit(1).cast("long").alias("first"), "last", "own").distinct()


def _both(tag: str, rows: DataFrame, *parts: str) -> DataFrame:
    """Members of the cells of all cards, and of those of the cards without amount."""
    every = rows.select(_key(tag, *parts), "uid")
    return every.unionByName(rows.where("amount is null").select(_key(tag.upper(), *parts), "uid"))


def _asked(tag: str, rows: DataFrame, *parts: str) -> DataFrame:
    """A card without amount looks for all cards, others for those without."""
    kind = F.when(F.col("amount").isNull(), F.lit(tag)).otherwise(F.lit(tag.upper()))
    return rows.select("uid", F.concat_ws("|", kind, *parts).alias("cell"), (F.col("own") & F.col("amount").isNull()).alias("own"))


def _by_word(standing: DataFrame, seeking: DataFrame) -> tuple[DataFrame, DataFrame]:
    members, asked = (f("w", rows.withColumn("word", F.explode("toks")), "slot", "chain", "word") for f, rows in ((_both, standing), (_asked, seeking)))
    return members, _whole(members, asked)


def _window(day: Column) -> Column:
    return F.floor(day / WINDOW_DAYS)


def _slot_day() -> Column:
    return F.unix_date(F.to_date(F.split("slot", " ")[1]))


def _bin(window: Column) -> Column:
    return F.concat_ws("|", "chain", window.cast("string"))


def open_names(standing: DataFrame) -> DataFrame:
    """(bin, norm, open): the names of a chain and window of days; open are those of a card without amount.

    A card stands in every window that cards NEAR_DAYS away look into; bins without an open name are left out later.
    """
    windows = F.array_distinct(F.array(_window(_slot_day() - NEAR_DAYS), _window(_slot_day() + NEAR_DAYS)))
    placed = standing.select("chain", "norm", F.col("amount").isNull().alias("open"), F.explode(windows).alias("window"))
    return placed.groupBy(_bin(F.col("window")).alias("bin"), "norm").agg(F.max("open").alias("open"))


def dealt_names(names: DataFrame, block: int = BLOCK) -> DataFrame:
    """(bin, i, j, norm, open, asks): names dealt to cells of at most about `block` open names and `block` names.

    Open names are compared with all of their bin. A bin of one block has one cell, and a name that is not open one row.
    """
    sizes = names.groupBy("bin").agg(F.ceil(F.count("*") / block).alias("blocks"), F.ceil(F.count_if("open") / block).alias("opens"))
    spot = F.xxhash64("norm")

    def cells(i: Column, j: Column, asks: bool) -> Column:
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(asks).alias("asks"))

    def upto(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n).cast("int") - 1)

    held = F.transform(upto("opens"), lambda i: cells(i, F.pmod(spot, F.col("blocks")), False))
    asks = F.transform(upto("blocks"), lambda j: cells(F.pmod(spot, F.col("opens")), j, True))
    both = F.when(F.col("open"), F.concat(held, asks)).otherwise(held)
    return names.join(sizes.where("opens > 0"), "bin").select("bin", "norm", "open", F.explode(both).alias("c")).select(
        "bin", "c.i", "c.j", "norm", "open", "c.asks")


def _alike_in_cell(cell: pa.Table) -> pa.Table:
    asks = cell["asks"].to_numpy()
    norm, open_ = np.array(cell["norm"].to_pylist(), dtype=object), cell["open"].to_numpy()
    asked, held, held_open = norm[asks], norm[~asks], open_[~asks]
    one, other = [], []
    for i, near in alike(list(asked), list(held), NAME_ALIKE):
        near = near[held[near] != asked[i]]
        one += [asked[i]] * len(near)
        other += list(held[near])
        back = held[near[~held_open[near]]]  # an open one finds its way back by itself
        one += list(back)
        other += [asked[i]] * len(back)
    return pa.table({"bin": pa.array([cell["bin"][0].as_py()] * len(one), pa.string()), "norm": pa.array(one, pa.string()), "name": pa.array(other, pa.string())})


def alike_names(names: DataFrame, block: int = BLOCK) -> DataFrame:
    """(bin, norm, name): different names of a bin alike in trigrams, both ways, one of them open at least."""
    return dealt_names(names, block).groupBy("bin", "i", "j").applyInArrow(_alike_in_cell, "bin string, norm string, name string").select(
        "bin", "norm", "name")


def _by_name(standing: DataFrame, seeking: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names alike in trigrams, among the distinct names of one chain and window of days that holds a card without amount.

    Of two cards one has no amount, so only names of such cards are compared with the others.
    """
    pairs = cut_lineage(alike_names(cut_lineage(open_names(standing), "names")), "alike")
    members = _both("n", standing, "slot", "chain", "norm")
    others = seeking.withColumn("bin", _bin(_window(_slot_day()))).join(pairs, ["bin", "norm"]).withColumn("own", F.lit(False))
    return members, _whole(members, _asked("n", seeking, "slot", "chain", "norm").unionByName(_asked("n", others, "slot", "chain", "name")))


def _by_release(p: DataFrame) -> tuple[DataFrame, DataFrame]:
    legal = p.where("fam = 'legal' and pub is not null").withColumn("word", F.explode("words"))
    members = legal.select(_key("l", F.date_format("pub", "yyyy-MM-dd"), "word"), "uid")
    asked = legal.withColumn("day", F.explode(_days("pub", 0, LEGAL_DAYS))).select(
        "uid", _key("l", F.date_format("day", "yyyy-MM-dd"), "word"), (F.col("day") == F.col("pub")).alias("own"))
    return members, _whole(members, asked)


@passing_steps()
def plausible_reach(cards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """members (cell, place, uid) and reach (uid, cell, first, last, n) over all relevant cards.

    n counts the cards of the range other than the card itself; ranges of the card alone are left out. Each kind of cell
    is written by itself, so that one kind's shuffle files are gone when the next one's are made.
    """
    p = _inputs(cards)
    attacks = p.where("fam <> 'legal'").withColumn("chain", F.explode("chains"))
    standing, seeking = cut_lineage(_standing(attacks), "standing"), _seeking(attacks)
    n = F.col("last") - F.col("first") + 1 - F.col("own").cast("long")
    members, found = [], []
    for make in (lambda: _by_amount(standing, seeking), lambda: _by_word(standing, seeking), lambda: _by_name(standing, seeking), lambda: _by_release(p)):
        with passing_steps():
            m, r = make()
            found.append(cut_lineage(r.withColumn("n", n).where("n > 0").select("uid", "cell", "first", "last", "n"), "reach", lasting=2))
        members.append(m if "amount" in m.columns else m.withColumn("amount", F.lit(None).cast("double")))
    placed = numbered(reduce(DataFrame.unionByName, members), ["cell"], ["amount", "uid"], "place").select("cell", "place", "uid")
    return cut_lineage(placed, "placed", lasting=1), reduce(DataFrame.unionByName, found)


def pairs(placed: DataFrame, reach: DataFrame) -> DataFrame:
    """(uid_a, uid_b) of the given ranges, each once."""
    met = reach.select("cell", "first", "last", F.col("uid").alias("one")).join(placed, "cell").where("place between first and last and uid <> one")
    return met.select(F.least("one", "uid").alias("uid_a"), F.greatest("one", "uid").alias("uid_b")).distinct()
