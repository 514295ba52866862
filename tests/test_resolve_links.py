"""Links between date cells: the components of all compatible pairs, without the pairs."""

import datetime as dt
import random

from pyspark.sql import functions as F

from caseloom.operators import resolve

DAY = dt.date(2024, 1, 1)
NODES = "scope date, fam string, node string, inc date, pub date, lb boolean, uid string"


def roots(uids, edges):
    up = {u: u for u in uids}

    def top(u):
        while up[u] != u:
            up[u] = up[up[u]]
            u = up[u]
        return u

    for a, b in edges:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    return {u: top(u) for u in uids}


def test_date_classes_connect_what_the_date_rule_does(spark):
    rng = random.Random(11)

    def day():
        return None if rng.random() < 0.3 else DAY + dt.timedelta(rng.randint(0, 60))

    rows, pairs, n = [], [], 0
    for group in range(120):
        scope = DAY + dt.timedelta(7 * group)
        for name in "pqr":
            for _ in range(rng.randint(0, 4)):
                rows.append((scope, rng.choice(["legal", "attack"]), name, day(), day(), rng.random() < 0.2, f"u{n:05d}"))
                n += 1
            pairs.append((scope, name, name))
        if rng.random() < 0.7:
            pairs += [(scope, "p", "q"), (scope, "q", "p")]
    nodes = spark.createDataFrame(rows, NODES)
    met = spark.createDataFrame(pairs, "scope date, x string, y string")
    edges = resolve.fuzzy_links(nodes, met).unionByName(resolve.star(resolve.date_cells(nodes), ["key"]))
    got = roots([r[6] for r in rows], [(r.a, r.b) for r in edges.collect()])
    side = [nodes.select("scope", "fam", *[F.col(c).alias(f"{c}_{t}") for c in ("node", "inc", "pub", "lb", "uid")]) for t in "xy"]
    both = side[0].join(side[1], ["scope", "fam"]).where("uid_x < uid_y").join(
        met.toDF("scope", "node_x", "node_y"), ["scope", "node_x", "node_y"], "left_semi").where(resolve.dates_fit("x", "y"))
    want = roots([r[6] for r in rows], [(r.uid_x, r.uid_y) for r in both.select("uid_x", "uid_y").collect()])
    assert got == want and len(set(want.values())) < len(rows)


def test_cells_of_a_name_give_edges_not_pairs(spark):
    """600 cells of one legal name, all compatible: 180,000 pairs before, a few edges a cell now."""
    nodes = spark.range(600).select(
        F.lit(DAY).alias("scope"), F.lit("legal").alias("fam"), F.lit("n:harbourtrust").alias("node"),
        F.date_add(F.lit(DAY), (F.col("id") / 8).cast("int")).alias("inc"), F.date_add(F.lit(DAY), F.col("id").cast("int") % 8).alias("pub"),
        F.lit(False).alias("lb"), F.format_string("u%05d", "id").alias("uid"))
    met = nodes.select("scope", F.col("node").alias("x"), F.col("node").alias("y")).distinct()
    edges = resolve.fuzzy_links(nodes, met).collect()
    assert len(edges) < 6 * 600
    assert len(set(roots([f"u{i:05d}" for i in range(600)], [(r.a, r.b) for r in edges]).values())) == 1


def test_a_star_has_no_edges_for_null_keys(spark):
    rows = [(DAY, "k", "c"), (DAY, "k", "a"), (DAY, "k", "b"), (DAY, "k", "b"), (DAY, None, "d"), (DAY, None, "e"), (None, "k", "f"), (None, "k", "g")]
    edges = resolve.star(spark.createDataFrame(rows, "scope date, key string, uid string"), ["scope", "key"])
    assert sorted((r.a, r.b) for r in edges.collect()) == [("a", "b"), ("a", "c")]
