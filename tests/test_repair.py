"""Repairs carried back to cards, evidence by field, addresses of enriched cards, on hand-made rows."""

from caseloom.operators import cards as cd
from caseloom.operators import extract
from caseloom.operators import quality as qa

ADDRESS = "uid string, ord int, address string, chain string, role string, note string"


def test_hashes_and_implied_chains_reach_the_card(spark):
    tx, own = "0x" + "a" * 64, "0x" + "b" * 64
    rows = [("u", 1, tx, "ETH", "attacker", ""), ("u", 2, own, "ETH", "attacker", ""), ("u", 3, "bc1qxyz", "", "victim", ""),
            ("u", 4, "TAddress", "", "victim", ""), ("u", 5, "bc1qother", "", "victim", ""), ("v", 1, "bad", "", "unknown", ""),
            ("w", 1, "0xdead", "ETH", "attacker", "attack tx")]
    labels = [(tx, "txhash", "", "evm", "", None), (own, "txhash", "", "evm", "", None), ("bc1qxyz", "wallet", "", "btc", "Bitcoin", None),
              ("TAddress", "wallet", "", "tron", "Tron", None), ("bc1qother", "wallet", "", "btc", "Bitcoin", None), ("bad", "invalid", "", "btc", "Bitcoin", None),
              ("0xdead", "unfunded", "", "evm", "", None)]
    labels = spark.createDataFrame([(*x, "", False) for x in labels],
                                   "key string, kind string, ctype string, family string, chain string, fixed string, reason string, rpc_failed boolean")
    repaired = qa.repair_addresses(spark.createDataFrame(rows, ADDRESS), labels)
    cards = spark.createDataFrame([("u", ["TRX", "eth"], [own]), ("v", [], []), ("w", None, None), ("x", ["Base"], ["h"])],
                                  "uid string, chains array<string>, tx_hashes array<string>")
    got = {r.uid: (r.chains, r.tx_hashes) for r in qa.apply_repairs(cards, repaired).collect()}
    assert got == {"u": (["TRX", "eth", "Bitcoin"], [own, tx]), "v": ([], []), "w": ([], []), "x": (["Base"], ["h"])}
    log = {(r.uid, r.ord, r.change): r.after for r in qa.repair_log(repaired).collect()}
    assert log["u", 1, "tx_hash_moved"] is None and log["v", 1, "invalid_removed"] is None and log["w", 1, "truncated_tx_removed"] is None
    assert log["u", 3, "implies Bitcoin"] == "bc1qxyz" and ("v", 1, "implies Bitcoin") not in log


def test_evidence_of_every_field(spark):
    text = "On May 3 2024 Orbit Bridge lost $12.5 million in an exploit of its oracle. " + "More words follow. " * 25
    patches = spark.createDataFrame([
        ("a", "on may 3 2024", 12_500_000.0, "lost $12.5 million", "exploit of its oracle", "Orbit Bridge"),
        ("b", "on june 9", 99.0, "lost $12.5 million", "short", "software developers"),
        ("c", None, None, None, None, None), ("gone", "on may 3 2024", 1.0, "x", "y", "Orbit")],
        "uid string, p_date_evidence string, p_amount double, p_amount_evidence string, p_type_evidence string, p_project string")
    texts = spark.createDataFrame([(u, text) for u in "abc"], "uid string, text string")
    got = {}
    for r in extract.field_evidence(patches, texts).collect():
        got.setdefault(r.uid, {})[r.field] = r.found
    every = ("date", "amount", "type", "project")
    assert got["a"] == dict.fromkeys(every, True) and got["b"] == dict.fromkeys(every, False)
    assert not any(got["c"].values()) and not any(got["gone"].values()) and set(got) == {"a", "b", "c", "gone"}


def test_addresses_of_enriched_cards_in_order(spark):
    def rows(*r):
        return spark.createDataFrame([("u", *x) for x in r], ADDRESS)
    given = rows((1, "0xAB", "ETH", "unknown", ""), (2, "0xCD", "ETH", "victim", "own"))
    proposed = rows((0, "0xab", "eth", "attacker", "drainer"), (1, "0xEE", "BSC", "unknown", ""))
    found = rows((0, "0xcd", "ETH", "unknown", ""), (1, "0xff", "ETH", "unknown", ""), (2, "0xee", "ETH", "unknown", ""))
    got = [tuple(r)[1:] for r in cd.card_addresses(given, proposed, found).orderBy("ord").collect()]
    assert got == [(1, "0xAB", "ETH", "attacker", "drainer"), (2, "0xCD", "ETH", "victim", "own"), (3, "0xEE", "BSC", "unknown", ""),
                   (4, "0xff", "ETH", "unknown", ""), (5, "0xee", "ETH", "unknown", "")]
