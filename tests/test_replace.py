"""What storing cards writes."""

import datetime as dt

from caseloom.operators import tables
from caseloom.session import scratch_path


def test_a_first_store_is_written_once(spark, monkeypatch):
    cut, kept = tables.cut_lineage, []
    monkeypatch.setattr(tables, "cut_lineage", lambda df, name="step": (kept.append(name), cut(df, name))[1])
    day, path = dt.date(2024, 1, 1), scratch_path(spark, "stored")
    cards = spark.createDataFrame([("a", day, "p"), ("b", day, "q")], "uid string, coll_day date, project string")
    addresses = spark.createDataFrame([("a", "ETH", "0x1", day), ("b", "ETH", "0x2", day)], "uid string, chain string, address string, first_seen date")
    tables.replace_cards(spark, path, cards, addresses)
    assert kept == ["cards"]  # the addresses went straight into the store
    tables.replace_cards(spark, path, cards.where("uid = 'a'"), addresses.limit(0))
    assert sorted(r.uid for r in tables.stored_cards(spark, path).collect()) == ["a", "b"]
    assert [r.uid for r in tables.stored_addresses(spark, path).collect()] == ["b"]
