
from __future__ import annotations

from __spark_entry__ import entry, queries

SF001 = "/root/testdata/sf0.01"
Q = queries()


def test_top3_sf0001(spark):
    assert [tuple(r) for r in entry(spark).collect()] == [
        ("PROMO", 1164), ("ECONOMY", 1066), ("MEDIUM", 985)]


def test_sf001_facts(spark):
    got = [tuple(r) for r in Q["top3_news"](spark, SF001).collect()]
    assert [g[0].split()[0] for g in got] == ["MEDIUM", "STANDARD", "LARGE"]
    assert [g[1] for g in got] == [10576, 10254, 10223]
    colours = {r.colour: r["count"] for r in Q["favourite_colour"](spark, SF001).collect()}
    assert colours == {"click": 24, "error": 30, "purchase": 30, "signup": 31, "view": 35}
    assert Q["word_count"](spark, SF001).count() == 54084  # distinct words
    assert Q["tumbling_count"](spark, SF001).count() == 9997
    assert Q["session_count"](spark, SF001).count() == 9919
    assert Q["recharge_match"](spark, SF001).count() == 8
    assert Q["bank_balance_aggregate"](spark, SF001).count() == 150
