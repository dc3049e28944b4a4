"""That the rule matcher does each dear step once, below its joins."""

from kinfold.operators import rules
from tests.test_size import SF, plan, table


def test_words_of_addresses_are_found_below_the_join(spark):
    r = table(spark, [("S1-1", "S1", 1, "US", "amber", "cedar road"), ("S2-1", "S2", 1, "US", "amber", "cedar lane")])
    assert "array_distinct" not in plan(rules.name_hits(*rules.sides(r)), "optimizedPlan").split("Join")[0]


def test_hits_are_dealt_once(spark):
    r = table(spark, [("S1-1", "S1", 1, "US", "amber", "cedar road"), ("S2-1", "S2", 1, "US", "amber", "cedar lane")])
    assert plan(rules.rule_pairs(r)).count("Exchange hashpartitioning(s1_id") == 1


def test_streamed_records_are_normalized_once(spark):
    from kinfold.plans import adapter
    from kinfold.streaming.match import stream_matches

    r, e = adapter.records(spark, SF), adapter.entities(spark, SF).where("source <> 'S1'")
    found = stream_matches(r, e)
    first, rest = rules.sides(r)
    want = rules.address_hits(first, rest).unionByName(rules.name_hits(first, rest)).where("match").select("s1_id", "cand_id")
    assert want.count() > 0 and found.exceptAll(want).count() == 0 and want.exceptAll(found).count() == 0
    assert plan(found).count("ArrowEvalPython") <= 4  # a name and an address of each of three tables' records at most, once
