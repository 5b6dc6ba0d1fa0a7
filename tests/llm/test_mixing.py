"""Given target weights of the mix."""

import math

import pytest

from labelloom.llm import mixing


def positions(spark, weights, slots):
    docs = spark.createDataFrame([(i, s) for i, s in enumerate((["a"] * 400 + ["b"] * 400 + [None] * 200))], "doc_id long, source string")
    table = spark.createDataFrame(weights, "source string, weight double")
    mixed = mixing.mix_sources(docs, block_rows=4, slots=slots, weights=table).collect()
    assert sorted(r.position for r in mixed) == list(range(1000))
    return [r.source for r in sorted(mixed, key=lambda r: r.position)]


@pytest.mark.parametrize("weights", [[("a", 5.0), ("b", 3.0), (None, 2.0)], [("a", 0.2), ("a", 0.3), ("b", 0.3), (None, 0.2), ("zz", None)]])
def test_every_source_stays_within_one_block_of_its_given_weight(spark, weights):
    got = positions(spark, weights, 10)
    for source, share in (("a", 0.5), ("b", 0.3), (None, 0.2)):
        for blocks in range(1, 101):  # until the first source runs out
            have = sum(s == source for s in got[: blocks * 4]) / 4
            assert math.fabs(have - share * blocks) < 1


def test_sources_without_a_usable_weight_have_one_slot_of_a_round(spark):
    got = positions(spark, [("a", 1.0), ("b", -3.0), (None, float("nan"))], 8)
    assert [sum(s == x for s in got[:40]) for x in ("a", "b", None)] == [32, 4, 4]
    even = positions(spark, [("other", 1.0)], 8)
    assert [sum(s == x for s in even[:12]) for x in ("a", "b", None)] == [4, 4, 4]
