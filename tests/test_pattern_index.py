"""Fragments by an index of grams against a test of every fragment on every name."""

import random

import pytest
from flowtide.operators import lookups, pattern_index
from flowtide.sources import settle

from tests.helpers import plan, rows

NAMES = ["UBS Financial and UBS Securities", "Wells Fargo via LPL", "edward jones trust", "Independent", "", "ab", None]


def tables(spark, names, fragments):
    left = spark.createDataFrame([(n,) for n in names], "organization_name string")
    return left, spark.createDataFrame(fragments, "fragment string, firm string")


def brute(names, fragments, dedupe=True):
    listed = {n for n in names if n is not None}
    found = [(n, firm) for n in listed for f, firm in fragments if f is not None and f.lower() in n.lower()]
    return sorted(set(found) if dedupe else found, key=lambda r: [(v is not None, str(v)) for v in r])


def test_same_rows_as_the_lookup(spark):
    left, _ = tables(spark, NAMES * 2, [])
    for dedupe in (True, False):
        found = pattern_index.names_with_fragments(left, pattern_index.pattern_table(spark), dedupe=dedupe)
        assert rows(found) == rows(lookups.firm_lookup(left, dedupe=dedupe))


@pytest.mark.parametrize("dedupe", [True, False])
@pytest.mark.parametrize("gram", [1, 2, 3, 5])
def test_brute_force(spark, gram, dedupe):
    rng = random.Random(gram)
    text = lambda most: "".join(rng.choice("aBéß ç🙂") for _ in range(rng.randrange(most)))
    names = [text(12) for _ in range(120)] + [None, "x" * 5000 + "aBa"]
    fragments = [(text(5), f"f{i % 20}") for i in range(60)] + [("", "all"), (None, "none"), ("aba", None), ("aba", None)]
    left, right = tables(spark, names, fragments)
    found = pattern_index.names_with_fragments(left, right, dedupe=dedupe, gram=gram)
    assert rows(found) == brute(names, fragments, dedupe)


def test_empty_tables(spark):
    left, right = tables(spark, NAMES, [])
    assert rows(pattern_index.names_with_fragments(left, right)) == []
    left, right = tables(spark, [], [("a", "b")])
    assert rows(pattern_index.names_with_fragments(left, right)) == []


def test_many_fragments_meet_by_an_equal_gram(spark, monkeypatch):
    monkeypatch.setattr(settle, "fits_broadcast", lambda df, limit=0: False)
    names = [f"name {i}" for i in range(300)]
    fragments = [(f"e {i}", f"f{i}") for i in range(300)]
    left, right = tables(spark, names, fragments)
    found = pattern_index.names_with_fragments(left, right)
    assert rows(found) == brute(names, fragments)
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
