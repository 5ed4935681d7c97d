"""Digest trees against plain comparison, and what a comparison reads."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import digests
from ledgerloom.plans import quality
from ledgerloom.plans.portfolio import Portfolio

SCHEMA = "borrower_id string, loan_id string, action_code string, rule_basis string"
SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted(str(r) for r in df.collect())


def leafed(spark, data, depth):
    return digests.with_leaf(spark.createDataFrame(data, SCHEMA).coalesce(2), quality.DECISION_KEY, depth)


@pytest.mark.parametrize("depth", [0, 2])
def test_differences_are_those_of_the_rows(spark, depth):
    rng = random.Random(depth)
    data = [(f"B{i}", rng.choice([None, f"L{i}"]), rng.choice("xyz"), rng.choice([None, "r"])) for i in range(300)]
    other = data[5:] + [("B7", "new", "x", None), data[50], data[51]]  # rows gone, one new, two repeated
    other[20] = (*other[20][:3], "moved")
    rng.shuffle(other)
    a, b = leafed(spark, data, depth), leafed(spark, other, depth)
    tree = digests.tree(a, quality.DECISION_COLUMNS, depth)
    assert digests.depth_of(tree) == depth
    assert rows(quality.difference_by_digest(a, tree, b, depth)) == rows(quality.run_difference(a, b))
    same = leafed(spark, rng.sample(data, len(data)), depth)
    assert digests.differing_leaves(tree, digests.tree(same, quality.DECISION_COLUMNS, depth), depth) is None
    if depth:
        leaves = digests.differing_leaves(tree, digests.tree(b, quality.DECISION_COLUMNS, depth), depth)
        assert 1 <= leaves.count() <= 9


def test_nulls_do_not_move_between_columns(spark):
    a, b = leafed(spark, [("B", "L", None, "q")], 0), leafed(spark, [("B", "L", "q", None)], 0)
    trees = [digests.tree(x, quality.DECISION_COLUMNS, 0) for x in (a, b)]
    assert digests.differing_leaves(*trees, 0).count() == 1
    empty = digests.tree(leafed(spark, [], 0), quality.DECISION_COLUMNS, 0)
    assert digests.differing_leaves(empty, empty, 0) is None and digests.differing_leaves(trees[0], empty, 0).count() == 1


def test_a_later_run_finds_a_planted_row_in_one_leaf(spark, monkeypatch):
    monkeypatch.setattr(digests, "ROWS_PER_LEAF", 8)
    earlier = Portfolio(spark, SF_DIR)
    earlier.publish()
    kept = Portfolio.open(spark, earlier.folder, SF_DIR)
    assert digests.depth_of(kept.baseline_tree) >= 1
    assert kept.changed_since(kept).count() == 0
    read = []
    monkeypatch.setattr(digests, "of_leaves", lambda table, leaves, f=digests.of_leaves: read.append(leaves.count()) or f(table, leaves))
    one = kept.recs.orderBy("recommendation_id").first().recommendation_id
    code = F.when(F.col("recommendation_id") == one, "OTHER").otherwise(F.col("action_code"))
    found = kept.changed_since(kept, kept.recs.withColumn("action_code", code)).collect()
    assert {(r.found_in, r.times) for r in found} == {("first", 1), ("second", 1)} and set(read) == {1}
