import math
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from oreline.operators import basket as B

ROWS = [(1, "A"), (1, "B"), (1, "C"), (2, "A"), (2, "B"), (3, "A"), (3, "C"), (4, "B"), (1, "A")]


@pytest.fixture(scope="module")
def sets(spark):
    trans = B.transactions(spark.createDataFrame(ROWS, "id_compra int, item string"))
    return B.frequent_itemsets(B.encode(trans), 0.25)


def test_itemsets(sets):
    assert {("".join(r["items"]), r.support) for r in sets.collect()} == {
        ("A", .75), ("B", .75), ("C", .5), ("AB", .5), ("AC", .5), ("BC", .25), ("ABC", .25)}


def test_rules(sets):
    every = B.association_rules(sets, min_threshold=0.0)
    assert every.count() == 12
    kept = {("".join(r.antecedents), "".join(r.consequents)): r for r in B.association_rules(sets, min_threshold=0.5).collect()}
    assert len(kept) == 9 and abs(kept["C", "AB"].lift - 1.0) < 1e-12
    assert kept["C", "A"].confidence == 1.0 and math.isinf(kept["C", "A"].conviction)
    assert abs(kept["A", "B"].lift - .8889) < 1e-4 and abs(kept["BC", "A"].lift - 1.3333) < 1e-4


def test_lift_is_symmetric_and_confidence_is_a_ratio(sets):
    rules = {(tuple(r.antecedents), tuple(r.consequents)): r for r in B.association_rules(sets, min_threshold=0.0).collect()}
    for (a, c), r in rules.items():
        assert abs(r.lift - rules[c, a].lift) < 1e-12
        assert abs(r.confidence - r.support / r.antecedent_support) < 1e-12


def test_recommendation_directions(sets):
    rules = B.association_rules(sets, min_threshold=0.5)
    got = {("".join(r.antecedents), "".join(r.consequents)) for r in B.recommend(rules, "A", 10).collect()}
    assert got == {("A", "B"), ("A", "C"), ("AB", "C"), ("AC", "B")}
    usual = {("".join(r.antecedents), "".join(r.consequents)) for r in B.recommend(rules, ["A"], 10, "basket").collect()}
    assert usual == {("A", "B"), ("A", "C")}


def test_absolute_support():
    assert B.least_count(30, 1500) == 30 and B.least_count(0.02, 1500) == 30 and B.least_count(1.0, 7) == 7


def test_long_itemset_is_expanded_whole(spark):
    items = [chr(97 + i) for i in range(9)]
    rows = [(t, i) for t in range(3) for i in items]
    sets = B.frequent_itemsets(B.encode(B.transactions(spark.createDataFrame(rows, "id_compra int, item string"))), 0.9)
    want = sum(2 ** len(s) - 2 for k in range(2, 10) for s in combinations(items, k))
    assert B.association_rules(sets, min_threshold=0.0).count() == want


def test_weighted_sample_under_a_dominant_weight(spark):
    groups = spark.range(300).selectExpr("id AS g", "3 AS k")
    items = spark.createDataFrame([(i, 1000.0 if i == 0 else 1.0) for i in range(5)], "item int, w double")
    out = B.weighted_sample(groups, "g", "k", items, "item", "w").collect()
    per = {}
    for r in out:
        per.setdefault(r.g, []).append(r["item"])
    assert len(per) == 300 and all(len(v) == 3 == len(set(v)) for v in per.values())
    assert sum(0 in v for v in per.values()) > 295


def _as_set(rules):
    return {("".join(r.antecedents), "".join(r.consequents), round(r.confidence, 9)) for r in rules.collect()}


@pytest.mark.parametrize("threshold", [0.3, 0.75, 1.0])
def test_grown_consequents_equal_all_splits(spark, threshold):
    baskets = [(i, c) for i in range(120) for j, c in enumerate("ABCDEFG") if (i * (j + 3)) % (j + 4) or i % 2]
    sets = B.frequent_itemsets(B.encode(B.transactions(spark.createDataFrame(baskets, "id_compra int, item string"))), 0.2)
    grown = _as_set(B.association_rules(sets, min_threshold=threshold, short_set=1))
    assert grown == _as_set(B.association_rules(sets, min_threshold=threshold, short_set=99)) and grown


def test_twenty_items_at_high_confidence(spark):
    # 20 items; only antecedents of 19 items, and those of 18 that hold items 0 to 15, are about as rare as the whole
    items = [f"i{j:02d}" for j in range(20)]
    rows = [(items, 90, 0.09, 20)]
    for size, support in ((1, 0.5), (2, 0.5), (3, 0.5), (4, 0.5), (17, 0.5), (19, 0.095)):
        rows += [(list(c), int(support * 1000), support, size) for c in combinations(items, size)]
    for c in combinations(items, 18):
        support = 0.095 if set(items[:16]) <= set(c) else 0.5
        rows.append((list(c), int(support * 1000), support, 18))
    sets = spark.createDataFrame(rows, "items array<string>, freq long, support double, n_items int")
    only_whole = sets.withColumn("n_items", F.when(F.col("n_items") == 20, 20).otherwise(1))      # the others are only looked up
    whole = B.association_rules(only_whole, min_threshold=0.9)
    got = sorted(("".join(r.consequents)) for r in whole.collect())
    tail = items[16:]
    assert got == sorted(items + ["".join(c) for c in combinations(tail, 2)])


def test_support_threshold_drops_whole_itemsets(sets):
    rules = {("".join(r.antecedents), "".join(r.consequents)) for r in B.association_rules(sets, "support", 0.5).collect()}
    assert rules == {("A", "B"), ("B", "A"), ("A", "C"), ("C", "A")}


def test_sample_draws_no_more_than_wanted_first(spark, monkeypatch):
    """a group without repeats is drawn once for each wanted item, and only groups with repeats are drawn again."""
    stored, plain = [], B.materialize

    def watched(df, *keys):
        out = plain(df, *keys)
        stored.append(out)
        return out
    monkeypatch.setattr(B, "materialize", watched)
    groups = spark.createDataFrame([(i, 3) for i in range(300)], "txn bigint, k int")
    items = spark.createDataFrame([(i, 1.0) for i in range(1000)], "item bigint, w double")
    got = B.weighted_sample(groups, "txn", "k", items, "item", "w").toPandas()
    assert len(got) == 900 and not got.duplicated(["txn", "item"]).any() and not got.duplicated(["txn", "pick"]).any()
    assert B.draw_rounds()[0] == (1, 0)
    _, _, first, *again = stored
    assert first.select("txn").distinct().count() == 300 and all(r.select("txn").distinct().count() < 10 for r in again)
