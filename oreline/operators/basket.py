"""Market-basket analysis on long transaction tables.

Baskets are ``(txn, items ARRAY<STRING>)``, itemsets ``(items, freq, support, n_items)`` and
rules carry sorted ``antecedents`` / ``consequents`` arrays.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.hashing import uniform
from ..session import materialize, shuffle_width


def unpivot_matrix(matrix: DataFrame, txn: str, item_columns: list[str]) -> DataFrame:
    """Binary transaction matrix (one boolean or 0/1 column per item) to the long form."""
    flags = matrix.select(txn, *[F.col(c).cast("boolean").alias(c) for c in item_columns])
    return (flags.unpivot(txn, item_columns, "item", "_present")
            .where("_present").select(F.col(txn).alias("txn"), "item"))


def transactions(df: DataFrame, txn: str = "id_compra", item: str = "item") -> DataFrame:
    """Rename to ``(txn, item)`` and drop rows without a key or an item."""
    return (df.select(F.col(txn).alias("txn"), F.col(item).cast("string").alias("item"))
            .where(F.col("txn").isNotNull() & F.col("item").isNotNull()))


def encode(trans: DataFrame) -> DataFrame:
    """One row per transaction with its sorted distinct items."""
    return trans.groupBy("txn").agg(F.array_sort(F.collect_set("item")).alias("items"))


def basket_count(baskets: DataFrame) -> int:
    return baskets.count()


def least_count(min_support: float, n: int) -> int:
    """Smallest count whose share of ``n`` reaches the threshold (above 1: a plain count)."""
    share = min_support if min_support <= 1.0 else min_support / n
    count = max(1, math.ceil(share * n) - 1)
    while count / n < share:
        count += 1
    return count


def frequent_itemsets(baskets: DataFrame, min_support: float = 0.01,
                      max_len: int | None = None, n: int | None = None) -> DataFrame:
    """All itemsets with support at or above the threshold."""
    # counted, then scanned twice by the miner: join and grouping run once
    baskets = materialize(baskets.select("items"))
    n = basket_count(baskets) if n is None else n
    schema = "items array<string>, freq bigint, support double, n_items int"
    if n == 0:
        return baskets.sparkSession.createDataFrame([], schema)
    need = least_count(min_support, n)
    model = FPGrowth(itemsCol="items", minSupport=(need - 0.5) / n,
                     minConfidence=1.0, numPartitions=2 * shuffle_width(baskets.sparkSession)).fit(baskets)
    found = model.freqItemsets.select(
        F.array_sort("items").alias("items"), F.col("freq").cast("bigint").alias("freq"))
    if max_len:
        found = found.where(F.size("items") <= max_len)
    return found.select("items", "freq", (F.col("freq") / F.lit(float(n))).alias("support"),
                        F.size("items").alias("n_items"))


def _rule_metrics(sa: Column, sc: Column, s: Column) -> dict[str, Column]:
    """Interest measures from antecedent, consequent and joint support."""
    confidence = s / sa
    leverage = s - sa * sc
    both_ways = F.greatest(s * (1 - sa), sa * (sc - s))
    back = s / sc
    return {
        "confidence": confidence,
        "lift": confidence / sc,
        "leverage": leverage,
        "conviction": F.when(confidence >= 1, F.lit(float("inf")))
                       .otherwise(F.try_divide(1 - sc, 1 - confidence)),
        "zhangs_metric": F.coalesce(F.try_divide(leverage, both_ways), F.lit(0.0)),
        "jaccard": s / (sa + sc - s),
        "certainty": F.coalesce(F.try_divide(confidence - sc, 1 - sc), F.lit(0.0)),
        "kulczynski": (confidence + back) / 2,
        "representativity": F.lit(1.0),
    }


SHORT_SET = 6            # itemsets up to this length are split in one pass: 62 splits at most


def _all_splits(store: DataFrame) -> DataFrame:
    """Every (items, support, consequents): the subsets of a k-itemset are the bit masks 1 .. 2^k - 2."""
    masks = (store.where("n_items >= 2")
             .withColumn("_mask", F.explode(F.expr(
                 "sequence(1L, shiftleft(1L, n_items) - 2L)"))))
    return masks.select("items", "support", F.expr("filter(items, (x, i) -> (shiftright(_mask, i) & 1L) = 0L)").alias("consequents"))


def _grown_splits(store: DataFrame, supports: DataFrame, min_confidence: float) -> DataFrame:
    """(items, support, consequents) that reach the confidence, by growing consequents.

    Moving an item from the antecedent to the consequent can only lower the confidence. So consequents
    of j + 1 items are put together from two passing ones of j items that share the first j - 1, and only
    those are looked up. One stored table per length.
    """
    def passing(candidates):
        known = candidates.join(supports, F.array_except("items", "consequents") == F.col("_set"))
        return materialize(known.where(F.col("support") / F.col("_support") >= F.lit(min_confidence))
                           .select("items", "support", "consequents"))

    longest = store.agg(F.max("n_items")).first()[0] or 0
    level = passing(store.select("items", "support", F.explode("items").alias("_i")).select(
        "items", "support", F.array("_i").alias("consequents")))
    levels = [level]
    for size in range(2, longest):
        head = F.slice("consequents", 1, size - 2)
        left = level.select("items", "support", head.alias("_head"), F.element_at("consequents", -1).alias("_a"))
        right = level.select("items", head.alias("_head"), F.element_at("consequents", -1).alias("_b"))
        pairs = left.join(right, ["items", "_head"]).where("_a < _b")
        level = passing(pairs.where(F.size("items") > size).select(
            "items", "support", F.concat("_head", F.array("_a", "_b")).alias("consequents")))
        if level.isEmpty():
            break
        levels.append(level)
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out


def association_rules(itemsets: DataFrame, metric: str = "confidence",
                      min_threshold: float = 0.5, short_set: int = SHORT_SET) -> DataFrame:
    """Every split of every itemset into antecedent and consequent that passes the threshold.

    Itemsets of up to ``short_set`` items are split in one pass. Longer ones grow their consequents level by
    level with confidence as the bound; a support threshold drops whole itemsets first. The other measures give
    no bound, so all splits of their itemsets are made. Supports come from equi-joins on the sorted item array.
    """
    store = materialize(itemsets.select("items", "freq", "support", "n_items"))
    wanted = store.where(F.col("support") >= F.lit(min_threshold)) if metric == "support" else store
    supports = store.select(F.col("items").alias("_set"), F.col("support").alias("_support"))
    if metric == "confidence" and min_threshold > 0:
        split = _all_splits(wanted.where(F.col("n_items") <= short_set))
        long_sets = wanted.where(F.col("n_items") > short_set)
        if not long_sets.isEmpty():
            split = split.unionByName(_grown_splits(long_sets, supports, min_threshold))
    else:
        split = _all_splits(wanted)
    split = split.withColumn("antecedents", F.array_except("items", "consequents"))
    ante = supports.toDF("antecedents", "antecedent_support")
    cons = supports.toDF("consequents", "consequent_support")
    joined = split.join(ante, "antecedents").join(cons, "consequents")
    measures = _rule_metrics(F.col("antecedent_support"), F.col("consequent_support"),
                             F.col("support"))
    rules = joined.withColumns(measures)
    if metric not in {"support", *measures}:
        raise ValueError(f"unknown rule metric {metric!r}")
    # the array columns are already sorted, so the union of the two sides is ``items``
    return (rules.where(F.col(metric) >= F.lit(min_threshold))
            .select("antecedents", "consequents", "antecedent_support", "consequent_support",
                    "support", *measures, "items"))


def contains_all(container: Column, wanted: Column) -> Column:
    """Set test: ``wanted`` is a subset of ``container``."""
    return F.size(F.array_except(wanted, container)) == 0


def item_array(items) -> Column:
    names = [items] if isinstance(items, str) else sorted(set(items))
    return F.array(*[F.lit(i) for i in names]).cast("array<string>")


def top_itemsets(itemsets: DataFrame, n: int = 10, n_items_min: int = 1) -> DataFrame:
    return (itemsets.where(F.col("n_items") >= n_items_min)
            .orderBy(F.desc("support"), "items").limit(n))


def itemsets_with(itemsets: DataFrame, items) -> DataFrame:
    """Itemsets that contain all the given items, best supported first."""
    return (itemsets.where(contains_all(F.col("items"), item_array(items)))
            .orderBy(F.desc("support"), "items"))


def rules_to(rules: DataFrame, item: str) -> DataFrame:
    """Rules whose consequent contains the item, most confident first."""
    return (rules.where(F.array_contains("consequents", item))
            .orderBy(F.desc("confidence"), "antecedents", "consequents"))


def rules_within(rules: DataFrame, items) -> DataFrame:
    """Rules that use only items of the selection."""
    return rules.where(contains_all(item_array(items), F.col("items")))


def rules_from(rules: DataFrame, item: str) -> DataFrame:
    """Rules whose antecedent contains the item."""
    return rules.where(F.array_contains("antecedents", item))


def antecedent_union(rules: DataFrame) -> DataFrame:
    """Sorted union of all antecedent items, one row per item."""
    return rules.select(F.explode("antecedents").alias("item")).distinct().orderBy("item")


def recommend(rules: DataFrame, basket, top_n: int = 5, mode: str = "reference") -> DataFrame:
    """Best rules for one basket.

    ``mode='reference'`` keeps rules whose antecedent contains the basket; ``mode='basket'``
    keeps the usual reading, rules whose antecedent is contained in the basket.
    """
    given = item_array(basket)
    if mode == "reference":
        fits = contains_all(F.col("antecedents"), given)
    elif mode == "basket":
        fits = contains_all(given, F.col("antecedents"))
    else:
        raise ValueError("mode must be 'reference' or 'basket'")
    return (rules.where(fits)
            .orderBy(F.desc("confidence"), F.desc("lift"), "antecedents", "consequents")
            .limit(top_n))


def recommend_all(rules: DataFrame, baskets: DataFrame, top_n: int = 5) -> DataFrame:
    """Best rules for every basket (antecedent inside the basket, consequent not yet in it).

    Many baskets hold the same items, so rules are matched once per distinct basket. Each
    rule is filed under the rarest item of its antecedent and meets only the baskets that hold
    that item: an equi-join followed by the exact subset test.
    """
    kinds = baskets.select("items").distinct()
    common = kinds.select(F.explode("items").alias("_anchor")).groupBy("_anchor").agg(F.count(F.lit(1)).alias("_n"))
    own = ["antecedents", "consequents", "confidence", "lift"]
    filed = (rules.select(*own, F.explode("antecedents").alias("_anchor")).join(common, "_anchor")
             .groupBy(*own).agg(F.min_by("_anchor", F.struct("_n", "_anchor")).alias("_anchor")))
    hits = (kinds.select("items", F.explode("items").alias("_anchor"))
            .join(filed, "_anchor")
            .where(contains_all(F.col("items"), F.col("antecedents"))
                   & ~F.arrays_overlap("items", "consequents")))
    best = W.partitionBy("items").orderBy(
        F.desc("confidence"), F.desc("lift"), "antecedents", "consequents")
    ranked = (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_n)
              .drop("_anchor"))
    return baskets.join(ranked, "items").select(
        "txn", "rank", "antecedents", "consequents", "confidence", "lift")


def item_support(trans: DataFrame, n: int | None = None) -> DataFrame:
    """Share of the transactions that hold each item."""
    distinct = trans.select("txn", "item").distinct()
    if n is None:
        n = trans.agg(F.count_distinct("txn")).first()[0]
    return (distinct.groupBy("item").agg(F.count(F.lit(1)).alias("freq"))
            .select("item", "freq", (F.col("freq") / F.lit(float(max(n, 1)))).alias("support")))


def size_distribution(trans: DataFrame) -> DataFrame:
    """Number of transactions of each size (rows per transaction)."""
    return (trans.groupBy("txn").agg(F.count(F.lit(1)).alias("size"))
            .groupBy("size").agg(F.count(F.lit(1)).alias("n_txn")))


def size_summary(trans: DataFrame) -> DataFrame:
    """Describe the transaction sizes with the 25, 50, 75 and 90 % points."""
    sizes = trans.groupBy("txn").agg(F.count(F.lit(1)).alias("size"))
    q = F.percentile("size", F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75, 0.9)]))
    return (sizes.agg(F.count(F.lit(1)).alias("n"), F.avg("size").alias("mean"),
                      F.stddev_samp("size").alias("std"), F.min("size").alias("min"),
                      q.alias("_q"), F.max("size").alias("max"))
            .select("n", "mean", "std", "min", F.col("_q")[0].alias("p25"),
                    F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75"),
                    F.col("_q")[3].alias("p90"), "max"))


def rules_summary(rules: DataFrame) -> DataFrame:
    """Count and spread of confidence and lift."""
    return rules.agg(
        F.count(F.lit(1)).alias("n_rules"),
        F.min("confidence").alias("min_confidence"), F.max("confidence").alias("max_confidence"),
        F.avg("confidence").alias("mean_confidence"),
        F.min("lift").alias("min_lift"), F.max("lift").alias("max_lift"),
        F.avg("lift").alias("mean_lift"), F.median("lift").alias("median_lift"))


def basket_summary(trans: DataFrame, itemsets: DataFrame | None = None,
                   rules: DataFrame | None = None) -> DataFrame:
    """Overview as ``(metric, value)`` rows: transactions, items, mean support, itemsets, rules."""
    def long(one_row: DataFrame) -> DataFrame:
        as_double = one_row.select(*[F.col(c).cast("double").alias(c) for c in one_row.columns])
        return as_double.unpivot([], as_double.columns, "metric", "value")

    counts = trans.agg(
        F.count_distinct("txn").alias("n_txn"), F.count_distinct("item").alias("n_items"),
        F.count_distinct("txn", "item").alias("pairs"))
    out = long(counts.select("n_txn", "n_items", F.try_divide(
        F.col("pairs"), F.col("n_txn") * F.col("n_items")).alias("mean_support")))
    if itemsets is not None:
        out = out.unionByName(long(itemsets.agg(F.count(F.lit(1)).alias("n_itemsets"))))
    if rules is not None:
        out = out.unionByName(long(rules_summary(rules).select(
            "n_rules", "mean_confidence", "mean_lift")))
    return out


MOST_DRAWS = 32          # draws per wanted item after which a group is completed by exponential keys


def cumulative_weights(items: DataFrame, item: str, weight: str) -> DataFrame:
    """Half-open share intervals ``(item, lo, hi)`` that tile [0, 1) in item order."""
    cells = 4 * shuffle_width(items.sparkSession)
    known = items.select(F.col(item).alias("item"), F.col(weight).cast("double").alias("w")) \
                 .where(F.col("w") > 0)
    pos = materialize(known.repartitionByRange(cells, "item")
                      .withColumn("_cell", F.spark_partition_id()))
    sums = pos.groupBy("_cell").agg(F.sum("w").alias("_w"))
    along = W.partitionBy(F.lit(0)).orderBy("_cell")
    before = sums.select("_cell", (F.sum("_w").over(along) - F.col("_w")).alias("_before"),
                         F.sum("_w").over(W.partitionBy(F.lit(0))).alias("_all"))
    inside = W.partitionBy("_cell").orderBy("item")
    run = pos.withColumn("_run", F.sum("w").over(inside)).join(before, "_cell")
    return run.select("item", ((F.col("_before") + F.col("_run") - F.col("w")) / F.col("_all")).alias("lo"),
                      ((F.col("_before") + F.col("_run")) / F.col("_all")).alias("hi"))


def weighted_sample(groups: DataFrame, group: str, size: str, items: DataFrame, item: str,
                    weight: str, seed: int = 42) -> DataFrame:
    """Weighted sampling without replacement of ``size`` items for every group.

    Draws with replacement whose repeats are discarded have the law of successive weighted
    draws without replacement. Draw j of a group is a hash of (group, j, seed) looked up in
    the cumulative weights by an equi-join on equal slots of the unit interval,
    so neither the item list nor a group has to fit in one task. Groups that saw too many
    repeats get more draws; a group that is still short (a few items hold nearly all weight) keeps
    what it has drawn and takes the rest in order of exponential keys -ln(u) / weight over the items
    it lacks, which is the same law and always ends.
    """
    n_items = items.where(F.col(weight) > 0).count()
    slots = max(1, n_items)
    table = cumulative_weights(items, item, weight)
    filed = materialize(table.withColumn("_slot", F.explode(F.sequence(
        F.floor(F.col("lo") * slots), F.least(F.floor(F.col("hi") * slots), F.lit(slots - 1))))))
    # the short group rows are placed first, so the draws made from them need no further move
    todo = (groups.select(F.col(group), F.least(F.col(size).cast("int"), F.lit(n_items)).alias("_k"))
            .repartition(4 * shuffle_width(groups.sparkSession), F.col(group)))
    done = None
    for factor, more in draw_rounds():
        draws = (todo.withColumn("_j", F.explode(F.sequence(F.lit(1), F.greatest(F.col("_k") * factor + more, F.lit(3)))))
                 .withColumn("_u", uniform(F.col(group), F.col("_j"), seed)))
        # the slot is a function of the draw and does not travel with it
        hits = draws.join(filed, F.floor(F.col("_u") * slots) == F.col("_slot")).where((F.col("_u") >= F.col("lo")) & (F.col("_u") < F.col("hi")))
        # one shuffle by group for the first draw of every item and the order of the items
        hits = hits.select(group, "_k", "_j", "item").repartition(F.col(group))
        firsts = hits.groupBy(group, "_k", "item").agg(F.min("_j").alias("_j"))
        of_group = W.partitionBy(group, "_k")
        firsts = firsts.withColumns({"pick": F.row_number().over(of_group.orderBy("_j")), "_n": F.count("*").over(of_group)})
        picked = materialize(firsts.where("pick <= _k").select(group, "_k", "pick", "item", (F.col("_n") < F.col("_k")).alias("_short")))
        whole = picked.where("not _short").select(group, "pick", "item")
        done = whole if done is None else done.unionByName(whole)
        short = picked.where("_short")
        if short.isEmpty():
            return done
        todo = short.select(group, "_k").distinct()
    order = F.array_sort(F.collect_list(F.struct("pick", "item")))
    short = short.groupBy(group, "_k").agg(F.transform(order, lambda d: d["item"]).alias("_i"))
    return done.unionByName(_completed(short, group, filed, slots, seed))


def draw_rounds() -> list[tuple[int, int]]:
    """(times, more): a round draws times * size + more items (3 at least) for a group. Most groups have no repeats and end in the first."""
    rounds = [(1, 0), (2, 4)]
    while rounds[-1][0] <= MOST_DRAWS:
        rounds.append((rounds[-1][0] * 4, 4))
    return rounds


def _completed(short: DataFrame, group: str, filed: DataFrame, slots: int, seed: int) -> DataFrame:
    """The drawn items of short groups, then the others by exponential keys."""
    home = filed.where(F.col("_slot") == F.least(F.floor(F.col("lo") * slots), F.lit(slots - 1)))
    lacking = (short.withColumn("_slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slots - 1).cast("bigint"))))
               .join(home, "_slot").where(~F.array_contains("_i", F.col("item"))))
    share = F.greatest(F.col("hi") - F.col("lo"), F.lit(1e-300))
    turn = F.row_number().over(W.partitionBy(group).orderBy(-F.log(uniform(F.col(group), F.col("item"), seed, "rest")) / share, "item"))
    rest = lacking.withColumn("_t", turn).where(F.col("_t") <= F.col("_k") - F.size("_i"))
    drawn = short.select(group, F.posexplode("_i").alias("pick", "item")).withColumn("pick", F.col("pick") + 1)
    return drawn.unionByName(rest.select(group, (F.size("_i") + F.col("_t")).alias("pick"), "item"))
