"""Market-basket analysis.

Exact pair counts without a self-join on the order: an item below the pair
threshold in its outlet cannot be part of a qualifying pair, so it is pruned
first (lossless); then equal baskets of an outlet collapse to one weighted row,
and pairs are formed once per distinct basket. With the threshold at a fixed
share of all orders the surviving items per outlet stay few however large the data get.
An order with more surviving items than ``PART`` is cut into parts by item hash, and each
two parts are one row: no row holds a whole long order, and its pairs spread over tasks.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.operators.enrich import completed
from salesmart.storage import materialize


#: Items a row of a basket holds about at most.
PART = 256


def order_items(lines: DataFrame, orders: DataFrame, items: DataFrame, item: str = "brand") -> DataFrame:
    """Distinct (outlet_id, order_id, item) of completed orders, stored once.

    Repeated lines fold in the partial aggregation before the shuffle.
    """
    o = completed(orders).select("order_id", "outlet_id")
    bought = lines.select("order_id", "item_id").join(o, "order_id").join(items.select("item_id", F.col(item).alias("item")), "item_id")
    return materialize(bought.groupBy("outlet_id", "order_id", "item").agg(F.lit(1).alias("one")).drop("one"), "baskets")


def item_counts(bought: DataFrame) -> DataFrame:
    return bought.groupBy("outlet_id", "item").agg(F.count("*").alias("n"))


def outlet_orders(bought: DataFrame) -> DataFrame:
    per_order = bought.groupBy("outlet_id", "order_id").agg(F.count("*").alias("size"))
    return per_order.groupBy("outlet_id").agg(F.count("*").alias("outlet_orders"))


def chain_orders(bought: DataFrame) -> Column:
    return outlet_orders(bought).agg(F.sum("outlet_orders")).scalar()


def long_pairs(kept: DataFrame, sizes: DataFrame, part: int) -> DataFrame:
    """One row a pair of the orders in ``sizes`` (outlet_id, order_id, size), formed by two parts of an order at a time."""
    at = F.pmod(F.xxhash64("item"), F.col("parts")).cast("int").alias("at")
    dealt = kept.join(sizes.withColumn("parts", F.ceil(F.col("size") / part)), ["outlet_id", "order_id"]).select("outlet_id", "order_id", "item", "parts", at)
    lists = dealt.groupBy("outlet_id", "order_id", "parts", "at").agg(F.collect_list("item").alias("items"))  # about ``part`` items
    cells = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1), lambda k: F.struct(F.least(k, F.col("at")).alias("i"), F.greatest(k, F.col("at")).alias("j")))
    met = lists.select("outlet_id", "order_id", "at", "items", F.inline(cells)).groupBy("outlet_id", "order_id", "i", "j").agg(
        F.max(F.when(F.col("at") == F.col("i"), F.col("items"))).alias("one"), F.max(F.when(F.col("at") == F.col("j"), F.col("items"))).alias("two"))
    both = met.select("outlet_id", "i", "j", F.explode("one").alias("a"), "two").select("outlet_id", "i", "j", "a", F.explode("two").alias("b"))
    pairs = both.where((F.col("i") < F.col("j")) | (F.col("a") < F.col("b")))
    return pairs.select("outlet_id", F.lit(1).cast("bigint").alias("w"), F.least("a", "b").alias("item_a"), F.greatest("a", "b").alias("item_b"))


def pair_counts(bought: DataFrame, min_pairs: int | Column, part: int = PART) -> DataFrame:
    """Orders per (outlet, item_a < item_b) reaching ``min_pairs``."""
    threshold = min_pairs if isinstance(min_pairs, Column) else F.lit(min_pairs)
    frequent = item_counts(bought).where(F.col("n") >= threshold).select("outlet_id", "item")
    kept = bought.join(frequent, ["outlet_id", "item"], "left_semi")
    per_order = kept.groupBy("outlet_id", "order_id").agg(F.count("*").alias("size"))
    long = materialize(per_order.where(F.col("size") > part), "long-orders")
    several = not long.isEmpty()
    short = kept.join(long.select("outlet_id", "order_id"), ["outlet_id", "order_id"], "left_anti") if several else kept
    baskets = short.groupBy("outlet_id", "order_id").agg(F.sort_array(F.collect_list("item")).alias("items")).where(F.size("items") > 1)
    weighted = baskets.groupBy("outlet_id", "items").agg(F.count("*").alias("w"))
    heads = weighted.select("outlet_id", "w", "items", F.posexplode("items").alias("i", "item_a")).where(F.col("i") < F.size("items") - 1)
    pairs = heads.select("outlet_id", "w", "item_a", F.explode(F.slice("items", F.col("i") + 2, F.size("items") - F.col("i") - 1)).alias("item_b"))
    if several:
        pairs = pairs.unionByName(long_pairs(kept, long, part))
    return pairs.groupBy("outlet_id", "item_a", "item_b").agg(F.sum("w").alias("pair_orders")).where(F.col("pair_orders") >= threshold)


def least_pairs(bought: DataFrame, floor: int, share: float) -> int:
    """A share of all orders, ``floor`` at least: it grows with the data, so rare items are pruned at every size."""
    orders = outlet_orders(bought).agg(F.sum("outlet_orders")).first()[0] or 0
    return max(floor, math.floor(orders * share))


def with_frequencies(pairs: DataFrame, bought: DataFrame) -> DataFrame:
    """Attach item and outlet order counts to the qualifying pairs."""
    counts = item_counts(bought)
    a = counts.select("outlet_id", F.col("item").alias("item_a"), F.col("n").alias("n_a"))
    b = counts.select("outlet_id", F.col("item").alias("item_b"), F.col("n").alias("n_b"))
    return pairs.join(a, ["outlet_id", "item_a"]).join(b, ["outlet_id", "item_b"]).join(outlet_orders(bought), "outlet_id")


def top_item_combos(bought: DataFrame, floor: int = 100, share: float = 0.001, k: int = 25) -> DataFrame:
    """Best pairs by lift within their outlet."""
    full = with_frequencies(pair_counts(bought, least_pairs(bought, floor, share)), bought)
    expected = F.col("n_a").cast("double") * F.col("n_b")
    together = F.col("pair_orders") * F.lit(1.0)
    return full.select(
        "item_a", "item_b", "outlet_id", F.col("pair_orders").alias("orders_with_combo"),
        (together * F.col("outlet_orders") / expected).alias("lift"), (together * chain_orders(bought) / expected).alias("chain_lift"),
    ).orderBy(F.desc("lift"), "outlet_id", "item_a", "item_b").limit(k)


def market_basket(bought: DataFrame, floor: int = 30, share: float = 0.001) -> DataFrame:
    """Support, confidence both ways, lift and chain lift of all pairs in enough orders."""
    total = chain_orders(bought)
    full = with_frequencies(pair_counts(bought, least_pairs(bought, floor, share)), bought)
    n = F.col("outlet_orders")
    return (
        full.withColumn("support", F.col("pair_orders") / n).withColumn("p_a", F.col("n_a") / n).withColumn("p_b", F.col("n_b") / n)
        .withColumn("confidence_a_to_b", F.col("support") / F.col("p_a")).withColumn("confidence_b_to_a", F.col("support") / F.col("p_b"))
        .withColumn("lift", F.col("confidence_a_to_b") / F.col("p_b"))
        .withColumn("chain_lift", F.col("pair_orders").cast("double") * total / (F.col("n_a").cast("double") * F.col("n_b")))
        .drop("n_a", "n_b")
    )


def frequent_itemsets(bought: DataFrame, min_support: float) -> DataFrame:
    """Frequent itemsets over all orders with MLlib's distributed FP-growth.

    Items below the support cannot occur in a frequent set, so they go first; the
    support is then restated for the remaining baskets as the same order count.
    """
    orders = bought.select("order_id").distinct().count()
    min_count = math.ceil(min_support * orders)
    frequent = bought.groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") >= min_count).select("item")
    kept = bought.join(frequent, "item", "left_semi").groupBy("order_id").agg(F.collect_list("item").alias("items"))
    baskets = materialize(kept, "frequent-baskets")
    share = (min_count - 0.5) / max(baskets.count(), 1)
    sets = FPGrowth(itemsCol="items", minSupport=share).fit(baskets).freqItemsets
    return sets.select(F.sort_array("items").alias("items"), "freq")


def association_rules(sets: DataFrame, orders: int, min_confidence: float = 0.0) -> DataFrame:
    """``antecedent, consequent, freq, support, confidence, lift`` of every rule inside the frequent sets.

    Every part of a frequent set is frequent, so the counts of both sides of a rule are among the sets: a set of k
    items gives 2^k - 2 rules, one for each proper part, and each meets its sides by two joins on the item array.
    """
    stored = materialize(sets.select(F.sort_array("items").alias("items"), "freq"), "itemsets")
    masks = F.explode(F.sequence(F.lit(1).cast("bigint"), F.expr("shiftleft(1L, size(items)) - 2"))).alias("mask")
    split = stored.where(F.size("items") > 1).select("items", "freq", masks).select(
        "freq", F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1) = 1)").alias("antecedent"), F.expr("filter(items, (x, i) -> (shiftright(mask, i) & 1) = 0)").alias("consequent"))
    left = stored.select(F.col("items").alias("antecedent"), F.col("freq").alias("freq_a"))
    right = stored.select(F.col("items").alias("consequent"), F.col("freq").alias("freq_c"))
    rules = split.join(left, "antecedent").join(right, "consequent")
    confidence = F.col("freq") / F.col("freq_a")
    return rules.select(
        "antecedent", "consequent", "freq", (F.col("freq") / F.lit(orders)).alias("support"), confidence.alias("confidence"),
        (F.col("freq").cast("double") * F.lit(orders) / (F.col("freq_a").cast("double") * F.col("freq_c"))).alias("lift")).where(F.col("confidence") >= min_confidence)
