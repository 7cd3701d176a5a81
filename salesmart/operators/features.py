"""Model features: orders, customers (items are in ``items.item_frame``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions import columns as c
from salesmart.functions.columns import exact_sum, zero, zero_int
from salesmart.functions.selection import first_share, hash_order
from salesmart.operators.enrich import category_codes, completed
from salesmart.operators.marts import customer_category_mix, customer_order_sums, order_basket_agg, order_category_sums, weekend_share
from salesmart.storage import materialize

# Feature lists of the three model tasks.
ORDER_FEATURES = ["order_hour", "day_of_week_code", "order_month", "is_weekend", "is_promo_order", "channel_code", "payment_code", "basket_size",
                  "basket_quantity", "avg_unit_price", "discount_rate_percentage", "total_orders", "total_spend"]
CHURN_FEATURES = ["f_log_orders", "f_log_spend", "average_order_value", "discount_dependency", "promo_dependency", "top_category_share",
                  "unique_categories", "total_items_purchased", "weekend_order_share"]
ITEM_FEATURES = ["average_rating", "rating_count", "wastage_ratio", "avg_unit_price", "promo_dependency", "weekend_order_share", "unique_customers", "order_line_count"]


def order_features(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Thirteen features per completed order; customer history leaves the order itself out.

    History is a per-customer aggregate joined back, so a customer with very many
    orders is split by adaptive execution instead of filling one window.
    """
    o = completed(orders)
    history = o.groupBy("customer_id").agg(F.count("*").alias("_n"), exact_sum("total_amount").alias("_s"))
    df = o.join(order_basket_agg(lines, orders), "order_id", "left").join(history, "customer_id")
    rest = c.on_grid(F.col("_s") - F.col("total_amount"))
    coded = category_codes(category_codes(df, "order_channel", "channel_code", among=o), "payment_method", "payment_code", among=o)
    flag = lambda p: F.when(p, 1).otherwise(0).cast("long")
    return coded.select(
        "order_id", "customer_id", "total_amount", F.coalesce("order_hour", F.lit(-1)).cast("long").alias("order_hour"),
        F.weekday("order_date").cast("long").alias("day_of_week_code"), F.month("order_date").cast("long").alias("order_month"),
        flag(c.is_weekend("order_date")).alias("is_weekend"), flag(F.col("promotion_id") != "").alias("is_promo_order"), "channel_code", "payment_code",
        zero_int("basket_size").alias("basket_size"), zero("basket_quantity").alias("basket_quantity"), zero("avg_unit_price").alias("avg_unit_price"),
        c.safe_percent("discount_amount", "subtotal").alias("discount_rate_percentage"),
        F.greatest(F.col("_n") - 1, F.lit(0)).alias("total_orders"), F.greatest(rest, F.lit(0.0)).alias("total_spend"))


def customer_behaviour(orders, lines, items, cutoff: str) -> DataFrame:
    """Behaviour measures of every customer with a completed order."""
    per_category = materialize(order_category_sums(lines, items), "order-categories")  # the one scan of the lines
    sums = customer_order_sums(orders, lines, items, per_category)
    mix, weekend = customer_category_mix(lines, orders, items, per_category), weekend_share(per_category, orders)
    df = sums.join(mix, "customer_id", "left").join(weekend, "customer_id", "left")
    df = df.withColumns({n: zero(n) for n in ("top_category_share", "total_items_purchased", "weekend_order_share")} | {"unique_categories": zero_int("unique_categories")})
    recency = F.datediff(F.lit(cutoff).cast("date"), "last_order_date").cast("long")
    return df.select(
        "customer_id", "first_order_date", recency.alias("recency_days"), "total_orders", "total_spend", "average_order_value",
        c.safe_ratio("total_discount_received", "total_spend").alias("discount_dependency"), c.safe_ratio("promo_orders", "total_orders").alias("promo_dependency"),
        "top_category_share", "unique_categories", "total_items_purchased", "weekend_order_share",
        F.log1p(F.col("total_orders").cast("double")).alias("f_log_orders"), F.log1p("total_spend").alias("f_log_spend"))


def churn_features(behaviour: DataFrame, cutoff: str, min_window: int = 180, quiet_days: int = 60) -> DataFrame:
    """Customers observed long enough, labelled churned when quiet at the end."""
    seen = behaviour.where(F.col("first_order_date") <= F.date_sub(F.lit(cutoff).cast("date"), min_window)).drop("first_order_date")
    return seen.withColumn("churned", F.when(F.col("recency_days") > quiet_days, 1).otherwise(0).cast("long"))


def ml_split(frame: DataFrame, key: str, test_percent: int = 20, seed: int = 42, held_out: DataFrame | None = None, label: str | None = None) -> DataFrame:
    """Add ``side`` (train/test) after removing held-out cases.

    Of each class of ``label`` (of all rows without one), ``test_percent`` in a hundred rows, to the
    nearest row, are the test side: those with the smallest key hashes. The same rows land on the same side
    in every run and on every cluster, and rows of one key and class stay together.
    """
    rows = frame.join(held_out.select(key).distinct(), key, "left_anti") if held_out is not None else frame
    stored = materialize(rows, "split-rows")
    test = first_share(stored, label, hash_order(key, seed), test_percent)
    return stored.withColumn("side", F.when(test, "test").otherwise("train"))


def validate_scores(batch: DataFrame, features: list[str], max_batch: int | None = None) -> DataFrame:
    """Rejects per scoring record: missing, non-numeric or non-finite features; optional batch size check.

    ``batch`` has ``batch_id``, a record key and ``payload``, a map of feature name to text.
    """
    tests = []
    for n in features:
        v = F.col("payload")[n]
        number = v.try_cast("double")
        tests.append(
            F.when(~F.map_contains_key("payload", F.lit(n)), f"missing:{n}").when(number.isNull(), f"not_numeric:{n}")
            .when(F.isnan(number) | (F.abs(number) == float("inf")), f"not_finite:{n}"))
    unknown = F.filter(F.map_keys("payload"), lambda k: ~k.isin(features))
    out = batch.withColumn("rejects", F.concat(F.array_compact(F.array(*tests)), F.transform(unknown, lambda k: F.concat(F.lit("unknown:"), k))))
    if max_batch is None:
        return out
    sizes = batch.groupBy("batch_id").agg(F.count("*").alias("_size"))
    too_large = F.when(F.col("_size") > max_batch, F.array(F.lit("batch_too_large"))).otherwise(F.array().cast("array<string>"))
    return out.join(sizes, "batch_id").withColumn("rejects", F.concat("rejects", too_large)).drop("_size")
