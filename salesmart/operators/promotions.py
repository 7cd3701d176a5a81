"""Promotion effectiveness."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions import columns as c
from salesmart.operators.enrich import completed
from salesmart.storage import materialize


def daily_outlet_sales(orders: DataFrame) -> DataFrame:
    """Completed orders, sales and discount per outlet, day and promotion ('' for none), stored once."""
    return materialize(completed(orders).groupBy("outlet_id", "order_date", "promotion_id").agg(
        F.count("*").alias("n"), c.exact_sum("total_amount").alias("s"), c.exact_sum("discount_amount").alias("x")), "outlet-days")


def running_control(daily: DataFrame, first: str, last: str) -> DataFrame:
    """Running count and sales of promotion-free orders per outlet over a dense calendar.

    The window sees one row per outlet and day, whatever the number of orders.
    """
    control = daily.where("promotion_id = ''").select("outlet_id", F.col("order_date").alias("day"), "n", "s")
    calendar = control.select("outlet_id").distinct().withColumn("day", F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))))
    run = Window.partitionBy("outlet_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    dense = calendar.join(control, ["outlet_id", "day"], "left")
    return dense.select("outlet_id", "day", F.sum(F.coalesce("n", F.lit(0))).over(run).alias("run_n"), c.exact_sum_over(c.zero("s"), run).alias("run_s"))


def promo_effectiveness(promotions: DataFrame, orders: DataFrame, first: str, last: str) -> DataFrame:
    """Promotion orders against promotion-free orders of the same outlet and window.

    Control totals are differences of running sums at the two window ends, so a
    promotion costs two lookups instead of a range join with every order. All
    promotions are kept, also those nobody used.
    """
    daily = daily_outlet_sales(orders)
    own = daily.where("promotion_id <> ''").withColumn("promotion_id", F.col("promotion_id").cast("long"))
    in_window = own.join(promotions.select("promotion_id", "outlet_id", "start_date", "end_date"), ["promotion_id", "outlet_id"]).where(
        F.col("order_date").between(F.col("start_date"), F.col("end_date")))
    used = in_window.groupBy("promotion_id").agg(
        F.sum("n").alias("promo_orders"), c.exact_sum("s").alias("promo_sales"), c.exact_sum("x").alias("promo_discount_spent"))

    running = running_control(daily, first, last)
    end = running.select("outlet_id", F.col("day").alias("to_day"), F.col("run_n").alias("to_n"), F.col("run_s").alias("to_s"))
    start = running.select("outlet_id", F.col("day").alias("from_day"), F.col("run_n").alias("from_n"), F.col("run_s").alias("from_s"))
    bounds = promotions.withColumn("to_day", F.least("end_date", F.lit(last).cast("date"))).withColumn(
        "from_day", F.least(F.date_sub("start_date", 1), F.lit(last).cast("date")))
    both = (
        bounds.join(end, ["outlet_id", "to_day"], "left").join(start, ["outlet_id", "from_day"], "left").join(used, "promotion_id", "left")
        .withColumn("control_orders", F.coalesce("to_n", F.lit(0)) - F.coalesce("from_n", F.lit(0)))
        .withColumn("control_sales", c.on_grid(c.zero("to_s") - c.zero("from_s")))
        .withColumn("promo_orders", c.zero_int("promo_orders")).withColumn("promo_discount_spent", c.zero("promo_discount_spent"))
        .withColumn("promo_avg_order_value", c.safe_ratio("promo_sales", "promo_orders"))
        .withColumn("control_avg_order_value", c.safe_ratio("control_sales", "control_orders"))
    )
    gap = F.col("promo_avg_order_value") - F.col("control_avg_order_value")
    scored = (
        both.withColumn("aov_lift_percentage", F.when(F.col("control_avg_order_value") > 0, gap / F.col("control_avg_order_value") * 100).otherwise(F.lit(0.0)))
        .withColumn("incremental_revenue_estimate", gap * F.col("promo_orders"))
        .withColumn("efficiency_ratio", F.col("incremental_revenue_estimate") / F.greatest("promo_discount_spent", F.lit(1.0)))
    )
    trap = (F.col("promo_orders") == 0) | (F.col("aov_lift_percentage") < 0) | (F.col("efficiency_ratio") < 0.1)
    return scored.select(
        "promotion_id", "promotion_name", "outlet_id", "discount_percentage", "start_date", "end_date", "promo_orders", "control_orders",
        "promo_avg_order_value", "control_avg_order_value", "aov_lift_percentage", "promo_discount_spent", "incremental_revenue_estimate",
        "efficiency_ratio", trap.alias("promotion_trap"))


def promo_stats(effects: DataFrame) -> DataFrame:
    """Totals for all promotions, traps and healthy ones in one aggregation."""
    group = F.explode(F.array(F.lit("all"), F.when(F.col("promotion_trap"), "traps").otherwise("healthy")))
    return effects.withColumn("subset", group).groupBy("subset").agg(
        F.count("*").alias("promotions"), F.count(F.when(F.col("promotion_trap"), 1)).alias("traps"),
        c.exact_avg("aov_lift_percentage", 8).alias("avg_lift"),
        c.exact_sum("incremental_revenue_estimate", 6).alias("total_incremental"), c.exact_sum("promo_discount_spent").alias("total_discount_spend"))
