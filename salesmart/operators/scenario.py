"""Recommendations and what-if scenarios."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.columns import exact_avg, exact_sum, zero

# Scenario name, class it applies to, price change in percent.
CLASS_SCENARIOS = [("price_increase_10pct", "Volume Driver", 10.0), ("price_decrease_10pct", "Hidden Opportunity", -10.0), ("discount_15pct", "Low Performer", -15.0)]
ITEM_SCENARIOS = ["price_change", "discount_change", "demand_change", "wastage_change", "remove_item"]


def whole(value: Column) -> Column:
    """Number cut to an integer for texts (no rounding ambiguity)."""
    return F.floor(value).cast("string")


def recommendations(classes, effects, risk, slow, cells, at_risk, ratings) -> DataFrame:
    """Eight evidence rules, each a small ordered top-k, as one prioritised table."""

    def rows(df, priority, text, kind, target, name, evidence, impact):
        return df.select(F.lit(priority).alias("priority"), F.lit(text).alias("recommendation"), F.lit(kind).alias("target_type"),
                         target.cast("string").alias("target_id"), name.alias("target_name"), evidence.alias("evidence"), impact.cast("double").alias("estimated_impact"))

    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    col = F.col
    hidden = classes.where("business_class = 'Hidden Opportunity'").orderBy(F.desc("profit_margin_percentage"), "item_id").limit(5)
    losing = classes.where("business_class = 'Low Performer' and estimated_profit < 0").orderBy("estimated_profit", "item_id").limit(5)
    traps = effects.where("promotion_trap").orderBy("incremental_revenue_estimate", "promotion_id").limit(3)
    waste = risk.where("risk_level = 'High'").orderBy(F.desc("wastage_cost"), "item_id").limit(5)
    stalled = slow.orderBy(F.desc("first_60d"), "item_id").limit(5)
    peak = cells.orderBy(F.desc("total_orders"), "day_of_week", "time_period", "order_channel").limit(1)
    lost = at_risk.agg(F.count("*").alias("n"), exact_sum("total_spend").alias("spend")).where("n > 0")
    poor = ratings.where("average_rating < 3.5 and rating_count >= 20").orderBy("average_rating", "item_id").limit(3)
    slot = F.concat_ws("/", "day_of_week", "time_period", "order_channel")
    parts = [
        rows(hidden, "P1", "Promote high-margin item with low volume", "item", col("item_id"), col("item_name"),
             say("margin ", whole(col("profit_margin_percentage")), "% on ", whole(col("units_sold")), " units"),
             col("estimated_profit") / F.greatest("units_sold", F.lit(1.0)) * 100),
        rows(losing, "P1", "Reprice or retire loss-making item", "item", col("item_id"), col("item_name"),
             say("loss on ", whole(col("units_sold")), " units"), F.abs("estimated_profit")),
        rows(lost, "P1", "Win back valuable customers at risk", "customer_group", F.lit("high_value_at_risk"), say(col("n").cast("string"), " customers"),
             say("lifetime spend ", whole(col("spend"))), col("spend") / 2),
        rows(traps, "P2", "Pause or rework promotion", "promotion", col("promotion_id"), col("promotion_name"),
             say(col("promo_orders").cast("string"), " promotion orders"), col("promo_discount_spent")),
        rows(waste, "P2", "Cut overproduction", "item", col("item_id"), col("item_name"),
             say("loss ratio ", whole(col("wastage_ratio") * 100), "%, trend ", col("trend_flag")), col("estimated_saving_30pct")),
        rows(poor, "P2", "Check quality of poorly rated item", "item", col("item_id"), col("item_name"),
             say(col("rating_count").cast("string"), " ratings"), col("average_rating")),
        rows(stalled, "P3", "Review item that lost momentum", "item", col("item_id"), col("item_name"),
             say(whole(col("first_60d")), " units before, ", whole(col("last_60d")), " now: ", col("status")), col("sales_change_percentage")),
        rows(peak, "P3", "Align staffing with the busiest cell", "period", slot, F.concat_ws(" ", "day_of_week", "time_period", "order_channel"),
             say(whole(col("order_share_percentage")), "% of all orders"), col("average_order_value")),
    ]
    return reduce(DataFrame.unionByName, parts)


# What each scenario takes for granted.
CLASS_ASSUMPTION = "Units answer the price with the mean elasticity of the class; unit cost stays"
ITEM_ASSUMPTIONS = {
    "price_change": "Units and cost stay; revenue moves with the price",
    "discount_change": "Units and cost stay; revenue falls by the discount",
    "demand_change": "Price and unit cost stay; revenue, contribution and units move together",
    "wastage_change": "Sales stay; contribution moves against the cost of waste",
    "remove_item": "Sales of the item are lost and go to no other item",
}


def what_if_class(classes: DataFrame, elasticity: DataFrame) -> DataFrame:
    """Price scenarios per item class: quantity answers with the class's mean elasticity.

    Items without an estimate count as -1; a class whose mean is not negative is treated as -1.
    """
    e = classes.join(elasticity.select("item_id", "price_elasticity"), "item_id", "left").withColumn("e", F.coalesce("price_elasticity", F.lit(-1.0)))
    sums = e.groupBy("business_class").agg(
        F.count("*").alias("affected_items"), exact_sum("revenue").alias("baseline_revenue"), exact_sum("estimated_profit").alias("baseline_profit"),
        exact_sum("estimated_cost").alias("cost"), exact_sum("units_sold").alias("units"), exact_avg("e", 3).alias("mean_e"))
    table = F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(s).alias("scope"), F.lit(p).alias("price_change_percentage")) for n, s, p in CLASS_SCENARIOS])
    runs = sums.where("units <> 0").select("*", F.inline(table)).where("scope = business_class")
    factor = 1 + F.col("price_change_percentage") / 100.0
    out = (
        runs.withColumn("elasticity", F.when(F.col("mean_e") < 0, F.col("mean_e")).otherwise(F.lit(-1.0)))
        .withColumn("new_units", F.col("units") * (1 + F.col("elasticity") * F.col("price_change_percentage") / 100.0))
        .withColumn("unit_price", F.col("baseline_revenue") / F.col("units")).withColumn("unit_cost", F.col("cost") / F.col("units"))
        .withColumn("new_revenue_estimate", F.col("new_units") * F.col("unit_price") * factor)
        .withColumn("new_profit_estimate", F.col("new_units") * (F.col("unit_price") * factor - F.col("unit_cost")))
    )
    return out.select("scenario", "scope", "price_change_percentage", "affected_items", "baseline_revenue", "baseline_profit", "elasticity",
                      "new_revenue_estimate", "new_profit_estimate", (F.col("new_revenue_estimate") - F.col("baseline_revenue")).alias("revenue_change"),
                      (F.col("new_profit_estimate") - F.col("baseline_profit")).alias("profit_change"), F.lit(CLASS_ASSUMPTION).alias("assumption"))


def what_if_item(revenue: DataFrame, risk: DataFrame, change_percent: float) -> DataFrame:
    """All item scenarios for every item: estimated revenue, contribution and units.

    ``revenue`` has item_id, revenue, contribution and units over completed orders.
    """
    if not -100.0 <= change_percent <= 100.0:
        raise ValueError("a change lies between -100 and 100 percent")
    rate = F.lit(change_percent / 100.0)
    base = revenue.join(risk.select("item_id", "wastage_cost"), "item_id", "left").withColumn("wastage_cost", zero("wastage_cost"))
    r, k, u = F.col("revenue"), F.col("contribution"), F.col("units")
    # A price or discount moves revenue; cost (revenue - contribution) stays.
    kept_cost = lambda f: k * ((r * f - (r - k)) / F.greatest(k, F.lit(1e-9)))
    price, discount, demand = 1 + rate, F.greatest(F.lit(0.0), 1 - rate), F.greatest(F.lit(0.0), 1 + rate)
    estimates = {
        "price_change": (r * price, kept_cost(price), u),
        "discount_change": (r * discount, kept_cost(discount), u),
        "demand_change": (r * demand, k * demand, u * demand),
        "wastage_change": (r, k - F.col("wastage_cost") * rate, u),
        "remove_item": (r * 0.0, k * 0.0, u * 0.0),
    }
    table = F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(ITEM_ASSUMPTIONS[n]).alias("assumption"), *[e.alias(x) for e, x in zip(estimates[n], ("revenue_estimate", "contribution_estimate", "units_estimate"))])
                      for n in ITEM_SCENARIOS])
    return base.select("item_id", "revenue", "contribution", "units", F.inline(table)).withColumns({
        "contribution_change": F.col("contribution_estimate") - F.col("contribution"), "revenue_change": F.col("revenue_estimate") - F.col("revenue")})
