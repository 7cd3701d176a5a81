"""Item analytics: business classes, losses, elasticity, slow movers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions import columns as c
from salesmart.functions.columns import exact_avg, exact_sum, zero, zero_int
from salesmart.functions.quantiles import with_quantiles
from salesmart.operators.enrich import completed
from salesmart.operators.marts import item_sales, loss_by_item, with_cost
from salesmart.storage import materialize


def item_frame(lines, orders, items, ratings, losses) -> DataFrame:
    """Sales, rating, loss and behaviour measures per sold item, zeros where absent.

    Sales sums, shares and distinct counts come from one pass over the lines.
    """
    sales = with_cost(item_sales(lines, orders), items).drop("d").withColumn("profit_margin_percentage", c.safe_percent("estimated_profit", "revenue"))
    scores = ratings.groupBy("item_id").agg(F.count("rating").alias("rating_count"), (F.sum("rating") / F.count("rating")).alias("average_rating"))
    wasted = loss_by_item(losses).select("item_id", "quantity_wasted")
    df = sales.join(scores, "item_id", "left").join(wasted, "item_id", "left")
    filled = df.withColumns({n: zero(n) for n in ("average_rating", "quantity_wasted")} | {"rating_count": zero_int("rating_count")})
    return filled.withColumn("average_selling_price", F.col("avg_unit_price")).withColumn(
        "wastage_ratio", F.col("quantity_wasted") / F.greatest(F.col("units_sold") + F.col("quantity_wasted"), F.lit(1.0)))


def item_business_class(frame: DataFrame) -> DataFrame:
    """Class by medians of units, profit and margin, plus contradictory cases."""
    stored = materialize(frame, "item-frame")
    m = with_quantiles(stored, [("um", "units_sold", 0.5), ("pm", "estimated_profit", 0.5), ("mm", "profit_margin_percentage", 0.5)])
    demand = F.col("units_sold") >= F.col("um")
    profit = F.col("estimated_profit") >= F.col("pm")
    margin = F.col("profit_margin_percentage") >= F.col("mm")
    # Class and case labels.
    label = (
        F.when(demand & profit & margin, "Profit Driver").when(demand, "Volume Driver").when(margin, "Hidden Opportunity").otherwise("Low Performer")
    )
    # Of several contradictions the last rule is reported, so it is tested first.
    odd = (
        F.when(profit & (F.col("wastage_ratio") > 0.15), "High profit but heavy wastage")
        .when(margin & (F.col("average_rating") > 0) & (F.col("average_rating") < 3), "High margin but poor customer rating")
        .when(demand & (F.col("estimated_profit") < 0), "High volume but negative profit").otherwise("")
    )
    return m.withColumn("business_class", label).withColumn("contradictory_case", odd).drop("um", "pm", "mm")


def loss_risk(losses: DataFrame, lines: DataFrame, orders: DataFrame, per_item_trend: bool = False) -> DataFrame:
    """Loss ratio and risk per item, with the cost trend from first to last quarter.

    The trend is one flag for the whole chain; ``per_item_trend`` gives each item its own.
    """
    by_item = losses.groupBy("item_id", "item_name", "outlet_id").agg(
        exact_sum("quantity_wasted").alias("quantity_wasted"), exact_sum("estimated_cost").alias("wastage_cost"), F.count("*").alias("wastage_records"))
    sold = lines.select("order_id", "item_id", "quantity").join(completed(orders).select("order_id"), "order_id").groupBy("item_id").agg(
        exact_sum("quantity").alias("units_sold"))
    ratio = F.col("quantity_wasted") / F.greatest(F.col("quantity_wasted") + F.col("units_sold"), F.lit(1.0))
    risk = F.when(F.col("wastage_ratio") > 0.15, "High").when(F.col("wastage_ratio") > 0.05, "Medium").otherwise("Low")
    df = by_item.join(sold, "item_id", "left").withColumn("units_sold", zero("units_sold")).withColumn("wastage_ratio", ratio).withColumn("risk_level", risk)

    keys = ["item_id"] if per_item_trend else []
    quarters = losses.groupBy(*keys, F.date_trunc("quarter", "loss_date").alias("q")).agg(exact_sum("estimated_cost").alias("cost"))
    ends = quarters.groupBy(*keys).agg(F.min_by("cost", "q").alias("first"), F.max_by("cost", "q").alias("last"), F.count("*").alias("n"))
    flag = (
        F.when(F.col("n") < 2, "stable").when(F.col("last") > F.col("first") * 1.1, "increasing")
        .when(F.col("last") < F.col("first") * 0.9, "decreasing").otherwise("stable")
    )
    trend = ends.select(*keys, flag.alias("trend_flag"))
    df = df.join(trend, "item_id", "left") if per_item_trend else df.withColumn("trend_flag", F.coalesce(trend.scalar(), F.lit("stable")))
    return df.withColumn("estimated_saving_30pct", F.col("wastage_cost") * 0.30)


def price_elasticity(lines: DataFrame, orders: DataFrame, min_months: int = 4) -> DataFrame:
    """Slope of ln(units) on ln(mean price) over months, per item."""
    sold = lines.select("order_id", "item_id", "quantity", "unit_price").join(completed(orders).select("order_id", "order_date"), "order_id")
    monthly = sold.groupBy("item_id", c.month_start("order_date").alias("month")).agg(
        exact_sum("quantity").alias("units"), exact_avg("unit_price", c.PRICE).alias("price")).where("units > 0 and price > 0")
    fit = monthly.groupBy("item_id").agg(
        F.count("*").alias("months_observed"), exact_avg("price", 10).alias("average_price"), exact_sum("units").alias("total_units"),
        F.regr_slope(F.ln("units"), F.ln("price")).alias("slope"), F.stddev_pop(F.ln("price")).alias("spread"))
    usable = fit.where((F.col("months_observed") >= min_months) & (F.col("spread") >= 1e-9))
    return usable.select("item_id", "months_observed", "average_price", "total_units", F.round("slope", 3).alias("price_elasticity"),
                         (F.col("slope") < -1.0).alias("price_sensitive"))


def slow_movers(lines, orders, items, start: str, cutoff: str, days: int = 60) -> DataFrame:
    """Items that sold in the first window and stopped, fell or barely move in the last."""
    first_day, last_day = F.lit(start).cast("date"), F.lit(cutoff).cast("date")
    day = F.col("order_date")
    late = day.between(F.date_sub(last_day, days), last_day)
    early = ~late & day.between(first_day, F.date_add(first_day, days))
    sold = lines.select("order_id", "item_id", "quantity").join(completed(orders).select("order_id", "order_date"), "order_id")
    units = lambda p: exact_sum(F.when(p, F.col("quantity")).otherwise(0.0))
    per_item = sold.groupBy("item_id").agg(units(early).alias("first_60d"), units(late).alias("last_60d"), units(~early & ~late).alias("mid"))
    frame = materialize(per_item.where("first_60d > 0").withColumn("both", F.col("first_60d") + F.col("last_60d")), "slow-movers")
    q = with_quantiles(frame, [("low_total", "both", 0.10), ("low_recent", "last_60d", 0.10)])
    status = (
        F.when(F.col("last_60d") == 0, "no_recent_sales").when(F.col("last_60d") < 0.25 * F.col("first_60d"), "declining")
        .when((F.col("both") <= F.col("low_total")) & (F.col("last_60d") <= F.col("low_recent")), "low_velocity").otherwise("stable")
    )
    change = (F.col("last_60d") - F.col("first_60d")) / F.col("first_60d") * 100
    slow = q.withColumn("sales_change_percentage", change).withColumn("status", status).where("status <> 'stable'")
    return slow.join(items.select("item_id", "item_name"), "item_id").select(
        "item_id", "item_name", "first_60d", "last_60d", "mid", "sales_change_percentage", "status")
