"""Aggregation marts.

Lines are reduced per order (or per item) before any other join, so the big
shuffle is the one on order_id and hot customers, items or outlets arrive as
partial sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions import columns as c
from salesmart.functions.columns import exact_avg, exact_sum, exact_sum_over, on_grid, zero, zero_int
from salesmart.functions.quantiles import with_quantiles
from salesmart.operators.enrich import completed
from salesmart.storage import materialize


def completed_item_sums(lines: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Per item over completed orders: units, lines, revenue, cost, profit.

    Costs are per item, so they join after the reduction.
    """
    sold = lines.join(completed(orders).select("order_id"), "order_id")
    sums = sold.groupBy("item_id").agg(
        exact_sum("quantity").alias("units_sold"),
        F.count("*").alias("order_lines"),
        exact_sum(F.col("quantity") * F.col("unit_price")).alias("revenue"),
        exact_sum("line_discount").alias("d"),
        exact_sum("net_revenue").alias("net_revenue"),
        exact_avg("unit_price", c.PRICE).alias("average_selling_price"),
    )
    return with_cost(sums, items).drop("d")


def with_cost(sums: DataFrame, items: DataFrame) -> DataFrame:
    """Item attributes, cost and profit for per-item ``units_sold``, ``revenue`` and discount ``d``."""
    cost = on_grid(F.col("units_sold") * F.col("cost_price"))
    measures = [n for n in sums.columns if n != "item_id"]
    return sums.join(items, "item_id").select(
        *items.columns, *measures, cost.alias("estimated_cost"), on_grid(F.col("revenue") - F.col("d") - cost).alias("estimated_profit"))


def order_line_sums(lines: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Per order: line count, units, gross, net (and cost, profit when ``items`` is given)."""
    rows = lines
    measures = [
        F.count("*").alias("n_lines"), exact_sum("quantity").alias("units"),
        exact_sum(F.col("quantity") * F.col("unit_price")).alias("gross"), exact_sum("net_revenue").alias("net"),
    ]
    if items is not None:
        rows = lines.join(items.select("item_id", "cost_price"), "item_id")
        cost = F.col("quantity") * F.col("cost_price")
        measures.append(exact_sum(F.col("quantity") * F.col("unit_price") - F.col("line_discount") - cost).alias("profit"))
    return rows.groupBy("order_id").agg(*measures)


def monthly_revenue(lines, orders, outlets, locations) -> DataFrame:
    """Orders and net revenue by month and area."""
    per_order = order_line_sums(lines).select("order_id", "net")
    by_outlet = (
        completed(orders).join(per_order, "order_id")
        .groupBy(c.month_start("order_date").alias("m"), "outlet_id").agg(F.count("*").alias("n"), exact_sum("net").alias("r"))
    )
    places = outlets.join(locations, "location_id").select("outlet_id", "city_area")
    return by_outlet.join(places, "outlet_id").groupBy(c.month_key("m").alias("month"), "city_area").agg(
        F.sum("n").alias("orders"), exact_sum("r").alias("revenue"))


def category_revenue_share(lines, orders, items, categories) -> DataFrame:
    """Net revenue by category and its share of the total."""
    per_item = (
        lines.join(completed(orders).select("order_id"), "order_id").groupBy("item_id").agg(exact_sum("net_revenue").alias("r"))
    )
    by_category = (
        per_item.join(items.select("item_id", "category_name"), "item_id").groupBy("category_name").agg(exact_sum("r").alias("revenue"))
        .join(categories, "category_name")
    )
    total = exact_sum_over("revenue", Window.partitionBy())
    return by_category.select("category_id", "category_name", "revenue", (F.col("revenue") / total).alias("share"))


def channel_monthly(orders) -> DataFrame:
    by_month = completed(orders).groupBy(c.month_start("order_date").alias("m"), "order_channel").agg(
        F.count("*").alias("orders"), exact_sum("total_amount").alias("revenue"))
    return by_month.select(c.month_key("m").alias("month"), "order_channel", "orders", "revenue")


def peak_hours(orders) -> DataFrame:
    return completed(orders).groupBy(F.col("order_hour").alias("hour"), c.day_type("order_date").alias("day_type")).agg(F.count("*").alias("orders"))


def peak_hours_per_day(orders) -> DataFrame:
    """Orders per day by hour and day type: totals divided by the days of that type.

    Days are counted on the reduced (date) set, not with a distinct over orders.
    """
    by_day = completed(orders).groupBy("order_date", F.col("order_hour").alias("hour")).agg(F.count("*").alias("n"))
    days = completed(orders).groupBy("order_date").agg(F.lit(1).alias("one")).groupBy(c.day_type("order_date").alias("day_type")).agg(F.count("*").alias("days"))
    cells = by_day.groupBy("hour", c.day_type("order_date").alias("day_type")).agg(F.sum("n").alias("orders"))
    return cells.join(days, "day_type").select("hour", "day_type", "orders", "days", (F.col("orders") / F.col("days")).alias("orders_per_day"))


def location_ranking(orders, outlets, locations) -> DataFrame:
    by_outlet = completed(orders).groupBy("outlet_id").agg(F.count("*").alias("n"), exact_sum("total_amount").alias("r"))
    return (
        by_outlet.join(outlets.select("outlet_id", "location_id"), "outlet_id").join(locations, "location_id")
        .groupBy("location_id", "city_area").agg(F.sum("n").alias("orders"), exact_sum("r").alias("revenue"))
        .withColumn("avg_order_value", F.col("revenue") / F.col("orders"))
    )


def order_category_sums(lines: DataFrame, items: DataFrame) -> DataFrame:
    """Per order and category: units, gross and profit. Several customer measures derive from it without the lines."""
    rows = lines.join(items.select("item_id", "category_name", "cost_price"), "item_id")
    gross = F.col("quantity") * F.col("unit_price")
    return rows.groupBy("order_id", "category_name").agg(
        exact_sum("quantity").alias("units"), exact_sum(gross).alias("gross"), exact_sum(gross - F.col("line_discount") - F.col("quantity") * F.col("cost_price")).alias("profit"))


def customer_order_sums(orders: DataFrame, lines: DataFrame, items: DataFrame, per_category: DataFrame | None = None) -> DataFrame:
    """Per customer over completed orders, orders and lines reduced in one shuffle; ``per_category`` are stored ``order_category_sums``."""
    per_order = order_line_sums(lines, items) if per_category is None else per_category.groupBy("order_id").agg(
        *[exact_sum(x).alias(x) for x in ("units", "gross", "profit")])
    facts = completed(orders).join(per_order, "order_id", "left")
    return facts.groupBy("customer_id").agg(
        F.count("*").alias("total_orders"), exact_sum("total_amount").alias("total_spend"), exact_avg("total_amount").alias("average_order_value"),
        exact_sum("discount_amount").alias("total_discount_received"), F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"), F.sum(F.when(F.col("promotion_id") != "", 1).otherwise(0)).alias("promo_orders"),
        exact_sum("units").alias("total_items_purchased"), exact_sum("gross").alias("estimated_revenue"),
        exact_sum("profit").alias("estimated_profit"))


def customer_analytics(customers, orders, lines, items) -> DataFrame:
    """All customers with their order, spend, profit and frequency measures."""
    joined = customers.join(customer_order_sums(orders, lines, items), "customer_id", "left")
    doubles = ["total_spend", "average_order_value", "total_discount_received", "total_items_purchased", "estimated_revenue", "estimated_profit"]
    filled = joined.withColumns({d: zero(d) for d in doubles} | {n: zero_int(n) for n in ("total_orders", "promo_orders")})
    days = F.datediff("last_order_date", "registration_date")
    orders_n = F.col("total_orders").cast("double")
    return filled.withColumn("customer_lifetime_days", days.cast("long")).withColumn(
        "orders_per_month",
        F.when(F.col("customer_lifetime_days") > 0, orders_n / (F.col("customer_lifetime_days") / 30)).otherwise(orders_n))


def customer_value_segment(analytics: DataFrame, share: float = 0.90) -> DataFrame:
    """Segment label by spend quantile and order count."""
    stored = materialize(analytics, "customers")
    label = (
        F.when(F.col("total_spend") >= F.col("threshold"), "High Value").when(F.col("total_orders") >= 10, "Frequent")
        .when(F.col("total_orders") >= 3, "Regular").otherwise("Low Activity")
    )
    return with_quantiles(stored, [("threshold", "total_spend", share)]).withColumn("customer_value_segment", label).drop("threshold")


def item_performance(lines, orders, items) -> DataFrame:
    sums = completed_item_sums(lines, orders, items)
    return sums.withColumn("profit_margin_percentage", c.safe_percent("estimated_profit", "revenue"))


def median_quadrant(performance: DataFrame) -> DataFrame:
    """High/low sales and profit against the medians, and both labels combined."""
    stored = materialize(performance, "items")
    marked = with_quantiles(stored, [("um", "units_sold", 0.5), ("pm", "estimated_profit", 0.5)])
    sales = F.when(F.col("units_sold") >= F.col("um"), "High Sales").when(F.col("units_sold") < F.col("um"), "Low Sales").otherwise("Unknown")
    profit = F.when(F.col("estimated_profit") >= F.col("pm"), "High Profit").when(F.col("estimated_profit") < F.col("pm"), "Low Profit").otherwise("Unknown")
    return (
        marked.withColumn("sales_classification", sales).withColumn("profitability_classification", profit)
        .withColumn("menu_business_classification", F.concat_ws(" / ", "sales_classification", "profitability_classification")).drop("um", "pm")
    )


def outlet_performance(orders, lines, items, outlets, locations) -> DataFrame:
    facts = completed(orders).join(order_line_sums(lines, items), "order_id", "left")
    sums = facts.groupBy("outlet_id").agg(
        F.count("*").alias("total_orders"), exact_sum("total_amount").alias("total_sales"), exact_avg("total_amount").alias("average_order_value"),
        exact_sum("discount_amount").alias("total_discount"), exact_sum("units").alias("units_sold"),
        exact_sum("profit").alias("estimated_profit"))
    doubles = ["total_sales", "average_order_value", "total_discount", "units_sold", "estimated_profit"]
    return outlets.join(sums, "outlet_id", "left").join(locations, "location_id", "left").withColumns(
        {d: zero(d) for d in doubles} | {"total_orders": zero_int("total_orders")})


def sales_measures(discount: bool = True) -> list:
    out = [F.count("*").alias("total_orders"), exact_sum("total_amount").alias("total_sales"), exact_avg("total_amount").alias("average_order_value")]
    return out + ([exact_sum("discount_amount").alias("total_discount")] if discount else [])


def daily_sales(orders) -> DataFrame:
    d = completed(orders).groupBy("order_date").agg(*sales_measures())
    return d.withColumn("day_of_week", F.date_format("order_date", "EEEE")).withColumn("is_weekend", c.is_weekend("order_date")).withColumn(
        "month", c.month_key("order_date"))


def monthly_sales(orders) -> DataFrame:
    by_month = completed(orders).groupBy(c.month_start("order_date").alias("month")).agg(*sales_measures())
    return by_month.withColumn("month", c.month_key("month"))


def share_of_total(df: DataFrame, column: str, name: str) -> DataFrame:
    """Percent of the whole set; ``df`` is an aggregate with few rows."""
    total = exact_sum_over(column, Window.partitionBy())
    return df.withColumn(name, F.when(total != 0, F.col(column) / total * 100).otherwise(F.lit(0.0)))


def channel_analysis(orders) -> DataFrame:
    return share_of_total(completed(orders).groupBy("order_channel").agg(*sales_measures()), "total_sales", "sales_percentage")


def by_period(orders, *keys: str) -> DataFrame:
    """Sales per weekday, day part and ``keys``; the weekday is named after the aggregation."""
    cells = completed(orders).groupBy(F.weekday("order_date").alias("_d"), c.day_part("order_hour").alias("time_period"), *keys).agg(*sales_measures(False))
    return cells.select(c.weekday_name("_d").alias("day_of_week"), (F.col("_d") >= 5).alias("is_weekend"), "time_period", *keys,
                        "total_orders", "total_sales", "average_order_value")


def time_pattern(orders) -> DataFrame:
    return by_period(orders)


def peak_period(orders) -> DataFrame:
    """Cells of weekday, day part and channel; peak cells reach the upper quartile of orders.

    At most weekdays x parts x channels cells, so the built-in exact percentile fits one task.
    """
    shared = share_of_total(by_period(orders, "order_channel"), "total_orders", "order_share_percentage")
    cut = F.percentile("total_orders", F.lit(0.75)).over(Window.partitionBy())
    return shared.withColumn("is_peak_cell", F.col("total_orders") >= cut)


def loss_by_item(losses) -> DataFrame:
    return losses.groupBy("item_id", "item_name", "category_name").agg(
        exact_sum("quantity_wasted").alias("quantity_wasted"), exact_sum("estimated_cost").alias("estimated_wastage_cost"),
        F.count("*").alias("wastage_records"))


def rating_by_item(ratings, items) -> DataFrame:
    stats = ratings.groupBy("item_id").agg(
        F.count("rating").alias("rating_count"), (F.sum("rating") / F.count("rating")).alias("average_rating"),
        F.min("rating").alias("minimum_rating"), F.max("rating").alias("maximum_rating"))
    named = stats.join(items.select("item_id", "item_name", "category_name"), "item_id")
    return named.withColumn("rating_anomaly_flag", (F.col("average_rating") < 2) | (F.col("average_rating") > 4.8))


def promotion_usage(promotions, orders) -> DataFrame:
    used = completed(orders).where("promotion_id <> ''").groupBy(F.col("promotion_id").cast("long").alias("promotion_id")).agg(
        F.count("*").alias("promo_orders"), exact_sum("total_amount").alias("promo_sales"), exact_sum("discount_amount").alias("promo_discount"),
        exact_avg("total_amount").alias("average_order_value"))
    return promotions.join(used, "promotion_id", "left").withColumns(
        {n: zero(n) for n in ("promo_sales", "promo_discount", "average_order_value")} | {"promo_orders": zero_int("promo_orders")})


def location_channel(orders, outlets, locations) -> DataFrame:
    by_outlet = completed(orders).groupBy("outlet_id", "order_channel").agg(
        F.count("*").alias("n"), exact_sum("total_amount").alias("s"),
        F.sum(F.when(c.is_weekend("order_date"), 1).otherwise(0)).alias("w"))
    places = outlets.join(locations, "location_id").select("outlet_id", "location_id", "city_area")
    out = by_outlet.join(places, "outlet_id").groupBy("city_area", "location_id", "order_channel").agg(
        F.sum("n").alias("total_orders"), exact_sum("s").alias("total_sales"), F.sum("w").alias("weekend_orders"))
    total = F.greatest(exact_sum_over("total_sales", Window.partitionBy()), F.lit(1.0))
    return (
        out.withColumn("average_order_value", F.col("total_sales") / F.col("total_orders"))
        .withColumn("weekend_order_share", c.safe_ratio("weekend_orders", "total_orders"))
        .withColumn("sales_share_percentage", F.col("total_sales") / total * 100)
    )


def order_basket_agg(lines, orders) -> DataFrame:
    """Basket size, quantity and mean price per completed order with lines."""
    per_order = lines.groupBy("order_id").agg(
        F.count("*").alias("basket_size"), exact_sum("quantity").alias("basket_quantity"), exact_avg("unit_price", c.PRICE).alias("avg_unit_price"))
    return per_order.join(completed(orders).select("order_id"), "order_id")


def customer_category_mix(lines, orders, items, per_category: DataFrame | None = None) -> DataFrame:
    """Largest category share of units and number of categories per customer; ``per_category`` are stored ``order_category_sums``."""
    sums = order_category_sums(lines, items) if per_category is None else per_category
    bought = sums.select("order_id", "category_name", "units").join(completed(orders).select("order_id", "customer_id"), "order_id")
    by_category = bought.groupBy("customer_id", "category_name").agg(exact_sum("units").alias("q"))
    return by_category.groupBy("customer_id").agg(
        (F.max("q") / F.sum("q")).alias("top_category_share"), F.count("*").alias("unique_categories"))


def weekend_share(lines, orders) -> DataFrame:
    """Share of a customer's completed orders with lines that fall on a weekend."""
    has_lines = completed(orders).join(lines.select("order_id").distinct(), "order_id", "left_semi")
    weekend = F.when(c.is_weekend("order_date"), 1).otherwise(0)
    return has_lines.groupBy("customer_id").agg((F.sum(weekend) / F.count("*")).alias("weekend_order_share"))


def item_sales(lines, orders) -> DataFrame:
    """Per item over completed orders: sales sums, per-line shares, distinct customers and orders, from one pass over the lines.

    Lines fold to (order, item) where the join on order_id has placed them, then to (item, customer), then to
    items: the rows of a level are the distinct count of the next, and sums on the grid add up exactly.
    """
    o = completed(orders).select("order_id", "customer_id", (F.col("promotion_id") != "").cast("int").alias("promo"), c.is_weekend("order_date").cast("int").alias("weekend"))
    amounts = {"units_sold": F.col("quantity"), "revenue": F.col("quantity") * F.col("unit_price"), "d": F.col("line_discount"), "net_revenue": F.col("net_revenue")}
    per_order = lines.join(o, "order_id").groupBy("order_id", "item_id", "customer_id", "promo", "weekend").agg(
        F.count("*").alias("n"), *[exact_sum(x).alias(name) for name, x in amounts.items()], exact_sum("unit_price", c.PRICE).alias("prices"))
    weighted = lambda flag: F.sum(F.col(flag) * F.col("n"))
    per_customer = per_order.groupBy("item_id", "customer_id").agg(
        F.count("*").alias("orders"), F.sum("n").alias("n"), weighted("promo").alias("promo"), weighted("weekend").alias("weekend"),
        *[exact_sum(name).alias(name) for name in amounts], exact_sum("prices", c.PRICE).alias("prices"))
    sums = per_customer.groupBy("item_id").agg(
        F.sum("n").alias("order_lines"), *[exact_sum(name).alias(name) for name in amounts], exact_sum("prices", c.PRICE).alias("prices"),
        F.sum("promo").alias("promo"), F.sum("weekend").alias("weekend"), F.count("*").alias("unique_customers"), F.sum("orders").alias("order_line_count"))
    each = lambda name: F.col(name) / F.col("order_lines")
    return sums.select(
        "item_id", "order_lines", *amounts, each("prices").alias("avg_unit_price"), each("promo").alias("promo_dependency"), each("weekend").alias("weekend_order_share"),
        "unique_customers", "order_line_count")


def item_behaviour(lines, orders) -> DataFrame:
    """Per item: mean price, promo and weekend shares per line, distinct customers and orders."""
    return item_sales(lines, orders).select("item_id", "avg_unit_price", "promo_dependency", "weekend_order_share", "unique_customers", "order_line_count")


def payment_mix(orders, unlabelled: str = "Unspecified") -> DataFrame:
    method = F.coalesce(c.blank_to_null("payment_method"), F.lit(unlabelled))
    mix = completed(orders).groupBy(method.alias("method")).agg(F.count("*").alias("orders"), exact_sum("total_amount").alias("total"))
    return share_of_total(mix, "total", "share")


def payment_pivot(orders, methods: list[str], unlabelled: str = "Unspecified") -> DataFrame:
    """Month by payment method; the method list is given, so no extra pass finds it."""
    method = F.coalesce(c.blank_to_null("payment_method"), F.lit(unlabelled))
    rows = completed(orders).select(c.month_start("order_date").alias("month"), method.alias("method"), F.col("total_amount").alias("a"))
    pivoted = rows.groupBy("month").pivot("method", [*methods, unlabelled]).agg(exact_sum("a"))
    return pivoted.select(c.month_key("month").alias("month"), *[zero(F.col(f"`{m}`")).alias(m.lower()) for m in [*methods, unlabelled]])


def channel_refunds(orders) -> DataFrame:
    """Completed totals per channel next to the refunded amount, one scan."""
    done = c.is_completed()
    refunded = F.upper(F.trim("order_status")) == "REFUNDED"
    sums = orders.groupBy(F.col("order_channel").alias("channel")).agg(
        F.count(F.when(done, 1)).alias("orders"), zero(exact_sum(F.when(done, F.col("total_amount")))).alias("revenue"),
        zero(exact_sum(F.when(refunded, F.col("total_amount")))).alias("refunds"))
    return sums.where("orders > 0").withColumn("avg_order_value", c.safe_ratio("revenue", "orders"))


def outlet_type_totals(orders, outlets) -> DataFrame:
    by_outlet = completed(orders).groupBy("outlet_id").agg(F.count("*").alias("n"), exact_sum("total_amount").alias("r"))
    return by_outlet.join(outlets.select("outlet_id", "outlet_type"), "outlet_id").groupBy("outlet_type").agg(
        F.sum("n").alias("orders"), exact_sum("r").alias("revenue"))


def area_month_matrix(monthly: DataFrame) -> DataFrame:
    """Dense area x month grid with zeros; the month list (calendar-sized) is one array."""
    stored = materialize(monthly, "monthly")
    months = stored.agg(F.collect_set("month"))
    grid = stored.select("city_area").distinct().withColumn("month", F.explode(months.scalar()))
    return grid.join(stored.select("city_area", "month", "revenue"), ["city_area", "month"], "left").withColumn("revenue", zero("revenue"))
