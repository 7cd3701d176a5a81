"""Integration joins and derived columns.

Dimension sides carry no broadcast hints: Spark broadcasts them when their size
allows (statically or at run time) and shuffles them otherwise. Only single-row
aggregates are broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions import columns as c
from salesmart.functions.quantiles import with_quantiles


def completed(orders: DataFrame) -> DataFrame:
    """Completed orders. The derived flag, where present, is a filter the scan can take."""
    return orders.where("is_completed") if "is_completed" in orders.columns else orders.where(c.is_completed())


def orders_enriched(orders, outlets, locations, customers, promotions, only_completed: bool = True) -> DataFrame:
    """Order facts with outlet, area, customer and (optional) promotion attributes."""
    o = completed(orders) if only_completed else orders
    who = customers.select("customer_id", "preferred_channel")
    offers = promotions.select(F.col("promotion_id").alias("offer_id"), "promotion_name")
    return (
        o.join(outlets, "outlet_id").join(locations, "location_id").join(who, "customer_id")
        .join(offers, F.nullif(F.col("promotion_id"), F.lit("")).try_cast("long") == F.col("offer_id"), "left")
        .select("order_id", "customer_id", "outlet_id", "order_date", "order_hour", "order_status", "order_channel", "payment_method",
                "promotion_id", "total_amount", "outlet_name", "outlet_type", "location_id", "city_area", "preferred_channel", "promotion_name")
    )


def order_item_revenue(lines, orders, items) -> DataFrame:
    """Lines of completed orders with net revenue and contribution."""
    return (
        lines.join(completed(orders).select("order_id"), "order_id")
        .join(items.select("item_id", "item_name", "category_name", "base_price", "cost_price"), "item_id")
        .select("order_id", "line_number", "item_id", "quantity", "line_total", "line_discount", "item_name", "category_name",
                "base_price", "cost_price", "net_revenue",
                (F.col("net_revenue") - F.col("quantity") * F.col("cost_price")).alias("contribution"))
    )


def item_enriched(items, categories, outlets, locations) -> DataFrame:
    """Item reference with category, outlet, area, unit profit and margin."""
    profit = F.col("base_price") - F.col("cost_price")
    return (
        items.join(categories, "category_name", "left").join(outlets, "outlet_id", "left").join(locations, "location_id", "left")
        .withColumn("estimated_unit_profit", profit)
        .withColumn("estimated_margin_percentage", c.safe_percent("estimated_unit_profit", "base_price"))
    )


def line_economics(lines: DataFrame, items: DataFrame) -> DataFrame:
    """Gross, cost, profit and margin per line (unknown items keep NULL cost)."""
    return (
        lines.join(items.select("item_id", "item_name", "category_name", "base_price", "cost_price"), "item_id", "left")
        .withColumn("gross_revenue", F.col("quantity") * F.col("unit_price"))
        .withColumn("estimated_cost", F.col("quantity") * F.col("cost_price"))
        .withColumn("estimated_profit", F.col("gross_revenue") - F.col("line_discount") - F.col("estimated_cost"))
        .withColumn("estimated_margin_percentage", c.safe_percent("estimated_profit", "gross_revenue"))
    )


def lines_integrated(lines, items, orders, outlets, locations) -> DataFrame:
    """Line economics with order, outlet and area attributes; every line is kept."""
    o = orders.select("order_id", "customer_id", "outlet_id", "order_date", "order_status", "is_completed",
                      (F.col("promotion_id") != "").alias("is_promo_order"))
    places = outlets.join(locations, "location_id", "left").select("outlet_id", "outlet_name", "outlet_type", "city_area")
    return line_economics(lines, items).join(o, "order_id", "left").join(places, "outlet_id", "left")


def orders_integrated(orders, customers, outlets, locations) -> DataFrame:
    """Orders with customer, outlet and area columns; clashing names get a suffix."""
    who = customers.select("customer_id", "customer_name", F.col("outlet_id").alias("outlet_id_customer"), "preferred_channel", "registration_date")
    where = outlets.select("outlet_id", "outlet_name", "outlet_type", F.col("location_id").alias("location_id_outlet"))
    area = locations.select(F.col("location_id").alias("location_id_outlet"), "city_area")
    return orders.join(who, "customer_id", "left").join(where, "outlet_id", "left").join(area, "location_id_outlet", "left")


def loss_enriched(losses: DataFrame, outlets: DataFrame) -> DataFrame:
    return losses.join(outlets.select("outlet_id", "outlet_name"), "outlet_id", "left").withColumn("loss_month", c.month_key("loss_date"))


def ratings_enriched(ratings: DataFrame, items: DataFrame, outlets: DataFrame) -> DataFrame:
    names = items.select("item_id", "item_name", "category_name", "outlet_id").join(outlets.select("outlet_id", "outlet_name"), "outlet_id", "left")
    return ratings.join(names, "item_id", "left")


def stock_enriched(stock: DataFrame) -> DataFrame:
    """Turnover indicator and low-stock flag per stock row."""
    return stock.withColumn("stock_turnover_indicator", c.safe_ratio("sold", "opening")).withColumn(
        "low_stock_flag", F.col("closing") <= F.col("reorder_level"))


def price_change(prices: DataFrame) -> DataFrame:
    changed = prices.withColumn("price_change", F.col("new_price") - F.col("old_price"))
    return changed.withColumn("price_change_percentage", c.safe_percent("price_change", "old_price"))


def promo_window_join(orders: DataFrame, promotions: DataFrame) -> DataFrame:
    """Every completed order with every promotion running at its outlet that day.

    Windows are unrolled to days, so the join is an equi-join on (outlet, day)
    instead of a range filter over all pairs of an outlet: a busy outlet spreads
    over its days and only true matches are produced.
    """
    days = promotions.where("start_date <= end_date").select("promotion_id", "discount_percentage", "outlet_id", F.explode(F.sequence("start_date", "end_date")).alias("order_date"))
    o = completed(orders).select("order_id", "outlet_id", "order_date", "total_amount")
    return o.join(days, ["outlet_id", "order_date"])


def first_value_lookup(rows: DataFrame, key: str, source: DataFrame, value: str, order: str, name: str) -> DataFrame:
    """Map ``key`` through ``source``; of several values per key the first by ``order`` wins.

    The winner is found with ``min(order)``, which combines before the shuffle, so a
    key repeated in most of the source costs no more than any other.
    """
    first = source.groupBy(key).agg(F.min(order).alias(order))
    mapping = first.join(source.select(key, order, F.col(value).alias(name)), [key, order]).select(key, name)
    return rows.join(mapping, key, "left")


def backfill(rows: DataFrame, column: str, dimension: DataFrame, key: str, source: str, default: str) -> DataFrame:
    """Fill blank values of ``column`` only: from the dimension, else ``default``."""
    looked_up = rows.join(dimension.select(key, F.col(source).alias("_fill")), key, "left")
    filled = F.coalesce(c.blank_to_null(column), c.blank_to_null("_fill"), F.lit(default))
    return looked_up.withColumn(column, filled).drop("_fill")


def daily_calendar(daily: DataFrame, date: str, values: list[str], start=None, end=None) -> DataFrame:
    """Gap-free calendar between the first and last day (or given bounds), zeros for missing days."""
    first = F.lit(start).cast("date") if start else F.min(date)
    last = F.lit(end).cast("date") if end else F.max(date)
    days = daily.agg(first.alias("a"), last.alias("z")).select(F.explode(F.sequence("a", "z")).alias(date))
    filled = [F.coalesce(F.col(v), F.lit(0)).cast(daily.schema[v].dataType).alias(v) for v in values]
    return days.join(daily, date, "left").select(date, *filled)


def calendar_parts(orders: DataFrame) -> DataFrame:
    d = F.col("order_date")
    return orders.select(
        "order_id", "order_date", F.year(d).alias("order_year"), F.month(d).alias("order_month"), F.date_format(d, "MMMM").alias("order_month_name"),
        F.weekofyear(d).alias("order_week"), F.dayofmonth(d).alias("order_day"), F.date_format(d, "EEEE").alias("day_of_week"),
        c.is_weekend(d).alias("is_weekend"))


def high_value_flag(orders: DataFrame, share: float = 0.90) -> DataFrame:
    """Orders at or above the value quantile of all orders."""
    marked = with_quantiles(orders, [("threshold", "total_amount", share)])
    return marked.withColumn("is_high_value_order", F.col("total_amount") >= F.col("threshold")).drop("threshold")


def category_codes(rows: DataFrame, column: str, name: str, missing: str = "Unknown", among: DataFrame | None = None) -> DataFrame:
    """0-based code of the sorted distinct values (of ``among``, a leaner frame of the same rows, if given), blanks coded as ``missing``.

    For enumerations: the distinct values form one small array, and each row looks
    itself up there. A join on the value would shuffle all rows to a few hot keys.
    """
    value = F.coalesce(c.blank_to_null(column), F.lit(missing))
    values = (rows if among is None else among).groupBy(value.alias("v")).agg(F.lit(1).alias("one")).agg(F.array_sort(F.collect_list("v")))
    return rows.withColumn(name, (F.array_position(values.scalar(), value) - 1).cast("long"))
