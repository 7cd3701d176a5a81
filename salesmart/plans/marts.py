"""Joins, derived columns and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.functions import columns as c
from salesmart.operators import enrich, marts
from salesmart.plans.registry import query, shared_view

# ---- joins -----------------------------------------------------------------


@query("orders_enriched", """
    SELECT o.order_id, o.customer_id, o.outlet_id, o.order_date, o.order_hour, o.order_status, o.order_channel, o.payment_method,
      o.promotion_id, o.total_amount, u.outlet_name, u.outlet_type, u.location_id, l.city_area, k.preferred_channel, p.promotion_name
    FROM donep o JOIN outlet u ON o.outlet_id = u.outlet_id JOIN loc l ON u.location_id = l.location_id
    JOIN cust k ON o.customer_id = k.customer_id LEFT JOIN promo p ON o.promotion_id = p.promotion_id::VARCHAR""")
def _(d):
    return enrich.orders_enriched(d.promo_orders, d.outlets, d.locations, d.customers, d.promotions)


@query("order_item_revenue", """
    SELECT l.order_id, l.line_number, l.item_id, l.quantity, l.line_total, l.line_discount, i.item_name, i.category_name,
      i.base_price, i.cost_price, l.net_revenue, l.net_revenue - l.quantity * i.cost_price AS contribution
    FROM line l JOIN done d ON l.order_id = d.order_id JOIN item i ON l.item_id = i.item_id""")
def _(d):
    return enrich.order_item_revenue(d.lines, d.orders, d.items)


@query("item_enriched", """
    SELECT i.*, c.category_id, u.outlet_name, u.location_id, u.outlet_type, l.city_area, i.base_price - i.cost_price AS estimated_unit_profit,
      CASE WHEN i.base_price > 0 THEN (i.base_price - i.cost_price) / i.base_price * 100 ELSE 0 END AS estimated_margin_percentage
    FROM item i LEFT JOIN cat c ON i.category_name = c.category_name LEFT JOIN outlet u ON i.outlet_id = u.outlet_id
    LEFT JOIN loc l ON u.location_id = l.location_id""")
def _(d):
    return enrich.item_enriched(d.items, d.categories, d.outlets, d.locations)


ECONOMICS = """l.quantity * l.unit_price AS gross_revenue, l.quantity * i.cost_price AS estimated_cost,
      l.quantity * l.unit_price - l.line_discount - l.quantity * i.cost_price AS estimated_profit,
      CASE WHEN l.quantity * l.unit_price > 0 THEN (l.quantity * l.unit_price - l.line_discount - l.quantity * i.cost_price)
        / (l.quantity * l.unit_price) * 100 ELSE 0 END AS estimated_margin_percentage"""


@query("line_economics", f"""
    SELECT l.*, i.item_name, i.category_name, i.base_price, i.cost_price, {ECONOMICS}
    FROM line l LEFT JOIN item i ON l.item_id = i.item_id""")
def _(d):
    return enrich.line_economics(d.lines, d.items)


@query("lines_integrated", f"""
    SELECT l.*, i.item_name, i.category_name, i.base_price, i.cost_price, {ECONOMICS},
      o.customer_id, o.outlet_id, o.order_date, o.order_status, upper(trim(o.order_status)) = 'COMPLETED' AS is_completed,
      o.promotion_id <> '' AS is_promo_order, u.outlet_name, u.outlet_type, a.city_area
    FROM line l LEFT JOIN item i ON l.item_id = i.item_id LEFT JOIN ordp o ON l.order_id = o.order_id
    LEFT JOIN outlet u ON o.outlet_id = u.outlet_id LEFT JOIN loc a ON u.location_id = a.location_id""")
def _(d):
    return enrich.lines_integrated(d.lines, d.items, d.promo_orders, d.outlets, d.locations)


@query("orders_integrated", """
    SELECT o.*, k.customer_name, k.outlet_id AS outlet_id_customer, k.preferred_channel, k.registration_date, u.outlet_name, u.outlet_type,
      u.location_id AS location_id_outlet, a.city_area
    FROM ord o LEFT JOIN cust k ON o.customer_id = k.customer_id LEFT JOIN outlet u ON o.outlet_id = u.outlet_id
    LEFT JOIN loc a ON u.location_id = a.location_id""")
def _(d):
    return enrich.orders_integrated(d.outlet_orders, d.customers, d.outlets, d.locations)


@query("loss_enriched", """SELECT w.*, u.outlet_name, strftime(loss_date, '%Y-%m') AS loss_month
    FROM loss w LEFT JOIN outlet u ON w.outlet_id = u.outlet_id""")
def _(d):
    return enrich.loss_enriched(d.losses, d.outlets)


@query("ratings_enriched", """SELECT r.*, i.item_name, i.category_name, i.outlet_id, u.outlet_name
    FROM rating r LEFT JOIN item i ON r.item_id = i.item_id LEFT JOIN outlet u ON i.outlet_id = u.outlet_id""")
def _(d):
    return enrich.ratings_enriched(d.ratings, d.items, d.outlets)


STOCK = """SELECT *, CASE WHEN opening > 0 THEN sold / opening ELSE 0 END AS stock_turnover_indicator,
    closing <= reorder_level AS low_stock_flag FROM stock"""
PRICE = """SELECT *, new_price - old_price AS price_change,
    CASE WHEN old_price > 0 THEN (new_price - old_price) / old_price * 100 ELSE 0 END AS price_change_percentage FROM price"""


@query("stock_enriched", STOCK)
def _(d):
    return enrich.stock_enriched(d.stock)


@query("stock_flags", f"SELECT low_stock_flag, count(*) AS rows, sum(sold) AS sold FROM ({STOCK}) GROUP BY 1")
def _(d):
    return enrich.stock_enriched(d.stock).groupBy("low_stock_flag").agg(F.count("*").alias("rows"), c.exact_sum("sold").alias("sold"))


@query("price_enriched", f"""SELECT p.*, n.n_items FROM ({PRICE}) p LEFT JOIN
    (SELECT brand, count(*) AS n_items FROM item GROUP BY 1) n ON p.brand = n.brand""")
def _(d):
    sizes = d.items.groupBy("brand").agg(F.count("*").alias("n_items"))
    return enrich.price_change(d.prices).join(sizes, "brand", "left")


@query("price_change", PRICE)
def _(d):
    return enrich.price_change(d.prices)


@query("semi_join_customers", "SELECT * FROM cust WHERE customer_id IN (SELECT customer_id FROM done)")
def _(d):
    return d.customers.join(enrich.completed(d.orders).select("customer_id").distinct(), "customer_id", "left_semi")


@query("anti_join_holdout", "SELECT * FROM cust WHERE customer_id NOT IN (SELECT customer_id FROM purchase_user)")
def _(d):
    held_out = d.table("events").where("event_type = 'purchase'").select(F.col("user_id").alias("customer_id")).distinct()
    return d.customers.join(held_out, "customer_id", "left_anti")


shared_view("purchase_user", "SELECT user_id AS customer_id FROM events WHERE event_type = 'purchase'")


@query("promo_window_join", """
    SELECT o.outlet_id, o.order_date, o.order_id, o.total_amount, p.promotion_id, p.discount_percentage
    FROM done o JOIN promo p ON o.outlet_id = p.outlet_id AND o.order_date BETWEEN p.start_date AND p.end_date""")
def _(d):
    return enrich.promo_window_join(d.outlet_orders, d.promotions)


@query("chain_lift", """
    SELECT i.brand, count(DISTINCT l.order_id) AS orders, count(DISTINCT l.order_id) / (SELECT count(*) FROM done) AS chain_share
    FROM line l JOIN done o ON l.order_id = o.order_id JOIN item i ON l.item_id = i.item_id GROUP BY 1""")
def _(d):
    done = enrich.completed(d.orders).select("order_id")
    bought = d.lines.select("order_id", "item_id").join(done, "order_id").join(d.items.select("item_id", "brand"), "item_id")
    pairs = bought.groupBy("brand", "order_id").agg(F.lit(1).alias("one"))
    return pairs.groupBy("brand").agg(F.count("*").alias("orders")).withColumn(
        "chain_share", F.col("orders") / done.agg(F.count("*")).scalar())


@query("dim_lookup", """
    SELECT p.brand, p.month, p.new_price, f.first_item_name FROM price p LEFT JOIN
      (SELECT brand, arg_min(item_name, item_id) AS first_item_name FROM item GROUP BY 1) f ON p.brand = f.brand""")
def _(d):
    return enrich.first_value_lookup(d.prices.select("brand", "month", "new_price"), "brand", d.items, "item_name", "item_id", "first_item_name")


@query("backfill_labels", """
    SELECT o.order_id, o.customer_id, o.order_date, o.order_hour, o.order_status, o.is_completed, o.order_channel, o.total_amount, o.outlet_id,
      coalesce(nullif(trim(o.payment_method), ''), nullif(trim(k.preferred_channel), ''), 'Unspecified') AS payment_method
    FROM ord o LEFT JOIN cust k ON o.customer_id = k.customer_id""")
def _(d):
    return enrich.backfill(d.outlet_orders, "payment_method", d.customers, "customer_id", "preferred_channel", "Unspecified")


@query("daily_calendar", """
    WITH sales AS (SELECT order_date, sum(total_amount::DECIMAL(18,4))::DOUBLE AS total_sales, count(*) AS total_orders FROM done GROUP BY 1)
    SELECT c.order_date, coalesce(total_sales, 0) AS total_sales, coalesce(total_orders, 0) AS total_orders
    FROM (SELECT unnest(generate_series((SELECT min(order_date) FROM sales), (SELECT max(order_date) FROM sales), INTERVAL 1 DAY))::DATE AS order_date) c
    LEFT JOIN sales s ON c.order_date = s.order_date""")
def _(d):
    daily = enrich.completed(d.orders).groupBy("order_date").agg(c.exact_sum("total_amount").alias("total_sales"), F.count("*").alias("total_orders"))
    return enrich.daily_calendar(daily, "order_date", ["total_sales", "total_orders"])


# ---- derived columns -------------------------------------------------------


@query("completed_orders", "SELECT order_id, customer_id, order_date, order_hour, order_status, is_completed, order_channel, total_amount FROM done")
def _(d):
    return enrich.completed(d.orders)


@query("calendar_parts", """
    SELECT order_id, order_date, year(order_date) AS order_year, month(order_date) AS order_month, monthname(order_date) AS order_month_name,
      weekofyear(order_date) AS order_week, day(order_date) AS order_day, dayname(order_date) AS day_of_week, isodow(order_date) >= 6 AS is_weekend
    FROM ord""")
def _(d):
    return enrich.calendar_parts(d.orders)


shared_view("clock", """SELECT event_id, event_type, CASE WHEN event_id % 50 = 0 THEN 'bad' WHEN event_id % 31 = 0 THEN '25:00:00'
    ELSE strftime(ts, '%H:%M:%S') END AS clock FROM events""")


@query("order_hour", """SELECT event_id, clock, CASE WHEN clock NOT IN ('bad', '25:00:00') THEN substr(clock, 1, 2)::INT END AS order_hour FROM clock""")
def _(d):
    key = F.col("event_id")
    text = F.when(key % 50 == 0, "bad").when(key % 31 == 0, "25:00:00").otherwise(F.date_format("ts", "HH:mm:ss"))
    return d.table("events").select("event_id", text.alias("clock")).withColumn("order_hour", c.hour_of("clock"))


DAY_PART = """CASE WHEN order_hour BETWEEN 7 AND 10 THEN 'Morning' WHEN order_hour BETWEEN 11 AND 14 THEN 'Lunch Peak'
    WHEN order_hour BETWEEN 15 AND 17 THEN 'Afternoon' WHEN order_hour BETWEEN 18 AND 21 THEN 'Dinner Peak' ELSE 'Late / Off-Peak' END"""


@query("day_part", f"SELECT order_id, order_hour, {DAY_PART} AS time_period FROM ord")
def _(d):
    return d.orders.select("order_id", "order_hour", c.day_part("order_hour").alias("time_period"))


@query("safe_ratio", """SELECT order_id, CASE WHEN subtotal > 0 THEN discount_amount / subtotal * 100 ELSE 0 END AS discount_rate_percentage,
    CASE WHEN discount_amount > 0 THEN total_amount / discount_amount ELSE 0 END AS spend_per_discount FROM ordp""")
def _(d):
    return d.promo_orders.select("order_id", c.safe_percent("discount_amount", "subtotal").alias("discount_rate_percentage"),
                                 c.safe_ratio("total_amount", "discount_amount").alias("spend_per_discount"))


@query("high_value_flag", """SELECT order_id, customer_id, order_date, order_hour, order_status, is_completed, order_channel, total_amount,
    total_amount >= (SELECT quantile_cont(total_amount, 0.9) FROM ord) AS is_high_value_order FROM ord""")
def _(d):
    return enrich.high_value_flag(d.orders)


@query("category_codes", """WITH v AS (SELECT order_id, coalesce(nullif(trim(payment_method), ''), 'Unknown') AS p FROM ord)
    SELECT o.order_id, o.customer_id, o.order_date, o.order_hour, o.order_status, o.is_completed, o.order_channel, o.total_amount, o.outlet_id, o.payment_method,
      c.code AS payment_code
    FROM ord o JOIN v ON o.order_id = v.order_id JOIN (SELECT p, row_number() OVER (ORDER BY p) - 1 AS code FROM (SELECT DISTINCT p FROM v)) c ON v.p = c.p""")
def _(d):
    return enrich.category_codes(d.outlet_orders, "payment_method", "payment_code")


@query("weekday_code", "SELECT order_id, isodow(order_date) - 1 AS day_of_week_code FROM ord")
def _(d):
    return d.orders.select("order_id", F.weekday("order_date").alias("day_of_week_code"))


# ---- marts -----------------------------------------------------------------


@query("monthly_revenue", """
    SELECT strftime(o.order_date, '%Y-%m') AS month, a.city_area, count(DISTINCT o.order_id) AS orders, sum(net_revenue::DECIMAL(18,4))::DOUBLE AS revenue
    FROM line l JOIN done o ON l.order_id = o.order_id JOIN outlet u ON o.outlet_id = u.outlet_id JOIN loc a ON u.location_id = a.location_id
    GROUP BY 1, 2""")
def _(d):
    return marts.monthly_revenue(d.lines, d.outlet_orders, d.outlets, d.locations)


@query("category_revenue_share", """
    SELECT c.category_id, c.category_name, r.revenue, r.revenue / (sum(r.revenue::DECIMAL(18,4)) OVER ())::DOUBLE AS share
    FROM (SELECT i.category_name, sum(l.net_revenue::DECIMAL(18,4))::DOUBLE AS revenue
      FROM line l JOIN done o ON l.order_id = o.order_id JOIN item i ON l.item_id = i.item_id GROUP BY 1) r
    JOIN cat c ON r.category_name = c.category_name""")
def _(d):
    return marts.category_revenue_share(d.lines, d.orders, d.items, d.categories)


@query("channel_monthly", """SELECT strftime(order_date, '%Y-%m') AS month, order_channel, count(*) AS orders,
    sum(total_amount::DECIMAL(18,4))::DOUBLE AS revenue FROM done GROUP BY 1, 2""")
def _(d):
    return marts.channel_monthly(d.orders)


DAY_TYPE = "CASE WHEN isodow(order_date) >= 6 THEN 'weekend' ELSE 'weekday' END"


@query("peak_hours", f"SELECT order_hour AS hour, {DAY_TYPE} AS day_type, count(*) AS orders FROM done GROUP BY 1, 2")
def _(d):
    return marts.peak_hours(d.orders)


PER_DAY = f"""SELECT h.hour, h.day_type, h.orders, t.days, h.orders / t.days AS orders_per_day
    FROM (SELECT order_hour AS hour, {DAY_TYPE} AS day_type, count(*) AS orders FROM done GROUP BY 1, 2) h
    JOIN (SELECT {DAY_TYPE} AS day_type, count(DISTINCT order_date) AS days FROM done GROUP BY 1) t ON h.day_type = t.day_type"""


@query("peak_hours_per_day", PER_DAY)
def _(d):
    return marts.peak_hours_per_day(d.orders)


LOCATION_RANKING = """SELECT a.location_id, a.city_area, count(*) AS orders, sum(total_amount::DECIMAL(18,4))::DOUBLE AS revenue,
    sum(total_amount::DECIMAL(18,4))::DOUBLE / count(*) AS avg_order_value
    FROM done o JOIN outlet u ON o.outlet_id = u.outlet_id JOIN loc a ON u.location_id = a.location_id GROUP BY 1, 2"""
shared_view("location_rank", LOCATION_RANKING)


@query("location_ranking", LOCATION_RANKING)
def _(d):
    return marts.location_ranking(d.outlet_orders, d.outlets, d.locations)


shared_view("customer_stats", """
    SELECT k.*, coalesce(o.n, 0)::BIGINT AS total_orders, coalesce(o.spend, 0) AS total_spend, coalesce(o.spend / o.n, 0) AS average_order_value,
      coalesce(o.disc, 0) AS total_discount_received, o.first_order_date, o.last_order_date, coalesce(o.promo, 0)::BIGINT AS promo_orders,
      coalesce(l.units, 0) AS total_items_purchased, coalesce(l.gross, 0) AS estimated_revenue, coalesce(l.profit, 0) AS estimated_profit,
      (o.last_order_date - k.registration_date)::BIGINT AS customer_lifetime_days,
      CASE WHEN o.last_order_date - k.registration_date > 0 THEN o.n::DOUBLE / ((o.last_order_date - k.registration_date) / 30)
        ELSE coalesce(o.n, 0)::DOUBLE END AS orders_per_month
    FROM cust k LEFT JOIN (SELECT customer_id, count(*) AS n, sum(total_amount::DECIMAL(18,4))::DOUBLE AS spend, sum(discount_amount::DECIMAL(18,4))::DOUBLE AS disc,
        min(order_date) AS first_order_date, max(order_date) AS last_order_date, sum(CASE WHEN promotion_id <> '' THEN 1 ELSE 0 END) AS promo
      FROM donep GROUP BY 1) o ON k.customer_id = o.customer_id
    LEFT JOIN (SELECT l.customer_id, sum(quantity::DECIMAL(18,4))::DOUBLE AS units, sum((quantity * unit_price)::DECIMAL(18,4))::DOUBLE AS gross,
        sum((quantity * unit_price - line_discount - quantity * cost_price)::DECIMAL(18,4))::DOUBLE AS profit
      FROM dline l JOIN item i ON l.item_id = i.item_id GROUP BY 1) l ON k.customer_id = l.customer_id""")


@query("customer_analytics", "SELECT * FROM customer_stats")
def _(d):
    return marts.customer_analytics(d.customers, d.promo_orders, d.lines, d.items)


shared_view("customer_segments", """SELECT *, CASE WHEN total_spend >= (SELECT quantile_cont(total_spend, 0.9) FROM customer_stats) THEN 'High Value'
    WHEN total_orders >= 10 THEN 'Frequent' WHEN total_orders >= 3 THEN 'Regular' ELSE 'Low Activity' END AS customer_value_segment FROM customer_stats""")


@query("customer_value_segment", "SELECT * FROM customer_segments")
def _(d):
    return marts.customer_value_segment(marts.customer_analytics(d.customers, d.promo_orders, d.lines, d.items))


shared_view("item_perf", """
    SELECT *, CASE WHEN revenue > 0 THEN estimated_profit / revenue * 100 ELSE 0 END AS profit_margin_percentage
    FROM (SELECT i.*, s.units_sold, s.order_lines, s.revenue, s.net_revenue, s.average_selling_price, s.cost::DOUBLE AS estimated_cost,
        (s.g - s.d - s.cost)::DOUBLE AS estimated_profit
      FROM item i JOIN (SELECT l.item_id, sum(quantity::DECIMAL(18,4))::DOUBLE AS units_sold, count(*) AS order_lines,
          sum((quantity * unit_price)::DECIMAL(18,4)) AS g, sum((quantity * unit_price)::DECIMAL(18,4))::DOUBLE AS revenue,
          sum(line_discount::DECIMAL(18,4)) AS d, sum(net_revenue::DECIMAL(18,4))::DOUBLE AS net_revenue,
          sum((quantity * cost_price)::DECIMAL(18,4)) AS cost, sum(unit_price::DECIMAL(18,7))::DOUBLE / count(*) AS average_selling_price
        FROM dline l JOIN item x ON l.item_id = x.item_id GROUP BY 1) s ON i.item_id = s.item_id)""")


@query("item_performance", "SELECT * FROM item_perf")
def _(d):
    return marts.item_performance(d.lines, d.orders, d.items)


@query("median_quadrant", """
    SELECT *, CASE WHEN units_sold >= um THEN 'High Sales' ELSE 'Low Sales' END AS sales_classification,
      CASE WHEN estimated_profit >= pm THEN 'High Profit' ELSE 'Low Profit' END AS profitability_classification,
      (CASE WHEN units_sold >= um THEN 'High Sales' ELSE 'Low Sales' END) || ' / '
        || (CASE WHEN estimated_profit >= pm THEN 'High Profit' ELSE 'Low Profit' END) AS menu_business_classification
    FROM (SELECT * FROM item_perf), (SELECT median(units_sold) AS um, median(estimated_profit) AS pm FROM item_perf)""".replace(
        "SELECT *, CASE WHEN units_sold >= um", "SELECT * EXCLUDE (um, pm), CASE WHEN units_sold >= um"))
def _(d):
    return marts.median_quadrant(marts.item_performance(d.lines, d.orders, d.items))


@query("outlet_performance", """
    SELECT u.*, a.city_area, coalesce(o.n, 0)::BIGINT AS total_orders, coalesce(o.s, 0) AS total_sales, coalesce(o.s / o.n, 0) AS average_order_value,
      coalesce(o.d, 0) AS total_discount, coalesce(l.units, 0) AS units_sold, coalesce(l.profit, 0) AS estimated_profit
    FROM outlet u LEFT JOIN (SELECT outlet_id, count(*) AS n, sum(total_amount::DECIMAL(18,4))::DOUBLE AS s, sum(discount_amount::DECIMAL(18,4))::DOUBLE AS d
      FROM donep GROUP BY 1) o ON u.outlet_id = o.outlet_id
    LEFT JOIN (SELECT l.outlet_id, sum(quantity::DECIMAL(18,4))::DOUBLE AS units,
      sum((quantity * unit_price - line_discount - quantity * cost_price)::DECIMAL(18,4))::DOUBLE AS profit
      FROM dline l JOIN item i ON l.item_id = i.item_id GROUP BY 1) l ON u.outlet_id = l.outlet_id
    LEFT JOIN loc a ON u.location_id = a.location_id""")
def _(d):
    return marts.outlet_performance(d.promo_orders, d.lines, d.items, d.outlets, d.locations)


MEASURES = """count(*) AS total_orders, sum(total_amount::DECIMAL(18,4))::DOUBLE AS total_sales,
    sum(total_amount::DECIMAL(18,4))::DOUBLE / count(*) AS average_order_value"""
DISCOUNT = "sum(discount_amount::DECIMAL(18,4))::DOUBLE AS total_discount"


@query("daily_sales", f"""SELECT order_date, {MEASURES}, {DISCOUNT}, dayname(order_date) AS day_of_week, isodow(order_date) >= 6 AS is_weekend,
    strftime(order_date, '%Y-%m') AS month FROM donep GROUP BY order_date""")
def _(d):
    return marts.daily_sales(d.promo_orders)


@query("monthly_sales", f"SELECT strftime(order_date, '%Y-%m') AS month, {MEASURES}, {DISCOUNT} FROM donep GROUP BY 1")
def _(d):
    return marts.monthly_sales(d.promo_orders)


@query("channel_analysis", f"""SELECT *, total_sales / (sum(total_sales::DECIMAL(18,4)) OVER ())::DOUBLE * 100 AS sales_percentage
    FROM (SELECT order_channel, {MEASURES}, {DISCOUNT} FROM donep GROUP BY 1)""")
def _(d):
    return marts.channel_analysis(d.promo_orders)


PERIOD = f"dayname(order_date) AS day_of_week, isodow(order_date) >= 6 AS is_weekend, {DAY_PART} AS time_period"


@query("time_pattern", f"SELECT {PERIOD}, {MEASURES} FROM done GROUP BY 1, 2, 3")
def _(d):
    return marts.time_pattern(d.orders)


shared_view("peak_cells", f"""SELECT *, total_orders / sum(total_orders) OVER () * 100 AS order_share_percentage,
    total_orders >= quantile_cont(total_orders, 0.75) OVER () AS is_peak_cell
    FROM (SELECT {PERIOD}, order_channel, {MEASURES} FROM done GROUP BY 1, 2, 3, 4)""")


@query("peak_period", "SELECT * FROM peak_cells")
def _(d):
    return marts.peak_period(d.orders)


shared_view("loss_item", """SELECT item_id, item_name, category_name, sum(quantity_wasted::DECIMAL(18,4))::DOUBLE AS quantity_wasted,
    sum(estimated_cost::DECIMAL(18,4))::DOUBLE AS estimated_wastage_cost, count(*) AS wastage_records FROM loss GROUP BY 1, 2, 3""")
shared_view("rating_item", """SELECT i.item_id, i.item_name, i.category_name, r.* EXCLUDE (item_id), average_rating < 2 OR average_rating > 4.8 AS rating_anomaly_flag
    FROM (SELECT item_id, count(*) AS rating_count, sum(rating) / count(*) AS average_rating, min(rating) AS minimum_rating, max(rating) AS maximum_rating
      FROM rating GROUP BY 1) r JOIN item i ON r.item_id = i.item_id""")


@query("loss_by_item", "SELECT * FROM loss_item")
def _(d):
    return marts.loss_by_item(d.losses)


@query("rating_by_item", "SELECT * FROM rating_item")
def _(d):
    return marts.rating_by_item(d.ratings, d.items)


@query("promotion_usage", """SELECT p.*, coalesce(n, 0)::BIGINT AS promo_orders, coalesce(s, 0) AS promo_sales, coalesce(x, 0) AS promo_discount,
    coalesce(s / n, 0) AS average_order_value FROM promo p LEFT JOIN (SELECT promotion_id, count(*) AS n, sum(total_amount::DECIMAL(18,4))::DOUBLE AS s,
      sum(discount_amount::DECIMAL(18,4))::DOUBLE AS x FROM donep WHERE promotion_id <> '' GROUP BY 1) o ON p.promotion_id::VARCHAR = o.promotion_id""")
def _(d):
    return marts.promotion_usage(d.promotions, d.promo_orders)


@query("location_channel", """
    SELECT *, total_sales / greatest((sum(total_sales::DECIMAL(18,4)) OVER ())::DOUBLE, 1) * 100 AS sales_share_percentage
    FROM (SELECT a.city_area, a.location_id, o.order_channel, count(*) AS total_orders, sum(total_amount::DECIMAL(18,4))::DOUBLE AS total_sales,
        sum(total_amount::DECIMAL(18,4))::DOUBLE / count(*) AS average_order_value, sum(CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END) AS weekend_orders,
        sum(CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END) / count(*) AS weekend_order_share
      FROM done o JOIN outlet u ON o.outlet_id = u.outlet_id JOIN loc a ON u.location_id = a.location_id GROUP BY 1, 2, 3)""")
def _(d):
    return marts.location_channel(d.outlet_orders, d.outlets, d.locations)


shared_view("basket_agg", """SELECT order_id, count(*) AS basket_size, sum(quantity::DECIMAL(18,4))::DOUBLE AS basket_quantity,
    sum(unit_price::DECIMAL(18,7))::DOUBLE / count(*) AS avg_unit_price FROM dline GROUP BY 1""")
shared_view("category_mix", """SELECT customer_id, max(q) / sum(q) AS top_category_share, count(*) AS unique_categories
    FROM (SELECT l.customer_id, i.category_name, sum(l.quantity) AS q FROM dline l JOIN item i ON l.item_id = i.item_id GROUP BY 1, 2) GROUP BY 1""")
shared_view("weekend_mix", """SELECT customer_id, sum(CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END) / count(*) AS weekend_order_share
    FROM (SELECT DISTINCT customer_id, order_id, order_date FROM dline) GROUP BY 1""")
shared_view("behaviour", """SELECT l.item_id, sum(unit_price::DECIMAL(18,7))::DOUBLE / count(*) AS avg_unit_price,
    sum(CASE WHEN promotion_id <> '' THEN 1 ELSE 0 END) / count(*) AS promo_dependency, sum(CASE WHEN isodow(o.order_date) >= 6 THEN 1 ELSE 0 END) / count(*) AS weekend_order_share,
    count(DISTINCT o.customer_id) AS unique_customers, count(DISTINCT o.order_id) AS order_line_count
    FROM line l JOIN donep o ON l.order_id = o.order_id GROUP BY 1""")


@query("order_basket_agg", "SELECT * FROM basket_agg")
def _(d):
    return marts.order_basket_agg(d.lines, d.orders)


@query("customer_category_mix", "SELECT * FROM category_mix")
def _(d):
    return marts.customer_category_mix(d.lines, d.orders, d.items)


@query("weekend_share", "SELECT * FROM weekend_mix")
def _(d):
    return marts.weekend_share(d.lines, d.orders)


@query("item_behaviour", "SELECT * FROM behaviour")
def _(d):
    return marts.item_behaviour(d.lines, d.promo_orders)


METHODS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
shared_view("paid", "SELECT *, coalesce(nullif(trim(payment_method), ''), 'Unspecified') AS method, strftime(order_date, '%Y-%m') AS month FROM done")


@query("payment_mix", """SELECT *, total / (sum(total::DECIMAL(18,4)) OVER ())::DOUBLE * 100 AS share
    FROM (SELECT method, count(*) AS orders, sum(total_amount::DECIMAL(18,4))::DOUBLE AS total FROM paid GROUP BY 1)""")
def _(d):
    return marts.payment_mix(d.outlet_orders)


@query("payment_pivot", "SELECT month, " + ", ".join(
    f"coalesce(sum(CASE WHEN method = '{m}' THEN total_amount::DECIMAL(18,4) END)::DOUBLE, 0) AS {m.lower()}" for m in [*METHODS, "Unspecified"])
    + " FROM paid GROUP BY 1")
def _(d):
    return marts.payment_pivot(d.outlet_orders, METHODS)


shared_view("refunds", """SELECT *, revenue / orders AS avg_order_value FROM (SELECT order_channel AS channel,
    count(*) FILTER (order_status = 'Completed') AS orders, coalesce((sum(total_amount::DECIMAL(18,4)) FILTER (order_status = 'Completed'))::DOUBLE, 0) AS revenue,
    coalesce((sum(total_amount::DECIMAL(18,4)) FILTER (order_status = 'Refunded'))::DOUBLE, 0) AS refunds FROM ord GROUP BY 1) WHERE orders > 0""")


@query("channel_refunds", "SELECT * FROM refunds")
def _(d):
    return marts.channel_refunds(d.orders)


@query("outlet_type_totals", """SELECT u.outlet_type, count(*) AS orders, sum(total_amount::DECIMAL(18,4))::DOUBLE AS revenue
    FROM done o JOIN outlet u ON o.outlet_id = u.outlet_id GROUP BY 1""")
def _(d):
    return marts.outlet_type_totals(d.outlet_orders, d.outlets)


shared_view("month_area", """SELECT strftime(o.order_date, '%Y-%m') AS month, a.city_area, sum(net_revenue::DECIMAL(18,4))::DOUBLE AS revenue
    FROM line l JOIN done o ON l.order_id = o.order_id JOIN outlet u ON o.outlet_id = u.outlet_id JOIN loc a ON u.location_id = a.location_id GROUP BY 1, 2""")


@query("area_month_matrix", """SELECT a.city_area, m.month, coalesce(x.revenue, 0) AS revenue
    FROM (SELECT DISTINCT city_area FROM month_area) a CROSS JOIN (SELECT DISTINCT month FROM month_area) m
    LEFT JOIN month_area x ON x.city_area = a.city_area AND x.month = m.month""")
def _(d):
    return marts.area_month_matrix(marts.monthly_revenue(d.lines, d.outlet_orders, d.outlets, d.locations))
