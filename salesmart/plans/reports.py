"""Dashboard reads, recommendations and scenarios."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from salesmart.functions.columns import on_grid
from salesmart.operators import anomaly, cleaning, customers, items, marts, reporting, scenario
from salesmart.plans.analytics import effects, item_frame
from salesmart.plans.registry import query, shared_view
from salesmart.sources.bindings import AS_OF, PERIOD_END, PERIOD_START
from salesmart.storage import concurrently


def days_before(n: int) -> str:
    return (dt.date.fromisoformat(AS_OF) - dt.timedelta(days=n)).isoformat()


def recent(d, days: int):
    """The dataset limited to the last ``days`` days up to the dashboard day."""
    return d.between(days_before(days - 1), AS_OF)


KPI = {
    "revenue": "coalesce((sum(total_amount::DECIMAL(18,4)) FILTER (order_status = 'Completed'))::DOUBLE, 0)",
    "orders": "count(*)::DOUBLE",
    "aov": "coalesce((sum(total_amount::DECIMAL(18,4)) FILTER (order_status = 'Completed'))::DOUBLE / nullif(count(*) FILTER (order_status = 'Completed'), 0), 0)",
    "customers": "count(DISTINCT customer_id)::DOUBLE",
    "locations_active": "count(DISTINCT location_id)::DOUBLE",
}
shared_view("placed", "SELECT o.*, u.location_id, u.outlet_name, u.outlet_type, a.city_area FROM ord o JOIN outlet u ON o.outlet_id = u.outlet_id JOIN loc a ON u.location_id = a.location_id")


@query("kpi_overview", "SELECT kpi, value, prev, CASE WHEN prev <> 0 THEN (value - prev) / abs(prev) * 100 END AS trend_pct FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS kpi, (SELECT {e} FROM placed WHERE order_date = DATE '{AS_OF}') AS value, (SELECT {e} FROM placed WHERE order_date = DATE '{AS_OF}' - 1) AS prev"
    for n, e in KPI.items()) + ")")
def _(d):
    return reporting.kpi_overview(recent(d, 2).outlet_orders, d.outlets, AS_OF)


@query("channel_pulse", f"""SELECT channel, orders, orders / sum(orders) OVER () * 100 AS share FROM (SELECT order_channel AS channel, count(*) AS orders
    FROM ord WHERE order_date = DATE '{AS_OF}' GROUP BY 1) ORDER BY orders DESC, channel LIMIT 4""")
def _(d):
    return reporting.channel_pulse(recent(d, 1).orders, AS_OF)


def placed(d):
    places = d.outlets.join(d.locations, "location_id")
    return d.outlet_orders.join(places, "outlet_id")


@query("orders_filter", f"""SELECT order_id, order_date, order_status, order_channel, payment_method, location_id, total_amount FROM placed
    WHERE location_id = 2 AND order_date BETWEEN DATE '{days_before(364)}' AND DATE '{AS_OF}' AND lower(order_status) = 'completed' AND lower(payment_method) = 'building'""")
def _(d):
    wanted = reporting.order_filter(location_id=2, date_from=days_before(364), date_to=AS_OF, status="COMPLETED", payment="Building")
    return placed(recent(d, 365)).where(wanted).select("order_id", "order_date", "order_status", "order_channel", "payment_method", "location_id", "total_amount")


SEARCHED = ["city_area", "outlet_name", "outlet_type", "payment_method", "order_channel"]


def found(text):
    return "(" + " OR ".join(f"contains(lower({n}), '{text}')" for n in SEARCHED) + ")"


@query("orders_search", f"""SELECT 'nation_1' AS searched, order_id, outlet_name, payment_method FROM placed WHERE {found('nation_1')} OR contains(order_id::VARCHAR, 'nation_1')
    UNION ALL SELECT 'ORD-0012', order_id, outlet_name, payment_method FROM placed WHERE {found('ord-0012')} OR order_id = 12
    UNION ALL SELECT '#77', order_id, outlet_name, payment_method FROM placed WHERE {found('#77')} OR order_id = 77
    UNION ALL SELECT 'mach', order_id, outlet_name, payment_method FROM placed WHERE {found('mach')}""")
def _(d):
    rows = placed(d)
    hits = F.array_compact(F.array(*[F.when(reporting.order_search(t, SEARCHED), t) for t in ("nation_1", "ORD-0012", "#77", "mach")]))
    return rows.select(F.explode(hits).alias("searched"), "order_id", "outlet_name", "payment_method")


PAGED = f"SELECT * FROM ord WHERE order_date BETWEEN DATE '{days_before(364)}' AND DATE '{AS_OF}' AND lower(order_channel) = '2-high'"


@query("orders_page", f"""SELECT *, (SELECT count(*) FROM ({PAGED})) AS total, ceil((SELECT count(*) FROM ({PAGED})) / 20)::BIGINT AS pages,
    (SELECT sum(total_amount::DECIMAL(18,4))::DOUBLE FROM ({PAGED}) WHERE order_status = 'Completed') AS revenue
    FROM ({PAGED}) ORDER BY order_date DESC, order_hour DESC, order_id DESC LIMIT 20 OFFSET 20""")
def _(d):
    rows = recent(d, 365).outlet_orders.where(reporting.order_filter(channel="2-high"))
    return reporting.orders_page(rows, "recent", page=2, size=20)


@query("order_documents", """SELECT p.order_id, 'ORD-' || CASE WHEN length(p.order_id::VARCHAR) < 4 THEN lpad(p.order_id::VARCHAR, 4, '0') ELSE p.order_id::VARCHAR END AS order_ref,
      p.order_date, p.total_amount, p.order_status, d.item_summary, d.items
    FROM ord p LEFT JOIN (
      SELECT order_id, array_to_string(list_slice(list(q || 'x ' || item_name ORDER BY item_id), 1, 2), ', ') || CASE WHEN count(*) > 2 THEN ', +' || (count(*) - 2) || ' more' ELSE '' END AS item_summary,
        count(*) AS items
      FROM (SELECT l.order_id, l.item_id, i.item_name, sum(l.quantity)::BIGINT AS q FROM line l JOIN item i ON l.item_id = i.item_id GROUP BY 1, 2, 3) GROUP BY 1) d ON p.order_id = d.order_id""")
def _(d):
    docs = reporting.order_documents(d.orders, d.lines, d.items)
    return docs.withColumn("items", F.when(F.col("items").isNotNull(), F.size("items").cast("long")))


shared_view("dishes", """SELECT item_id, item_name, category_name, units, revenue, orders, contribution, row_number() OVER (ORDER BY revenue DESC, item_id) AS rank
    FROM (SELECT l.item_id, i.item_name, i.category_name, sum(quantity::DECIMAL(18,4))::DOUBLE AS units, sum(net_revenue::DECIMAL(18,4))::DOUBLE AS revenue,
        count(DISTINCT l.order_id) AS orders, (sum(net_revenue::DECIMAL(18,4)) - sum((quantity * cost_price)::DECIMAL(18,4)))::DOUBLE AS contribution
      FROM dline l JOIN item i ON l.item_id = i.item_id GROUP BY 1, 2, 3)""")


@query("dish_ranking", "SELECT * FROM dishes WHERE contains(lower(item_name), 'red') OR contains(lower(category_name), 'red')")
def _(d):
    return reporting.dish_ranking(d.lines, d.orders, d.items, search="red")


@query("area_ranking", "SELECT *, row_number() OVER (ORDER BY revenue DESC, location_id) AS rank FROM location_rank")
def _(d):
    return reporting.area_ranking(marts.location_ranking(d.outlet_orders, d.outlets, d.locations))


def _span(n):
    now = f"order_date BETWEEN DATE '{AS_OF}' - {n - 1} AND DATE '{AS_OF}'"
    before = f"order_date BETWEEN DATE '{AS_OF}' - {2 * n - 1} AND DATE '{AS_OF}' - {n}"
    total = "coalesce((sum(total_amount::DECIMAL(18,4)) FILTER ({}))::DOUBLE, 0)"
    return f"{total.format(now)} AS total, {total.format(before)} AS prev_total, count(*) FILTER ({now}) AS orders FROM done"


@query("revenue_series", "SELECT *, CASE WHEN prev_total <> 0 THEN (total - prev_total) / abs(prev_total) * 100 END AS trend_pct FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS range, {_span(k)}" for n, k in (("today", 1), ("week", 7), ("month", 30))) + ")")
def _(d):
    return reporting.revenue_series(recent(d, 60).orders, AS_OF)


@query("revenue_hourly", f"""SELECT h.hour, coalesce(sum(total_amount::DECIMAL(18,4))::DOUBLE, 0) AS value, count(order_id) AS orders
    FROM (SELECT unnest(range(24)) AS hour) h LEFT JOIN (SELECT * FROM done WHERE order_date = DATE '{AS_OF}') o ON h.hour = o.order_hour GROUP BY 1""")
def _(d):
    return reporting.revenue_hourly(recent(d, 1).orders, AS_OF)


@query("revenue_daily", f"""SELECT c.order_date, coalesce(sum(total_amount::DECIMAL(18,4))::DOUBLE, 0) AS value, count(order_id) AS orders
    FROM (SELECT (DATE '{AS_OF}' - unnest(range(30))::INT)::DATE AS order_date) c LEFT JOIN done o ON c.order_date = o.order_date GROUP BY 1""")
def _(d):
    return reporting.revenue_daily(recent(d, 30).orders, AS_OF)


@query("month_trend", """SELECT *, CASE WHEN prev <> 0 THEN (value - prev) / abs(prev) * 100 END AS trend_pct FROM (SELECT *, lag(value) OVER (ORDER BY month) AS prev
    FROM (SELECT strftime(order_date, '%Y-%m') AS month, sum(total_amount::DECIMAL(18,4))::DOUBLE AS value, count(*) AS orders FROM done GROUP BY 1))""")
def _(d):
    return reporting.month_trend(d.orders)


@query("filter_values", " UNION ALL ".join(
    f"SELECT '{n}' AS filter, string_agg(v, '|' ORDER BY v) AS choices FROM (SELECT DISTINCT {n} AS v FROM ord WHERE {n} <> '')" for n in ("order_channel", "payment_method", "order_status")))
def _(d):
    return reporting.filter_values(d.outlet_orders)


@query("transactions", f"""SELECT order_id, 'ORD-' || CASE WHEN length(order_id::VARCHAR) < 4 THEN lpad(order_id::VARCHAR, 4, '0') ELSE order_id::VARCHAR END AS order_ref,
    coalesce(nullif(trim(payment_method), ''), 'Unspecified') || ' Payment' AS type, coalesce(nullif(trim(payment_method), ''), 'Unspecified') AS method,
    total_amount AS amount, order_date AS date, CASE WHEN order_status = 'Completed' THEN 'Paid' ELSE 'Cancelled' END AS status FROM ord
    WHERE order_date BETWEEN DATE '{days_before(29)}' AND DATE '{AS_OF}'""")
def _(d):
    return reporting.transactions(recent(d, 30).outlet_orders)


@query("meta_summary", "SELECT *, (SELECT min(order_date) FROM ord) AS date_min, (SELECT max(order_date) FROM ord) AS date_max FROM location_rank")
def _(d):
    return reporting.meta_summary(d.orders, marts.location_ranking(d.outlet_orders, d.outlets, d.locations))


@query("item_intelligence", """SELECT c.item_id, c.item_name, c.units_sold, c.revenue, c.business_class, c.wastage_ratio, r.wastage_cost, r.risk_level
    FROM item_class c LEFT JOIN risk r ON c.item_id = r.item_id""")
def _(d):
    return reporting.item_intelligence(items.item_business_class(item_frame(d)), items.loss_risk(d.losses, d.lines, d.orders))


@query("alerts", """SELECT id, level, n, n || title AS title FROM (
    SELECT 'losing_promotions' AS id, 'medium' AS level, ' promotions sell more and earn less' AS title, (SELECT count(*) FROM promo_effect WHERE promotion_trap) AS n
    UNION ALL SELECT 'quiet_customers', 'high', ' customers without an order for half a year', (SELECT count(*) FROM quiet WHERE days_since >= 180)
    UNION ALL SELECT 'held_back_orders', 'low', ' orders wait for a correction', (SELECT count(*) FROM marked_orders WHERE quarantine_reason IS NOT NULL)) WHERE n > 0""")
def _(d):
    raw = d.raw_tables
    cleaned = cleaning.clean_tables({n: raw[n] for n in ("locations", "outlets", "customers", "orders")}, cleaning.specs(PERIOD_START, PERIOD_END))
    bad = cleaned["orders"].bad
    return reporting.alerts(effects(d), customers.churn_candidates(d.customers, d.orders, PERIOD_END), bad)


@query("order_mix", """SELECT mix, part, count(*) AS orders, count(*) / sum(count(*)) OVER (PARTITION BY mix) * 100 AS share FROM (
    SELECT 'status' AS mix, CASE WHEN order_status = 'Completed' THEN 'completed' ELSE 'other' END AS part FROM ordp
    UNION ALL SELECT 'promotion', CASE WHEN promotion_id <> '' THEN 'promotion' ELSE 'none' END FROM ordp) GROUP BY 1, 2""")
def _(d):
    return reporting.order_mix(d.promo_orders)


@query("headline_rollups", f"""
    SELECT 'items_per_class' AS rollup, business_class AS name, count(*)::DOUBLE AS value FROM item_class GROUP BY 2
    UNION ALL (SELECT 'best_area_by_order_value', city_area, avg_order_value FROM location_rank ORDER BY avg_order_value DESC LIMIT 1)
    UNION ALL SELECT 'orders_per_hour', order_hour::VARCHAR, count(*)::DOUBLE FROM done GROUP BY 2
    UNION ALL SELECT 'channel_revenue', 'all', sum(revenue::DECIMAL(18,4))::DOUBLE FROM refunds
    UNION ALL SELECT 'channel_refunds', 'all', sum(refunds::DECIMAL(18,4))::DOUBLE FROM refunds
    UNION ALL (SELECT 'top_anomaly', entity || '/' || period, z_score FROM a_daily ORDER BY abs(z_score) DESC, entity, period LIMIT 6)""")
def _(d):
    return reporting.headline_rollups(
        items.item_business_class(item_frame(d)), marts.location_ranking(d.outlet_orders, d.outlets, d.locations), marts.peak_hours_per_day(d.orders),
        marts.channel_refunds(d.orders), anomaly.anomaly_daily_sales(d.outlet_orders))


# ---- recommendations and scenarios -----------------------------------------

shared_view("at_risk", """SELECT s.customer_id, s.total_spend FROM customer_segments s JOIN quiet q ON s.customer_id = q.customer_id
    WHERE q.days_since >= 180 AND s.customer_value_segment IN ('High Value', 'Frequent')""")


def _top(view, where, order, k):
    return f"(SELECT * FROM {view} WHERE {where} ORDER BY {order} LIMIT {k})"


@query("recommendations", f"""
    SELECT 'P1' AS priority, 'Promote high-margin item with low volume' AS recommendation, 'item' AS target_type, item_id::VARCHAR AS target_id, item_name AS target_name,
      'margin ' || floor(profit_margin_percentage)::BIGINT || '% on ' || floor(units_sold)::BIGINT || ' units' AS evidence, estimated_profit / greatest(units_sold, 1) * 100 AS estimated_impact
      FROM {_top('item_class', "business_class = 'Hidden Opportunity'", 'profit_margin_percentage DESC, item_id', 5)}
    UNION ALL SELECT 'P1', 'Reprice or retire loss-making item', 'item', item_id::VARCHAR, item_name, 'loss on ' || floor(units_sold)::BIGINT || ' units', abs(estimated_profit)
      FROM {_top('item_class', "business_class = 'Low Performer' AND estimated_profit < 0", 'estimated_profit, item_id', 5)}
    UNION ALL SELECT 'P1', 'Win back valuable customers at risk', 'customer_group', 'high_value_at_risk', count(*) || ' customers',
      'lifetime spend ' || floor(sum(total_spend::DECIMAL(18,4))::DOUBLE)::BIGINT, sum(total_spend::DECIMAL(18,4))::DOUBLE / 2 FROM at_risk HAVING count(*) > 0
    UNION ALL SELECT 'P2', 'Pause or rework promotion', 'promotion', promotion_id::VARCHAR, promotion_name, promo_orders || ' promotion orders', promo_discount_spent
      FROM {_top('promo_effect', 'promotion_trap', 'incremental_revenue_estimate, promotion_id', 3)}
    UNION ALL SELECT 'P2', 'Cut overproduction', 'item', item_id::VARCHAR, item_name, 'loss ratio ' || floor(wastage_ratio * 100)::BIGINT || '%, trend ' || trend_flag, estimated_saving_30pct
      FROM {_top('risk', "risk_level = 'High'", 'wastage_cost DESC, item_id', 5)}
    UNION ALL SELECT 'P2', 'Check quality of poorly rated item', 'item', item_id::VARCHAR, item_name, rating_count || ' ratings', average_rating
      FROM {_top('rating_item', 'average_rating < 3.5 AND rating_count >= 20', 'average_rating, item_id', 3)}
    UNION ALL SELECT 'P3', 'Review item that lost momentum', 'item', item_id::VARCHAR, item_name,
      floor(first_60d)::BIGINT || ' units before, ' || floor(last_60d)::BIGINT || ' now: ' || status, sales_change_percentage FROM {_top('slow', 'TRUE', 'first_60d DESC, item_id', 5)}
    UNION ALL SELECT 'P3', 'Align staffing with the busiest cell', 'period', day_of_week || '/' || time_period || '/' || order_channel,
      day_of_week || ' ' || time_period || ' ' || order_channel, floor(order_share_percentage)::BIGINT || '% of all orders', average_order_value
      FROM {_top('peak_cells', 'TRUE', 'total_orders DESC, day_of_week, time_period, order_channel', 1)}""")
def _(d):
    orders, lines, item_rows, losses, ratings = d.promo_orders, d.lines, d.items, d.losses, d.ratings
    parts = concurrently(
        classes=lambda: items.item_business_class(item_frame(d)),
        effects=lambda: effects(d),
        segments=lambda: marts.customer_value_segment(marts.customer_analytics(d.customers, orders, lines, item_rows)),
        slow=lambda: items.slow_movers(lines, d.orders, item_rows, PERIOD_START, PERIOD_END),
    )
    quiet = customers.churn_candidates(d.customers, d.orders, PERIOD_END).where("days_since >= 180").select("customer_id")
    at_risk = parts["segments"].where("customer_value_segment in ('High Value', 'Frequent')").join(quiet, "customer_id")
    return scenario.recommendations(
        parts["classes"], parts["effects"], items.loss_risk(losses, lines, d.orders), parts["slow"], marts.peak_period(d.orders), at_risk,
        marts.rating_by_item(ratings, item_rows))


@query("what_if_class", """SELECT scenario, scope, price_change_percentage, affected_items, baseline_revenue, baseline_profit, elasticity, new_revenue_estimate, new_profit_estimate,
      new_revenue_estimate - baseline_revenue AS revenue_change, new_profit_estimate - baseline_profit AS profit_change,
      'Units answer the price with the mean elasticity of the class; unit cost stays' AS assumption
    FROM (SELECT *, new_units * (baseline_revenue / units) * (1 + p / 100) AS new_revenue_estimate, new_units * (baseline_revenue / units * (1 + p / 100) - cost / units) AS new_profit_estimate
      FROM (SELECT *, p AS price_change_percentage, units * (1 + elasticity * p / 100) AS new_units
        FROM (SELECT v.scenario, v.scope, v.p::DOUBLE AS p, s.*, CASE WHEN mean_e < 0 THEN mean_e ELSE -1 END AS elasticity
          FROM (VALUES ('price_increase_10pct', 'Volume Driver', 10), ('price_decrease_10pct', 'Hidden Opportunity', -10), ('discount_15pct', 'Low Performer', -15)) v(scenario, scope, p)
          JOIN (SELECT business_class, count(*) AS affected_items, sum(revenue::DECIMAL(18,4))::DOUBLE AS baseline_revenue, sum(estimated_profit::DECIMAL(18,4))::DOUBLE AS baseline_profit,
              sum(estimated_cost::DECIMAL(18,4))::DOUBLE AS cost, sum(units_sold::DECIMAL(18,4))::DOUBLE AS units,
              sum(coalesce(price_elasticity, -1)::DECIMAL(18,3))::DOUBLE / count(*) AS mean_e
            FROM item_class c LEFT JOIN elastic e ON c.item_id = e.item_id GROUP BY 1) s ON v.scope = s.business_class)))""")
def _(d):
    return scenario.what_if_class(items.item_business_class(item_frame(d)), items.price_elasticity(d.lines, d.orders))


@query("what_if_item", """SELECT item_id, revenue, contribution, units, scenario, contribution_estimate, contribution_estimate - contribution AS contribution_change, revenue_estimate, units_estimate,
      revenue_estimate - revenue AS revenue_change, CASE scenario WHEN 'price_change' THEN 'Units and cost stay; revenue moves with the price' WHEN 'discount_change' THEN 'Units and cost stay; revenue falls by the discount'
      WHEN 'demand_change' THEN 'Price and unit cost stay; revenue, contribution and units move together' WHEN 'wastage_change' THEN 'Sales stay; contribution moves against the cost of waste'
      ELSE 'Sales of the item are lost and go to no other item' END AS assumption
    FROM (SELECT *, CASE scenario WHEN 'price_change' THEN revenue * 1.1::DOUBLE WHEN 'discount_change' THEN revenue * 0.9::DOUBLE WHEN 'demand_change' THEN revenue * 1.1::DOUBLE
          WHEN 'wastage_change' THEN revenue ELSE revenue * 0 END AS revenue_estimate,
        CASE scenario WHEN 'price_change' THEN contribution * ((revenue * 1.1::DOUBLE - (revenue - contribution)) / greatest(contribution, 1e-9))
          WHEN 'discount_change' THEN contribution * ((revenue * 0.9::DOUBLE - (revenue - contribution)) / greatest(contribution, 1e-9))
          WHEN 'demand_change' THEN contribution * 1.1::DOUBLE WHEN 'wastage_change' THEN contribution - wastage_cost * 0.1::DOUBLE ELSE contribution * 0 END AS contribution_estimate,
        CASE scenario WHEN 'demand_change' THEN units * 1.1::DOUBLE WHEN 'remove_item' THEN units * 0 ELSE units END AS units_estimate
      FROM (SELECT d.item_id, d.revenue, d.contribution, d.units, coalesce(r.wastage_cost, 0) AS wastage_cost FROM dishes d LEFT JOIN risk r ON d.item_id = r.item_id),
        (VALUES ('price_change'), ('discount_change'), ('demand_change'), ('wastage_change'), ('remove_item')) v(scenario))""")
def _(d):
    base = marts.completed_item_sums(d.lines, d.orders, d.items)
    revenue = base.select("item_id", F.col("net_revenue").alias("revenue"), F.col("units_sold").alias("units"),
                          on_grid(F.col("net_revenue") - F.col("estimated_cost")).alias("contribution"))
    return scenario.what_if_item(revenue, items.loss_risk(d.losses, d.lines, d.orders), 10.0)
