"""Baskets, promotions, items, customers, forecast and anomalies."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.functions import columns as c
from salesmart.operators import anomaly, basket, customers, forecast, items, promotions
from salesmart.plans.registry import query, shared_view
from salesmart.sources.bindings import PERIOD_END, PERIOD_START
from salesmart.storage import materialize

# ---- baskets ---------------------------------------------------------------

MIN_COMBO = 5  # orders per pair; a parameter, set low because the bound data has small baskets

shared_view("bought", "SELECT DISTINCT l.outlet_id, l.order_id, i.brand AS item FROM dline l JOIN item i ON l.item_id = i.item_id")
shared_view("bought_n", "SELECT outlet_id, item, count(*) AS n FROM bought GROUP BY 1, 2")
shared_view("bought_outlet", "SELECT outlet_id, count(DISTINCT order_id) AS outlet_orders FROM bought GROUP BY 1")
shared_view("pairs", """SELECT a.outlet_id, a.item AS item_a, b.item AS item_b, count(*) AS pair_orders
    FROM bought a JOIN bought b ON a.order_id = b.order_id AND a.item < b.item GROUP BY 1, 2, 3""")
shared_view("pairs_full", """SELECT p.*, x.n AS n_a, y.n AS n_b, r.outlet_orders, (SELECT count(DISTINCT order_id) FROM bought) AS total
    FROM pairs p JOIN bought_n x ON p.outlet_id = x.outlet_id AND p.item_a = x.item JOIN bought_n y ON p.outlet_id = y.outlet_id AND p.item_b = y.item
    JOIN bought_outlet r ON p.outlet_id = r.outlet_id""")


def _bought(d):
    return basket.order_items(d.lines, d.outlet_orders, d.items)


@query("basket_pairs", f"SELECT * FROM pairs WHERE pair_orders >= {MIN_COMBO}")
def _(d):
    return basket.pair_counts(_bought(d), MIN_COMBO)


@query("top_item_combos", f"""SELECT item_a, item_b, outlet_id, pair_orders AS orders_with_combo, pair_orders * 1.0::DOUBLE * outlet_orders / (n_a * n_b) AS lift,
    pair_orders * 1.0::DOUBLE * total / (n_a * n_b) AS chain_lift FROM pairs_full WHERE pair_orders >= greatest({MIN_COMBO}, floor(total * 0.001))
    ORDER BY lift DESC, outlet_id, item_a, item_b LIMIT 25""")
def _(d):
    return basket.top_item_combos(_bought(d), floor=MIN_COMBO)


@query("market_basket", f"""SELECT outlet_id, item_a, item_b, pair_orders, outlet_orders, pair_orders / outlet_orders AS support, n_a / outlet_orders AS p_a, n_b / outlet_orders AS p_b,
    (pair_orders / outlet_orders) / (n_a / outlet_orders) AS confidence_a_to_b, (pair_orders / outlet_orders) / (n_b / outlet_orders) AS confidence_b_to_a,
    (pair_orders / outlet_orders) / (n_a / outlet_orders) / (n_b / outlet_orders) AS lift, pair_orders * total / (n_a * n_b) AS chain_lift
    FROM pairs_full WHERE pair_orders >= greatest({MIN_COMBO}, floor(total * 0.001)) """)
def _(d):
    return basket.market_basket(_bought(d), floor=MIN_COMBO)


@query("basket_fpgrowth", """SELECT a.item AS item_a, b.item AS item_b, count(*) AS freq FROM bought a JOIN bought b ON a.order_id = b.order_id AND a.item < b.item
    GROUP BY 1, 2 HAVING count(*) >= ceil(0.01 * (SELECT count(DISTINCT order_id) FROM bought))""")
def _(d):
    sets = basket.frequent_itemsets(_bought(d), 0.01).where(F.size("items") == 2)
    return sets.select(F.col("items")[0].alias("item_a"), F.col("items")[1].alias("item_b"), "freq")


SUPPORT = 0.005
#: All parts of all baskets, item by item in ascending order; ``parts`` refers to itself.
PARTS = """WITH RECURSIVE parts AS (SELECT order_id, [item] AS items, item AS last FROM bought
    UNION ALL SELECT p.order_id, list_append(p.items, b.item), b.item FROM parts p JOIN bought b ON p.order_id = b.order_id AND b.item > p.last)"""


def itemsets(d):
    bought = _bought(d)
    return basket.frequent_itemsets(bought, SUPPORT), bought.select("order_id").distinct().count()


@query("basket_itemsets", f"""{PARTS} SELECT array_to_string(items, '+') AS items, len(items)::INT AS size, freq FROM
    (SELECT items, count(*) AS freq FROM parts GROUP BY items HAVING count(*) >= ceil({SUPPORT} * (SELECT count(DISTINCT order_id) FROM bought)))""")
def _(d):
    """Frequent sets of every size."""
    return itemsets(d)[0].select(F.array_join("items", "+").alias("items"), F.size("items").alias("size"), "freq")


@query("basket_rules", f"""{PARTS}, sets AS (SELECT items, count(*) AS freq FROM parts GROUP BY items HAVING count(*) >= ceil({SUPPORT} * (SELECT count(DISTINCT order_id) FROM bought))),
    total AS (SELECT count(DISTINCT order_id) AS n FROM bought)
    SELECT array_to_string(a.items, '+') AS antecedent, array_to_string(c.items, '+') AS consequent, s.freq, s.freq / n AS support, s.freq / a.freq AS confidence,
      s.freq::DOUBLE * n / (a.freq::DOUBLE * c.freq) AS lift
    FROM sets s JOIN sets a ON len(a.items) < len(s.items) AND list_has_all(s.items, a.items)
    JOIN sets c ON len(c.items) = len(s.items) - len(a.items) AND list_has_all(s.items, c.items) AND NOT list_has_any(a.items, c.items), total""")
def _(d):
    """All rules inside the frequent sets, with any number of items on both sides."""
    sets, orders = itemsets(d)
    return basket.association_rules(sets, orders).withColumns({c: F.array_join(c, "+") for c in ("antecedent", "consequent")})


# ---- promotions ------------------------------------------------------------

shared_view("promo_effect", """
    SELECT promotion_id, promotion_name, outlet_id, discount_percentage, start_date, end_date, promo_orders, control_orders,
      pa AS promo_avg_order_value, ca AS control_avg_order_value, lift AS aov_lift_percentage, promo_discount_spent,
      (pa - ca) * promo_orders AS incremental_revenue_estimate, (pa - ca) * promo_orders / greatest(promo_discount_spent, 1) AS efficiency_ratio,
      promo_orders = 0 OR lift < 0 OR (pa - ca) * promo_orders / greatest(promo_discount_spent, 1) < 0.1 AS promotion_trap
    FROM (SELECT *, CASE WHEN ca > 0 THEN (pa - ca) / ca * 100 ELSE 0 END AS lift FROM (
      SELECT p.promotion_id, p.promotion_name, p.outlet_id, p.discount_percentage, p.start_date, p.end_date,
        count(*) FILTER (o.promotion_id = p.promotion_id::VARCHAR) AS promo_orders, count(*) FILTER (o.promotion_id = '') AS control_orders,
        coalesce((sum(total_amount::DECIMAL(18,4)) FILTER (o.promotion_id = p.promotion_id::VARCHAR))::DOUBLE / count(*) FILTER (o.promotion_id = p.promotion_id::VARCHAR), 0) AS pa,
        coalesce((sum(total_amount::DECIMAL(18,4)) FILTER (o.promotion_id = ''))::DOUBLE / count(*) FILTER (o.promotion_id = ''), 0) AS ca,
        coalesce((sum(discount_amount::DECIMAL(18,4)) FILTER (o.promotion_id = p.promotion_id::VARCHAR))::DOUBLE, 0) AS promo_discount_spent
      FROM promo p LEFT JOIN donep o ON o.outlet_id = p.outlet_id AND o.order_date BETWEEN p.start_date AND p.end_date
      GROUP BY 1, 2, 3, 4, 5, 6))""")


def effects(d):
    return promotions.promo_effectiveness(d.promotions, d.promo_orders, PERIOD_START, PERIOD_END)


@query("promo_effectiveness", "SELECT * FROM promo_effect")
def _(d):
    return effects(d)


@query("promo_stats", """SELECT subset, count(*) AS promotions, count(*) FILTER (promotion_trap) AS traps, sum(aov_lift_percentage::DECIMAL(30,8))::DOUBLE / count(*) AS avg_lift,
    sum(incremental_revenue_estimate::DECIMAL(30,6))::DOUBLE AS total_incremental, sum(promo_discount_spent::DECIMAL(18,4))::DOUBLE AS total_discount_spend
    FROM (SELECT *, 'all' AS subset FROM promo_effect UNION ALL SELECT *, CASE WHEN promotion_trap THEN 'traps' ELSE 'healthy' END FROM promo_effect) GROUP BY 1""")
def _(d):
    return promotions.promo_stats(effects(d))


# ---- items -----------------------------------------------------------------

shared_view("item_measures", """SELECT p.*, coalesce(r.rating_count, 0) AS rating_count, coalesce(r.average_rating, 0) AS average_rating,
      coalesce(w.quantity_wasted, 0) AS quantity_wasted, coalesce(b.avg_unit_price, 0) AS avg_unit_price, coalesce(b.promo_dependency, 0) AS promo_dependency,
      coalesce(b.weekend_order_share, 0) AS weekend_order_share, coalesce(b.unique_customers, 0) AS unique_customers, coalesce(b.order_line_count, 0) AS order_line_count,
      coalesce(w.quantity_wasted, 0) / greatest(p.units_sold + coalesce(w.quantity_wasted, 0), 1) AS wastage_ratio
    FROM item_perf p LEFT JOIN rating_item r ON p.item_id = r.item_id LEFT JOIN loss_item w ON p.item_id = w.item_id LEFT JOIN behaviour b ON p.item_id = b.item_id""")
shared_view("item_class", """SELECT * EXCLUDE (um, pm, mm), CASE WHEN units_sold >= um AND estimated_profit >= pm AND profit_margin_percentage >= mm THEN 'Profit Driver'
      WHEN units_sold >= um THEN 'Volume Driver' WHEN profit_margin_percentage >= mm THEN 'Hidden Opportunity' ELSE 'Low Performer' END AS business_class,
    CASE WHEN estimated_profit >= pm AND wastage_ratio > 0.15 THEN 'High profit but heavy wastage'
      WHEN profit_margin_percentage >= mm AND average_rating > 0 AND average_rating < 3 THEN 'High margin but poor customer rating'
      WHEN units_sold >= um AND estimated_profit < 0 THEN 'High volume but negative profit' ELSE '' END AS contradictory_case
    FROM (SELECT * FROM item_measures), (SELECT median(units_sold) AS um, median(estimated_profit) AS pm, median(profit_margin_percentage) AS mm FROM item_measures)""")


def item_frame(d):
    return items.item_frame(d.lines, d.promo_orders, d.items, d.ratings, d.losses)


@query("item_features", "SELECT * FROM item_measures")
def _(d):
    return item_frame(d)


@query("item_business_class", "SELECT * FROM item_class")
def _(d):
    return items.item_business_class(item_frame(d))


@query("contradictory_items", """SELECT item_id, item_name, business_class, contradictory_case, estimated_profit, wastage_ratio, average_rating
    FROM item_class WHERE contradictory_case <> ''""")
def _(d):
    return items.item_business_class(item_frame(d)).where("contradictory_case <> ''").select(
        "item_id", "item_name", "business_class", "contradictory_case", "estimated_profit", "wastage_ratio", "average_rating")


shared_view("loss_quarter", "SELECT date_trunc('quarter', loss_date) AS q, sum(estimated_cost::DECIMAL(18,4))::DOUBLE AS cost FROM loss GROUP BY 1")
shared_view("risk", """SELECT *, CASE WHEN wastage_ratio > 0.15 THEN 'High' WHEN wastage_ratio > 0.05 THEN 'Medium' ELSE 'Low' END AS risk_level,
      (SELECT CASE WHEN count(*) < 2 THEN 'stable' WHEN arg_max(cost, q) > arg_min(cost, q) * 1.1 THEN 'increasing'
        WHEN arg_max(cost, q) < arg_min(cost, q) * 0.9 THEN 'decreasing' ELSE 'stable' END FROM loss_quarter) AS trend_flag,
      wastage_cost * 0.30::DOUBLE AS estimated_saving_30pct
    FROM (SELECT w.*, coalesce(s.u, 0) AS units_sold, quantity_wasted / greatest(quantity_wasted + coalesce(s.u, 0), 1) AS wastage_ratio
      FROM (SELECT item_id, item_name, outlet_id, sum(quantity_wasted::DECIMAL(18,4))::DOUBLE AS quantity_wasted,
          sum(estimated_cost::DECIMAL(18,4))::DOUBLE AS wastage_cost, count(*) AS wastage_records FROM loss GROUP BY 1, 2, 3) w
      LEFT JOIN (SELECT item_id, sum(quantity::DECIMAL(18,4))::DOUBLE AS u FROM dline GROUP BY 1) s ON w.item_id = s.item_id)""")


@query("loss_risk", "SELECT * FROM risk")
def _(d):
    return items.loss_risk(d.losses, d.lines, d.orders)


shared_view("elastic", """SELECT item_id, months_observed, average_price, total_units, round(slope, 3) AS price_elasticity, slope < -1 AS price_sensitive FROM (
      SELECT item_id, count(*) AS months_observed, sum(price::DECIMAL(22,10))::DOUBLE / count(*) AS average_price, sum(units::DECIMAL(18,4))::DOUBLE AS total_units,
        regr_slope(ln(units), ln(price)) AS slope, stddev_pop(ln(price)) AS spread
      FROM (SELECT item_id, strftime(order_date, '%Y-%m') AS month, sum(quantity::DECIMAL(18,4))::DOUBLE AS units,
          sum(unit_price::DECIMAL(18,7))::DOUBLE / count(*) AS price FROM dline GROUP BY 1, 2) GROUP BY 1)
    WHERE months_observed >= 4 AND spread >= 1e-9""")


@query("price_elasticity", "SELECT * FROM elastic")
def _(d):
    return items.price_elasticity(d.lines, d.orders)


LATE = f"order_date BETWEEN DATE '{PERIOD_END}' - 60 AND DATE '{PERIOD_END}'"
EARLY = f"NOT ({LATE}) AND order_date BETWEEN DATE '{PERIOD_START}' AND DATE '{PERIOD_START}' + 60"
shared_view("windows", f"""SELECT item_id, coalesce(sum(quantity) FILTER ({EARLY}), 0) AS first_60d, coalesce(sum(quantity) FILTER ({LATE}), 0) AS last_60d,
    coalesce(sum(quantity) FILTER (NOT ({LATE}) AND NOT ({EARLY})), 0) AS mid FROM dline GROUP BY 1""")
shared_view("started", "SELECT *, first_60d + last_60d AS units_both FROM windows WHERE first_60d > 0")
shared_view("slow", """SELECT w.item_id, i.item_name, first_60d, last_60d, mid, (last_60d - first_60d) / first_60d * 100 AS sales_change_percentage, status
    FROM (SELECT *, CASE WHEN last_60d = 0 THEN 'no_recent_sales' WHEN last_60d < 0.25 * first_60d THEN 'declining'
        WHEN units_both <= (SELECT quantile_cont(units_both, 0.1) FROM started) AND last_60d <= (SELECT quantile_cont(last_60d, 0.1) FROM started) THEN 'low_velocity'
        ELSE 'stable' END AS status FROM started) w JOIN item i ON w.item_id = i.item_id
    WHERE status <> 'stable'""")


@query("slow_movers", "SELECT * FROM slow")
def _(d):
    return items.slow_movers(d.lines, d.orders, d.items, PERIOD_START, PERIOD_END)


# ---- customers -------------------------------------------------------------

shared_view("quiet", f"""SELECT k.customer_id, k.preferred_channel, o.last_order_date, (DATE '{PERIOD_END}' - o.last_order_date)::INT AS days_since, o.total_orders
    FROM cust k JOIN (SELECT customer_id, max(order_date) AS last_order_date, count(*) FILTER (order_status = 'Completed') AS total_orders FROM ord GROUP BY 1) o
    ON k.customer_id = o.customer_id WHERE DATE '{PERIOD_END}' - o.last_order_date > 60""")


@query("churn_candidates", "SELECT * FROM quiet")
def _(d):
    return customers.churn_candidates(d.customers, d.orders, PERIOD_END)


@query("churn_tiers", """SELECT count(*) AS total, count(*) FILTER (days_since >= 180) AS high, count(*) FILTER (days_since >= 90 AND days_since < 180) AS medium,
    count(*) FILTER (days_since < 90) AS low, 0 AS unknown, sum(days_since) / count(*) AS avg_days, count(*) FILTER (days_since < 30) AS days_0_29,
    count(*) FILTER (days_since >= 30 AND days_since < 90) AS days_30_89, count(*) FILTER (days_since >= 90 AND days_since < 180) AS days_90_179,
    count(*) FILTER (days_since >= 180) AS days_180_up FROM quiet""")
def _(d):
    return customers.churn_tiers(customers.churn_candidates(d.customers, d.orders, PERIOD_END))


def _score(column):
    q = [f"quantile_cont({column}, {p}) OVER ()" for p in (0, 0.2, 0.4, 0.6, 0.8, 1)]
    collide = " OR ".join(f"{a} = {b}" for a, b in zip(q, q[1:]))
    steps = " + ".join(f"({column} > {e})::INT" for e in q[1:5])
    return f"(CASE WHEN {collide} THEN 3 ELSE 1 + {steps} END)::BIGINT"


shared_view("rfm", f"""SELECT customer_id, (DATE '{PERIOD_END}' - max(order_date))::BIGINT AS r_days, count(*)::DOUBLE AS f_orders,
    sum(total_amount::DECIMAL(18,4))::DOUBLE AS m_spend FROM done GROUP BY 1""")


@query("rfm_scores", f"""SELECT customer_id, r_days, f_orders, m_spend, {_score('(-r_days)::DOUBLE')} AS r_score, {_score('f_orders')} AS f_score, {_score('m_spend')} AS m_score FROM rfm""")
def _(d):
    return customers.rfm_scores(customers.rfm_frame(d.orders, PERIOD_END))


@query("rfm_segments")
def _(d):
    return customers.rfm_segments(customers.rfm_scores(customers.rfm_frame(d.orders, PERIOD_END)))


# ---- forecast --------------------------------------------------------------

shared_view("series", f"""SELECT c.date, coalesce(s, 0) AS actual_sales, coalesce(n, 0) AS actual_orders
    FROM (SELECT unnest(generate_series(DATE '{PERIOD_START}', DATE '{PERIOD_END}', INTERVAL 1 DAY))::DATE AS date) c
    LEFT JOIN (SELECT order_date, sum(total_amount::DECIMAL(18,4))::DOUBLE AS s, count(*) AS n FROM done GROUP BY 1) t ON c.date = t.order_date""")
MEAN = "sum(actual_sales::DECIMAL(18,4)) OVER w{0}::DOUBLE / nullif(count(*) OVER w{0}, 0) AS rev_{0}d_ma"
shared_view("means", f"""SELECT *, (sum(actual_sales::DECIMAL(18,4)) OVER w7)::DOUBLE / count(*) OVER w7 AS rev_7d_ma,
    (sum(actual_sales::DECIMAL(18,4)) OVER w28)::DOUBLE / count(*) OVER w28 AS rev_28d_ma FROM series
    WINDOW w7 AS (ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), w28 AS (ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)""")


def series(d):
    return forecast.daily_series(d.orders, PERIOD_START, PERIOD_END)


@query("trailing_means", "SELECT * FROM means")
def _(d):
    return forecast.trailing_means(series(d))


FEATURES = "SELECT * REPLACE (coalesce(rev_7d_ma, tm) AS rev_7d_ma, coalesce(rev_28d_ma, tm) AS rev_28d_ma) EXCLUDE (tm)"


@query("forecast_features", f"""SELECT date, actual_sales, actual_orders, coalesce(rev_7d_ma, tm) AS rev_7d_ma, coalesce(rev_28d_ma, tm) AS rev_28d_ma,
    DATE '{PERIOD_END}' - date < 90 AS in_test, floor((date - DATE '{PERIOD_START}') / 7) AS week_index,
    {', '.join(f"(isodow(date) = {i + 1})::INT::DOUBLE AS dow_{i}" for i in range(7))}
    FROM means, (SELECT sum(actual_sales::DECIMAL(18,4))::DOUBLE / count(*) AS tm FROM series WHERE DATE '{PERIOD_END}' - date >= 90)""")
def _(d):
    return forecast.forecast_features(series(d), PERIOD_START)


shared_view("naive", f"""SELECT date, actual_sales, coalesce(lag(actual_sales) OVER (ORDER BY date), actual_sales) AS naive_prediction
    FROM series WHERE DATE '{PERIOD_END}' - date < 90""")


@query("naive_lag", "SELECT date, actual_sales, lag(actual_sales) OVER (ORDER BY date) AS previous_sales FROM series")
def _(d):
    from pyspark.sql import Window

    return series(d).select("date", "actual_sales", F.lag("actual_sales").over(Window.orderBy("date")).alias("previous_sales"))


@query("naive_forecast", "SELECT * FROM naive")
def _(d):
    return forecast.naive_forecast(series(d))


@query("demand_forecast")
def _(d):
    s = series(d)
    return forecast.demand_forecast(forecast.forecast_features(s, PERIOD_START), forecast.naive_forecast(s))


@query("forecast_metrics", """SELECT 'naive_baseline' AS model, round(avg(abs(actual_sales - naive_prediction)), 4) AS mae,
    round(sqrt(avg((actual_sales - naive_prediction) * (actual_sales - naive_prediction))), 4) AS rmse,
    round(avg(abs(actual_sales - naive_prediction) / greatest(actual_sales, 1)) * 100, 6) AS mape FROM naive""")
def _(d):
    return forecast.forecast_metrics(forecast.naive_forecast(series(d)), "naive_prediction", "naive_baseline")


# ---- anomalies -------------------------------------------------------------

MIN_RATINGS, DRIFT, BURST = 10, 2.0, 3.0  # per item and month
DAY_RATINGS, DAY_DRIFT, DAY_BURST = 3, 1.2, 1.0  # per item and day, where the short bound rating history does reach the limits
shared_view("zscores", """SELECT outlet_id, order_date, sales, CASE WHEN stddev_samp(sales) OVER (PARTITION BY outlet_id) > 0 THEN
      round((sales - (sum(sales::DECIMAL(18,4)) OVER (PARTITION BY outlet_id))::DOUBLE / count(*) OVER (PARTITION BY outlet_id)) / stddev_samp(sales) OVER (PARTITION BY outlet_id), 6) END AS z_score
    FROM (SELECT outlet_id, order_date, sum(total_amount::DECIMAL(18,4))::DOUBLE AS sales FROM done GROUP BY 1, 2)""")
shared_view("a_daily", """SELECT 'daily_sales_spike_or_drop' AS anomaly_type, 'outlet_' || outlet_id AS entity, order_date::VARCHAR AS period, sales AS value, z_score,
    'Daily sales more than 3 standard deviations from the outlet mean' AS note FROM zscores WHERE abs(z_score) > 3""")


def value_outliers(kind: str, key: str, value: str, date: str, table: str) -> str:
    return f"""SELECT '{kind}_outlier' AS anomaly_type, '{kind}_' || {key} AS entity, {date}::DATE::VARCHAR AS period, {value} AS value, NULL::DOUBLE AS z_score, 'Value above Q3 + 3 IQR' AS note
    FROM {table} WHERE {value} > (SELECT quantile_cont({value}, 0.75) + 3 * (quantile_cont({value}, 0.75) - quantile_cont({value}, 0.25)) FROM {table})"""


shared_view("a_total", value_outliers("order", "order_id", "total_amount", "order_date", "ord"))
shared_view("a_event", value_outliers("event", "event_id", "value", "ts", "events"))
shared_view("rating_base", """SELECT item_id, s1 / n AS mu, CASE WHEN n > 1 THEN sqrt((n * s2 - s1 * s1) / (n * (n - 1))) END AS sigma
    FROM (SELECT item_id, count(*) AS n, sum(rating)::BIGINT AS s1, sum(rating * rating)::BIGINT AS s2 FROM rating GROUP BY 1)""")
for _of, _period, _least, _drift, _burst in (("month", "strftime({}, '%Y-%m')", MIN_RATINGS, DRIFT, BURST), ("day", "{}::VARCHAR", DAY_RATINGS, DAY_DRIFT, DAY_BURST)):
    shared_view(f"rating_{_of}", f"""SELECT item_id, period, sum(n)::BIGINT AS rating_count, sum(rating * n) / sum(n) AS avg_rating, max(n) / sum(n) AS top_rating_share
        FROM (SELECT item_id, {_period.format("review_date")} AS period, rating, count(*) AS n FROM rating GROUP BY 1, 2, 3) GROUP BY 1, 2 HAVING sum(n) >= {_least}""")
    shared_view(f"a_drift_{_of}", f"""SELECT CASE WHEN z > 0 THEN 'rating_spike' ELSE 'rating_drop' END AS anomaly_type, 'item_' || item_id AS entity, period, avg_rating AS value, z AS z_score,
        'Mean rating shifted away from the item baseline' AS note
        FROM (SELECT m.*, (avg_rating - mu) / sigma AS z FROM rating_{_of} m JOIN rating_base b ON m.item_id = b.item_id WHERE sigma > 0) WHERE abs(z) > {_drift}""")
    shared_view(f"a_same_{_of}", f"""SELECT 'rating_identical_cluster' AS anomaly_type, 'item_' || item_id AS entity, period, top_rating_share AS value, NULL::DOUBLE AS z_score,
        'At least 90% of the ratings share one score' AS note FROM rating_{_of} WHERE top_rating_share >= 0.9""")
    shared_view(f"a_burst_{_of}", f"""SELECT 'rating_volume_burst' AS anomaly_type, 'item_' || m.item_id AS entity, period, rating_count::DOUBLE AS value, NULL::DOUBLE AS z_score,
        'Rating volume far above the item''s upper quartile' AS note FROM rating_{_of} m JOIN (SELECT item_id, quantile_cont(rating_count, 0.25) AS q1, quantile_cont(rating_count, 0.75) AS q3 FROM rating_{_of} GROUP BY 1) q
        ON m.item_id = q.item_id WHERE rating_count > q3 + {_burst} * (q3 - q1)""")
    shared_view(f"a_mismatch_{_of}", f"""SELECT 'rating_purchase_mismatch' AS anomaly_type, 'item_' || m.item_id AS entity, m.period, rating_count / n AS value, NULL::DOUBLE AS z_score,
        'More ratings than completed purchases in the same period' AS note FROM rating_{_of} m JOIN (SELECT item_id, {_period.format("order_date")} AS period, count(DISTINCT order_id) AS n FROM purchase GROUP BY 1, 2) p
        ON m.item_id = p.item_id AND m.period = p.period WHERE rating_count > n * 1.05""")


@query("daily_zscore", "SELECT * FROM zscores")
def _(d):
    return anomaly.daily_zscore(d.outlet_orders)


def rating_detectors(d, period, least, drift, burst):
    """Name -> function giving its rows; the frame of items and periods is stored once."""
    held = {}

    def rated():
        if not held:
            held["df"] = materialize(anomaly.rating_periods(d.ratings, least, period), "rating-periods")
        return held["df"]

    return {
        "anomaly_rating_drift": lambda: anomaly.anomaly_rating_drift(rated(), anomaly.rating_baseline(d.ratings), drift),
        "anomaly_identical": lambda: anomaly.anomaly_identical(rated()),
        "anomaly_burst": lambda: anomaly.anomaly_burst(rated(), burst),
        "anomaly_mismatch": lambda: anomaly.anomaly_mismatch(rated(), d.purchases, period=period),
    }


def detectors(d):
    return {
        "anomaly_daily_sales": lambda: anomaly.anomaly_daily_sales(d.outlet_orders),
        "anomaly_order_total": lambda: anomaly.anomaly_order_total(d.orders, "order_id", "total_amount", "order_date", "order"),
        **rating_detectors(d, "month", MIN_RATINGS, DRIFT, BURST),
    }


def event_values(d):
    return d.table("events").select("event_id", "value", F.col("ts").cast("date").alias("day"))


for _name, _view in (("anomaly_daily_sales", "a_daily"), ("anomaly_order_total", "a_total"), ("anomaly_rating_drift", "a_drift_month"), ("anomaly_identical", "a_same_month"),
                     ("anomaly_burst", "a_burst_month"), ("anomaly_mismatch", "a_mismatch_month")):
    query(_name, f"SELECT * FROM {_view}")(lambda d, n=_name: detectors(d)[n]())
for _name, _view in (("anomaly_rating_drift", "a_drift_day"), ("anomaly_identical", "a_same_day"), ("anomaly_burst", "a_burst_day"), ("anomaly_mismatch", "a_mismatch_day")):
    query(f"{_name}_by_day", f"SELECT * FROM {_view}")(lambda d, n=_name: rating_detectors(d, "day", DAY_RATINGS, DAY_DRIFT, DAY_BURST)[n]())
query("anomaly_event_value", "SELECT * FROM a_event")(lambda d: anomaly.anomaly_order_total(event_values(d), "event_id", "value", "day", "event"))

shared_view("feed", " UNION ALL ".join(f"SELECT * FROM {v}" for v in ("a_daily", "a_total", "a_event", "a_drift_month", "a_same_month", "a_burst_month", "a_mismatch_month", "a_drift_day", "a_same_day", "a_burst_day", "a_mismatch_day")))


@query("anomaly_feed", "SELECT *, CASE WHEN anomaly_type LIKE 'rating%' THEN 'rating' ELSE 'sales' END AS family FROM feed")
def _(d):
    by_day = rating_detectors(d, "day", DAY_RATINGS, DAY_DRIFT, DAY_BURST)
    events = anomaly.anomaly_order_total(event_values(d), "event_id", "value", "day", "event")
    return anomaly.anomaly_feed([*(detect() for detect in (detectors(d) | {f"{n}_by_day": f for n, f in by_day.items()}).values()), events])
