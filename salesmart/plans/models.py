"""Features, models and their comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.operators import features, items, models
from salesmart.operators.models import CHURN_TASK, ITEM_TASK, ORDER_TASK
from salesmart.plans.analytics import item_frame
from salesmart.plans.registry import query, shared_view
from salesmart.sources.bindings import PERIOD_END
from salesmart.storage import materialize, new_path

shared_view("channel_codes", "SELECT order_channel, row_number() OVER (ORDER BY order_channel) - 1 AS channel_code FROM (SELECT DISTINCT order_channel FROM donep)")
shared_view("payment_codes", """SELECT p, row_number() OVER (ORDER BY p) - 1 AS payment_code FROM (SELECT DISTINCT coalesce(nullif(trim(payment_method), ''), 'Unknown') AS p FROM donep)""")
shared_view("order_x", """SELECT o.order_id, o.customer_id, o.total_amount, o.order_hour, isodow(o.order_date) - 1 AS day_of_week_code, month(o.order_date) AS order_month,
      (isodow(o.order_date) >= 6)::INT AS is_weekend, (o.promotion_id <> '')::INT AS is_promo_order, c.channel_code, p.payment_code,
      coalesce(b.basket_size, 0) AS basket_size, coalesce(b.basket_quantity, 0) AS basket_quantity, coalesce(b.avg_unit_price, 0) AS avg_unit_price,
      CASE WHEN o.subtotal > 0 THEN o.discount_amount / o.subtotal * 100 ELSE 0 END AS discount_rate_percentage,
      greatest(h.n - 1, 0) AS total_orders, greatest((h.s - o.total_amount::DECIMAL(18,4))::DOUBLE, 0) AS total_spend
    FROM donep o LEFT JOIN basket_agg b ON o.order_id = b.order_id
    JOIN (SELECT customer_id, count(*) AS n, sum(total_amount::DECIMAL(18,4)) AS s FROM donep GROUP BY 1) h ON o.customer_id = h.customer_id
    JOIN channel_codes c ON o.order_channel = c.order_channel JOIN payment_codes p ON coalesce(nullif(trim(o.payment_method), ''), 'Unknown') = p.p""")


def order_frame(d):
    return features.order_features(d.promo_orders, d.lines)


@query("order_features", "SELECT * FROM order_x")
def _(d):
    return order_frame(d)


shared_view("churn_x", f"""SELECT s.customer_id, (DATE '{PERIOD_END}' - s.last_order_date)::BIGINT AS recency_days, s.total_orders, s.total_spend, s.average_order_value,
      CASE WHEN total_spend > 0 THEN total_discount_received / total_spend ELSE 0 END AS discount_dependency,
      CASE WHEN total_orders > 0 THEN promo_orders / total_orders ELSE 0 END AS promo_dependency, coalesce(m.top_category_share, 0) AS top_category_share,
      coalesce(m.unique_categories, 0) AS unique_categories, s.total_items_purchased, coalesce(w.weekend_order_share, 0) AS weekend_order_share,
      (DATE '{PERIOD_END}' - s.last_order_date > 60)::BIGINT AS churned
    FROM customer_stats s LEFT JOIN category_mix m ON s.customer_id = m.customer_id LEFT JOIN weekend_mix w ON s.customer_id = w.customer_id
    WHERE s.total_orders > 0 AND s.first_order_date <= DATE '{PERIOD_END}' - 180""")


def behaviour(d):
    return features.customer_behaviour(d.promo_orders, d.lines, d.items, PERIOD_END)


def churn_frame(d):
    return features.churn_features(behaviour(d), PERIOD_END)


@query("churn_features", "SELECT *, round(ln(1 + total_orders), 9) AS f_log_orders, round(ln(1 + total_spend), 9) AS f_log_spend FROM churn_x")
def _(d):
    return churn_frame(d).withColumns({n: F.round(n, 9) for n in ("f_log_orders", "f_log_spend")})


shared_view("split_x", """SELECT customer_id, churned, ('0x' || substr(md5(customer_id || ':42'), 1, 15))::BIGINT AS place FROM churn_x
    WHERE customer_id NOT IN (SELECT customer_id FROM purchase_user)""")


@query("ml_split", """SELECT customer_id, churned, CASE WHEN row_number() OVER (PARTITION BY churned ORDER BY place) <= (count(*) OVER (PARTITION BY churned) * 20 + 50) // 100
    THEN 'test' ELSE 'train' END AS side FROM split_x""")
def _(d):
    return features.ml_split(churn_frame(d), "customer_id", held_out=buyers(d), label="churned").select("customer_id", "churned", "side")


# ---- models ----------------------------------------------------------------


def buyers(d):
    """Held-out cases: customers, orders and items that the purchase events name. No training sees them."""
    bought = d.table("events").where("event_type = 'purchase'")
    return bought.select(F.col("user_id").alias("customer_id"), F.col("event_id").alias("order_id"), (F.col("user_id") % 25).alias("item_id"))


def order_split(d):
    """Orders have their label from the training side, so they are not cut by class."""
    return materialize(models.label_high_value(models.prepared_split(order_frame(d), "order_id", buyers(d))), "labelled")


def churn_split(d, frame=None):
    return models.prepared_split(churn_frame(d) if frame is None else frame, "customer_id", buyers(d), "churned")


def item_split(d):
    return models.prepared_split(items.item_business_class(item_frame(d)), "item_id", buyers(d), "business_class")


def run(task, split, family, trees=150):
    model = models.train(task, split, family, trees)
    return model, models.score(model, split.where("side = 'test'"), task)


def report(task, split, family):
    _, scored = run(task, split, family)
    return models.evaluate(scored, task).withColumn("n_train", split.where("side = 'train'").agg(F.count("*")).scalar())


@query("model_high_value")
def _(d):
    return report(ORDER_TASK, order_split(d), "forest")


@query("model_churn")
def _(d):
    return report(CHURN_TASK, churn_split(d), "logistic")


@query("model_item_class")
def _(d):
    return report(ITEM_TASK, item_split(d), "forest")


@query("model_second")
def _(d):
    return report(CHURN_TASK, churn_split(d), "boosted")


@query("model_comparison")
def _(d):
    """Two families on the held-out cases, which neither has seen."""
    frame = materialize(churn_frame(d), "churn-frame")
    split, held = churn_split(d, frame), models.held_out_cases(frame, "customer_id", buyers(d))
    a, b = (materialize(models.score(models.train(CHURN_TASK, split, family), held, CHURN_TASK), "scored") for family in ("logistic", "boosted"))
    cases = a.select("customer_id", "actual").join(held.select("customer_id", "recency_days"), "customer_id")
    return models.dual_summary(models.dual_compare(models.align(cases, a, b, "customer_id"), [models.NEAR_THE_QUIET_LIMIT]), "customer_churn")


@query("ensemble_score")
def _(d):
    split = churn_split(d)
    a, b = models.train(CHURN_TASK, split, "logistic"), models.train(CHURN_TASK, split, "forest", 50)
    return models.ensemble_score(a, b, split.where("side = 'test'"), CHURN_TASK)


@query("ensemble_tables", """SELECT a.order_id, a.probability AS probability_a, b.probability AS probability_b, (a.probability + b.probability) / 2 AS probability_ensemble,
    ((a.probability + b.probability) / 2 >= 0.5)::BIGINT AS ensemble_label FROM scored_a a JOIN scored_b b ON a.order_id = b.order_id""")
def _(d):
    return models.ensemble(*rule_scores(d), "order_id")


@query("ensemble_class_score")
def _(d):
    from pyspark.ml.functions import vector_to_array

    split = item_split(d)
    test = split.where("side = 'test'")
    m1, m2 = models.train(ITEM_TASK, split, "forest", 50), models.train(ITEM_TASK, split, "logistic")
    a = m1.transform(test).select("item_id", vector_to_array("probability").alias("classes"))
    b = m2.transform(test).select("item_id", vector_to_array("probability").alias("classes"))
    return models.ensemble_classes(a, b, "item_id", m1.stages[-1].getLabels())


@query("model_registry")
def _(d):
    root, split = new_path(d.spark, "models"), churn_split(d)
    for family in ("logistic", "boosted"):
        model, scored = run(CHURN_TASK, split, family)
        models.save_model(d.spark, root, CHURN_TASK, family, model, models.evaluate(scored, CHURN_TASK))
    return models.model_catalog(d.spark, root)


@query("model_catalog")
def _(d):
    """Versions of two tasks side by side, the newest of each active."""
    root = new_path(d.spark, "models")
    for task, split, family in ((CHURN_TASK, churn_split(d), "logistic"), (ITEM_TASK, item_split(d), "logistic")):
        model, scored = run(task, split, family)
        models.save_model(d.spark, root, task, family, model, models.evaluate(scored, task))
    return models.model_catalog(d.spark, root)


@query("model_class_comparison")
def _(d):
    """Item class against the predictions of two model families, with match and explanation."""
    split = item_split(d)
    a, b = (materialize(run(ITEM_TASK, split, family, 50)[1], "scored") for family in ("forest", "logistic"))
    return models.dual_compare(models.align(a.select("item_id", "actual"), a, b, "item_id"), [models.NEITHER_IS_RIGHT])


@query("model_reload_check")
def _(d):
    """A reloaded model must reproduce its stored predictions; the result counts differences."""
    root, split = new_path(d.spark, "models"), churn_split(d)
    model, scored = run(CHURN_TASK, split, "logistic")
    stored = materialize(scored, "scored")
    models.save_model(d.spark, root, CHURN_TASK, "logistic", model, models.evaluate(stored, CHURN_TASK))
    again = models.score(models.load_latest(d.spark, root, CHURN_TASK.name), split.where("side = 'test'"), CHURN_TASK)
    return stored.exceptAll(again).unionAll(again.exceptAll(stored)).agg(F.count("*").alias("differences"))


@query("churn_risk")
def _(d):
    active = materialize(behaviour(d), "behaviour")
    split = churn_split(d, features.churn_features(active, PERIOD_END))
    return models.churn_risk(models.train(CHURN_TASK, split, "logistic"), active)


# ---- metrics and comparison on rule-based predictions ----------------------
# Two transparent scorers (basket quantity, spend history) stand in for models,
# so the evaluation operators can be compared with SQL to the last bit.

shared_view("scored_a", """SELECT order_id, (total_amount >= 400000)::BIGINT AS actual, basket_quantity / (basket_quantity + 100) AS probability,
    (basket_quantity / (basket_quantity + 100) >= 0.5)::BIGINT AS predicted FROM order_x""")
shared_view("scored_b", """SELECT order_id, (total_amount >= 400000)::BIGINT AS actual, basket_size / (basket_size + 4) AS probability,
    (basket_size / (basket_size + 4) >= 0.5)::BIGINT AS predicted FROM order_x""")


def rule_scores(d):
    x = materialize(order_frame(d).select("order_id", "total_amount", "basket_quantity", "basket_size"), "scores")

    def scorer(p):
        s = x.select("order_id", (F.col("total_amount") >= 400000).cast("long").alias("actual"), p.alias("probability"))
        return s.withColumn("predicted", (F.col("probability") >= 0.5).cast("long"))

    return scorer(F.col("basket_quantity") / (F.col("basket_quantity") + 100)), scorer(F.col("basket_size") / (F.col("basket_size") + 4))


def _f1(c):
    return (f"(SELECT CASE WHEN count(*) FILTER (actual = {c}) + count(*) FILTER (predicted = {c}) > 0 THEN 2 * count(*) FILTER (actual = {c} AND predicted = {c})"
            f" / (count(*) FILTER (actual = {c}) + count(*) FILTER (predicted = {c})) ELSE 0 END FROM scored_a)")


@query("ml_metrics", f"""SELECT 'high_value_order' AS task, count(*) AS cases, count(*) FILTER (actual = predicted) / count(*) AS accuracy, {_f1(1)} AS f1, ({_f1(0)} + {_f1(1)}) / 2 AS macro_f1,
    (SELECT 1 - sum(p * (above + n / 2)) / (sum(p) * sum(n)) FROM (SELECT p, n, coalesce(sum(n) OVER (ORDER BY probability DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above
      FROM (SELECT probability, sum(actual)::BIGINT AS p, sum(1 - actual)::BIGINT AS n FROM scored_a GROUP BY 1))) AS roc_auc FROM scored_a""")
def _(d):
    return models.evaluate(rule_scores(d)[0], ORDER_TASK)


shared_view("aligned", """SELECT a.order_id, a.actual, a.predicted AS pred_a, a.probability AS prob_a, b.predicted AS pred_b, b.probability AS prob_b
    FROM scored_a a JOIN scored_b b ON a.order_id = b.order_id""")
shared_view("compared", """SELECT a.*, pred_a = pred_b AS match, CASE WHEN pred_a = pred_b THEN '' WHEN abs(prob_b - 0.5) < 0.2 THEN 'probability near one half'
    WHEN x.total_orders > 0 AND x.total_amount > 1.5 * x.total_spend / x.total_orders THEN 'order is far above the mean of its customer'
    WHEN abs(prob_a - prob_b) < 0.15 THEN 'probabilities are close' ELSE 'models weigh the features differently' END AS explanation FROM aligned a JOIN order_x x ON a.order_id = x.order_id""")


def aligned(d):
    a, b = rule_scores(d)
    return models.align(a.select("order_id", "actual"), a, b, "order_id")


@query("prediction_align", "SELECT * FROM aligned")
def _(d):
    return aligned(d)


def compared_orders(d):
    past = order_frame(d).select("order_id", F.when(F.col("total_orders") > 0, F.col("total_amount") > 1.5 * F.col("total_spend") / F.col("total_orders")).alias("far_above"))
    rows = aligned(d).join(past, "order_id")
    return models.dual_compare(rows, [models.AMOUNT_FAR_ABOVE_MEAN]).drop("far_above")


@query("dual_compare", "SELECT * FROM compared")
def _(d):
    return compared_orders(d)


@query("dual_summary", """SELECT 'high_value_order' AS task, count(*) AS cases, count(*) FILTER (match) AS matching_cases, count(*) FILTER (NOT match) AS disagreeing_cases,
    count(*) FILTER (match) * 100.0::DOUBLE / count(*) AS agreement_percentage, count(*) FILTER (pred_a = actual) / count(*) AS accuracy_a, count(*) FILTER (pred_b = actual) / count(*) AS accuracy_b,
    round(avg(abs(prob_a - prob_b)), 9) AS mean_abs_probability_gap,
    '{"0":' || count(*) FILTER (actual = 0) || ',"1":' || count(*) FILTER (actual = 1) || '}' AS class_distribution FROM compared""")
def _(d):
    return models.dual_summary(compared_orders(d), "high_value_order")


SCORE_FEATURES = ["order_hour", "basket_quantity", "avg_unit_price"]


@query("score_validate", """SELECT order_id, batch_id, concat_ws('|', CASE WHEN order_id % 13 = 0 THEN 'missing:order_hour' END,
      CASE WHEN order_id % 17 = 0 THEN 'not_numeric:basket_quantity' WHEN order_id % 19 = 0 THEN 'not_finite:basket_quantity' END,
      CASE WHEN order_id % 23 = 0 THEN 'unknown:colour' END) AS rejects
    FROM (SELECT order_id, order_id % 60 AS batch_id FROM order_x)""")
def _(d):
    key = F.col("order_id")
    text = lambda n: F.col(n).cast("string")
    quantity = F.when(key % 17 == 0, "many").when(key % 19 == 0, "Infinity").otherwise(text("basket_quantity"))
    entries = F.array_compact(F.array(
        F.when(key % 13 != 0, F.struct(F.lit("order_hour").alias("k"), text("order_hour").alias("v"))),
        F.struct(F.lit("basket_quantity").alias("k"), quantity.alias("v")), F.struct(F.lit("avg_unit_price").alias("k"), text("avg_unit_price").alias("v")),
        F.when(key % 23 == 0, F.struct(F.lit("colour").alias("k"), F.lit("red").alias("v")))))
    batch = order_frame(d).select("order_id", (key % 60).alias("batch_id"), F.map_from_entries(entries).alias("payload"))
    return features.validate_scores(batch, SCORE_FEATURES).select("order_id", "batch_id", F.array_join("rejects", "|").alias("rejects"))
