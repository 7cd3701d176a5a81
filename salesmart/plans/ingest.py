"""Validated record ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.operators import ingest, search
from salesmart.operators.ingest import Field
from salesmart.plans.registry import query
from salesmart.sources import contracts

ORDER_CONTRACT = {
    "order_id": Field("integer", required=True, low=0),
    "customer_id": Field("integer", required=True, low=0, high=9_999_999),
    "order_date": Field("date", required=True),
    "order_status": Field("enum", required=True, choices=("Completed", "Cancelled", "Refunded")),
    "total_amount": Field("number", required=True, low=0),
    "order_channel": Field("string", max_length=12),
}
ACCEPT = """concat_ws('|', CASE WHEN customer_id > 9999999 THEN 'invalid:customer_id' END, CASE WHEN try_strptime(order_date, '%Y-%m-%d') IS NULL THEN 'invalid:order_date' END,
    CASE WHEN order_status NOT IN ('Completed', 'Cancelled', 'Refunded') THEN 'invalid:order_status' END,
    CASE WHEN coalesce(try_cast(total_amount AS DOUBLE) < 0, TRUE) THEN 'invalid:total_amount' END,
    CASE WHEN length(trim(order_channel)) > 12 THEN 'invalid:order_channel' END)"""


def validated(d):
    return ingest.ingest_validate(d.dirty_orders, ORDER_CONTRACT, ("copy_no",))


@query("ingest_validate", f"SELECT order_id, copy_no, {ACCEPT} AS rejects FROM dirty")
def _(d):
    return validated(d).select("order_id", "copy_no", F.array_join("rejects", "|").alias("rejects"))


@query("ingest_relationships", """
    SELECT 'lines' AS entity, 'item of another outlet' AS problem, count(*) AS rows FROM line l JOIN ord o ON l.order_id = o.order_id JOIN item i ON l.item_id = i.item_id
      WHERE i.outlet_id <> o.outlet_id HAVING count(*) > 0
    UNION ALL SELECT 'orders', 'promotion not active', count(*) FROM ordp o JOIN promo p ON o.promotion_id = p.promotion_id::VARCHAR
      WHERE NOT o.order_date + 20 BETWEEN p.start_date AND p.end_date HAVING count(*) > 0
    UNION ALL SELECT 'ratings', 'customer differs from order', count(*) FROM rating r JOIN ord o ON r.order_id = o.order_id WHERE r.customer_id <> o.customer_id HAVING count(*) > 0
    UNION ALL SELECT 'ratings', 'rated before the order', count(*) FROM rating r JOIN ord o ON r.order_id = o.order_id WHERE r.review_date < o.order_date + 20 HAVING count(*) > 0
    UNION ALL SELECT 'ratings', 'item not in the order', count(*) FROM rating r JOIN ord o ON r.order_id = o.order_id
      WHERE NOT EXISTS (SELECT 1 FROM line l WHERE l.order_id = r.order_id AND l.item_id = r.item_id) HAVING count(*) > 0""")
def _(d):
    # Checked as of delivery, 20 days after the order, so that some promotions have ended.
    delivered = d.promo_orders.withColumn("order_date", F.date_add("order_date", 20))
    return ingest.relationship_problems(d.lines, delivered, d.items, d.promotions, d.ratings)


@query("upsert_snapshot", """SELECT coalesce(k.customer_id, u.customer_id) AS customer_id, k.customer_name, k.outlet_id, coalesce(u.preferred_channel, k.preferred_channel) AS preferred_channel,
      k.registration_date, CASE WHEN u.customer_id IS NULL THEN 'keep' WHEN k.customer_id IS NULL THEN 'insert' ELSE 'update' END AS action
    FROM cust k FULL OUTER JOIN (SELECT customer_id + 100 AS customer_id, CASE WHEN customer_id % 3 = 0 THEN NULL ELSE 'WEB' END AS preferred_channel FROM cust) u
    ON k.customer_id = u.customer_id""")
def _(d):
    batch = d.customers.select((F.col("customer_id") + 100).alias("customer_id"),
                               F.when(F.col("customer_id") % 3 == 0, F.lit(None)).otherwise("WEB").alias("preferred_channel"))
    return ingest.upsert_snapshot(d.customers, batch, "customer_id")


@query("guarded_delete", """SELECT customer_id, CASE WHEN customer_id IN (SELECT customer_id FROM ord) THEN 'restricted' ELSE 'deleted' END AS outcome FROM cust""")
def _(d):
    return ingest.guarded_delete(d.customers.select("customer_id"), "customer_id", [d.orders])


@query("cascade_delete", """SELECT flag, count(*) AS lines FROM line WHERE order_id NOT IN (SELECT order_id FROM ord WHERE order_status = 'Refunded') GROUP BY 1""")
def _(d):
    refunded = d.orders.where("order_status = 'Refunded'")
    return ingest.cascade_delete(d.lines.select("order_id", "flag"), refunded, "order_id").groupBy("flag").agg(F.count("*").alias("lines"))


@query("audit_log", f"""SELECT action, n AS record_count, CASE WHEN n > 0 THEN 'success' ELSE 'empty' END AS status, '{{"entity":"orders","records":"' || n || '"}}' AS details
    FROM (SELECT 'create' AS action, count(*) AS n FROM dirty WHERE {ACCEPT} = '' UNION ALL SELECT 'reject', count(*) FROM dirty WHERE {ACCEPT} <> '')""")
def _(d):
    rows = validated(d)
    return ingest.audit_log([("create", rows.where(F.size("rejects") == 0), "orders"), ("reject", rows.where(F.size("rejects") > 0), "orders")])


@query("keyword_search", """SELECT *, (SELECT count(*) FROM promo WHERE contains(lower(promotion_name), '00000001')) AS total FROM promo
    WHERE contains(lower(promotion_name), '00000001') ORDER BY promotion_id LIMIT 25""")
def _(d):
    hits = d.promotions.where(F.lower("promotion_name").contains("00000001"))
    total = hits.agg(F.count("*")).scalar()
    return hits.orderBy("promotion_id").limit(25).withColumn("total", total)


SEARCHED = {"locations": "loc", "outlets": "outlet", "categories": "cat", "items": "item", "customers": "cust", "promotions": "promo", "orders": "ord", "stock": "stock"}
TERMS = ["Type 2", "steel", "#0", "00012", "a", "high", "1998", "nowhere at all"]


def key_sql(table):
    kinds = dict(x.split()[:2] for x in contracts.DDL[table].split(", "))
    cells = [f"""'"{k}":' || {f"'\"' || {k} || '\"'" if kinds[k] == "STRING" else f"{k}::VARCHAR"}""" for k in contracts.PRIMARY_KEYS[table]]
    return "'{' || " + " || ',' || ".join(cells) + " || '}'"


@query("keyword_search_all", "SELECT term, dataset, key, string_agg(DISTINCT name, ',' ORDER BY name) AS columns FROM (" + " UNION ALL ".join(
    f"SELECT '{t}' AS term, '{table}' AS dataset, {key_sql(table)} AS key, '{n}' AS name FROM {view} WHERE contains(lower({n}), '{t.lower()}')"
    for t in TERMS for table, view in SEARCHED.items() for n in contracts.SEARCHABLE[table]) + ") GROUP BY 1, 2, 3")
def _(d):
    """Several terms over all allowed columns of all tables, through the posting index."""
    frames = {"locations": d.locations, "outlets": d.outlets, "categories": d.categories, "items": d.items, "customers": d.customers, "promotions": d.promotions, "orders": d.orders, "stock": d.stock}
    index = search.SearchIndex.build(frames, contracts.SEARCHABLE)
    return index.search(TERMS, frames, contracts.PRIMARY_KEYS)
