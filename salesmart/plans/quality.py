"""Sources and sinks, quality checks and cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions import columns as c
from salesmart.operators import checks, cleaning, enrich, marts, quality
from salesmart.plans.registry import query, shared_view
from salesmart.sources import contracts, files
from salesmart.sources.bindings import PERIOD_END, PERIOD_START
from salesmart.storage import concurrently, materialize, new_path


def union(parts):
    return reduce(DataFrame.unionByName, parts)


# ---- sources and sinks -----------------------------------------------------


def _csv_copy(d, df, label):
    path = new_path(d.spark, label)
    files.write_csv(df, path)
    return path


@query("scan_csv_contract", "SELECT outlet_id, outlet_name, location_id, outlet_type, NULL::VARCHAR AS _corrupt FROM outlet")
def _(d):
    return files.load_table(d.spark, _csv_copy(d, d.outlets, "csv"), contracts.schema("outlets"))


CONTRACT_VIEWS = {"locations": "loc", "outlets": "outlet", "categories": "cat", "items": "item", "customers": "cust", "promotions": "promo", "orders": "ord",
                  "lines": "line", "ratings": "rating", "losses": "loss", "stock": "stock", "prices": "price"}


def canonical_tables(d):
    return {"locations": d.locations, "outlets": d.outlets, "categories": d.categories, "items": d.items, "customers": d.customers, "promotions": d.promotions, "orders": d.orders,
            "lines": d.lines, "ratings": d.ratings, "losses": d.losses, "stock": d.stock, "prices": d.prices}


def _fields(table):
    return [tuple(x.split()[:2]) for x in contracts.DDL[table].split(", ")]


@query("scan_csv_contracts", " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, count(*) AS rows, 0 AS corrupt_rows, " + " + ".join(f"count({n})" for n, _ in _fields(t)) + f" AS filled_cells FROM {v}" for t, v in CONTRACT_VIEWS.items()))
def _(d):
    """Every table of the contract written as CSV and read again by its contract."""
    parts = []
    for table, df in canonical_tables(d).items():
        names = [n for n, _ in _fields(table)]
        loaded = files.load_table(d.spark, _csv_copy(d, df.select(*names), "csv"), contracts.schema(table))
        filled = sum((F.count(n) for n in names[1:]), F.count(names[0]))
        parts.append(loaded.agg(F.count("*").alias("rows"), F.count("_corrupt").alias("corrupt_rows"), filled.alias("filled_cells")).select(F.lit(table).alias("dataset"), "rows", "corrupt_rows", "filled_cells"))
    return union(parts)


@query("schema_drift")
def _(d):
    path = _csv_copy(d, d.customers.withColumnRenamed("preferred_channel", "channel"), "csv")
    inferred = d.spark.read.options(header=True, inferSchema=True).csv(path)
    return files.schema_drift(d.spark, inferred.schema, contracts.schema("customers"), "customers")


ORDER_MONTHS = """SELECT order_id, customer_id, order_date, order_hour, order_status, is_completed, order_channel, total_amount,
    strftime(order_date, '%Y-%m') AS order_month FROM ord"""


@query("parquet_roundtrip", ORDER_MONTHS)
def _(d):
    path = new_path(d.spark, "orders-by-month")
    df = d.orders.withColumn("order_month", c.month_key("order_date"))
    files.write_partitioned(df, path, ["order_month"])
    files.write_partitioned(df, path, ["order_month"])  # a second run replaces the same partitions
    return d.spark.read.option("basePath", path).schema(df.schema).parquet(path)


@query("partitioned_fact", """SELECT o.outlet_id, count(*) AS lines, sum(l.net_revenue::DECIMAL(18,4))::DOUBLE AS net_revenue
    FROM line l JOIN ord o ON l.order_id = o.order_id GROUP BY 1""")
def _(d):
    path = new_path(d.spark, "lines-by-outlet")
    df = d.lines.join(d.outlet_orders.select("order_id", "outlet_id"), "order_id")
    files.write_partitioned(df, path, ["outlet_id"])
    stored = d.spark.read.schema(df.schema).parquet(path)
    return stored.groupBy("outlet_id").agg(F.count("*").alias("lines"), c.exact_sum("net_revenue").alias("net_revenue"))


@query("export_csv", "SELECT month, order_channel, orders, revenue FROM (SELECT strftime(order_date, '%Y-%m') AS month, order_channel, count(*) AS orders, "
       "sum(total_amount::DECIMAL(18,4))::DOUBLE AS revenue FROM done GROUP BY 1, 2)")
def _(d):
    out = marts.channel_monthly(d.orders)
    return d.spark.read.schema(out.schema).option("header", True).csv(_csv_copy(d, out, "export"))


@query("capped_evidence", """SELECT l.order_id, l.line_number, l.item_id, l.net_revenue FROM line l JOIN done d ON l.order_id = d.order_id
    ORDER BY l.net_revenue DESC, l.order_id, l.line_number, l.item_id LIMIT 2000""")
def _(d):
    rows = enrich.order_item_revenue(d.lines, d.orders, d.items).select("order_id", "line_number", "item_id", "net_revenue")
    return rows.orderBy(F.desc("net_revenue"), "order_id", "line_number", "item_id").limit(2000)


@query("run_summary", """
    SELECT output, rows, least(rows, cap) AS evidence_rows, 'spark' AS engine FROM (
      SELECT 'orders_enriched' AS output, (SELECT count(*) FROM done) AS rows, 2000 AS cap
      UNION ALL SELECT 'order_item_revenue', (SELECT count(*) FROM dline), 2000
      UNION ALL SELECT 'channel_monthly', (SELECT count(*) FROM (SELECT DISTINCT strftime(order_date, '%Y-%m'), order_channel FROM done)), 5000
      UNION ALL SELECT 'peak_hours', (SELECT count(*) FROM (SELECT DISTINCT order_hour, isodow(order_date) >= 6 FROM done)), 5000
      UNION ALL SELECT 'location_ranking', (SELECT count(*) FROM location_rank), 5000)""")
def _(d):
    outputs = {
        "orders_enriched": (enrich.orders_enriched(d.promo_orders, d.outlets, d.locations, d.customers, d.promotions), 2000),
        "order_item_revenue": (enrich.order_item_revenue(d.lines, d.orders, d.items), 2000),
        "channel_monthly": (marts.channel_monthly(d.orders), 5000),
        "peak_hours": (marts.peak_hours(d.orders), 5000),
        "location_ranking": (marts.location_ranking(d.outlet_orders, d.outlets, d.locations), 5000),
    }
    return union([df.agg(F.count("*").alias("rows")).select(
        F.lit(n).alias("output"), "rows", F.least("rows", F.lit(cap).cast("long")).alias("evidence_rows"), F.lit("spark").alias("engine"))
        for n, (df, cap) in outputs.items()])


@query("source_catalog", """SELECT 'orders' AS key, 'orders.parquet' AS file, 'raw' AS layer, 'loaded' AS status, count(*) AS rows FROM orders
    UNION ALL SELECT 'lines', 'lineitem.parquet', 'raw', 'loaded', count(*) FROM lineitem
    UNION ALL SELECT 'inventory', NULL, NULL, 'file_missing', 0""")
def _(d):
    return files.source_catalog(d.spark, {
        "orders": [("processed", f"{d.path}/processed/orders.parquet"), ("raw", f"{d.path}/orders.parquet")],
        "lines": [("raw", f"{d.path}/lineitem.parquet")],
        "inventory": [("raw", f"{d.path}/inventory.parquet")],
    })


@query("export_dataset", """SELECT order_channel, '[' || string_agg('{"month":"' || month || '","orders":' || orders || '}', ',' ORDER BY month) || ']' AS series
    FROM (SELECT strftime(order_date, '%Y-%m') AS month, order_channel, count(*) AS orders FROM done GROUP BY 1, 2) GROUP BY 1 ORDER BY order_channel LIMIT 25000""")
def _(d):
    # The collected array is one entry per calendar month.
    series = marts.channel_monthly(d.orders).groupBy("order_channel").agg(F.sort_array(F.collect_list(F.struct("month", "orders"))).alias("series"))
    return files.export_dataset({"channel_series": series}, "channel_series", ["order_channel"])


# ---- quality checks --------------------------------------------------------


#: The twelve tables as delivered, and the views the oracle reads for them.
RAW_VIEWS = {"locations": "dirtyl", "outlets": "dirtyo", "categories": "cat", "items": "item", "customers": "dirtyc", "promotions": "promo", "orders": "dirty",
             "lines": "line", "ratings": "rating", "losses": "loss", "stock": "stock", "prices": "price"}
GOOD_VIEWS = {n: f"good_{n}" for n in RAW_VIEWS}
#: Columns of delivered tables that differ from the contract's.
RAW_COLUMNS = {
    "outlets": ["outlet_id", "outlet_name", "location_id", "outlet_type", "copy_no"],
    "customers": ["customer_id", "customer_name", "outlet_id", "preferred_channel", "registration_date", "copy_no"],
    "orders": ["order_id", "customer_id", "order_date", "order_status", "total_amount", "order_channel", "copy_no"],
}
NUMBERS = ("BIGINT", "INT", "DOUBLE")


def columns_of(table: str) -> list[str]:
    return RAW_COLUMNS.get(table) or contracts.typed_columns(table, *NUMBERS, "STRING", "DATE")


def row_checks_sql(table: str) -> dict[str, str]:
    """Check -> condition under which a row fails, as DuckDB reads it."""
    columns = columns_of(table)
    out = {}
    for n in contracts.typed_columns(table, *NUMBERS):
        out[f"invalid_number_{n}"] = f"trim({n}::VARCHAR) <> '' AND try_cast({n}::VARCHAR AS DOUBLE) IS NULL"
    for n in contracts.typed_columns(table, "DATE"):
        out[f"invalid_date_{n}"] = f"trim({n}::VARCHAR) <> '' AND try_strptime({n}::VARCHAR, '%Y-%m-%d') IS NULL"
    for n in contracts.NON_NEGATIVE.get(table, []):
        out[f"negative_{n}"] = f"try_cast({n}::VARCHAR AS DOUBLE) < 0"
    out = {check: p for check, p in out.items() if any(check.endswith(f"_{n}") and check.split("_", 1 if check.startswith("negative") else 2)[-1] == n for n in columns)}
    for n in contracts.PERIOD_DATES.get(table, []):
        out[f"{n}_outside_period"] = f"NOT coalesce({n}::VARCHAR BETWEEN '{PERIOD_START}' AND '{PERIOD_END}', false)"
    out |= contracts.ROW_RULES.get(table, {})
    out["pk_null"] = " OR ".join(f"{k} IS NULL" for k in contracts.PRIMARY_KEYS[table])
    return out


def checks_sql(views: dict[str, str]) -> str:
    """Every check of every table: row checks from one scan each, repeated rows by DISTINCT, keys by NOT EXISTS."""
    parts = []
    for table, view in views.items():
        missing = " + ".join(f"({n} IS NULL)::BIGINT" for n in columns_of(table))
        rules = {"missing_cells": f"coalesce(sum({missing}), 0)"} | {check: f"count(*) FILTER ({p})" for check, p in row_checks_sql(table).items()}
        sets = {"pk_duplicate": contracts.PRIMARY_KEYS[table], "duplicate_rows": columns_of(table)}
        if table in contracts.BUSINESS_LINE:
            sets["duplicate_business_line"] = contracts.BUSINESS_LINE[table]
        rules |= {check: f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(columns)} FROM {view}))" for check, columns in sets.items()}
        names, counts = ", ".join(f"'{n}'" for n in rules), ", ".join(f"({x})::BIGINT" for x in rules.values())
        parts.append(f"SELECT '{table}' AS dataset, unnest([{names}]) AS \"check\", unnest(counts) AS failures FROM (SELECT [{counts}] AS counts FROM {view})")
        for check, columns, parent, parent_columns in contracts.parents_of(table):
            same = " AND ".join(f"p.{b} = c.{a}" for a, b in zip(columns, parent_columns, strict=True))
            parts.append(f"SELECT '{table}', '{check}', count(*) FROM {view} c WHERE NOT EXISTS (SELECT 1 FROM {views[parent]} p WHERE {same})")
    return " UNION ALL ".join(parts)


@query("profile_table", " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, count(*) AS rows, {len(columns_of(t))} AS columns, coalesce(sum({' + '.join(f'({n} IS NULL)::BIGINT' for n in columns_of(t))}), 0)::BIGINT AS missing_cells FROM {v}"
    for t, v in RAW_VIEWS.items()))
def _(d):
    return union([quality.profile_table(df, n) for n, df in d.raw_tables.items()])


@query("profile_duplicates", " UNION ALL ".join(
    f"""SELECT '{t}' AS dataset, 'duplicate_rows' AS "check", (SELECT count(*) FROM {v}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {v})) AS failures""" for t, v in RAW_VIEWS.items()))
def _(d):
    return union([quality.duplicates(df, n, df.columns, "duplicate_rows") for n, df in d.raw_tables.items()])


PK_SQL = " UNION ALL ".join(
    f"""SELECT '{t}' AS dataset, 'pk_duplicate' AS "check", (SELECT count(*) FROM {v}) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(contracts.PRIMARY_KEYS[t])} FROM {v})) AS failures
    UNION ALL SELECT '{t}', 'pk_null', (SELECT count(*) FROM {v} WHERE {' OR '.join(f'{k} IS NULL' for k in contracts.PRIMARY_KEYS[t])})""" for t, v in RAW_VIEWS.items())


@query("check_pk", PK_SQL + """
    UNION ALL SELECT 'dirty_channel', 'pk_duplicate', (SELECT count(*) - count(DISTINCT coalesce(order_channel, '?')) FROM dirty)
    UNION ALL SELECT 'dirty_channel', 'pk_null', (SELECT count(*) FROM dirty WHERE order_channel IS NULL)""")
def _(d):
    return union([*(quality.check_pk(df, n, contracts.PRIMARY_KEYS[n]) for n, df in d.raw_tables.items()), quality.check_pk(d.dirty_orders, "dirty_channel", ["order_channel"])])


NUMERIC_SQL = """SELECT 'orders' AS dataset, 'invalid_number_total_amount' AS "check",
    count(*) FILTER (total_amount IS NOT NULL AND try_cast(total_amount AS DOUBLE) IS NULL) AS failures FROM dirty"""


@query("check_numeric_parse", NUMERIC_SQL)
def _(d):
    return quality.check_numeric_parse(d.dirty_orders, "orders", ["total_amount"])


DATE_SQL = """SELECT 'orders' AS dataset, 'invalid_date_order_date' AS "check",
    count(*) FILTER (order_date IS NOT NULL AND try_strptime(order_date, '%Y-%m-%d') IS NULL) AS failures FROM dirty"""


@query("check_date_parse", DATE_SQL)
def _(d):
    return quality.check_date_parse(d.dirty_orders, "orders", ["order_date"])


@query("check_negative", """SELECT 'orders' AS dataset, 'negative_total_amount' AS "check", count(*) FILTER (try_cast(total_amount AS DOUBLE) < 0) AS failures FROM dirty
    UNION ALL SELECT 'stock', 'negative_closing', count(*) FILTER (closing < 0) FROM stock
    UNION ALL SELECT 'stock', 'negative_received', count(*) FILTER (received < 0) FROM stock
    UNION ALL SELECT 'lines', 'negative_quantity', count(*) FILTER (quantity < 0) FROM line
    UNION ALL SELECT 'lines', 'negative_line_total', count(*) FILTER (line_total < 0) FROM line""")
def _(d):
    return union([quality.check_negative(d.dirty_orders, "orders", ["total_amount"]), quality.check_negative(d.stock, "stock", ["closing", "received"]),
                  quality.check_negative(d.lines, "lines", ["quantity", "line_total"])])


@query("check_ranges", """SELECT 'ratings' AS dataset, 'rating_outside_1_5' AS "check", count(*) FILTER (NOT rating BETWEEN 1 AND 5) AS failures FROM rating
    UNION ALL SELECT 'promotions', 'discount_outside_0_100', count(*) FILTER (NOT discount_percentage BETWEEN 0 AND 100) FROM promo
    UNION ALL SELECT 'lines', 'quantity_not_positive', count(*) FILTER (quantity <= 0) FROM line
    UNION ALL SELECT 'lines', 'discount_above_5000', count(*) FILTER (line_discount > 5000) FROM line
    UNION ALL SELECT 'items', 'base_price_not_positive', count(*) FILTER (base_price <= 0) FROM item
    UNION ALL SELECT 'losses', 'quantity_not_positive', count(*) FILTER (quantity_wasted <= 0) FROM loss""")
def _(d):
    return union([
        quality.count_failures(d.ratings, "ratings", {"rating_outside_1_5": quality.outside("rating", 1, 5)}),
        quality.count_failures(d.promotions, "promotions", {"discount_outside_0_100": quality.outside("discount_percentage", 0, 100)}),
        quality.count_failures(d.lines, "lines", {"quantity_not_positive": F.col("quantity") <= 0, "discount_above_5000": F.col("line_discount") > 5000}),
        quality.count_failures(d.items, "items", {"base_price_not_positive": F.col("base_price") <= 0}),
        quality.count_failures(d.losses, "losses", {"quantity_not_positive": F.col("quantity_wasted") <= 0}),
    ])


PERIOD_SQL = f"""SELECT 'orders' AS dataset, 'order_date_outside_period' AS "check",
    count(*) FILTER (coalesce(NOT order_date BETWEEN '{PERIOD_START}' AND '{PERIOD_END}', TRUE)) AS failures FROM dirty"""


@query("check_period", PERIOD_SQL)
def _(d):
    return quality.count_failures(d.dirty_orders, "orders", {"order_date_outside_period": quality.outside("order_date", PERIOD_START, PERIOD_END)})


TOTAL_SQL = """SELECT 'orders' AS dataset, 'total_mismatch' AS "check", count(*) FILTER (abs(subtotal - discount_amount + tax_amount + delivery_fee - total_amount) > 0.01)
    AS failures FROM ordp"""


@query("check_total_identity", TOTAL_SQL)
def _(d):
    return quality.count_failures(d.promo_orders, "orders", {"total_mismatch": quality.total_mismatch()})


@query("check_stock_balance", """SELECT 'stock' AS dataset, 'balance_mismatch' AS "check", count(*) FILTER (closing <> opening + received - sold) AS failures FROM stock
    UNION ALL SELECT 'stock', 'closing_below_zero', count(*) FILTER (closing < 0) FROM stock""")
def _(d):
    return quality.count_failures(d.stock, "stock", {
        "balance_mismatch": F.col("closing") != F.col("opening") + F.col("received") - F.col("sold"), "closing_below_zero": F.col("closing") < 0})


@query("check_margin", """SELECT 'items' AS dataset, 'cost_exceeds_base_price' AS "check", count(*) FILTER (cost_price > base_price) AS failures FROM item""")
def _(d):
    return quality.count_failures(d.items, "items", {"cost_exceeds_base_price": F.col("cost_price") > F.col("base_price")})


@query("check_fk", """SELECT 'dirty_orders' AS dataset, 'fk_customer_id' AS "check", (SELECT count(*) FROM dirty WHERE customer_id NOT IN (SELECT customer_id FROM cust)) AS failures
    UNION ALL SELECT 'lines', 'fk_order_id', (SELECT count(*) FROM line WHERE order_id NOT IN (SELECT order_id FROM ord))
    UNION ALL SELECT 'lines', 'fk_item_id', (SELECT count(*) FROM line WHERE item_id NOT IN (SELECT item_id FROM item))
    UNION ALL SELECT 'ratings', 'fk_order_id', (SELECT count(*) FROM rating WHERE order_id NOT IN (SELECT order_id FROM ord))
    UNION ALL SELECT 'outlets', 'fk_location_id', 0
    UNION ALL SELECT 'items', 'fk_outlet_id', (SELECT count(*) FROM item WHERE outlet_id NOT IN (SELECT outlet_id FROM outlet))
    UNION ALL SELECT 'promotions', 'fk_outlet_id', 0
    UNION ALL SELECT 'customers', 'fk_outlet_id', 0""")
def _(d):
    frames = {"outlets": d.outlets, "items": d.items, "customers": d.customers, "promotions": d.promotions, "orders": d.orders,
              "lines": d.lines, "ratings": d.ratings, "locations": d.locations}
    out = [quality.check_fk(d.dirty_orders, "dirty_orders", "customer_id", d.customers, "customer_id")]
    out += [quality.check_fk(frames[child], child, key, frames[parent], pk) for child, key, parent, pk in contracts.FOREIGN_KEYS if child != "orders"]
    return union(out)


@query("check_fk_optional", """SELECT 'orders' AS dataset, 'fk_promotion_id' AS "check", count(*) FILTER (promotion_id <> '' AND promotion_id NOT IN
    (SELECT promotion_id::VARCHAR FROM promo WHERE discount_percentage > 10)) AS failures FROM ordp""")
def _(d):
    return quality.check_fk(d.promo_orders, "orders", "promotion_id", d.promotions.where("discount_percentage > 10"), "promotion_id", optional=True)


@query("check_fk_consistency", """SELECT 'lines' AS dataset, 'fk_outlet_consistency' AS "check", count(*) AS failures FROM line l JOIN ord o ON l.order_id = o.order_id
    LEFT JOIN item i ON l.item_id = i.item_id WHERE i.outlet_id IS DISTINCT FROM o.outlet_id""")
def _(d):
    return quality.check_fk_consistency(d.lines, d.outlet_orders, d.items)


@query("check_owner_match", """SELECT 'ratings' AS dataset, 'fk_customer_match' AS "check", count(*) AS failures FROM rating r LEFT JOIN ord o ON r.order_id = o.order_id
    WHERE o.customer_id IS DISTINCT FROM r.customer_id""")
def _(d):
    return quality.check_owner_match(d.ratings, d.orders)


@query("check_pair_membership", """SELECT 'ratings' AS dataset, 'fk_item_in_order' AS "check", count(*) AS failures FROM rating r
    WHERE NOT EXISTS (SELECT 1 FROM line l WHERE l.order_id = r.order_id AND l.item_id = r.item_id)""")
def _(d):
    return quality.check_pair_membership(d.ratings, d.lines)


@query("check_composite_fk", """SELECT 'losses' AS dataset, 'fk_item_id_outlet_id' AS "check", count(*) AS failures FROM loss w JOIN ord o ON w.order_id = o.order_id
    WHERE NOT EXISTS (SELECT 1 FROM item i WHERE i.item_id = w.item_id AND i.outlet_id = o.outlet_id)""")
def _(d):
    sold_at = d.losses.drop("outlet_id").join(d.outlet_orders.select("order_id", "outlet_id"), "order_id")
    return quality.check_composite_fk(sold_at, "losses", ["item_id", "outlet_id"], d.items)


@query("check_promo_active", """SELECT 'orders' AS dataset, 'promo_not_active' AS "check", count(*) AS failures FROM ordp o JOIN promo p ON o.promotion_id = p.promotion_id::VARCHAR
      WHERE p.outlet_id <> o.outlet_id OR NOT o.order_date BETWEEN p.start_date AND p.end_date
    UNION ALL SELECT 'orders', 'promo_not_active_on_delivery', count(*) FROM ordp o JOIN promo p ON o.promotion_id = p.promotion_id::VARCHAR
      WHERE p.outlet_id <> o.outlet_id OR NOT o.order_date + 20 BETWEEN p.start_date AND p.end_date""")
def _(d):
    delivered = d.promo_orders.withColumn("delivery_date", F.date_add("order_date", 20))
    return quality.check_promo_active(d.promo_orders, d.promotions).unionByName(
        quality.check_promo_active(delivered, d.promotions, "delivery_date", "promo_not_active_on_delivery"))


@query("check_dup_lines", """SELECT 'lines' AS dataset, 'duplicate_business_line' AS "check", (SELECT count(*) FROM line) -
    (SELECT count(*) FROM (SELECT DISTINCT order_id, item_id, quantity, unit_price, line_discount, line_total FROM line)) AS failures""")
def _(d):
    return quality.duplicates(d.lines, "lines", ["order_id", "item_id", "quantity", "unit_price", "line_discount", "line_total"], "duplicate_business_line")


shared_view("checks", checks_sql(RAW_VIEWS))


def _report(d):
    """All checks of the delivered tables. Those derived from the lines are read by three checks each, so they are stored first."""
    raw = d.raw_tables
    derived = concurrently(**{n: lambda n=n: materialize(raw[n], f"raw-{n}") for n in ("losses", "stock", "prices")})
    return checks.check_all(raw | derived, PERIOD_START, PERIOD_END)


@query("quality_checks", "SELECT * FROM checks")
def _(d):
    return _report(d)


@query("quality_report", """SELECT dataset, count(*) AS checks, count(*) FILTER (failures > 0) AS failing_checks, sum(failures)::BIGINT AS total_failures FROM checks GROUP BY 1""")
def _(d):
    return quality.report_summary(_report(d))


@query("quality_pivot", "SELECT dataset, " + ", ".join(f"""coalesce(sum(failures) FILTER ("check" = '{n}'), 0)::BIGINT AS {n}""" for n in checks.all_checks()) + " FROM checks GROUP BY 1")
def _(d):
    return quality.summary_pivot(_report(d), checks.all_checks())


@query("quality_violations", " UNION ALL ".join(
    f"""SELECT '{t}' AS dataset, '{n}' AS "check", '{{' || {" || ',' || ".join(f"""'"{k}":' || coalesce({k + "::VARCHAR" if columns in NUMBERS else "'" + '"' + "' || " + k + " || '" + '"' + "'"}, 'null')""" for k, columns in ((k, next(x.split()[1] for x in contracts.DDL[t].split(", ") if x.split()[0] == k)) for k in contracts.PRIMARY_KEYS[t]))} || '}}' AS key FROM {v} WHERE {p}"""
    for t, v in RAW_VIEWS.items() for n, p in row_checks_sql(t).items()))
def _(d):
    raw = d.raw_tables
    return union([checks.violations(df, n, checks.row_rules(n, df.columns, PERIOD_START, PERIOD_END), contracts.PRIMARY_KEYS[n]) for n, df in raw.items()])


# ---- cleaning --------------------------------------------------------------


@query("clean_dates", """SELECT order_id, copy_no, CASE WHEN try_strptime(order_date, '%Y-%m-%d') IS NULL THEN '' ELSE order_date END AS order_date FROM dirty""")
def _(d):
    return cleaning.clean_dates(d.dirty_orders.select("order_id", "copy_no", "order_date"), ["order_date"])


@query("clean_numeric", "SELECT order_id, copy_no, try_cast(total_amount AS DOUBLE) AS total_amount FROM dirty")
def _(d):
    return cleaning.clean_numeric(d.dirty_orders.select("order_id", "copy_no", "total_amount"), ["total_amount"])


@query("clean_text", "SELECT order_id, copy_no, coalesce(trim(order_status), '') AS order_status, coalesce(trim(order_channel), '') AS order_channel FROM dirty")
def _(d):
    return cleaning.clean_text(d.dirty_orders.select("order_id", "copy_no", "order_status", "order_channel"), ["order_status", "order_channel"])


@query("dedup_keep_first", "SELECT * FROM dirty WHERE copy_no = 0")
def _(d):
    return cleaning.dedup_keep_first(d.dirty_orders, ["order_id"], "copy_no")


@query("dedup_rows", "SELECT DISTINCT * FROM line UNION ALL SELECT NULL, location_id, NULL, NULL, NULL, NULL, NULL, NULL, city_area, NULL FROM (SELECT DISTINCT * FROM dirtyl)")
def _(d):
    """Whole equal rows of the lines, and of the locations in the same shape."""
    places = d.dirty_locations.dropDuplicates().select(F.col("location_id").alias("line_number"), F.col("city_area").alias("flag"))
    return d.lines.dropDuplicates().unionByName(places, allowMissingColumns=True)


def unknown(view: str, *columns: str) -> str:
    return f"NOT EXISTS (SELECT 1 FROM good_{view} p WHERE {' AND '.join(f'p.{c} = c.{c}' for c in columns)})"


def marked(table: str, rows: str, *rules: tuple[str, str]) -> None:
    """Oracle views of a table's rows with their reason, and of the good ones."""
    cases = " ".join(f"WHEN {p} THEN '{reason.replace(chr(39), chr(39) * 2)}'" for reason, p in rules)
    shared_view(f"marked_{table}", f"SELECT *, {f'CASE {cases} END' if rules else 'NULL::VARCHAR'} AS quarantine_reason FROM ({rows}) c")
    shared_view(f"good_{table}", f"SELECT * EXCLUDE (quarantine_reason) FROM marked_{table} WHERE quarantine_reason IS NULL")


OUTLET = ("Unknown outlet_id", unknown("outlets", "outlet_id"))
marked("locations", "SELECT DISTINCT location_id, coalesce(trim(city_area), '') AS city_area FROM dirtyl")
marked("categories", "SELECT coalesce(trim(category_name), '') AS category_name, category_id FROM cat", ("Blank category_name", "category_name = ''"))
marked("outlets", "SELECT outlet_id, coalesce(trim(outlet_name), '') AS outlet_name, location_id, coalesce(trim(outlet_type), '') AS outlet_type, copy_no FROM dirtyo",
       ("Duplicate outlet_id", "copy_no > 0"), ("Unknown location_id", unknown("locations", "location_id")))
marked("customers", """SELECT customer_id, coalesce(trim(customer_name), '') AS customer_name, outlet_id, coalesce(trim(preferred_channel), '') AS preferred_channel,
    CASE WHEN try_strptime(registration_date, '%Y-%m-%d') IS NULL THEN '' ELSE registration_date END AS registration_date, copy_no FROM dirtyc""",
       ("Duplicate customer_id", "copy_no > 0"), OUTLET)
marked("items", "SELECT * FROM item", OUTLET, ("Unknown category_name", unknown("categories", "category_name")),
       ("Invalid price or cost", "base_price <= 0 OR cost_price < 0 OR cost_price > base_price"))
marked("promotions", "SELECT * FROM promo", OUTLET, ("Discount outside 0..100", "NOT discount_percentage BETWEEN 0 AND 100"), ("End before start", "end_date < start_date"))
marked("orders", """SELECT order_id, customer_id, CASE WHEN try_strptime(order_date, '%Y-%m-%d') IS NULL THEN '' ELSE order_date END AS order_date,
    coalesce(trim(order_status), '') AS order_status, try_cast(total_amount AS DOUBLE) AS total_amount, coalesce(trim(order_channel), '') AS order_channel, copy_no FROM dirty""",
       ("Duplicate order_id", "copy_no > 0"), ("Unknown customer_id", unknown("customers", "customer_id")),
       ("order_date outside analysis period", f"NOT order_date BETWEEN '{PERIOD_START}' AND '{PERIOD_END}'"), ("No order key or negative amount", "order_id IS NULL OR total_amount < 0"))
marked("lines", "SELECT * FROM line", ("Unknown order_id", unknown("orders", "order_id")), ("Unknown item_id", unknown("items", "item_id")),
       ("Invalid quantity, price or total", "quantity <= 0 OR unit_price < 0 OR line_total < 0 OR line_discount < 0"))
marked("ratings", "SELECT * FROM rating", ("Unknown order_id", unknown("orders", "order_id")), ("Rating customer differs from order customer", unknown("orders", "order_id", "customer_id")),
       ("Rated item is not in the order", unknown("lines", "order_id", "item_id")), ("Rating outside 1..5", "NOT rating BETWEEN 1 AND 5"))
marked("losses", "SELECT * FROM loss", ("Unknown item_id", unknown("items", "item_id")), ("Item is not the outlet's", unknown("items", "item_id", "outlet_id")),
       ("Unknown order line", unknown("lines", "order_id", "line_number")), ("Invalid quantity or cost", "quantity_wasted <= 0 OR estimated_cost < 0"))
marked("stock", "SELECT * FROM stock", ("Unknown brand", unknown("items", "brand")), ("Negative stock", "closing < 0 OR received < 0 OR sold < 0"), ("Stock does not balance", "closing <> opening + received - sold"))
marked("prices", "SELECT * FROM price", ("Unknown brand", unknown("items", "brand")), ("Invalid price", "new_price <= 0 OR old_price <= 0"))


def _all(d):
    return cleaning.clean_all(d, PERIOD_START, PERIOD_END)


@query("rule_quarantine", "SELECT * FROM marked_orders WHERE quarantine_reason IS NOT NULL")
def _(d):
    return _all(d)["orders"].bad


@query("fk_quarantine", """SELECT order_id, customer_id, copy_no, CASE WHEN customer_id NOT IN (SELECT customer_id FROM cust) THEN 'Unknown customer_id' END AS quarantine_reason
    FROM dirty WHERE customer_id NOT IN (SELECT customer_id FROM cust)""")
def _(d):
    of_customer = cleaning.Parent("Unknown customer_id", ("customer_id",), "customers", ("customer_id",))
    rows = of_customer.flag(d.dirty_orders.select("order_id", "customer_id", "copy_no"), d.customers, "ok")
    return cleaning.mark(rows, [(of_customer.reason, of_customer.fails("ok"))]).where("quarantine_reason is not null").drop("ok")


@query("consistency_quarantine", "SELECT * FROM marked_ratings WHERE quarantine_reason IS NOT NULL")
def _(d):
    return _all(d)["ratings"].bad


@query("period_quarantine", f"""SELECT order_id, copy_no, order_date FROM (SELECT order_id, copy_no, CASE WHEN try_strptime(order_date, '%Y-%m-%d') IS NULL THEN '' ELSE order_date END AS order_date FROM dirty)
    WHERE NOT order_date BETWEEN '{PERIOD_START}' AND '{PERIOD_END}'""")
def _(d):
    return cleaning.clean_dates(d.dirty_orders.select("order_id", "copy_no", "order_date"), ["order_date"]).where(
        ~F.col("order_date").between(PERIOD_START, PERIOD_END))


@query("norm_optional_id", """SELECT order_id, raw_id, CASE WHEN raw_id IS NULL OR trim(raw_id) = '' THEN '' ELSE try_cast(try_cast(raw_id AS DOUBLE) AS BIGINT)::VARCHAR END AS promotion_id
    FROM (SELECT order_id, CASE WHEN promotion_id = '' AND order_id % 2 = 0 THEN NULL WHEN promotion_id = '' THEN ' ' ELSE promotion_id || '.0' END AS raw_id FROM ordp)""")
def _(d):
    blank = F.col("promotion_id") == ""
    raw = F.when(blank & (F.col("order_id") % 2 == 0), F.lit(None)).when(blank, " ").otherwise(F.concat("promotion_id", F.lit(".0")))
    return d.promo_orders.select("order_id", raw.alias("raw_id")).withColumn("promotion_id", c.optional_id("raw_id"))


BY_REASON = " UNION ALL ".join(f"SELECT '{n}' AS dataset, quarantine_reason, count(*) AS rows FROM marked_{n} WHERE quarantine_reason IS NOT NULL GROUP BY 2" for n in RAW_VIEWS)
SUMMARY = " UNION ALL ".join(
    f"SELECT '{n}' AS dataset, (SELECT count(*) FROM {v}) AS raw_rows, count(*) FILTER (quarantine_reason IS NULL) AS processed_rows, "
    f"(SELECT count(*) FROM {v}) - count(*) FILTER (quarantine_reason IS NULL) AS removed_rows FROM marked_{n}" for n, v in RAW_VIEWS.items())
BLANKS = " UNION ALL ".join(
    f"SELECT '{n}', 'retained_blank', count(*), '{column} missing' FROM good_{n} WHERE {column} = '' HAVING count(*) > 0"
    for n, spec in cleaning.specs(PERIOD_START, PERIOD_END).items() for column in spec.texts + spec.dates)


@query("quarantine_table", BY_REASON)
def _(d):
    path = new_path(d.spark, "quarantine")
    rows = cleaning.quarantine_rows(_all(d), "run-1")
    files.write_partitioned(rows, path, ["run", "dataset"])
    stored = d.spark.read.schema(rows.schema).parquet(path)
    return stored.groupBy("dataset", "quarantine_reason").agg(F.count("*").alias("rows"))


@query("cleaning_summary", SUMMARY)
def _(d):
    return cleaning.cleaning_summary(_all(d))


@query("quarantine_by_reason", BY_REASON)
def _(d):
    return cleaning.quarantine_by_reason(_all(d))


@query("clean_all", f"""SELECT dataset, 'quarantined' AS action, rows AS affected_rows, quarantine_reason AS reason FROM ({BY_REASON})
    UNION ALL SELECT dataset, 'processed', processed_rows, 'Clean records' FROM ({SUMMARY})
    UNION ALL {BLANKS} UNION ALL SELECT 'locations', 'deduplicated', (SELECT count(*) FROM dirtyl) - count(*), 'Equal rows' FROM marked_locations""")
def _(d):
    return cleaning.cleaning_log(_all(d), cleaning.specs(PERIOD_START, PERIOD_END))


@query("verify_clean", checks_sql(GOOD_VIEWS))
def _(d):
    """Every check again on the cleaned tables."""
    return checks.check_all({n: x.good for n, x in _all(d).items()}, PERIOD_START, PERIOD_END)
