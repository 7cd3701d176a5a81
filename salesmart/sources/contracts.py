"""Table contracts: columns, keys and rules of the canonical entities, as plain data."""

from __future__ import annotations

from pyspark.sql import types as T

# Column DDL per entity as delivered in CSV.
DDL = {
    "locations": "location_id BIGINT, city_area STRING",
    "outlets": "outlet_id BIGINT, outlet_name STRING, location_id BIGINT, outlet_type STRING",
    "categories": "category_name STRING, category_id BIGINT",
    "items": "item_id BIGINT, item_name STRING, category_name STRING, brand STRING, outlet_id BIGINT, base_price DOUBLE, cost_price DOUBLE",
    "customers": "customer_id BIGINT, customer_name STRING, outlet_id BIGINT, preferred_channel STRING, registration_date DATE",
    "promotions": "promotion_id BIGINT, promotion_name STRING, outlet_id BIGINT, discount_percentage BIGINT, start_date DATE, end_date DATE",
    "orders": "order_id BIGINT, customer_id BIGINT, order_date DATE, order_hour INT, order_status STRING, order_channel STRING, total_amount DOUBLE",
    "lines": "order_id BIGINT, line_number BIGINT, item_id BIGINT, quantity DOUBLE, unit_price DOUBLE, line_total DOUBLE, "
             "line_discount DOUBLE, net_revenue DOUBLE, flag STRING, ship_date DATE",
    "ratings": "rating_id BIGINT, order_id BIGINT, customer_id BIGINT, item_id BIGINT, rating BIGINT, review_date DATE",
    "losses": "order_id BIGINT, line_number BIGINT, item_id BIGINT, item_name STRING, category_name STRING, outlet_id BIGINT, quantity_wasted DOUBLE, estimated_cost DOUBLE, loss_date DATE",
    "stock": "brand STRING, month STRING, opening DOUBLE, received DOUBLE, sold DOUBLE, closing DOUBLE, reorder_level DOUBLE",
    "prices": "brand STRING, month STRING, new_price DOUBLE, old_price DOUBLE",
}

PRIMARY_KEYS = {
    "locations": ["location_id"], "outlets": ["outlet_id"], "categories": ["category_id"], "items": ["item_id"], "customers": ["customer_id"],
    "promotions": ["promotion_id"], "orders": ["order_id"], "lines": ["order_id", "line_number"], "ratings": ["rating_id"],
    "losses": ["order_id", "line_number"], "stock": ["brand", "month"], "prices": ["brand", "month"],
}

# (child, foreign key, parent, parent key)
FOREIGN_KEYS = [
    ("outlets", "location_id", "locations", "location_id"),
    ("items", "outlet_id", "outlets", "outlet_id"),
    ("customers", "outlet_id", "outlets", "outlet_id"),
    ("promotions", "outlet_id", "outlets", "outlet_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("lines", "order_id", "orders", "order_id"),
    ("lines", "item_id", "items", "item_id"),
    ("ratings", "order_id", "orders", "order_id"),
]

# Keys of several columns that must be met together, and keys that need not be unique in the parent:
# (child, check, child columns, parent, parent columns).
COMPOSITE_KEYS = [
    ("items", "fk_category_name", ["category_name"], "categories", ["category_name"]),
    ("ratings", "fk_customer_match", ["order_id", "customer_id"], "orders", ["order_id", "customer_id"]),
    ("ratings", "fk_item_in_order", ["order_id", "item_id"], "lines", ["order_id", "item_id"]),
    ("losses", "fk_order_line", ["order_id", "line_number"], "lines", ["order_id", "line_number"]),
    ("losses", "fk_item_id_outlet_id", ["item_id", "outlet_id"], "items", ["item_id", "outlet_id"]),
    ("stock", "fk_brand", ["brand"], "items", ["brand"]),
    ("prices", "fk_brand", ["brand"], "items", ["brand"]),
]

# Columns that must not be negative.
NON_NEGATIVE = {
    "items": ["base_price", "cost_price"],
    "orders": ["total_amount"],
    "lines": ["quantity", "unit_price", "line_discount", "line_total"],
    "losses": ["quantity_wasted", "estimated_cost"],
    "stock": ["opening", "received", "sold", "closing"],
    "prices": ["new_price", "old_price"],
}

# Dates that must lie in the analysis period; a missing one lies outside.
PERIOD_DATES = {"orders": ["order_date"]}

# Further rules: check -> SQL condition under which a row fails (unknown counts as passing).
ROW_RULES = {
    "ratings": {"rating_outside_1_5": "NOT coalesce(rating BETWEEN 1 AND 5, false)"},
    "promotions": {"discount_outside_0_100": "NOT coalesce(discount_percentage BETWEEN 0 AND 100, false)", "end_before_start": "end_date < start_date"},
    "lines": {"quantity_not_positive": "quantity <= 0", "discount_above_5000": "line_discount > 5000"},
    "items": {"base_price_not_positive": "base_price <= 0", "cost_exceeds_base_price": "cost_price > base_price"},
    "losses": {"quantity_not_positive": "quantity_wasted <= 0"},
    "stock": {"balance_mismatch": "closing <> opening + received - sold"},
}

# Columns that make up a business line; equal ones are counted beside the key.
BUSINESS_LINE = {"lines": ["order_id", "item_id", "quantity", "unit_price", "line_discount", "line_total"]}

# Text columns that a keyword search may look into.
SEARCHABLE = {
    "locations": ["city_area"], "outlets": ["outlet_name", "outlet_type"], "categories": ["category_name"], "items": ["item_name", "category_name", "brand"],
    "customers": ["customer_name", "preferred_channel"], "promotions": ["promotion_name"], "orders": ["order_status", "order_channel"], "stock": ["brand", "month"],
}

TABLES = list(DDL)


def typed_columns(name: str, *kinds: str) -> list[str]:
    return [c.split()[0] for c in DDL[name].split(", ") if c.split()[1] in kinds]


def parents_of(name: str) -> list[tuple[str, list[str], str, list[str]]]:
    """(check, child columns, parent, parent columns) of all keys of a table."""
    single = [(f"fk_{key}", [key], parent, [parent_key]) for child, key, parent, parent_key in FOREIGN_KEYS if child == name]
    return single + [(check, columns, parent, parent_columns) for child, check, columns, parent, parent_columns in COMPOSITE_KEYS if child == name]


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[name])
