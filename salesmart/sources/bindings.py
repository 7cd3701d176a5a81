"""Binding of the given tables to the canonical sales entities.

Every entity exists twice, as a DataFrame (``Dataset``) and as the SQL text the
oracle uses (``ORACLE_VIEWS``). Operators only see canonical columns.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesmart.functions.columns import PRICE, exact_avg, exact_sum, month_key, month_start
from salesmart.sources.files import listing, path_exists
from salesmart.storage import write_table

# The analysis window of the bound data and the day dashboards read.
PERIOD_START = "1995-01-01"
PERIOD_END = "2001-08-01"
AS_OF = "2000-06-30"


_SCHEMAS: dict[tuple, StructType] = {}
_DERIVED: dict[tuple, tuple[str, StructType]] = {}


class Dataset:
    """Canonical entities of one data folder, all lazy."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table. Its schema is inferred once per process and state of the folder, not once per query."""
        if name not in self._tables:
            key = (self.state, name)
            reader = self.spark.read
            if key in _SCHEMAS:
                reader = reader.schema(_SCHEMAS[key])
            self._tables[name] = reader.parquet(f"{self.path}/{name}.parquet")
            _SCHEMAS[key] = self._tables[name].schema
        return self._tables[name]

    @cached_property
    def state(self) -> tuple:
        """The folder and what lies in it: what is derived from replaced tables is made anew."""
        return self.path, listing(self.spark, self.path)

    def _stored(self, label: str, df: DataFrame) -> DataFrame:
        """A small derived table, written once per application and state of the data folder."""
        key = (self.spark.sparkContext.applicationId, self.state, label)
        if key not in _DERIVED or not path_exists(self.spark, _DERIVED[key][0]):
            _DERIVED[key] = write_table(df, label), df.schema
        path, schema = _DERIVED[key]
        return self.spark.read.schema(schema).parquet(path)

    @cached_property
    def locations(self) -> DataFrame:
        return self.table("region").select(F.col("r_regionkey").cast("long").alias("location_id"), F.col("r_name").alias("city_area"))

    @cached_property
    def outlets(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("long").alias("outlet_id"),
            F.col("n_name").alias("outlet_name"),
            F.col("n_regionkey").cast("long").alias("location_id"),
            F.concat(F.lit("Type "), (F.col("n_nationkey") % 4).cast("string")).alias("outlet_type"),
        )

    @cached_property
    def categories(self) -> DataFrame:
        # Distinct category names are few by nature; the unpartitioned window sees only them.
        names = self.table("part").select(F.col("p_type").alias("category_name")).distinct()
        return self._stored("categories", names.withColumn("category_id", F.row_number().over(Window.orderBy("category_name")).cast("long")))

    @cached_property
    def items(self) -> DataFrame:
        cents = F.floor(F.col("p_retailprice") * 100 + 0.5)
        return self.table("part").select(
            F.col("p_partkey").alias("item_id"),
            F.col("p_name").alias("item_name"),
            F.col("p_type").alias("category_name"),
            F.col("p_brand").alias("brand"),
            F.pmod(F.col("p_partkey"), F.lit(25)).cast("long").alias("outlet_id"),
            F.col("p_retailprice").alias("base_price"),
            ((cents * (40 + F.col("p_partkey") % 97)).cast("double") / 10000).alias("cost_price"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_nationkey").cast("long").alias("outlet_id"),
            F.col("c_mktsegment").alias("preferred_channel"),
            F.date_add(F.lit(PERIOD_START).cast("date"), (F.col("c_custkey") % 365).cast("int")).alias("registration_date"),
        )

    @cached_property
    def promotions(self) -> DataFrame:
        start = F.date_add(F.lit(PERIOD_START).cast("date"), ((F.col("s_suppkey") * 53) % 2300).cast("int"))
        return self.table("supplier").select(
            F.col("s_suppkey").alias("promotion_id"),
            F.col("s_name").alias("promotion_name"),
            F.col("s_nationkey").cast("long").alias("outlet_id"),
            (5 + (F.col("s_suppkey") % 6) * 5).cast("long").alias("discount_percentage"),
            start.alias("start_date"),
            F.date_add(start, (30 + F.col("s_suppkey") % 60).cast("int")).alias("end_date"),
        )

    def between(self, first: str, last: str) -> "Dataset":
        """The same data limited to orders of a date range; the filter reaches the scan."""
        limited = Dataset(self.spark, self.path)
        limited._range = (first, last)
        return limited

    _range: tuple[str, str] | None = None

    @cached_property
    def orders(self) -> DataFrame:
        """Orders without the columns that need a join."""
        status = F.col("o_orderstatus")
        raw = self.table("orders")
        if self._range:
            first, last = self._range
            raw = raw.where(f"o_orderdate >= timestamp_ntz'{first} 00:00:00' and o_orderdate < timestamp_ntz'{last} 00:00:00' + interval 1 day")
        return raw.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.pmod(F.col("o_orderkey"), F.lit(24)).cast("int").alias("order_hour"),
            F.when(status == "F", "Completed").when(status == "O", "Cancelled").otherwise("Refunded").alias("order_status"),
            (status == "F").alias("is_completed"),
            F.col("o_orderpriority").alias("order_channel"),
            F.col("o_totalprice").alias("total_amount"),
        )

    @cached_property
    def outlet_orders(self) -> DataFrame:
        """Orders with their outlet and payment method (from the customer)."""
        return self.orders.join(
            self.table("customer").select(
                F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").cast("long").alias("outlet_id"), "c_mktsegment"
            ),
            "customer_id",
        ).select(
            *self.orders.columns,
            "outlet_id",
            F.when(F.col("order_id") % 101 == 0, "").otherwise(F.col("c_mktsegment")).alias("payment_method"),
        )

    @cached_property
    def active_promotion(self) -> DataFrame:
        """Lowest promotion id active per outlet and day.

        Stored, since it has at most outlets x calendar days rows however many promotions
        there are: its real size then lets Spark broadcast it and leave the orders in place.
        """
        days = self.promotions.where("start_date <= end_date").select("promotion_id", "outlet_id", F.explode(F.sequence("start_date", "end_date")).alias("order_date"))
        lowest = days.groupBy("outlet_id", "order_date").agg(F.min("promotion_id").alias("active_id"))
        percent = self.promotions.select(F.col("promotion_id").alias("active_id"), F.col("discount_percentage").alias("active_pct"))
        return self._stored("active-promotions", lowest.join(percent, "active_id"))

    @cached_property
    def promo_orders(self) -> DataFrame:
        """Full order rows: outlet, payment, promotion and money columns."""
        o = self.outlet_orders
        on_promo = (F.col("order_id") % 4 == 0) & F.col("active_id").isNotNull()
        cents = F.floor(F.col("total_amount") * 100 + 0.5)
        out = o.join(self.active_promotion, ["outlet_id", "order_date"], "left").select(
            *o.columns,
            F.when(on_promo, F.col("active_id").cast("string")).otherwise("").alias("promotion_id"),
            F.when(on_promo, (cents * F.col("active_pct")).cast("double") / 10000).otherwise(0.0).alias("discount_amount"),
            ((cents * 5).cast("double") / 10000).alias("tax_amount"),
            F.when(F.col("order_channel") == "1-URGENT", 3.0).otherwise(0.0).alias("delivery_fee"),
        )
        planted = F.when(F.col("order_id") % 103 == 0, 1.0).otherwise(0.0)
        return out.withColumn(
            "subtotal", F.col("total_amount") + F.col("discount_amount") - F.col("tax_amount") - F.col("delivery_fee") + planted
        )

    @cached_property
    def lines(self) -> DataFrame:
        price, disc = F.col("l_extendedprice"), F.col("l_discount")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").cast("long").alias("line_number"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_quantity").cast("double").alias("quantity"),
            (price / F.col("l_quantity")).alias("unit_price"),
            price.alias("line_total"),
            (price * disc).alias("line_discount"),
            (price - price * disc).alias("net_revenue"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
        )

    @cached_property
    def losses(self) -> DataFrame:
        """Wastage: returned lines with their cost."""
        returned = self.lines.where(F.col("flag") == "R").select("order_id", "line_number", "item_id", "quantity", "ship_date")
        item = self.items.select("item_id", "item_name", "category_name", "outlet_id", "cost_price")
        return returned.join(item, "item_id").select(
            "order_id", "line_number", "item_id", "item_name", "category_name", "outlet_id",
            F.col("quantity").alias("quantity_wasted"),
            (F.col("quantity") * F.col("cost_price")).alias("estimated_cost"),
            F.col("ship_date").alias("loss_date"),
        )

    @cached_property
    def stock(self) -> DataFrame:
        """Inventory by brand and month."""
        moved = self.lines.select("item_id", "quantity", "flag", month_start("ship_date").alias("month"))
        quantity = lambda flag: exact_sum(F.when(F.col("flag") == flag, F.col("quantity")).otherwise(0.0))
        return (
            moved.join(self.items.select("item_id", "brand"), "item_id")
            .groupBy("brand", "month").agg(quantity("N").alias("received"), quantity("A").alias("sold"))
            .select("brand", month_key("month").alias("month"), F.lit(100.0).alias("opening"), "received", "sold",
                    (100.0 + F.col("received") - F.col("sold")).alias("closing"), F.lit(100.0).alias("reorder_level"))
        )

    @cached_property
    def prices(self) -> DataFrame:
        """Mean unit price by brand and month with the previous month's price."""
        sold = self.lines.select("item_id", "unit_price", month_start("ship_date").alias("month")).join(self.items.select("item_id", "brand"), "item_id")
        monthly = sold.groupBy("brand", "month").agg(exact_avg("unit_price", PRICE).alias("new_price"))
        by_brand = Window.partitionBy("brand").orderBy("month")
        return monthly.select("brand", month_key("month").alias("month"), "new_price", F.lag("new_price").over(by_brand).alias("old_price"))

    @cached_property
    def ratings(self) -> DataFrame:
        return self.table("events").where(F.col("event_type") == "view").select(
            F.col("event_id").alias("rating_id"),
            F.col("event_id").alias("order_id"),
            F.col("user_id").alias("customer_id"),
            (F.col("user_id") % 25).alias("item_id"),
            F.least(F.lit(5), 1 + F.floor(F.col("value") / 25)).cast("long").alias("rating"),
            F.col("ts").cast("date").alias("review_date"),
        )

    @cached_property
    def purchases(self) -> DataFrame:
        return self.table("events").where(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("order_id"), (F.col("user_id") % 25).alias("item_id"), F.col("ts").cast("date").alias("order_date")
        )

    @cached_property
    def dirty_locations(self) -> DataFrame:
        """Locations with an equal row."""
        return self.locations.unionByName(self.locations.where("location_id = 1"))

    @cached_property
    def dirty_outlets(self) -> DataFrame:
        """Outlets with a repeated key, padded names and one outlet at an unknown location."""
        key = F.col("outlet_id")
        copies = F.when(key == 7, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return self.outlets.withColumn("copy_no", F.explode(copies)).select(
            "outlet_id", F.when(key % 5 == 0, F.concat(F.lit("  "), "outlet_name", F.lit(" "))).otherwise(F.col("outlet_name")).alias("outlet_name"),
            F.when(key == 12, 99).otherwise(F.col("location_id")).cast("long").alias("location_id"), "outlet_type", F.col("copy_no").cast("long").alias("copy_no"))

    @cached_property
    def dirty_customers(self) -> DataFrame:
        """Customers with repeated keys, unreadable dates and missing texts."""
        key = F.col("customer_id")
        copies = F.when(key % 59 == 0, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return self.customers.withColumn("copy_no", F.explode(copies)).select(
            "customer_id", F.when(key % 37 == 0, F.lit(None)).otherwise(F.concat(F.lit(" "), "customer_name")).alias("customer_name"), "outlet_id",
            F.when(key % 41 == 0, F.lit(" ")).otherwise(F.col("preferred_channel")).alias("preferred_channel"),
            F.when(key % 43 == 0, "not-a-date").otherwise(F.date_format("registration_date", "yyyy-MM-dd")).alias("registration_date"),
            F.col("copy_no").cast("long").alias("copy_no"))

    #: Columns of a delivered table that the binding computes from others of the same row, to the last bit.
    derived = {"lines": {"unit_price": "line_total / quantity", "net_revenue": "line_total - line_discount"}}

    @property
    def raw_tables(self) -> dict[str, DataFrame]:
        """The twelve tables as they are delivered."""
        return {
            "locations": self.dirty_locations, "outlets": self.dirty_outlets, "categories": self.categories, "items": self.items, "customers": self.dirty_customers,
            "promotions": self.promotions, "orders": self.dirty_orders, "lines": self.lines, "ratings": self.ratings, "losses": self.losses, "stock": self.stock, "prices": self.prices,
        }

    @cached_property
    def dirty_orders(self) -> DataFrame:
        """Orders as untyped text with planted defects, for the quality and cleaning operators."""
        key = F.col("o_orderkey")
        copies = F.when(key % 79 == 0, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        source = self.table("orders").withColumn("copy_no", F.explode(copies))
        return source.select(
            key.alias("order_id"),
            F.when(key % 89 == 0, F.col("o_custkey") + 10_000_000).otherwise(F.col("o_custkey")).alias("customer_id"),
            F.when(key % 83 == 0, "1990-01-01").when(key % 61 == 0, "not-a-date")
            .otherwise(F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")).alias("order_date"),
            F.when(key % 7 == 0, "  completed ").otherwise("Completed").alias("order_status"),
            F.when(key % 97 == 0, "-5.0").when(key % 71 == 0, "abc")
            .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("total_amount"),
            F.when(key % 101 == 0, F.lit(None)).otherwise(F.concat(F.lit(" "), F.col("o_orderpriority"))).alias("order_channel"),
            F.col("copy_no").cast("long").alias("copy_no"),
        )


ORACLE_VIEWS = {
    "loc": "SELECT r_regionkey::BIGINT AS location_id, r_name AS city_area FROM region",
    "outlet": """SELECT n_nationkey::BIGINT AS outlet_id, n_name AS outlet_name, n_regionkey::BIGINT AS location_id,
        'Type ' || (n_nationkey % 4)::VARCHAR AS outlet_type FROM nation""",
    "cat": """SELECT category_name, row_number() OVER (ORDER BY category_name)::BIGINT AS category_id
        FROM (SELECT DISTINCT p_type AS category_name FROM part)""",
    "item": """SELECT p_partkey AS item_id, p_name AS item_name, p_type AS category_name, p_brand AS brand,
        (p_partkey % 25)::BIGINT AS outlet_id, p_retailprice AS base_price,
        (floor(p_retailprice * 100 + 0.5)::BIGINT * (40 + p_partkey % 97))::DOUBLE / 10000 AS cost_price FROM part""",
    "cust": """SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey::BIGINT AS outlet_id,
        c_mktsegment AS preferred_channel, (DATE '1995-01-01' + (c_custkey % 365)::INT)::DATE AS registration_date FROM customer""",
    "promo": """SELECT s_suppkey AS promotion_id, s_name AS promotion_name, s_nationkey::BIGINT AS outlet_id,
        (5 + (s_suppkey % 6) * 5)::BIGINT AS discount_percentage,
        (DATE '1995-01-01' + ((s_suppkey * 53) % 2300)::INT)::DATE AS start_date,
        (DATE '1995-01-01' + ((s_suppkey * 53) % 2300 + 30 + s_suppkey % 60)::INT)::DATE AS end_date FROM supplier""",
    "ord": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate::DATE AS order_date,
        (o_orderkey % 24)::INT AS order_hour,
        CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Cancelled' ELSE 'Refunded' END AS order_status, o_orderstatus = 'F' AS is_completed,
        o_orderpriority AS order_channel, o_totalprice AS total_amount, c_nationkey::BIGINT AS outlet_id,
        CASE WHEN o_orderkey % 101 = 0 THEN '' ELSE c_mktsegment END AS payment_method
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "done": "SELECT * FROM ord WHERE upper(trim(order_status)) = 'COMPLETED'",
    "ordp0": """SELECT o.*, CASE WHEN o.order_id % 4 = 0 THEN (SELECT min(p.promotion_id) FROM promo p
        WHERE p.outlet_id = o.outlet_id AND o.order_date BETWEEN p.start_date AND p.end_date) END AS pid FROM ord o""",
    "ordp": """SELECT t.* EXCLUDE (pid, pct), coalesce(pid::VARCHAR, '') AS promotion_id, discount_amount_ AS discount_amount,
        tax_ AS tax_amount, fee_ AS delivery_fee,
        total_amount + discount_amount_ - tax_ - fee_ + (CASE WHEN order_id % 103 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS subtotal
        FROM (SELECT o.*, p.discount_percentage AS pct,
          CASE WHEN pid IS NOT NULL THEN (floor(total_amount * 100 + 0.5)::BIGINT * p.discount_percentage)::DOUBLE / 10000 ELSE 0.0::DOUBLE END AS discount_amount_,
          (floor(total_amount * 100 + 0.5)::BIGINT * 5)::DOUBLE / 10000 AS tax_,
          CASE WHEN order_channel = '1-URGENT' THEN 3.0::DOUBLE ELSE 0.0::DOUBLE END AS fee_
          FROM ordp0 o LEFT JOIN promo p ON o.pid = p.promotion_id) t""",
    "donep": "SELECT * FROM ordp WHERE upper(trim(order_status)) = 'COMPLETED'",
    "line": """SELECT l_orderkey AS order_id, l_linenumber::BIGINT AS line_number, l_partkey AS item_id, l_quantity::DOUBLE AS quantity,
        l_extendedprice / l_quantity AS unit_price, l_extendedprice AS line_total, l_extendedprice * l_discount AS line_discount,
        l_extendedprice - l_extendedprice * l_discount AS net_revenue, l_returnflag AS flag, l_shipdate::DATE AS ship_date FROM lineitem""",
    "dline": """SELECT l.*, d.customer_id, d.outlet_id, d.order_date FROM line l JOIN done d ON l.order_id = d.order_id""",
    "loss": """SELECT l.order_id, l.line_number, l.item_id, i.item_name, i.category_name, i.outlet_id, l.quantity AS quantity_wasted,
        l.quantity * i.cost_price AS estimated_cost, l.ship_date AS loss_date FROM line l JOIN item i ON l.item_id = i.item_id WHERE l.flag = 'R'""",
    "stock": """SELECT brand, month, 100.0::DOUBLE AS opening, received, sold, 100.0::DOUBLE + received - sold AS closing, 100.0::DOUBLE AS reorder_level
        FROM (SELECT i.brand, strftime(l.ship_date, '%Y-%m') AS month,
          sum(CASE WHEN flag = 'N' THEN quantity ELSE 0 END) AS received, sum(CASE WHEN flag = 'A' THEN quantity ELSE 0 END) AS sold
          FROM line l JOIN item i ON l.item_id = i.item_id GROUP BY 1, 2)""",
    "price": """SELECT *, lag(new_price) OVER (PARTITION BY brand ORDER BY month) AS old_price FROM (
        SELECT i.brand, strftime(l.ship_date, '%Y-%m') AS month, sum(unit_price::DECIMAL(18,7))::DOUBLE / count(*) AS new_price
          FROM line l JOIN item i ON l.item_id = i.item_id GROUP BY 1, 2)""",
    "rating": """SELECT event_id AS rating_id, event_id AS order_id, user_id AS customer_id, user_id % 25 AS item_id,
        least(5, 1 + floor(value / 25))::BIGINT AS rating, ts::DATE AS review_date FROM events WHERE event_type = 'view'""",
    "purchase": """SELECT event_id AS order_id, user_id % 25 AS item_id, ts::DATE AS order_date FROM events WHERE event_type = 'purchase'""",
    "dirtyl": "SELECT * FROM loc UNION ALL SELECT * FROM loc WHERE location_id = 1",
    "dirtyo": """SELECT outlet_id, CASE WHEN outlet_id % 5 = 0 THEN '  ' || outlet_name || ' ' ELSE outlet_name END AS outlet_name,
        CASE WHEN outlet_id = 12 THEN 99 ELSE location_id END::BIGINT AS location_id, outlet_type, c.copy_no
        FROM outlet, (SELECT unnest([0, 1])::BIGINT AS copy_no) c WHERE c.copy_no = 0 OR outlet_id = 7""",
    "dirtyc": """SELECT customer_id, CASE WHEN customer_id % 37 = 0 THEN NULL ELSE ' ' || customer_name END AS customer_name, outlet_id,
        CASE WHEN customer_id % 41 = 0 THEN ' ' ELSE preferred_channel END AS preferred_channel,
        CASE WHEN customer_id % 43 = 0 THEN 'not-a-date' ELSE strftime(registration_date, '%Y-%m-%d') END AS registration_date, c.copy_no
        FROM cust, (SELECT unnest([0, 1])::BIGINT AS copy_no) c WHERE c.copy_no = 0 OR customer_id % 59 = 0""",
    "dirty": """SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 89 = 0 THEN o_custkey + 10000000 ELSE o_custkey END AS customer_id,
        CASE WHEN o_orderkey % 83 = 0 THEN '1990-01-01' WHEN o_orderkey % 61 = 0 THEN 'not-a-date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
        CASE WHEN o_orderkey % 7 = 0 THEN '  completed ' ELSE 'Completed' END AS order_status,
        CASE WHEN o_orderkey % 97 = 0 THEN '-5.0' WHEN o_orderkey % 71 = 0 THEN 'abc' ELSE (o_totalprice::DECIMAL(18,2))::VARCHAR END AS total_amount,
        CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE ' ' || o_orderpriority END AS order_channel, c.copy_no
        FROM orders, (SELECT unnest([0, 1])::BIGINT AS copy_no) c WHERE c.copy_no = 0 OR o_orderkey % 79 = 0""",
}
