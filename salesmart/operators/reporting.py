"""Dashboard reads: KPIs, series, rankings, pages, searches and alerts."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions import columns as c
from salesmart.functions.columns import exact_sum
from salesmart.functions.dealing import dealt
from salesmart.functions.ranking import global_rank
from salesmart.operators.enrich import completed
from salesmart.operators.marts import share_of_total
from salesmart.storage import materialize

UNLABELLED = "Unspecified"


def long_rows(df: DataFrame, names: list[str], build) -> DataFrame:
    """One output row per name from a single-row frame."""
    return df.select(F.inline(F.array(*[F.struct(*build(n)) for n in names])))


def kpi_overview(orders: DataFrame, outlets: DataFrame, day: str) -> DataFrame:
    """Revenue, orders, mean order, customers and active areas of a day against the day before."""
    today = F.lit(day).cast("date")
    rows = orders.where(F.col("order_date").between(F.date_sub(today, 1), today)).join(outlets.select("outlet_id", "location_id"), "outlet_id")
    now, done = F.col("order_date") == today, c.is_completed()
    money = lambda p: c.zero(exact_sum(F.when(p, F.col("total_amount"))))
    sums = rows.agg(
        money(now & done).alias("revenue_v"), money(~now & done).alias("revenue_p"),
        F.count(F.when(now, 1)).cast("double").alias("orders_v"), F.count(F.when(~now, 1)).cast("double").alias("orders_p"),
        F.count(F.when(now & done, 1)).alias("done_v"), F.count(F.when(~now & done, 1)).alias("done_p"),
        F.count_distinct(F.when(now, F.col("customer_id"))).cast("double").alias("customers_v"),
        F.count_distinct(F.when(~now, F.col("customer_id"))).cast("double").alias("customers_p"),
        F.count_distinct(F.when(now, F.col("location_id"))).cast("double").alias("locations_active_v"),
        F.count_distinct(F.when(~now, F.col("location_id"))).cast("double").alias("locations_active_p"))
    sums = sums.withColumn("aov_v", c.safe_ratio("revenue_v", "done_v")).withColumn("aov_p", c.safe_ratio("revenue_p", "done_p"))
    return long_rows(sums, ["revenue", "orders", "aov", "customers", "locations_active"], lambda n: [
        F.lit(n).alias("kpi"), F.col(f"{n}_v").alias("value"), F.col(f"{n}_p").alias("prev"), c.trend_percent(f"{n}_v", f"{n}_p").alias("trend_pct")])


def channel_pulse(orders: DataFrame, day: str, k: int = 4) -> DataFrame:
    """Busiest channels of a day with their share of the day's orders."""
    counts = orders.where(F.col("order_date") == F.lit(day).cast("date")).groupBy(
        F.coalesce(c.blank_to_null("order_channel"), F.lit(UNLABELLED)).alias("channel")).agg(F.count("*").alias("orders"))
    return share_of_total(counts, "orders", "share").orderBy(F.desc("orders"), "channel").limit(k)


def order_filter(location_id=None, date_from=None, date_to=None, status=None, channel=None, payment=None) -> Column:
    """Conjunction of the given filters; texts compare without case, dates inclusively."""
    tests = []
    if location_id is not None:
        tests.append(F.col("location_id") == location_id)
    if date_from is not None:
        tests.append(F.col("order_date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        tests.append(F.col("order_date") <= F.lit(date_to).cast("date"))
    for name, wanted in (("order_status", status), ("order_channel", channel), ("payment_method", payment)):
        if wanted:
            tests.append(F.lower(name) == wanted.lower())
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def order_search(text: str, columns: list[str], prefix: str = "ord") -> Column:
    """Literal, case-insensitive text search, or an order reference such as ``ORD-0012``, ``#12``, ``no. 12``, ``12``."""
    wanted = text.strip().lower()
    found = reduce(lambda a, b: a | b, [F.coalesce(F.lower(n).contains(wanted), F.lit(False)) for n in columns])
    # Fixed value: the accepted spellings of an order reference.
    reference = re.fullmatch(rf"(?:{re.escape(prefix)}[-_\s]*|#|no\.?\s*)?0*(\d+)", wanted)
    if reference:
        return found | (F.col("order_id") == int(reference.group(1)))
    if re.search(r"\d", wanted):
        return found | F.col("order_id").cast("string").contains(wanted)
    return found


SORTS = {
    "recent": [F.desc, "order_date", F.desc, "order_hour", F.desc, "order_id"],
    "amount_desc": [F.desc, "total_amount", F.desc, "order_id"],
    "amount_asc": [F.asc, "total_amount", F.asc, "order_id"],
}


def sort_columns(sort: str) -> list[Column]:
    spec = SORTS.get(sort, SORTS["recent"])
    return [direction(name) for direction, name in zip(spec[::2], spec[1::2])]


def orders_page(orders: DataFrame, sort: str = "recent", page: int = 1, size: int = 12) -> DataFrame:
    """One page of any size with totals over the whole filtered set on each row."""
    if page < 1 or size < 1:
        raise ValueError("pages count from 1 and have a row at least")
    stats = orders.agg(F.count("*").alias("total"), F.coalesce(exact_sum(F.when(c.is_completed(), F.col("total_amount"))), F.lit(0.0)).alias("revenue"))
    rows = orders.orderBy(*sort_columns(sort)).offset((page - 1) * size).limit(size)
    full = rows.withColumn("_s", stats.select(F.struct("*")).scalar())
    pages = F.greatest(F.ceil(F.col("_s.total") / size), F.lit(1)).cast("long")
    return full.select(*orders.columns, F.col("_s.total").alias("total"), pages.alias("pages"), F.col("_s.revenue").alias("revenue"))


def order_ref(prefix: str = "ORD") -> Column:
    padded = F.when(F.length(F.col("order_id").cast("string")) < 4, F.lpad(F.col("order_id").cast("string"), 4, "0")).otherwise(F.col("order_id").cast("string"))
    return F.concat(F.lit(f"{prefix}-"), padded)


def order_documents(orders: DataFrame, lines: DataFrame, items: DataFrame) -> DataFrame:
    """All given orders (filtered or not) as documents: items nested, with a short summary of the first two.

    Lines are found by a semi-join and folded per item before they are nested, so a document is
    as long as its order has different items. Both steps work on tasks of a bounded number of rows.
    """
    page, rows = orders, lines.count()
    wanted = lines.join(page.select("order_id"), "order_id", "left_semi").select("order_id", "item_id", "quantity")
    per_item = dealt(wanted, rows, "order_id", "item_id").groupBy("order_id", "item_id").agg(F.sum(F.col("quantity").cast("long")).alias("quantity"))
    entry = F.struct("item_id", "item_name", "quantity")
    named = per_item.join(items.select("item_id", "item_name"), "item_id")
    nested = dealt(named, rows, "order_id").groupBy("order_id").agg(F.sort_array(F.collect_list(entry)).alias("items"))
    shown = F.transform(F.slice("items", 1, 2), lambda x: F.concat(x.quantity.cast("string"), F.lit("x "), x.item_name))
    more = F.when(F.size("items") > 2, F.concat(F.lit(", +"), (F.size("items") - 2).cast("string"), F.lit(" more"))).otherwise("")
    return page.join(nested, "order_id", "left").select(
        "order_id", order_ref().alias("order_ref"), "order_date", "order_status", "total_amount", "items",
        F.when(F.col("items").isNotNull(), F.concat(F.array_join(shown, ", "), more)).alias("item_summary"))


def dish_ranking(lines, orders, items, search: str = "", include_all: bool = False) -> DataFrame:
    """Items ranked by net revenue; ``search`` keeps the rank among all items."""
    o = (orders if include_all else completed(orders)).select("order_id")
    sold = lines.join(o, "order_id").select("item_id", "order_id", "quantity", "net_revenue")
    per_order = dealt(sold, lines.count(), "item_id", "order_id").groupBy("item_id", "order_id").agg(
        exact_sum("quantity").alias("u"), exact_sum("net_revenue").alias("r"))
    sums = per_order.groupBy("item_id").agg(
        exact_sum("u").alias("units"), exact_sum("r").alias("revenue"), F.count("*").alias("orders"))
    named = sums.join(items.select("item_id", "item_name", "category_name", "cost_price"), "item_id")
    contribution = c.on_grid(F.col("revenue") - c.on_grid(F.col("units") * F.col("cost_price")))
    stored = materialize(named.withColumn("contribution", contribution).drop("cost_price"), "dishes")
    ranked = global_rank(stored, "revenue", "item_id")
    if search:
        text = search.lower()
        ranked = ranked.where(F.lower("item_name").contains(text) | F.lower("category_name").contains(text))
    return ranked


def area_ranking(ranking: DataFrame) -> DataFrame:
    """Areas by revenue (a handful of rows, so the window is unpartitioned)."""
    return ranking.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("revenue"), "location_id")).cast("long"))


def revenue_series(orders: DataFrame, day: str) -> DataFrame:
    """Day, 7-day and 30-day revenue against the previous equal window, one scan."""
    end = F.lit(day).cast("date")
    age = F.datediff(end, "order_date")
    rows = completed(orders).where(age.between(0, 59)).select(age.alias("age"), F.col("total_amount").alias("a"))
    spans = {"today": 1, "week": 7, "month": 30}
    aggs = []
    for n, days in spans.items():
        now, before = F.col("age") < days, F.col("age").between(days, 2 * days - 1)
        aggs += [c.zero(exact_sum(F.when(now, F.col("a")))).alias(f"{n}_v"),
                 c.zero(exact_sum(F.when(before, F.col("a")))).alias(f"{n}_p"), F.count(F.when(now, 1)).alias(f"{n}_n")]
    return long_rows(rows.agg(*aggs), list(spans), lambda n: [
        F.lit(n).alias("range"), F.col(f"{n}_v").alias("total"), F.col(f"{n}_p").alias("prev_total"), F.col(f"{n}_n").alias("orders"),
        c.trend_percent(f"{n}_v", f"{n}_p").alias("trend_pct")])


def revenue_hourly(orders: DataFrame, day: str) -> DataFrame:
    """24 rows, zero where nothing was sold."""
    sums = completed(orders).where(F.col("order_date") == F.lit(day).cast("date")).groupBy(F.col("order_hour").cast("long").alias("hour")).agg(
        exact_sum("total_amount").alias("value"), F.count("*").alias("orders"))
    hours = orders.sparkSession.range(24).withColumnRenamed("id", "hour")
    return hours.join(sums, "hour", "left").select("hour", c.zero("value").alias("value"), c.zero_int("orders").alias("orders"))


def revenue_daily(orders: DataFrame, day: str, days: int = 30) -> DataFrame:
    end = F.lit(day).cast("date")
    sums = completed(orders).where(F.datediff(end, "order_date").between(0, days - 1)).groupBy("order_date").agg(
        exact_sum("total_amount").alias("value"), F.count("*").alias("orders"))
    calendar = orders.sparkSession.range(days).select(F.date_sub(end, F.col("id").cast("int")).alias("order_date"))
    return calendar.join(sums, "order_date", "left").select("order_date", c.zero("value").alias("value"), c.zero_int("orders").alias("orders"))


def month_trend(orders: DataFrame) -> DataFrame:
    """Revenue per month against the month before (calendar-sized window)."""
    by_month = completed(orders).groupBy(c.month_start("order_date").alias("month")).agg(exact_sum("total_amount").alias("value"), F.count("*").alias("orders"))
    m = by_month.withColumn("month", c.month_key("month"))
    previous = m.withColumn("prev", F.lag("value").over(Window.orderBy("month")))
    return previous.withColumn("trend_pct", c.trend_percent("value", "prev"))


def filter_values(orders: DataFrame) -> DataFrame:
    """Distinct filter choices, combined before the final (choice-sized) list."""
    pairs = orders.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("filter"), F.col(n).alias("value")) for n in ("order_channel", "payment_method", "order_status")])).alias("p")).select("p.*")
    values = pairs.where("value <> ''").groupBy("filter", "value").agg(F.lit(1).alias("one"))
    return values.groupBy("filter").agg(F.array_join(F.array_sort(F.collect_list("value")), "|").alias("choices"))


def transactions(orders: DataFrame) -> DataFrame:
    """Orders in payment form."""
    method = F.coalesce(c.blank_to_null("payment_method"), F.lit(UNLABELLED))
    status = F.when(c.is_completed(), "Paid").when(c.blank_to_null("order_status").isNotNull(), "Cancelled").otherwise("Unknown")
    return orders.select("order_id", order_ref().alias("order_ref"), F.concat(method, F.lit(" Payment")).alias("type"), method.alias("method"),
                         F.col("total_amount").alias("amount"), F.col("order_date").alias("date"), status.alias("status"))


def meta_summary(orders: DataFrame, ranking: DataFrame) -> DataFrame:
    """Area totals with the date range of all orders."""
    span = orders.agg(F.struct(F.min("order_date").alias("date_min"), F.max("order_date").alias("date_max"))).scalar()
    return ranking.withColumn("_r", span).select(*ranking.columns, "_r.date_min", "_r.date_max")


def item_intelligence(classes: DataFrame, risk: DataFrame) -> DataFrame:
    r = risk.select("item_id", "wastage_cost", "risk_level")
    return classes.select("item_id", "item_name", "units_sold", "revenue", "business_class", "wastage_ratio").join(r, "item_id", "left")


def alerts(effects: DataFrame, candidates: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Threshold alerts over marts; a rule with nothing to report gives no row."""
    rules = [
        ("losing_promotions", "medium", " promotions sell more and earn less", effects.where("promotion_trap")),
        ("quiet_customers", "high", " customers without an order for half a year", candidates.where("days_since >= 180")),
        ("held_back_orders", "low", " orders wait for a correction", quarantined),
    ]
    rows = [df.agg(F.count("*").alias("n")).select(F.lit(i).alias("id"), F.lit(level).alias("level"), "n",
            F.concat(F.col("n").cast("string"), F.lit(title)).alias("title")) for i, level, title, df in rules]
    return reduce(DataFrame.unionByName, rows).where("n > 0")


def order_mix(orders: DataFrame) -> DataFrame:
    """Completed against other and promotion against plain orders, with shares."""
    split = F.explode(F.array(
        F.struct(F.lit("status").alias("mix"), F.when(c.is_completed(), "completed").otherwise("other").alias("part")),
        F.struct(F.lit("promotion").alias("mix"), F.when(F.col("promotion_id") != "", "promotion").otherwise("none").alias("part"))))
    counts = orders.select(split.alias("s")).groupBy("s.mix", "s.part").agg(F.count("*").alias("orders"))
    return counts.withColumn("share", F.col("orders") / F.sum("orders").over(Window.partitionBy("mix")) * 100)


def headline_rollups(classes, ranking, hours_per_day, refunds, anomalies) -> DataFrame:
    """Small roll-ups shown on the landing page: (rollup, name, value)."""

    def rows(df, rollup, name, value):
        return df.select(F.lit(rollup).alias("rollup"), name.cast("string").alias("name"), value.cast("double").alias("value"))

    best = ranking.agg(F.max_by("city_area", "avg_order_value").alias("a"), F.max("avg_order_value").alias("v"))
    per_hour = hours_per_day.groupBy("hour").agg(F.sum("orders").alias("o"))
    totals = refunds.agg(exact_sum("revenue").alias("revenue"), exact_sum("refunds").alias("refunds"))
    top = anomalies.where("z_score is not null").orderBy(F.desc(F.abs("z_score")), "entity", "period").limit(6)
    parts = [
        rows(classes.groupBy("business_class").agg(F.count("*").alias("n")), "items_per_class", F.col("business_class"), F.col("n")),
        rows(best, "best_area_by_order_value", F.col("a"), F.col("v")),
        rows(per_hour, "orders_per_hour", F.col("hour"), F.col("o")),
        rows(totals, "channel_revenue", F.lit("all"), F.col("revenue")), rows(totals, "channel_refunds", F.lit("all"), F.col("refunds")),
        rows(top, "top_anomaly", F.concat_ws("/", "entity", "period"), F.col("z_score")),
    ]
    return reduce(DataFrame.unionByName, parts)
