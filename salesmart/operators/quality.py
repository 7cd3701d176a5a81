"""Profiling and quality checks. Each returns rows (dataset, check, failures).

All predicates of a table are counted in one aggregation. Key and relationship
checks first reduce the child to its distinct key values with counts, so a key
that holds much of the table is one row by the time it is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions import columns as c


def count_failures(df: DataFrame, dataset: str, checks: dict[str, Column]) -> DataFrame:
    """One pass: how many rows satisfy each failure predicate (NULL counts as passing)."""
    sums = df.agg(*[F.count(F.when(p, 1)).alias(n) for n, p in checks.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("failures")) for n in checks])
    return sums.select(F.lit(dataset).alias("dataset"), F.inline(rows))


def _single(df: DataFrame, dataset: str, check: str, failures: Column) -> DataFrame:
    return df.agg(F.coalesce(failures, F.lit(0)).cast("long").alias("failures")).select(
        F.lit(dataset).alias("dataset"), F.lit(check).alias("check"), "failures")


def profile_table(df: DataFrame, dataset: str) -> DataFrame:
    """Rows, columns and missing cells in one aggregation."""
    cells = reduce(lambda a, b: a + b, [F.col(f"`{n}`").isNull().cast("long") for n in df.columns])
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(cells), F.lit(0)).alias("missing_cells")).select(
        F.lit(dataset).alias("dataset"), "rows", F.lit(len(df.columns)).cast("long").alias("columns"), "missing_cells")


def duplicates(df: DataFrame, dataset: str, columns: list[str], check: str) -> DataFrame:
    """Rows beyond the first of each combination of ``columns``."""
    return _single(df.groupBy(*columns).agg(F.count("*").alias("n")), dataset, check, F.sum(F.col("n") - 1))


def check_pk(df: DataFrame, dataset: str, keys: list[str]) -> DataFrame:
    """Null keys, and rows after the first of each key (NULL keys equal each other)."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    sums = groups.agg(
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("pk_null"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("pk_duplicate"))
    rows = F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("failures")) for k in ("pk_null", "pk_duplicate")])
    return sums.select(F.lit(dataset).alias("dataset"), F.inline(rows))


def check_numeric_parse(df: DataFrame, dataset: str, columns: list[str]) -> DataFrame:
    """Present values that are no number."""
    return count_failures(df, dataset, {f"invalid_number_{n}": F.col(n).isNotNull() & F.col(n).try_cast("double").isNull() for n in columns})


def check_date_parse(df: DataFrame, dataset: str, columns: list[str]) -> DataFrame:
    """Present values that are no ISO date."""
    return count_failures(df, dataset, {f"invalid_date_{n}": F.col(n).isNotNull() & F.try_to_date(n, "yyyy-MM-dd").isNull() for n in columns})


def check_negative(df: DataFrame, dataset: str, columns: list[str]) -> DataFrame:
    return count_failures(df, dataset, {f"negative_{n}": F.col(n).cast("string").try_cast("double") < 0 for n in columns})


def outside(column: str, low, high) -> Column:
    """Out of range, where a missing value also counts as outside."""
    return ~F.coalesce(F.col(column).between(low, high), F.lit(False))


def total_mismatch(eps: float = 0.01) -> Column:
    expected = F.col("subtotal") - F.col("discount_amount") + F.col("tax_amount") + F.col("delivery_fee")
    return F.abs(expected - F.col("total_amount")) > eps


def check_fk(child: DataFrame, dataset: str, key: str, parent: DataFrame, parent_key: str, optional: bool = False) -> DataFrame:
    """Rows whose key is unknown to the parent. A NULL key is an orphan unless ``optional``."""
    rows = child.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "") if optional else child
    per_key = rows.groupBy(F.col(key).cast("string").alias("k")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key).cast("string").alias("k"))
    return _single(per_key.join(known, "k", "left_anti"), dataset, f"fk_{key}", F.sum("n"))


def check_fk_consistency(lines: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Lines whose item does not belong to the order's outlet."""
    pairs = lines.select("order_id", "item_id").join(orders.select("order_id", F.col("outlet_id").alias("order_outlet")), "order_id").groupBy(
        "item_id", "order_outlet").agg(F.count("*").alias("n"))
    owned = items.select("item_id", F.col("outlet_id").alias("item_outlet"))
    wrong = pairs.join(owned, "item_id", "left").where(~F.col("item_outlet").eqNullSafe(F.col("order_outlet")))
    return _single(wrong, "lines", "fk_outlet_consistency", F.sum("n"))


def check_owner_match(ratings: DataFrame, orders: DataFrame) -> DataFrame:
    """Ratings whose customer is not the order's customer (or whose order is unknown)."""
    owner = orders.select("order_id", F.col("customer_id").alias("owner"))
    return count_failures(ratings.join(owner, "order_id", "left"), "ratings", {"fk_customer_match": ~F.col("owner").eqNullSafe(F.col("customer_id"))})


def check_pair_membership(ratings: DataFrame, lines: DataFrame) -> DataFrame:
    """Ratings of an item the order does not contain."""
    orphan = ratings.join(lines.select("order_id", "item_id").distinct(), ["order_id", "item_id"], "left_anti")
    return _single(orphan, "ratings", "fk_item_in_order", F.count("*"))


def check_composite_fk(rows: DataFrame, dataset: str, keys: list[str], parent: DataFrame) -> DataFrame:
    """Rows whose key combination the parent does not have."""
    per_key = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    return _single(per_key.join(parent.select(*keys), keys, "left_anti"), dataset, "fk_" + "_".join(keys), F.sum("n"))


def check_promo_active(orders: DataFrame, promotions: DataFrame, date: str = "order_date", check: str = "promo_not_active") -> DataFrame:
    """Promotion orders outside the promotion's outlet or window."""
    p = promotions.select(F.col("promotion_id").cast("string").alias("promotion_id"), F.col("outlet_id").alias("promo_outlet"), "start_date", "end_date")
    used = orders.where("promotion_id <> ''").groupBy("promotion_id", "outlet_id", F.col(date).alias("day")).agg(F.count("*").alias("n"))
    wrong = (F.col("promo_outlet") != F.col("outlet_id")) | ~F.col("day").between(F.col("start_date"), F.col("end_date"))
    return _single(used.join(p, "promotion_id").where(wrong), "orders", check, F.sum("n"))


def quality_report(parts: list[DataFrame]) -> DataFrame:
    """All check rows as one long table."""
    return reduce(DataFrame.unionByName, parts)


def report_summary(report: DataFrame) -> DataFrame:
    """Failures, failing checks and checks per dataset."""
    return report.groupBy("dataset").agg(
        F.count("*").alias("checks"), F.count(F.when(F.col("failures") > 0, 1)).alias("failing_checks"), F.sum("failures").alias("total_failures"))


def summary_pivot(report: DataFrame, checks: list[str]) -> DataFrame:
    """One row per dataset with a column per check (0 where not run)."""
    return report.groupBy("dataset").pivot("check", checks).agg(F.sum("failures")).na.fill(0)
