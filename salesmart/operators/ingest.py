"""Validated record ingest: contracts, relationships, upsert, guarded delete, audit."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
FLAG_WORDS = ["1", "true", "True", "yes", "on", "0", "false", "False", "no", "off"]


@dataclass(frozen=True)
class Field:
    """Contract of one delivered text field."""

    kind: str  # integer, number, boolean, date, datetime, enum or string
    required: bool = False
    choices: tuple[str, ...] = field(default=())
    low: float | None = None
    high: float | None = None
    max_length: int = 2000


def _bad_value(name: str, f: Field) -> Column:
    """Whether a present value breaks its kind, bounds or length."""
    v = F.col(name).cast("string")
    number = v.try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))
    good = {
        "integer": lambda: v.rlike(INTEGER_TEXT) & v.try_cast("long").isNotNull(),
        "number": lambda: finite,
        "boolean": lambda: v.isin(FLAG_WORDS),
        "date": lambda: F.try_to_date(v, "yyyy-MM-dd").isNotNull(),
        "datetime": lambda: v.try_cast("timestamp").isNotNull(),
        "enum": lambda: v.isin(list(f.choices)),
        "string": lambda: F.length(F.trim(v)) <= f.max_length,
    }[f.kind]()
    bad = ~F.coalesce(good, F.lit(False))
    if f.low is not None:
        bad = bad | F.coalesce(number < f.low, F.lit(True))
    if f.high is not None:
        bad = bad | F.coalesce(number > f.high, F.lit(True))
    return bad


def ingest_validate(batch: DataFrame, contract: dict[str, Field], passthrough: tuple[str, ...] = ()) -> DataFrame:
    """Add ``rejects``: every contract violation of the record, empty when it is accepted."""
    unknown = [n for n in batch.columns if n not in contract and n not in passthrough]
    tests = [F.lit(f"unknown:{n}") for n in unknown]
    tests += [F.lit(f"missing:{n}") for n, f in contract.items() if f.required and n not in batch.columns]
    for n, f in contract.items():
        if n not in batch.columns:
            continue
        blank = F.col(n).isNull() | (F.col(n).cast("string") == "")
        problem = F.when(blank, f"missing:{n}") if f.required else F.when(blank, F.lit(None).cast("string"))
        tests.append(problem.when(_bad_value(n, f), f"invalid:{n}"))
    return batch.withColumn("rejects", F.array_compact(F.array(*tests)))


def relationship_problems(lines, orders, items, promotions, ratings) -> DataFrame:
    """Records that contradict their parents, counted per (entity, problem).

    Children are reduced to the keys a rule needs before each join.
    """
    owned = items.select("item_id", F.col("outlet_id").alias("item_outlet"))
    per_pair = lines.select("order_id", "item_id").join(orders.select("order_id", "outlet_id"), "order_id").groupBy("item_id", "outlet_id").agg(F.count("*").alias("n"))
    foreign = per_pair.join(owned, "item_id").where("item_outlet <> outlet_id").select(F.lit("lines").alias("entity"), F.lit("item of another outlet").alias("problem"), "n")

    p = promotions.select(F.col("promotion_id").cast("string").alias("promotion_id"), F.col("outlet_id").alias("scope"), "start_date", "end_date")
    used = orders.where("promotion_id <> ''").groupBy("promotion_id", "outlet_id", "order_date").agg(F.count("*").alias("n")).join(p, "promotion_id")
    inactive = used.where(~F.col("order_date").between(F.col("start_date"), F.col("end_date"))).select(F.lit("orders"), F.lit("promotion not active"), "n")
    scoped = used.where("scope <> outlet_id").select(F.lit("orders"), F.lit("promotion of another outlet"), "n")

    rated = ratings.join(orders.select("order_id", F.col("customer_id").alias("owner"), "order_date"), "order_id")
    one = F.lit(1).cast("long").alias("n")
    stranger = rated.where("owner <> customer_id").select(F.lit("ratings"), F.lit("customer differs from order"), one)
    early = rated.where("review_date < order_date").select(F.lit("ratings"), F.lit("rated before the order"), one)
    absent = rated.join(lines.select("order_id", "item_id").distinct(), ["order_id", "item_id"], "left_anti").select(F.lit("ratings"), F.lit("item not in the order"), one)
    reversed_ = promotions.where("end_date < start_date").select(F.lit("promotions"), F.lit("end before start"), one)
    found = reduce(DataFrame.union, [foreign, inactive, scoped, stranger, early, absent, reversed_])
    return found.groupBy("entity", "problem").agg(F.sum("n").alias("rows"))


def upsert_snapshot(base: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """New snapshot: batch fields win where present, absent fields keep their value, new keys are added.

    ``batch`` has one row per key and may lack columns of ``base``.
    """
    names = [n for n in base.columns if n != key]
    old = base.withColumn("_known", F.lit(True)).alias("b")
    new = batch.withColumn("_hit", F.lit(True)).alias("u")
    values = [F.coalesce(F.col(f"u.{n}"), F.col(f"b.{n}")).alias(n) if n in batch.columns else F.col(f"b.{n}").alias(n) for n in names]
    action = F.when(F.col("_hit").isNull(), "keep").when(F.col("_known").isNull(), "insert").otherwise("update")
    return old.join(new, key, "full_outer").select(key, *values, action.alias("action"))


def guarded_delete(requested: DataFrame, key: str, references: list[DataFrame]) -> DataFrame:
    """Each requested key with ``deleted`` or, if any child refers to it, ``restricted``."""
    used = reduce(DataFrame.union, [r.select(key) for r in references]).distinct()
    held = requested.join(used, key, "left_semi").withColumn("outcome", F.lit("restricted"))
    free = requested.join(used, key, "left_anti").withColumn("outcome", F.lit("deleted"))
    return held.unionByName(free)


def cascade_delete(children: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Children that remain after their parents were deleted."""
    return children.join(deleted.select(key), key, "left_anti")


def audit_log(entries: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """One row per (action, affected rows, entity): count, status and details as JSON."""
    rows = []
    for action, df, entity in entries:
        n = df.agg(F.count("*").alias("record_count"))
        details = F.to_json(F.create_map(F.lit("entity"), F.lit(entity), F.lit("records"), F.col("record_count").cast("string")))
        rows.append(n.select(F.lit(action).alias("action"), "record_count", F.when(F.col("record_count") > 0, "success").otherwise("empty").alias("status"),
                             details.alias("details")))
    return reduce(DataFrame.unionByName, rows)
