"""Cleaning with quarantine.

Each rule marks a row with the first reason that applies; the marked frame is
stored once and read as kept rows, quarantined rows and counts, so no row is ever
dropped silently and no rule re-runs the lineage. Tables are cleaned in the order of
their references, each against the kept rows of its parents.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions import columns as c
from salesmart.storage import concurrently, materialize

REASON = "quarantine_reason"


@dataclass
class Split:
    """Marked rows of one table: kept (no reason) and quarantined."""

    dataset: str
    marked: DataFrame
    repeated: int = 0  # equal rows that were made one, and are not in ``marked``

    @property
    def good(self) -> DataFrame:
        return self.marked.where(F.col(REASON).isNull()).drop(REASON)

    @property
    def bad(self) -> DataFrame:
        return self.marked.where(F.col(REASON).isNotNull())


def clean_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """ISO text, unreadable values blank."""
    return df.withColumns({n: F.coalesce(F.date_format(F.try_to_date(n, "yyyy-MM-dd"), "yyyy-MM-dd"), F.lit("")) for n in columns})


def clean_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({n: F.col(n).try_cast("double") for n in columns})


def clean_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Trimmed text, missing values blank (never guessed)."""
    return df.withColumns({n: F.coalesce(F.trim(n), F.lit("")) for n in columns})


def first_by_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds ``is_first``: the row with the lowest ``order`` of its key.

    ``min`` combines before the shuffle and the join back is split by adaptive
    execution when one key dominates, unlike a per-key sort.
    """
    firsts = df.groupBy(*keys).agg(F.min(order).alias("_first"))
    same = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    joined = df.alias("l").join(firsts.alias("r"), same)
    return joined.select("l.*", (F.col(f"l.{order}") == F.col("r._first")).alias("is_first"))


def dedup_keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """First row per key by an explicit order column (unique within the key)."""
    return first_by_key(df, keys, order).where("is_first").drop("is_first")


def mark(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Add the reason of the first rule that holds, NULL when none does."""
    reason = F.lit(None).cast("string")
    for text, predicate in reversed(rules):
        reason = F.when(F.coalesce(predicate, F.lit(False)), text).otherwise(reason)
    return df.withColumn(REASON, reason)


@dataclass(frozen=True)
class Parent:
    """A key that the cleaned rows of another table (or of the same one) must have."""

    reason: str
    columns: tuple[str, ...]
    table: str
    parent_columns: tuple[str, ...]
    optional: bool = False  # a blank key is no key

    def flag(self, df: DataFrame, good: DataFrame, name: str) -> DataFrame:
        """``df`` with ``name``: whether the key is among the rows ``good``. The parent's keys are made distinct first."""
        keys = [F.col(c).alias(f"{name}_{k}") for k, c in enumerate(self.parent_columns)]
        met = good.groupBy(*keys).agg(F.lit(True).alias(name))
        same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"{name}_{k}") for k, c in enumerate(self.columns)])
        return df.join(met, same, "left").drop(*[f"{name}_{k}" for k in range(len(keys))])

    def fails(self, name: str) -> Column:
        unknown = F.col(name).isNull()
        blank = reduce(lambda a, b: a & b, [F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "" for c in self.columns])
        return unknown & ~blank if self.optional else unknown


@dataclass(frozen=True)
class Spec:
    """How a table is cleaned. ``steps`` are parents or (reason, SQL condition); the first one that holds is the reason."""

    key: tuple[str, ...]
    steps: tuple = ()
    order: str | None = None  # with it, later rows of a key are duplicates
    exact_rows: bool = False  # equal rows are one
    dates: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()
    derived: tuple[tuple[str, str], ...] = ()  # (column, SQL) that the binding computes from other columns of the row

    @property
    def parents(self) -> list[Parent]:
        return [s for s in self.steps if isinstance(s, Parent)]


def clean_table(name: str, spec: Spec, raw: DataFrame, good: dict[str, DataFrame]) -> Split:
    """Standardise, de-duplicate and check one table against its cleaned parents.

    A table that refers to itself is checked again until no more rows go: each round takes away the children
    of the rows that went in the round before. Derived columns are neither shuffled nor stored: they are computed again.
    """
    again = {n: F.expr(sql) for n, sql in spec.derived}
    df = (raw.dropDuplicates() if spec.exact_rows else raw).drop(*again)
    df = clean_text(clean_numeric(clean_dates(df, list(spec.dates)), list(spec.numbers)), list(spec.texts))
    rules: list[tuple[str, Column]] = []
    if spec.order:
        df = first_by_key(df, list(spec.key), spec.order)
        rules.append((f"Duplicate {', '.join(spec.key)}", ~F.col("is_first")))
    for k, step in enumerate(spec.steps):
        if not isinstance(step, Parent):
            rules.append((step[0], F.expr(step[1])))
        elif step.table != name:
            df = step.flag(df, good[step.table], f"_known{k}")
            rules.append((step.reason, step.fails(f"_known{k}")))
    stored = [n for n in raw.columns if n not in again]
    marked = materialize(mark(df.withColumns(again) if again else df, rules).select(*stored, REASON), f"clean-{name}")
    marked = marked.withColumns(again).select(*raw.columns, REASON) if again else marked
    removed = raw.count() - marked.count() if spec.exact_rows else 0
    for own in (p for p in spec.parents if p.table == name):
        while True:
            split = Split(name, marked, removed)
            orphans = own.flag(split.good, split.good, "_known").where(own.fails("_known"))
            if orphans.isEmpty():
                break
            gone = orphans.select(*raw.columns, F.lit(own.reason).alias(REASON))
            kept = own.flag(split.good, split.good, "_known").where(~own.fails("_known")).select(*raw.columns, F.lit(None).cast("string").alias(REASON))
            marked = materialize(split.bad.unionByName(gone).unionByName(kept), f"clean-{name}")
    return Split(name, marked, removed)


def clean_tables(frames: dict[str, DataFrame], specs: dict[str, Spec]) -> dict[str, Split]:
    """Clean tables parents first, so that a quarantined row takes its children along over any number of levels.

    Tables whose parents are all done run at the same time. Parents that have no spec are taken from ``frames`` as they are.
    """
    done: dict[str, Split] = {}
    good = {n: df for n, df in frames.items() if n not in specs}
    waiting = [n for n in specs if n in frames]
    while waiting:
        ready = [n for n in waiting if all(p.table in good or p.table == n for p in specs[n].parents)]
        if not ready:
            raise ValueError(f"tables refer to each other in a circle or to unknown ones: {', '.join(waiting)}")
        found = concurrently(**{n: lambda n=n: clean_table(n, specs[n], frames[n], good) for n in ready})
        done |= {n: found[n] for n in ready}
        good |= {n: found[n].good for n in ready}
        waiting = [n for n in waiting if n not in done]
    return done


OF_OUTLET = Parent("Unknown outlet_id", ("outlet_id",), "outlets", ("outlet_id",))
OF_ORDER = Parent("Unknown order_id", ("order_id",), "orders", ("order_id",))
OF_ITEM = Parent("Unknown item_id", ("item_id",), "items", ("item_id",))
OF_BRAND = Parent("Unknown brand", ("brand",), "items", ("brand",))


def specs(start: str, end: str) -> dict[str, Spec]:
    """The twelve tables."""
    return {
        "locations": Spec(("location_id",), exact_rows=True, texts=("city_area",)),
        "categories": Spec(("category_id",), (("Blank category_name", "category_name = ''"),), texts=("category_name",)),
        "outlets": Spec(("outlet_id",), (Parent("Unknown location_id", ("location_id",), "locations", ("location_id",)),), order="copy_no", texts=("outlet_name", "outlet_type")),
        "customers": Spec(("customer_id",), (OF_OUTLET,), order="copy_no", dates=("registration_date",), texts=("customer_name", "preferred_channel")),
        "items": Spec(("item_id",), (
            OF_OUTLET, Parent("Unknown category_name", ("category_name",), "categories", ("category_name",)),
            ("Invalid price or cost", "base_price <= 0 OR cost_price < 0 OR cost_price > base_price"))),
        "promotions": Spec(("promotion_id",), (
            OF_OUTLET, ("Discount outside 0..100", "NOT discount_percentage BETWEEN 0 AND 100"), ("End before start", "end_date < start_date"))),
        "orders": Spec(("order_id",), (
            Parent("Unknown customer_id", ("customer_id",), "customers", ("customer_id",)),
            ("order_date outside analysis period", f"NOT order_date BETWEEN '{start}' AND '{end}'"),
            ("No order key or negative amount", "order_id IS NULL OR total_amount < 0")),
            order="copy_no", dates=("order_date",), numbers=("total_amount",), texts=("order_status", "order_channel")),
        "lines": Spec(("order_id", "line_number"), (
            OF_ORDER, OF_ITEM, ("Invalid quantity, price or total", "quantity <= 0 OR unit_price < 0 OR line_total < 0 OR line_discount < 0"))),
        "ratings": Spec(("rating_id",), (
            OF_ORDER, Parent("Rating customer differs from order customer", ("order_id", "customer_id"), "orders", ("order_id", "customer_id")),
            Parent("Rated item is not in the order", ("order_id", "item_id"), "lines", ("order_id", "item_id")),
            ("Rating outside 1..5", "NOT rating BETWEEN 1 AND 5"))),
        "losses": Spec(("order_id", "line_number"), (
            OF_ITEM, Parent("Item is not the outlet's", ("item_id", "outlet_id"), "items", ("item_id", "outlet_id")),
            Parent("Unknown order line", ("order_id", "line_number"), "lines", ("order_id", "line_number")),
            ("Invalid quantity or cost", "quantity_wasted <= 0 OR estimated_cost < 0"))),
        "stock": Spec(("brand", "month"), (OF_BRAND, ("Negative stock", "closing < 0 OR received < 0 OR sold < 0"), ("Stock does not balance", "closing <> opening + received - sold"))),
        "prices": Spec(("brand", "month"), (OF_BRAND, ("Invalid price", "new_price <= 0 OR old_price <= 0"))),
    }


def clean_all(d, start: str, end: str) -> dict[str, Split]:
    by_table = {n: replace(spec, derived=tuple(d.derived.get(n, {}).items())) for n, spec in specs(start, end).items()}
    return clean_tables(d.raw_tables, by_table)


def retained_blanks(splits: dict[str, Split], by_table: dict[str, Spec]) -> DataFrame:
    """Log rows for text values that stay blank in kept rows: missing ones are never guessed."""
    parts = []
    for n, s in splits.items():
        texts = by_table[n].texts + by_table[n].dates
        if texts:
            sums = s.good.agg(*[F.count_if(F.col(c) == "").alias(c) for c in texts])
            cells = F.array(*[F.struct(F.lit(f"{c} missing").alias("reason"), F.col(c).alias("affected_rows")) for c in texts])
            parts.append(sums.select(F.lit(n).alias("dataset"), F.lit("retained_blank").alias("action"), F.inline(cells)))
    return reduce(DataFrame.unionByName, parts).where("affected_rows > 0").select("dataset", "action", "affected_rows", "reason")


def cleaning_summary(splits: dict[str, Split]) -> DataFrame:
    """Raw, processed and removed rows per table."""
    rows = [s.marked.agg(F.count("*").alias("raw_rows"), F.count(F.when(F.col(REASON).isNull(), 1)).alias("processed_rows")).select(
        F.lit(n).alias("dataset"), (F.col("raw_rows") + s.repeated).alias("raw_rows"), "processed_rows", (F.col("raw_rows") + s.repeated - F.col("processed_rows")).alias("removed_rows"))
        for n, s in splits.items()]
    return reduce(DataFrame.unionByName, rows)


def quarantine_by_reason(splits: dict[str, Split]) -> DataFrame:
    rows = [s.bad.groupBy(REASON).agg(F.count("*").alias("rows")).select(F.lit(n).alias("dataset"), REASON, "rows") for n, s in splits.items()]
    return reduce(DataFrame.unionByName, rows)


def cleaning_log(splits: dict[str, Split], by_table: dict[str, Spec]) -> DataFrame:
    """Log rows (dataset, action, affected_rows, reason): one per reason, the processed count, blanks kept and equal rows made one."""
    moved = quarantine_by_reason(splits).select("dataset", F.lit("quarantined").alias("action"), F.col("rows").alias("affected_rows"), F.col(REASON).alias("reason"))
    kept = cleaning_summary(splits).select("dataset", F.lit("processed").alias("action"), F.col("processed_rows").alias("affected_rows"),
                                           F.lit("Clean records").alias("reason"))
    spark = next(iter(splits.values())).marked.sparkSession
    equal = spark.createDataFrame([(n, "deduplicated", s.repeated, "Equal rows") for n, s in splits.items() if s.repeated], kept.schema)
    return moved.unionByName(kept).unionByName(retained_blanks(splits, by_table)).unionByName(equal)


def quarantine_rows(splits: dict[str, Split], run: str) -> DataFrame:
    """All quarantined rows in one shape: record as JSON, reason, table and run."""
    parts = [s.bad.select(F.to_json(F.struct(*[x for x in s.bad.columns if x != REASON])).alias("record"), REASON,
                          F.lit(n).alias("dataset"), F.lit(run).alias("run")) for n, s in splits.items()]
    return reduce(DataFrame.unionByName, parts)
