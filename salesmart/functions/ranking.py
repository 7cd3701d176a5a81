"""Global ranks and running totals without a single-partition window.

Approximate quantiles cut the value range into buckets. Any cut gives an exact
result, because the rows of each bucket are then counted exactly; the cut only
decides how even the work is. A value equal to a cut gets a bucket of its own,
so a value shared by many rows never drags neighbours along, and such a bucket is
split further by the tie-breaking key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows a bucket holds about; the number of buckets follows from the number of rows alone.
BUCKET_ROWS = 2_000_000


def _cuts(df: DataFrame, column: str, buckets: int):
    """Ascending cuts, and the first of every ``step`` of them; null when the column has no value."""
    probs = [i / buckets for i in range(1, buckets)]
    cuts = df.agg(F.array_sort(F.array_distinct(F.percentile_approx(column, probs, max(10_000, 10 * buckets)))).alias("cuts"))
    step = math.isqrt(buckets) + 1
    heads = F.transform(F.sequence(F.lit(0), F.size("cuts") - 1, F.lit(step)), lambda i: F.get("cuts", i))
    return cuts.select(F.struct("cuts", F.when(F.size("cuts") > 0, heads).alias("heads"))).scalar(), step


def _place(cuts: str, step: int, column: str) -> tuple[Column, Column]:
    """How many cuts are below the value, and whether the next one equals it; found in two steps of sqrt(cuts) each."""
    value = F.col(column)
    blocks = F.coalesce(F.size(F.filter(f"{cuts}.heads", lambda x: x < value)), F.lit(0))
    start = F.greatest(blocks - 1, F.lit(0)) * step
    below = start + F.coalesce(F.size(F.filter(F.slice(f"{cuts}.cuts", start + 1, F.lit(step)), lambda x: x < value)), F.lit(0))
    return below, F.coalesce(F.get(f"{cuts}.cuts", below) == value, F.lit(False))


def with_buckets(df: DataFrame, value: str, key: str | None, buckets: int) -> DataFrame:
    """Add ``_b`` and ``_s``: bucket numbers that ascend as ``value`` descends (then ``key`` ascends).

    A null value stands behind all others and a null key before all others, as in a descending
    and an ascending sort. Nulls and values that equal a cut are split further by key.
    """
    cuts, step = _cuts(df, value, buckets)
    out = df.withColumn("_cuts", cuts)
    below, on_cut = _place("_cuts", step, value)
    alone = F.col(value).isNull() | on_cut
    bucket = F.when(F.col(value).isNull(), 1).otherwise(-(below * 2 + on_cut.cast("int")))
    if key is None:
        return out.withColumn("_b", bucket).withColumn("_s", F.lit(0)).drop("_cuts")
    keys, key_step = _cuts(df, key, buckets)
    smaller, _ = _place("_keys", key_step, key)
    split = F.when(alone & F.col(key).isNotNull(), smaller + 1).otherwise(0)
    return out.withColumn("_keys", keys).withColumn("_b", bucket).withColumn("_s", split).drop("_cuts", "_keys")


def running_total(df: DataFrame, value: str, key: str | None, amounts: dict[str, str], buckets: int | None = None) -> DataFrame:
    """Sums of ``amounts`` (new name -> column) over all rows before this one in descending ``value``.

    ``df`` is read several times: pass a stored table, whose rows are counted from its footers.
    """
    order = [F.desc(value)] + ([F.col(key)] if key else [])
    b = with_buckets(df, value, key, buckets or 2 + df.count() // BUCKET_ROWS)
    totals = b.groupBy("_b", "_s").agg(*[F.sum(col).alias(f"_t_{n}") for n, col in amounts.items()])
    before = Window.orderBy("_b", "_s").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket and tie group; Spark decides by its size how to join it.
    offsets = totals.select("_b", "_s", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in amounts])
    inside = Window.partitionBy("_b", "_s").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = b.join(offsets, ["_b", "_s"])
    return joined.select(*df.columns, *[(F.col(f"_o_{n}") + F.coalesce(F.sum(col).over(inside), F.lit(0))).alias(n) for n, col in amounts.items()])


def global_rank(df: DataFrame, value: str, key: str, name: str = "rank", buckets: int | None = None) -> DataFrame:
    """1-based position by descending ``value``, ties by ascending ``key`` (unique)."""
    counted = df.withColumn("_one", F.lit(1))
    ranked = running_total(counted, value, key, {name: "_one"}, buckets)
    return ranked.withColumn(name, (F.col(name) + 1).cast("long")).drop("_one")
