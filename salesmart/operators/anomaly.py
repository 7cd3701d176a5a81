"""Anomaly detection. All detectors return (anomaly_type, entity, period, value, z_score, note)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions import columns as c
from salesmart.functions.quantiles import find_quantiles
from salesmart.operators.enrich import completed

COLUMNS = ["anomaly_type", "entity", "period", "value", "z_score", "note"]


def _rows(df: DataFrame, kind, entity, period, value, z, note) -> DataFrame:
    return df.select(
        (F.lit(kind) if isinstance(kind, str) else kind).alias("anomaly_type"), entity.alias("entity"), period.cast("string").alias("period"),
        value.cast("double").alias("value"), (F.lit(None).cast("double") if z is None else z).alias("z_score"), F.lit(note).alias("note"))


def daily_zscore(orders: DataFrame) -> DataFrame:
    """Daily sales per outlet with their z-score. The window holds one row per day of an outlet."""
    daily = completed(orders).groupBy("outlet_id", "order_date").agg(c.exact_sum("total_amount").alias("sales"))
    own = Window.partitionBy("outlet_id")
    sigma = F.stddev_samp("sales").over(own)
    mean = c.exact_sum_over("sales", own) / F.count("sales").over(own)
    return daily.withColumn("z_score", F.when(sigma > 0, F.round((F.col("sales") - mean) / sigma, 6)))


def anomaly_daily_sales(orders: DataFrame, limit: float = 3.0) -> DataFrame:
    z = daily_zscore(orders).where(F.abs("z_score") > limit)
    return _rows(z, "daily_sales_spike_or_drop", F.concat(F.lit("outlet_"), "outlet_id"), F.col("order_date"), F.col("sales"), F.col("z_score"),
                 "Daily sales more than 3 standard deviations from the outlet mean")


def anomaly_order_total(rows: DataFrame, key: str, value: str, date: str, prefix: str) -> DataFrame:
    """All values above Q3 + 3 IQR. ``rows`` is read several times: pass a table."""
    q = find_quantiles(rows, [("q1", value, 0.25), ("q3", value, 0.75)])
    upper = None if q["q1"] is None else q["q3"] + 3 * (q["q3"] - q["q1"])
    high = rows.where(F.col(value) > F.lit(upper).cast("double"))
    return _rows(high, f"{prefix}_outlier", F.concat(F.lit(f"{prefix}_"), F.col(key)), F.col(date), F.col(value), None, "Value above Q3 + 3 IQR")


def period_of(date: str, period: str) -> Column:
    """``month`` as yyyy-MM, ``day`` as yyyy-MM-dd."""
    return F.date_format(date, {"month": "yyyy-MM", "day": "yyyy-MM-dd"}[period]).alias("period")


def rating_periods(ratings: DataFrame, min_count: int = 10, period: str = "month") -> DataFrame:
    """Per item and period: count, mean and the share of the most frequent score."""
    by_score = ratings.groupBy("item_id", period_of("review_date", period), "rating").agg(F.count("*").alias("n"))
    return by_score.groupBy("item_id", "period").agg(
        F.sum("n").alias("rating_count"), (F.sum(F.col("rating") * F.col("n")) / F.sum("n")).alias("avg_rating"),
        (F.max("n") / F.sum("n")).alias("top_rating_share")).where(F.col("rating_count") >= min_count)


def rating_baseline(ratings: DataFrame) -> DataFrame:
    """Mean and sample deviation of single scores per item, from integer power sums (products of sums as wide decimals)."""
    s = ratings.groupBy("item_id").agg(F.count("rating").alias("n"), F.sum("rating").alias("s1"), F.sum(F.col("rating") * F.col("rating")).alias("s2"))
    n, s1, s2 = (F.col(c).cast("decimal(19,0)") for c in ("n", "s1", "s2"))
    variance = (n * s2 - s1 * s1).cast("double") / (n * (n - 1)).cast("double")
    return s.select("item_id", (F.col("s1") / F.col("n")).alias("mu"), F.when(F.col("n") > 1, F.sqrt(variance)).alias("sigma"))


def _item(prefix: str = "item_"):
    return F.concat(F.lit(prefix), F.col("item_id"))


def anomaly_rating_drift(periods: DataFrame, baseline: DataFrame, limit: float = 2.0) -> DataFrame:
    m = periods.join(baseline, "item_id").where("sigma > 0")
    z = (F.col("avg_rating") - F.col("mu")) / F.col("sigma")
    drift = m.withColumn("z", z).where(F.abs("z") > limit)
    return _rows(drift, F.when(F.col("z") > 0, "rating_spike").otherwise("rating_drop"), _item(), F.col("period"), F.col("avg_rating"), F.col("z"),
                 "Mean rating shifted away from the item baseline")


def anomaly_identical(periods: DataFrame, share: float = 0.90) -> DataFrame:
    same = periods.where(F.col("top_rating_share") >= share)
    return _rows(same, "rating_identical_cluster", _item(), F.col("period"), F.col("top_rating_share"), None, "At least 90% of the ratings share one score")


def anomaly_burst(periods: DataFrame, factor: float = 3.0) -> DataFrame:
    """Rating volume above the item's own Q3 + factor x IQR over periods (few rows per item)."""
    q = periods.groupBy("item_id").agg(F.percentile("rating_count", F.lit(0.25)).alias("q1"), F.percentile("rating_count", F.lit(0.75)).alias("q3"))
    burst = periods.join(q, "item_id").where(F.col("rating_count") > F.col("q3") + factor * (F.col("q3") - F.col("q1")))
    return _rows(burst, "rating_volume_burst", _item(), F.col("period"), F.col("rating_count"), None, "Rating volume far above the item's upper quartile")


def anomaly_mismatch(periods: DataFrame, purchases: DataFrame, slack: float = 1.05, period: str = "month") -> DataFrame:
    """More ratings than purchase orders of the same item and period."""
    bought = purchases.groupBy("item_id", period_of("order_date", period), "order_id").agg(F.lit(1).alias("one")).groupBy(
        "item_id", "period").agg(F.count("*").alias("purchase_orders"))
    m = periods.join(bought, ["item_id", "period"]).where(F.col("rating_count") > F.col("purchase_orders") * slack)
    return _rows(m, "rating_purchase_mismatch", _item(), F.col("period"), F.col("rating_count") / F.col("purchase_orders"), None,
                 "More ratings than completed purchases in the same period")


def anomaly_feed(parts: list[DataFrame]) -> DataFrame:
    """All detectors in one table, with the family the dashboards split on."""
    feed = reduce(DataFrame.unionByName, parts)
    return feed.withColumn("family", F.when(F.col("anomaly_type").startswith("rating"), "rating").otherwise("sales"))
