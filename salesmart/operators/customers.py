"""Customer analytics: recency, RFM, churn tiers."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions import columns as c
from salesmart.functions.columns import exact_sum
from salesmart.functions.quantiles import with_quantiles
from salesmart.operators.enrich import completed
from salesmart.storage import materialize


def churn_candidates(customers, orders, cutoff: str, days: int = 60) -> DataFrame:
    """Customers whose last order of any status is more than ``days`` before the cutoff."""
    last = orders.groupBy("customer_id").agg(F.max("order_date").alias("last_order_date"), F.count(F.when(c.is_completed(), 1)).alias("total_orders"))
    quiet = last.withColumn("days_since", F.datediff(F.lit(cutoff).cast("date"), "last_order_date")).where(F.col("days_since") > days)
    return customers.select("customer_id", "preferred_channel").join(quiet, "customer_id")


def churn_tiers(candidates: DataFrame) -> DataFrame:
    """Risk tiers and recency buckets in one aggregation."""
    d = F.col("days_since")
    return candidates.agg(
        F.count("*").alias("total"), F.count(F.when(d >= 180, 1)).alias("high"), F.count(F.when((d >= 90) & (d < 180), 1)).alias("medium"),
        F.count(F.when(d < 90, 1)).alias("low"), F.count(F.when(d.isNull(), 1)).alias("unknown"), (F.sum(d) / F.count(d)).alias("avg_days"),
        F.count(F.when(d < 30, 1)).alias("days_0_29"), F.count(F.when((d >= 30) & (d < 90), 1)).alias("days_30_89"),
        F.count(F.when((d >= 90) & (d < 180), 1)).alias("days_90_179"), F.count(F.when(d >= 180, 1)).alias("days_180_up"))


def rfm_frame(orders: DataFrame, cutoff: str) -> DataFrame:
    """Recency, frequency and spend of customers with a completed order."""
    sums = completed(orders).groupBy("customer_id").agg(
        F.max("order_date").alias("last"), F.count("*").cast("double").alias("f_orders"), exact_sum("total_amount").alias("m_spend"))
    return sums.select("customer_id", F.datediff(F.lit(cutoff).cast("date"), "last").cast("long").alias("r_days"), "f_orders", "m_spend")


def quintile_score(value, edges: list, extremes: tuple):
    """1..5 by right-closed quantile buckets; 3 when two edges coincide."""
    bounds = [extremes[0], *edges, extremes[1]]
    collide = bounds[0] == bounds[1]
    for a, b in zip(bounds[1:], bounds[2:]):
        collide = collide | (a == b)
    score = F.lit(1)
    for e in edges:
        score = score + (value > e).cast("int")
    return F.when(collide, 3).otherwise(score).cast("long")


def rfm_scores(frame: DataFrame) -> DataFrame:
    """Quintile scores; recent customers score high."""
    stored = materialize(frame.withColumn("neg_r", -F.col("r_days")), "rfm")
    probs = {"lo": 0.0, "q2": 0.2, "q4": 0.4, "q6": 0.6, "q8": 0.8, "hi": 1.0}
    sources = {"r_score": "neg_r", "f_score": "f_orders", "m_score": "m_spend"}
    q = with_quantiles(stored, [(f"{s}_{n}", s, p) for s in sources.values() for n, p in probs.items()])
    scores = {
        name: quintile_score(F.col(s), [F.col(f"{s}_{n}") for n in ("q2", "q4", "q6", "q8")], (F.col(f"{s}_lo"), F.col(f"{s}_hi")))
        for name, s in sources.items()
    }
    return q.withColumns(scores).select("customer_id", "r_days", "f_orders", "m_spend", *scores)


def rfm_segments(scores: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """KMeans on scaled (-r_score, log orders, log spend); clusters named by their centres."""
    stored = materialize(scores, "rfm-scores")
    x = stored.select("*", (-F.col("r_score")).cast("double").alias("x_r"), F.log1p("f_orders").alias("x_f"), F.log1p("m_spend").alias("x_m"))
    stages = [
        VectorAssembler(inputCols=["x_r", "x_f", "x_m"], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, featuresCol="scaled", predictionCol="cluster"),
    ]
    model = Pipeline(stages=stages).fit(x)
    labels = segment_labels(np.array(model.stages[-1].clusterCenters()))
    label = F.element_at(F.array(*[F.lit(n) for n in labels]), F.col("cluster") + 1)
    return model.transform(x).select(*scores.columns, "cluster", label.alias("segment"))


# The five segment labels, by whether a cluster is recent and frequent.
SEGMENTS = {(True, True): "Loyal Customers", (True, False): "Potential Loyalist", (False, True): "At Risk - High Value", (False, False): "Hibernating"}
BEST_SEGMENT = "Champions"


def segment_labels(centres: np.ndarray) -> list[str]:
    """Label of each cluster from its centre (age of the last order, log orders, log spend).

    A cluster is recent or frequent when it is not behind the median cluster; the most frequent one
    of those that are both stands out.
    """
    recent = centres[:, 0] <= np.median(centres[:, 0])
    frequent = centres[:, 1] >= np.median(centres[:, 1])
    labels = [SEGMENTS[pair] for pair in zip(recent.tolist(), frequent.tolist(), strict=True)]
    both = recent & frequent
    if both.any():
        labels[int(np.where(both, centres[:, 1], -np.inf).argmax())] = BEST_SEGMENT
    return labels
