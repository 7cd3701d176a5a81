"""Whole queries on skewed tables, as on a cluster: no broadcast joins, skewed partitions
split, distributed quantiles and ranks instead of their small-table forms."""

import duckdb
import oracle
import pytest
from oracle import DATA

from salesmart.functions import quantiles, ranking
from salesmart.plans.registry import oracle_queries, spark_queries

CLUSTER = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
}
QUERIES = """order_item_revenue lines_integrated orders_integrated category_codes customer_analytics customer_value_segment item_business_class
median_quadrant monthly_revenue item_behaviour market_basket promo_effectiveness clean_all check_pair_membership rfm_scores dish_ranking
anomaly_order_total high_value_flag order_features dual_summary ml_metrics recommendations""".split()


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of the lines in one order, a third on one item, a third of the orders of one customer."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    changes = {
        "lineitem": "REPLACE (CASE WHEN hash(l_partkey, l_extendedprice) % 3 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey, "
                    "CASE WHEN hash(l_extendedprice) % 3 = 1 THEN 7 ELSE l_partkey END AS l_partkey)",
        "orders": "REPLACE (CASE WHEN o_orderkey % 3 = 1 THEN 5 ELSE o_custkey END AS o_custkey)",
        "events": "REPLACE (CASE WHEN event_id % 3 = 1 THEN 5 ELSE user_id END AS user_id, CASE WHEN event_id % 3 = 2 THEN 9.99 ELSE value END AS value)",
    }
    for t in oracle.TABLES:
        duckdb.sql(f"COPY (SELECT * {changes.get(t, '')} FROM '{DATA}/{t}.parquet') TO '{folder}/{t}.parquet' (FORMAT parquet)")
    return folder


@pytest.fixture
def cluster(spark, monkeypatch):
    before = {k: spark.conf.get(k, None) for k in CLUSTER}
    for k, v in CLUSTER.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 100)
    monkeypatch.setattr(quantiles.find_quantiles, "__defaults__", (50, 20))
    monkeypatch.setattr(quantiles.exact_quantiles, "__defaults__", (50, 20))
    monkeypatch.setattr(quantiles.with_quantiles, "__defaults__", (50, 20))
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", QUERIES)
def test_skewed_tables_match_sql(spark, cluster, skewed, name):
    problem = oracle.compare(spark_queries()[name](spark, skewed), oracle.connect(skewed), oracle_queries()[name])
    assert problem is None, problem
