"""Registered queries that have no SQL: what must hold of their results."""

import pytest
from oracle import DATA
from pyspark.sql import functions as F

from salesmart.operators import models
from salesmart.plans import models as plans
from salesmart.plans.registry import spark_queries

QUERIES = spark_queries()


def rows(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, DATA).collect()]


@pytest.fixture(scope="module")
def trained_on(data):
    """Every frame that a registered query trains on, with its key."""
    return {"order_id": plans.order_split(data), "customer_id": plans.churn_split(data), "item_id": plans.item_split(data)}


def test_no_training_sees_a_held_out_case(spark, monkeypatch):
    seen = []
    real = models.train
    monkeypatch.setattr(models, "train", lambda task, split, *a, **k: seen.append((task, split)) or real(task, split, *a, **k))
    for name in ("model_high_value", "model_churn", "model_item_class", "model_second", "churn_risk", "model_comparison"):
        QUERIES[name](spark, DATA)
    assert len(seen) >= 7
    from salesmart.sources.bindings import Dataset

    held = plans.buyers(Dataset(spark, DATA))
    for task, split in seen:
        assert split.where("side = 'train'").count() > 0
        assert split.join(held.select(task.key).distinct(), task.key, "left_semi").isEmpty()


def test_sides_have_their_share_of_each_class(trained_on):
    for key, label in (("customer_id", "churned"), ("item_id", "business_class")):
        for r in trained_on[key].groupBy(label).agg(F.count("*").alias("n"), F.count_if(F.col("side") == "test").alias("t")).collect():
            assert r["t"] == (r["n"] * 20 + 50) // 100


def test_high_value_threshold_is_that_of_the_training_side(trained_on):
    import numpy as np

    split = trained_on["order_id"]
    amounts = [r[0] for r in split.where("side = 'train'").select("total_amount").collect()]
    assert split.select("threshold").distinct().collect()[0][0] == pytest.approx(np.quantile(amounts, 0.9), rel=1e-12)


@pytest.mark.parametrize("name, task", [("model_high_value", "high_value_order"), ("model_churn", "customer_churn"), ("model_item_class", "item_class"), ("model_second", "customer_churn")])
def test_metrics_are_those_of_a_held_out_side(spark, name, task):
    (r,) = rows(spark, name)
    assert r["task"] == task and r["cases"] > 0 and r["n_train"] > 3 * r["cases"]
    for m in ("accuracy", "macro_f1"):
        assert 0 <= r[m] <= 1
    assert (r["roc_auc"] is None) == (task == "item_class") or 0 <= r["roc_auc"] <= 1


def test_comparison_counts_held_out_cases(spark, data):
    (r,) = rows(spark, "model_comparison")
    held = models.held_out_cases(plans.churn_frame(data), "customer_id", plans.buyers(data)).count()
    assert r["cases"] == held and r["matching_cases"] + r["disagreeing_cases"] == held


def test_class_comparison_explains_disagreement_only(spark):
    for r in rows(spark, "model_class_comparison"):
        assert r["match"] == (r["pred_a"] == r["pred_b"]) and (r["explanation"] == "") == r["match"]


def test_ensemble_is_the_mean_of_its_models(spark):
    for r in rows(spark, "ensemble_score"):
        assert r["probability_ensemble"] == pytest.approx((r["probability_a"] + r["probability_b"]) / 2)
        assert r["ensemble_label"] == int(r["probability_ensemble"] >= 0.5)
    classes = rows(spark, "ensemble_class_score")
    assert classes and all(0 < r["probability"] <= 1 and r["ensemble_class"] for r in classes)


def test_catalogue_has_one_active_version_of_each_task(spark):
    registry, catalog = rows(spark, "model_registry"), rows(spark, "model_catalog")
    assert [(r["version"], r["status"]) for r in sorted(registry, key=lambda r: r["version"])] == [(1, "archived"), (2, "active")]
    assert sorted((r["task"], r["version"], r["status"]) for r in catalog) == [("customer_churn", 1, "active"), ("item_class", 1, "active")]


def test_a_reloaded_model_predicts_the_same(spark):
    assert rows(spark, "model_reload_check") == [{"differences": 0}]


def test_every_active_customer_has_a_risk(spark, data):
    risks = rows(spark, "churn_risk")
    assert len(risks) == len({r["customer_id"] for r in risks}) == plans.behaviour(data).count()
    for r in risks:
        p = r["churn_probability"]
        assert r["churn_risk"] == ("High" if p >= 0.7 else "Medium" if p >= 0.4 else "Low")
