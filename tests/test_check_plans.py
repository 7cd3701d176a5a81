"""What the checks of a whole data set cost, and keys of all kinds that they must tell apart."""

import itertools

from pyspark.sql import functions as F
from test_scans import line_scans

from salesmart.operators import checks
from salesmart.plans.registry import REGISTRY


def failures(df):
    return {r["check"]: r["failures"] for r in df.collect()}


def test_derived_tables_are_built_once(spark, monkeypatch):
    """Three checks read the lines; losses, stock and prices do once each, and ratings and losses meet the lines as parents."""
    assert line_scans(spark, monkeypatch, REGISTRY["quality_checks"].build) <= 8


def test_references_meet_in_one_grouping(spark):
    child = spark.range(20).select(F.col("id").alias("a"), F.col("id").cast("string").alias("b"))
    refs = [("fk_a", ["a"], spark.range(10), ["id"]), ("fk_b", ["b"], spark.range(15), ["id"]), ("fk_pair", ["a", "b"], child.limit(5), ["a", "b"])]
    plan = checks.check_references(child, "child", refs)
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert failures(plan) == {"fk_a": 10, "fk_b": 5, "fk_pair": 15}


def test_nulls_and_neighbouring_texts_are_told_apart(spark):
    cells = list(itertools.product([None, 0, 1, 2], [None, 0, 1], [None, "", "a", "ab"], [None, "", "b", "ab"], [0.0, 0.5, None]))
    df = spark.createDataFrame(cells * 2, "i long, j int, s string, t string, x double")
    sets = {"one": ["i"], "two": ["i", "j"], "texts": ["s", "t"], "mixed": ["j", "s"], "all": df.columns}
    at = {n: k for k, n in enumerate(df.columns)}
    wanted = {n: 2 * len(cells) - len({tuple(r[at[c]] for c in columns) for r in cells}) for n, columns in sets.items()}
    assert failures(checks.check_unique(df, "d", sets)) == wanted
    parent = spark.createDataFrame([(1, 1, "a", "b"), (0, None, "", ""), (0, 1, "ab", "")], "i long, j int, s string, t string")
    got = failures(checks.check_references(df, "d", [("two", ["i", "j"], parent, ["i", "j"]), ("texts", ["s", "t"], parent, ["s", "t"])]))
    both = {"two": {(1, 1), (0, 1)}, "texts": {("a", "b"), ("", ""), ("ab", "")}}
    assert got == {n: sum(tuple(r[at[c]] for c in sets[n]) not in both[n] for r in cells * 2) for n in both}


def test_numbers_are_not_read_from_text(spark):
    df = spark.createDataFrame([(1, -1.0, "x"), (2, float("nan"), "-2"), (3, None, " ")], "order_id long, total_amount double, customer_id string")
    rules = checks.row_rules("orders", df.columns, "1995-01-01", "2001-08-01", checks.numeric(df))
    got = failures(checks.check_rows(df, "orders", rules))
    assert (got["negative_total_amount"], got["invalid_number_total_amount"], got["invalid_number_customer_id"]) == (1, 0, 1)
    assert rules["invalid_number_total_amount"]._jc.toString() == "false"
