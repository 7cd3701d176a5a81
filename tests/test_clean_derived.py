"""Columns that the binding derives are neither shuffled nor stored when a table is cleaned."""

from pyspark.sql import functions as F

from salesmart.operators import cleaning
from salesmart.operators.cleaning import Parent, Spec
from salesmart.sources.bindings import Dataset


def test_derived_columns_are_computed_again(spark, monkeypatch):
    rows = [(1, 2.0, 10.0, 0.1), (1, 4.0, 7.77, 0.07), (2, 3.0, 1.0, None), (None, None, 5.0, 0.3), (9, 7.0, -0.1, 0.3)]
    raw = spark.createDataFrame(rows, "order_id long, quantity double, line_total double, discount double").select(
        "order_id", (F.col("line_total") / F.col("quantity")).alias("unit_price"), "quantity", "line_total", (F.col("line_total") * F.col("discount")).alias("line_discount"),
        (F.col("line_total") - F.col("line_total") * F.col("discount")).alias("net_revenue"))
    orders = spark.createDataFrame([(1,), (2,), (9,)], "order_id long")
    steps = (Parent("Unknown order_id", ("order_id",), "orders", ("order_id",)), ("Invalid price", "unit_price < 0"))
    plain = cleaning.clean_table("lines", Spec(("order_id",), steps), raw, {"orders": orders})
    stored, write = [], cleaning.materialize
    monkeypatch.setattr(cleaning, "materialize", lambda df, label: stored.append(df.columns) or write(df, label))
    split = cleaning.clean_table("lines", Spec(("order_id",), steps, derived=tuple(Dataset.derived["lines"].items())), raw, {"orders": orders})
    assert stored == [["order_id", "quantity", "line_total", "line_discount", cleaning.REASON]]
    assert split.marked.schema == plain.marked.schema
    assert sorted(map(str, split.marked.collect())) == sorted(map(str, plain.marked.collect()))
    assert sorted(r[cleaning.REASON] or "" for r in split.marked.collect()) == ["", "", "", "Invalid price", "Unknown order_id"]


def test_lines_of_the_data_set_are_derived_as_declared(data):
    """To the last bit, nulls included."""
    wrong = [~F.col(n).eqNullSafe(F.expr(sql)) for n, sql in data.derived["lines"].items()]
    assert data.lines.where(wrong[0] | wrong[1]).count() == 0
