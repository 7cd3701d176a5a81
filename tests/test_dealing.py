"""Steps on the lines work on tasks of a bounded number of rows, whatever the sizes of files and partitions."""

import random
import re
from collections import Counter, defaultdict

import pytest

from salesmart.functions import dealing
from salesmart.operators import reporting


@pytest.fixture
def tables(spark):
    rng = random.Random(5)
    items = [(k, f"{'red' if k % 3 else 'blue'} {k}", "cat", 2.5) for k in range(12)]
    orders = [(k, "2000-01-01", rng.choice(["Completed", " completed ", "Refunded"]), 10.0) for k in range(60)]
    lines = [(rng.choice([None, *range(65)]), rng.choice([None, *range(14)]), float(rng.randint(1, 9)), rng.randint(1, 900) / 4) for _ in range(900)]
    lines += [(7, 3, 1.0, 0.25)] * 300 + lines[:50]
    return (spark.createDataFrame(orders, "order_id long, order_date string, order_status string, total_amount double"), lines,
            spark.createDataFrame(lines, "order_id long, item_id long, quantity double, net_revenue double"),
            spark.createDataFrame(items, "item_id long, item_name string, category_name string, cost_price double"))


def dealt_to(df, keys):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [int(n) for n in re.findall(rf"RepartitionByExpression \[{keys}\], (\d+)", plan)]


def test_order_documents(monkeypatch, tables):
    orders, rows, lines, items = tables
    monkeypatch.setattr(dealing, "TASK_ROWS", 20)
    out = reporting.order_documents(orders, lines, items)
    n = 1 + len(rows) // 20
    assert dealt_to(out, r"order_id#\w+, item_id#\w+") == [n] and dealt_to(out, r"order_id#\w+") == [n]
    wanted = defaultdict(Counter)
    for order, item, quantity, _ in rows:
        if item is not None and item < 12:
            wanted[order][item] += int(quantity)
    got = {r["order_id"]: r["items"] for r in out.collect()}
    assert set(got) == set(range(60))
    assert all([(x["item_id"], x["quantity"]) for x in found or []] == sorted(wanted[order].items()) for order, found in got.items())


def test_dish_ranking(monkeypatch, spark, tables):
    orders, rows, lines, items = tables
    monkeypatch.setattr(dealing, "TASK_ROWS", 20)
    plans, write = [], reporting.materialize
    monkeypatch.setattr(reporting, "materialize", lambda df, label: plans.append(df) or write(df, label))
    got = {r["item_id"]: (r["units"], r["revenue"], r["orders"]) for r in reporting.dish_ranking(lines, orders, items).collect()}
    assert dealt_to(plans[0], r"item_id#\w+, order_id#\w+") == [1 + len(rows) // 20]
    done = {r["order_id"] for r in orders.collect() if r["order_status"].strip().lower() == "completed"}
    sold = [r for r in rows if r[0] in done and r[1] is not None and r[1] < 12]
    assert got == {k: (sum(r[2] for r in sold if r[1] == k), sum(r[3] for r in sold if r[1] == k), len({r[0] for r in sold if r[1] == k})) for k in {r[1] for r in sold}}
