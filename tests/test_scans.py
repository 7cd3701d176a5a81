"""How often a query reads the line table, stored steps included."""

import pytest
from oracle import DATA

from salesmart import storage
from salesmart.plans import analytics, models
from salesmart.sources.bindings import Dataset


def line_scans(spark, monkeypatch, build):
    plans, write = [], storage.write_table

    def recorded(df, label):
        plans.append(df)
        return write(df, label)

    d = Dataset(spark, DATA)
    for name in ("categories", "active_promotion"):
        getattr(d, name)  # derived tables of the data folder, stored once
    monkeypatch.setattr(storage, "write_table", recorded)
    plans.append(build(d))
    return sum(df._jdf.queryExecution().executedPlan().toString().count("/lineitem.parquet]") for df in plans)


@pytest.mark.parametrize("build, most", [(models.order_frame, 1), (models.churn_frame, 1), (lambda d: analytics.items.item_sales(d.lines, d.promo_orders), 1), (analytics.item_frame, 2)])
def test_lines_are_read_once(spark, monkeypatch, build, most):
    """The item frame reads them a second time, for the losses that are bound to returned lines."""
    assert 1 <= line_scans(spark, monkeypatch, build) <= most
