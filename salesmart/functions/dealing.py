"""Tasks of a bounded number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows of a task, about.
TASK_ROWS = 500_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, of up to ``rows`` rows, dealt by ``keys`` to tasks of about ``TASK_ROWS`` rows.

    A grouping by the keys (or by more columns) then needs no further shuffle. Without this, it holds a hash
    map of its whole file split before the shuffle, and after it as many rows as fit the advisory partition
    size: several million where keys repeat seldom.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 1 + rows // TASK_ROWS), *keys)
