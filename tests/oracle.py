"""Side-by-side run of a named query and its oracle SQL.

``python tests/oracle.py [name ...]`` checks the named (or all) queries at
``$CHECK_SF_DIR`` (default sf0.01) and prints one line each.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cores: str = "8", partitions: str = "8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("salesmart-tests")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(path: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else int(v) if v.is_integer() and abs(v) < 1e15 else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, dict):
        return {k: plain(x) for k, x in v.items()}
    return v


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(df, con, sql):
    """None if equal, else a short description of the difference."""
    mine_cols, mine = normalised(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    their_cols, theirs = normalised([d[0] for d in cur.description], cur.fetchall())
    if mine_cols != their_cols:
        return f"columns {mine_cols} vs {their_cols}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}; mine {mine[:2]} theirs {theirs[:2]}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(c, x, y) for c, x, y in zip(mine_cols, a, b) if x != y]
        return f"{len(bad)} of {len(mine)} rows differ, first: {cells}"
    return None


def main(names):
    from salesmart.plans.registry import oracle_queries, spark_queries

    path = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark, con = session(), connect(path)
    q, sql = spark_queries(), oracle_queries()
    failures = 0
    for name in names or q:
        start = time.time()
        try:
            df = q[name](spark, path)
            if name in sql:
                problem = compare(df, con, sql[name])
                rows = None
            else:
                rows, problem = len(df.collect()), None
        except Exception as e:  # report and go on with the next query
            rows, problem = None, f"{type(e).__name__}: {str(e)[:600]}"
        kind = "oracle" if name in sql else f"rows={rows}"
        if problem is None and rows is None and name in sql:
            rows = df.count() if os.environ.get("CHECK_COUNT") else None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28s} {kind:10s} {time.time() - start:5.1f}s {problem or ''}", flush=True)
        failures += problem is not None
    print(f"{failures} failures of {len(names or q)}")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
