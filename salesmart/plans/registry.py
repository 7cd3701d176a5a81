"""Registry of named queries and assembly of their oracle SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from salesmart.sources.bindings import ORACLE_VIEWS, Dataset


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Dataset], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(dataset) -> DataFrame`` under ``name`` with its oracle SQL."""

    def add(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, fn, sql)
        return fn

    return add


def _views_used(text: str, views: dict[str, str]) -> list[str]:
    """Views named after FROM/JOIN/comma in ``text``, dependencies first."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for word in re.findall(r"(?:\bFROM|\bJOIN|,)\s+([a-z_0-9]+)\b", sql, flags=re.IGNORECASE):
            if word in views and word not in ordered:
                visit(views[word])
                if word not in ordered:
                    ordered.append(word)

    visit(text)
    return ordered


EXTRA_VIEWS: dict[str, str] = {}


def shared_view(name: str, sql: str) -> None:
    """Add a named oracle view other oracle queries may select from."""
    EXTRA_VIEWS[name] = sql


def full_sql(sql: str) -> str:
    """Prefix ``sql`` with the canonical views it needs."""
    views = {**ORACLE_VIEWS, **EXTRA_VIEWS}
    used = _views_used(sql, views)
    if not used:
        return sql.strip()
    ctes = ",\n".join(f"{v} AS ({views[v]})" for v in used)
    body = sql.strip()
    if head := re.match(r"WITH(\s+RECURSIVE)?\b", body, flags=re.IGNORECASE):
        return f"{head[0]} {ctes},\n{body[head.end() :].lstrip()}"
    return f"WITH {ctes}\n{body}"


def _load_all() -> None:
    from salesmart.plans import ALL_MODULES  # noqa: F401  (registers on import)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()

    def runner(q: Query):
        return lambda spark, sf_dir: q.build(Dataset(spark, sf_dir))

    return {name: runner(q) for name, q in REGISTRY.items()}


def oracle_queries() -> dict[str, str]:
    _load_all()
    return {name: full_sql(q.sql) for name, q in REGISTRY.items() if q.sql}
