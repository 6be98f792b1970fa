from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.catalog.oracle_views import VIEWS
from tidemark.sources.driver_tables import Warehouse


@dataclass(frozen=True)
class Query:
    build: Callable[[Warehouse], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    """Register ``build(warehouse) -> DataFrame`` under ``key``."""

    def register(build):
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = Query(build, sql)
        return build

    return register


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the definitions of the logical tables it names."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    sql = sql.strip()
    if not needed:
        return sql
    head = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in needed)
    own = re.match(r"WITH\b", sql)
    return f"WITH {head},{sql[own.end():]}" if own else f"WITH {head}\n{sql}"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, sf_dir: build(Warehouse(spark, sf_dir))

    return {key: bind(q.build) for key, q in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {key: with_views(q.sql) for key, q in QUERIES.items() if q.sql is not None}
