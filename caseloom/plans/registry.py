"""Registry of the named queries and of the SQL that states the same results."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caseloom.plans import fixture

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}  # as written; composed when all expressions are known
CTES: dict[str, str] = {name: fixture.duck_cte(name) for name in fixture.TABLES}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


def compose(sql: str) -> str:
    """Prefix a statement with the common table expressions it names, in dependency order."""
    order: list[str] = []

    def visit(text: str, above: tuple[str, ...]) -> None:
        for name in dict.fromkeys(re.findall(r"[a-z_][a-z_0-9]*", text)):
            if name in CTES and name not in order and name not in above:
                visit(CTES[name], (*above, name))
                order.append(name)

    visit(sql, ())
    if not order:
        return sql
    return "with recursive " + ",\n".join(f"{n} as materialized ({CTES[n]})" for n in order) + "\n" + sql


def query(name: str, oracle: str | None = None):
    """Register a query; oracle is DuckDB SQL over the given tables and the named expressions."""
    def keep(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return keep


def composed() -> dict[str, str]:
    return {name: compose(sql) for name, sql in ORACLES.items()}
