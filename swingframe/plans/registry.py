"""Registered queries and the SQL each one must agree with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
RELATIONS: dict[str, str] = {}


def relation(name: str, sql: str) -> None:
    """A named subquery that oracle texts may refer to."""
    RELATIONS[name] = sql.strip()


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return add


def expand(sql: str) -> str:
    """Prefix a text with the named subqueries it needs, in dependency order."""
    order: list[str] = []
    opened: set[str] = set()

    def visit(text: str) -> None:
        for word in re.findall(r"\b\w+\b", text):
            if word in RELATIONS and word not in opened:
                opened.add(word)  # a relation may name itself
                visit(RELATIONS[word])
                order.append(word)

    visit(sql)
    if not order:
        return sql
    recursive = any(re.search(rf"\b{n}\b", RELATIONS[n]) for n in order)
    return f"WITH {'RECURSIVE ' * recursive}" + ",\n".join(f"{n} AS ({RELATIONS[n]})" for n in order) + "\n" + sql


def oracle_texts() -> dict[str, str]:
    return {name: expand(sql) for name, sql in ORACLES.items()}


def dround(expr: str, places: int) -> str:
    """Half-up rounding on the decimal reading of a double, as Spark's round does."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,10)),{places}) AS DOUBLE)"
