"""Registered queries and their SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortwise.checks.sql_parts import PARTS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_WORD = re.compile(r"\b(?:FROM|JOIN)\s+(\w+)")


def with_parts(text: str) -> str:
    """Put the shared SQL parts that a text names in front of it, dependencies first."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in _WORD.findall(sql):
            if name in PARTS and name not in order and name not in stack:
                stack.add(name)
                visit(PARTS[name])
                order.append(name)

    stack: set[str] = set()
    visit(text)
    if not order:
        return text
    head = "WITH " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in order)
    own = text.lstrip()
    return head + (",\n" + own[len("WITH "):] if own.startswith("WITH ") else "\n" + text)


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = with_parts(sql)
        return fn
    return register
