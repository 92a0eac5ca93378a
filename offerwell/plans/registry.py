"""Registry of named queries and of the equivalent SQL used to check them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from offerwell.sources.views import Tables, ansi_views

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``; ``sql`` is the same result for another engine."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = with_views(sql)
        return fn

    return add


def with_views(sql: str) -> str:
    """Prefix the domain views that ``sql`` mentions as common table expressions."""
    body = sql.strip()
    used = {n: v for n, v in ansi_views().items() if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", body)}
    if not used:
        return body
    head = ", ".join(f"{n} AS ({v})" for n, v in used.items())
    if re.match(r"WITH\b", body):
        return f"WITH {head}, {body[4:].lstrip()}"
    return f"WITH {head} {body}"


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, folder: fn(Tables(spark, folder))

    return {name: bind(fn) for name, fn in QUERIES.items()}


def r2(x: str) -> str:
    return f"floor(({x})*100+0.5)/100"


def r4(x: str) -> str:
    return f"floor(({x})*10000+0.5)/10000"


def mean(x: str, where: str = "") -> str:
    """Mean with an exact decimal sum."""
    cond = f" FILTER ({where})" if where else ""
    return f"sum(cast({x} AS DECIMAL(28,4))){cond}::DOUBLE / count({x}){cond}"
