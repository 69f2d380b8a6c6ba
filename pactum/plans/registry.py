"""Registry of named queries and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from pactum.plans.check_sql import CHECK_VIEWS
from pactum.sources import adapter
from pactum.sources.domain import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    check: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, check: str | None = None):
    """Register ``build(tables)`` under ``name``; ``check`` is the same in SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, build, check)
        return build

    return register


def full_check(check: str) -> str:
    """A check with the views it reads put in front as common table expressions."""
    views = {**adapter.SQL, **CHECK_VIEWS, "_check": check}
    names = adapter.ordered(["_check"], views)[:-1]
    if not names:
        return check
    ctes = ", ".join(f"{n} AS MATERIALIZED ({views[n]})" for n in names)
    return f"WITH {ctes} {check}"
