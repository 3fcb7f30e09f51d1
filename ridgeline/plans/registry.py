"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Builder, str | None]] = {}
# Queries without a SQL twin and why (the driver then checks rows only).
NO_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, *, no_oracle: str | None = None):
    if sql is None and not no_oracle:
        raise ValueError(f"{name}: give the SQL twin or the reason there is none")

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = (fn, sql)
        if sql is None:
            NO_ORACLE[name] = no_oracle
        return fn

    return deco


def with_ctes(*ctes: str, body: str) -> str:
    """Compose ``WITH a AS (...), b AS (...) body``."""
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body
