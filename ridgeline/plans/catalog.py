"""All registered queries. Importing this module registers every plan."""

from __future__ import annotations

from ridgeline.plans import (  # noqa: F401
    analysis_queries,
    chart_queries,
    genre_queries,
    publish_queries,
    text_queries,
)
from ridgeline.plans.registry import NO_ORACLE, REGISTRY


def queries():
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}


def no_oracle():
    """Queries without a SQL twin, with the reason."""
    return dict(NO_ORACLE)
