"""Registered queries (one per operator of the inventory) and their oracle SQL."""

from __future__ import annotations

from hausprep.registry import (  # noqa: F401  (registration side effects)
    io_queries,
    listing_queries,
    plan_queries,
    table_queries,
    token_queries,
)
from hausprep.registry.core import ORACLE, QUERIES, QueryFn


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
