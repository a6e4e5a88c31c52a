"""All registered queries."""

from __future__ import annotations

from revlens.plans import io_queries, ml_queries, scalar_queries, table_queries  # noqa: F401
from revlens.plans.registry import REGISTRY, Query


def catalog() -> dict[str, Query]:
    return dict(REGISTRY)
