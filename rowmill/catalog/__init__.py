"""Registered queries: each reads the given tables and, where SQL can say the
same, carries a hand-written SQL text as an independent check."""

from importlib import import_module

from rowmill.catalog.base import QUERIES, Query

MODULES = (
    "storage", "profiling", "projection", "imputation", "aggregation", "scalars",
    "features", "sampling", "learning", "scoring", "jobs",
)


def all_queries() -> dict[str, Query]:
    for name in MODULES:
        import_module(f"rowmill.catalog.{name}")
    return QUERIES
