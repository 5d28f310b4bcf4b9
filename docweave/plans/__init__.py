"""Registered queries (key → Spark builder + DuckDB oracle SQL)."""

from docweave.plans.registry import REGISTRY, Query, register


def load_all() -> dict:
    # Importing the modules registers their queries.
    from docweave.plans import text_queries  # noqa: F401
    from docweave.plans import request_queries  # noqa: F401
    from docweave.plans import reply_queries  # noqa: F401
    from docweave.plans import dedup_queries  # noqa: F401
    from docweave.plans import change_queries  # noqa: F401
    from docweave.plans import extra_queries  # noqa: F401
    return REGISTRY


__all__ = ["REGISTRY", "Query", "register", "load_all"]
