"""Views of the sample tables in the engine's schemas, and the registered queries with their SQL."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ("daily_queries", "table_queries", "model_queries")


def registry() -> dict:
    """Query name to ``(builder, oracle SQL or None)``."""
    out: dict = {}
    for family in FAMILIES:
        out.update(import_module(f"newstape.checks.{family}").QUERIES)
    return out
