"""The queries over the given tables, each with the SQL that checks it (None where SQL cannot)."""

from __future__ import annotations

from importlib import import_module

MODULES = ("records", "relations", "families", "kin", "review", "archive", "village", "doubts", "slips")


def registered() -> dict[str, tuple]:
    """Query name to (function, SQL)."""
    found: dict[str, tuple] = {}
    for module in MODULES:
        found |= import_module(f"kinweave.plans.{module}").QUERIES
    return found
