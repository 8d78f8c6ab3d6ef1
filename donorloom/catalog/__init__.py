"""Registered queries, by module."""

from __future__ import annotations

from importlib import import_module

from donorloom.catalog.base import CATALOG, Query

MODULES = ("q_sources", "q_values", "q_filters", "q_joins", "q_aggregates", "q_windows", "q_dates", "q_codes",
           "q_composites", "q_quality")


def load() -> dict[str, Query]:
    for name in MODULES:
        import_module(f"donorloom.catalog.{name}")
    return CATALOG
