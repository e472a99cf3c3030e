"""Named queries over the given tables."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("sources", "rows", "joins", "aggregates", "windows", "functions", "sampling", "jobs")


def load():
    """The registry with every query module registered."""
    for name in _MODULES:
        import_module(f"txlab.queries.{name}")
    return import_module("txlab.queries.registry")
