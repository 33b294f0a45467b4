"""All queries of the engine and their DuckDB counterparts."""

from __future__ import annotations

from importlib import import_module

FLAGSHIP = "resolution"
_GROUPS = ("entities", "web", "graph", "text", "parts", "streams", "sources", "assembly")


def _gathered(what: str) -> dict:
    out: dict = {}
    for name in _GROUPS:
        out |= getattr(import_module(f".plans.{name}", __package__), what)
    return out


def queries() -> dict:
    """name -> function of (spark, sf_dir)."""
    return _gathered("QUERIES")


def oracle_sql() -> dict[str, str]:
    """name -> DuckDB SQL with the same rows."""
    return _gathered("SQL")
