"""Registered queries, grouped by the kind of work they do."""

from __future__ import annotations

from importlib import import_module

from ..registry import CHECK_SQL, QUERIES, Query

MODULES = (
    "scans", "rules", "joins", "aggregates", "windows", "features", "evaluation", "semistructured", "streams",
    "models", "public_features", "rule_lists",
)


def _load() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_check_sql() -> dict[str, str]:
    _load()
    return dict(CHECK_SQL)
