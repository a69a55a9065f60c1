"""Check queries of all operators."""

from __future__ import annotations

import importlib

from streetgrain.catalog.base import CHECK_SQL, QUERIES

MODULES = ["spatial", "conform", "ledger", "scalars", "sources", "coverage", "products", "stream"]


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"streetgrain.catalog.{module}")


def queries():
    _load()
    return dict(QUERIES)


def check_sql():
    _load()
    return dict(CHECK_SQL)
