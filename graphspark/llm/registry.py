"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import importlib
import pkgutil

import graphspark.llm as package

_MODULES = [importlib.import_module(f"graphspark.llm.{m.name}") for m in pkgutil.iter_modules(package.__path__) if m.name not in ("registry", "common")]


def _joined(name: str) -> dict:
    found: dict = {}
    for m in _MODULES:
        found |= getattr(m, name, {})
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def queries() -> dict:
    return _joined("QUERIES")


def oracle_sql() -> dict:
    return _joined("ORACLE")
