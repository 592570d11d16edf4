"""Import every query module and expose the registry."""

from __future__ import annotations

import importlib

from wardflow.plans.catalog import ORACLE, QUERIES

_MODULES = ["q_cleaning", "q_features", "q_evaluation", "q_analytics", "q_ml"]


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"wardflow.plans.{m}")


def queries():
    _load()
    return dict(QUERIES)


def oracle_sql():
    _load()
    return dict(ORACLE)
