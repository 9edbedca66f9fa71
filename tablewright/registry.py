"""Every query of the consolidation library and the SQL that states it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "r01_duplicate_candidates"
MODULES = ("scalars", "linkage", "consolidation", "profiling", "streams")


def _all() -> dict:
    found: dict = {}
    for name in MODULES:
        found |= importlib.import_module(f"tablewright.plans.{name}").Q
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, (fn, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all().items() if sql}
