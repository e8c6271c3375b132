"""All core queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "p5_found"
#: Modules that define QUERIES (name -> function) and perhaps SQL (name -> text).
MODULES = ("timestamps", "notices", "corpus", "parts", "concepts", "graph", "vectors", "events", "codes", "scrubbing", "documents", "trust", "exports", "review", "recovery", "pages")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict = {}
    for m in MODULES:
        out |= import_module(f"weftline.plans.{m}").QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict = {}
    for m in MODULES:
        out |= getattr(import_module(f"weftline.plans.{m}"), "SQL", {})
    return out
