"""The queries of this subpackage."""

from __future__ import annotations

from importlib import import_module

#: Modules that define QUERIES (name -> function) and perhaps SQL (name -> text).
MODULES = ("makers", "ledger", "canonical", "splitting", "mixing", "leakage", "spam", "scans")


def queries() -> dict:
    out: dict = {}
    for m in MODULES:
        out |= import_module(f"weftline.llm.{m}").QUERIES
    return out


def oracle_sql() -> dict:
    out: dict = {}
    for m in MODULES:
        out |= getattr(import_module(f"weftline.llm.{m}"), "SQL", {})
    return out
