"""Registered queries: each operator run over whole tables, with the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

NAMES = (
    "reconcile", "groups", "sequences", "text", "rules", "bulk", "inventory", "ports", "trace", "audits", "sheets",
)


def modules():
    return [import_module(f"hilvan.catalog.{name}") for name in NAMES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for module in modules() for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in modules() for name, sql in module.SQL.items()}
