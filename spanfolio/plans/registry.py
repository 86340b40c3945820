"""All named queries and the SQL that each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("panel_queries", "risk_queries", "portfolio_queries", "spectrum_queries", "book_queries")


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        part = getattr(import_module(f"spanfolio.plans.{name}"), attribute)
        clash = merged.keys() & part.keys()
        if clash:
            raise ValueError(f"query defined twice: {sorted(clash)}")
        merged.update(part)
    return merged


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLES")
