"""All core queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rosta.plans import crawl, general, reference

MODULES = (general, reference, crawl)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to query, over all modules."""
    return {name: f for module in MODULES for name, f in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """Name to SQL, over all modules."""
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()} | crawl.DOCUMENT_SQL
