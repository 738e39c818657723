"""Collects the registered queries of every plan module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkloom.plans import archives, changes, elements, extras, fields, layouts, lookups, matching, medallion, records, runs, texts

Query = Callable[[SparkSession, str], DataFrame]
MODULES = (medallion, changes, lookups, texts, extras, records, layouts, matching, archives, elements, runs, fields)


def queries() -> dict[str, Query]:
    """Every query of :data:`MODULES`; a name may occur once."""
    found: dict[str, Query] = {}
    for module in MODULES:
        for name, (query, _) in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query registered twice: {name}")
            found[name] = query
    return found


def oracle_sql() -> dict[str, str]:
    """The SQL of the queries that have one."""
    return {name: sql for module in MODULES for name, (_, sql) in module.QUERIES.items() if sql}
