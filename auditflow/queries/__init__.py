"""Named queries over the driver tables, each with its oracle where SQL can say it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from auditflow.fixtures import Tables, oracle

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}

FAMILIES = [
    "scans", "texts", "extract", "predicates", "joins", "reports",
    "windows", "sets", "scalars", "validators", "stateful", "pipelines",
]


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, its oracle."""
    def register(build: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            _ORACLES[name] = oracle(sql)
        return build

    return register


def load() -> None:
    for family in FAMILIES:
        importlib.import_module(f"auditflow.queries.{family}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    load()
    return dict(_ORACLES)
