"""The register of queries and the SQL each one must agree with."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewright.sources.tables import Tables

_MODULES = [
    "sources", "projections", "joins", "aggregates", "windows", "scalars", "row_changes",
    "history", "cleaning", "layouts", "governance", "streams", "runs",
]
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its name, with SQL that gives the same rows."""

    def register(function: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(Tables(spark, sf_dir))

        name = function.__name__
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        run.__name__, run.__doc__ = name, function.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql.strip()
        return function

    return register


def load() -> None:
    for module in _MODULES:
        importlib.import_module(f"tablewright.plans.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    load()
    return dict(_SQL)
