"""Registered queries: one per operator, with SQL twins where SQL can say the same."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trialbook.plans.bindings import Registry, with_entities
from trialbook.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_MODULES = ["catalog", "joins", "analysis", "columns", "scoring", "flows", "changes", "files"]


def query(name: str, sql: str | None = None, needs: list[str] | None = None):
    """Register ``fn(registry) -> DataFrame`` under ``name``, with its SQL over the named entities."""

    def register(fn: Callable[[Registry], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            return fn(Registry(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_entities(needs or [], sql)
        return fn

    return register


def load() -> None:
    for module in _MODULES:
        importlib.import_module(f"trialbook.queries.{module}")
