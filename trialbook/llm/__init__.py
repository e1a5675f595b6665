"""Operators for building training corpora, their registered queries and SQL twins."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_MODULES = ["quality", "exact_dedup", "packing", "mixing", "minhash", "substring_dedup", "suffix_dedup", "chat", "langid", "toxicity", "token_files", "vector_codes", "hard_negatives"]


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame`` under ``name``, with SQL that gives the same rows."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    for module in _MODULES:
        importlib.import_module(f"trialbook.llm.{module}")
