"""Column expressions on texts that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, empty if null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it in a lambda."""
    return F.transform(F.array(value), body)[0]
