"""Column expressions for hyperparameter maps and typed parameter text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_key(parameters: Column) -> Column:
    """One digest per parameter set, whatever the order of its entries."""
    return F.sha2(F.to_json(F.array_sort(F.map_entries(parameters))), 256)


def empty_map() -> Column:
    return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))


def strip_prefix(parameters: Column, prefix: str) -> Column:
    """Drop a prefix from the keys that carry it."""
    n = len(prefix)
    return F.transform_keys(
        parameters, lambda k, _: F.when(k.startswith(prefix), F.substring(k, n + 1, 1_000_000)).otherwise(k))


def decode_json_text(value: Column) -> Column:
    """A JSON scalar as plain text: quotes off strings, other values as they stand."""
    return F.try_variant_get(F.try_parse_json(value), "$", "string")


def last_segment(name: Column, separator: str) -> Column:
    return F.substring_index(name, separator, -1)


def as_number(value: Column) -> Column:
    """The number a text stands for; anything else is NULL."""
    return value.try_cast("double")


def as_boolean(value: Column) -> Column:
    low = F.lower(F.trim(value))
    return F.when(low == "true", True).when(low == "false", False)


def integer_if_integral(value: Column) -> Column:
    """``3.0`` becomes ``3``, ``3.5`` stays; text in, text out."""
    number = value.try_cast("double")
    whole = number == F.floor(number)
    return F.when(number.isNull(), value).when(whole, F.floor(number).cast("string")).otherwise(number.cast("string"))
