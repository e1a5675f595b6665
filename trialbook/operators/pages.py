"""Late pages: an index of exact row counts per slice of an order.

Rows are cut into slices of the order, and the index holds each slice's number of rows, first key and last key. A page adds
up counts to find the slices that hold it, reads the rows between their keys, and sorts only these. The index needs
the order's columns alone. Its size is the number of slices, whatever the number of rows, so it is held by the driver.

``write_pages`` also writes the rows in the same slices: then a page reads the files of its slices and no others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A column by name or as an expression, ascending with NULLs first, or ("name", "desc") with NULLs last.
By = str | Column | tuple[str, str]


def _value(by: By) -> Column:
    return F.col(by[0]) if isinstance(by, tuple) else F.col(by) if isinstance(by, str) else by


def _falls(by: By) -> bool:
    return isinstance(by, tuple) and by[1] == "desc"


def sort_columns(order: Sequence[By]) -> list[Column]:
    return [_value(by).desc() if _falls(by) else _value(by).asc() for by in order]


def _not_before(order: Sequence[By], key: Sequence[Any], later: bool) -> Column:
    """Rows at a key, and those after it (``later``) or before it, in the order."""
    value, falls = _value(order[0]), _falls(order[0])
    if key[0] is None:
        # NULLs are the first rows, or the last ones where the order falls.
        beyond = value.isNotNull() if later != falls else F.lit(False)
    elif later != falls:
        beyond = value > F.lit(key[0])
    else:
        beyond = value < F.lit(key[0])
    if key[0] is not None and later == falls:
        beyond = beyond | value.isNull()
    here = value.eqNullSafe(F.lit(key[0])) if key[0] is not None else value.isNull()
    return beyond | (here & (_not_before(order[1:], key[1:], later) if len(order) > 1 else F.lit(True)))


@dataclass(frozen=True)
class PageIndex:
    """``slices``: (rows, first key, last key), in order."""

    order: tuple[By, ...]
    slices: tuple[tuple[int, tuple, tuple], ...]

    def page(self, df: DataFrame, size: int | None = None, offset: int = 0) -> DataFrame:
        """Rows ``offset`` to ``offset + size`` of the frame that was indexed, in its order."""
        held, before = [], 0
        start = 0
        for rows, first, last in self.slices:
            if before + rows > offset and (size is None or before < offset + size):
                start = before if not held else start
                held.append((first, last))
            before += rows
        if not held:
            return df.filter(F.lit(False))
        low, high = held[0][0], held[-1][1]
        # The first column alone is what reaches the scan.
        near = _not_before(self.order[:1], low[:1], True) & _not_before(self.order[:1], high[:1], False)
        rows = df.filter(near & _not_before(self.order, low, True) & _not_before(self.order, high, False)).orderBy(*sort_columns(self.order))
        rows = rows.offset(offset - start) if offset > start else rows
        return rows if size is None else rows.limit(size)


def _sliced(df: DataFrame, order: Sequence[By], slices: int | None) -> DataFrame:
    by = sort_columns(order)
    dealt = df.repartitionByRange(slices, *by) if slices else df.repartitionByRange(*by)
    return dealt.sortWithinPartitions(*by).withColumns({"_slice": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})


def _index(sliced: DataFrame, order: Sequence[By]) -> PageIndex:
    key = F.struct(*[_value(by).alias(f"k{i}") for i, by in enumerate(order)])
    found = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("n"), F.min_by(key, "_at").alias("first"), F.max_by(key, "_at").alias("last"))
    rows = sorted(found.collect(), key=lambda r: r["_slice"])  # one row per slice
    return PageIndex(tuple(order), tuple((r["n"], tuple(r["first"]), tuple(r["last"])) for r in rows))


def page_index(df: DataFrame, order: Sequence[By], slices: int | None = None) -> PageIndex:
    """An index of ``df``; ``order`` must end in something unique, or rows that are equal in it must be alike.

    The frame must give the same values whenever it is read, as tables do.
    """
    keys = df.select(*[_value(by).alias(f"c{i}") for i, by in enumerate(order)])
    names: list[By] = [(f"c{i}", "desc") if _falls(by) else f"c{i}" for i, by in enumerate(order)]
    return PageIndex(tuple(order), _index(_sliced(keys, names, slices), names).slices)


def write_pages(df: DataFrame, order: Sequence[str | tuple[str, str]], path: str, slices: int | None = None) -> PageIndex:
    """Write rows in slices of the order, and their index beside them."""
    _sliced(df, order, slices).write.parquet(f"{path}/rows")
    return open_pages(df.sparkSession, order, path)[1]


def open_pages(spark: SparkSession, order: Sequence[str | tuple[str, str]], path: str) -> tuple[DataFrame, PageIndex]:
    """The rows that were written, and their index."""
    written = spark.read.parquet(f"{path}/rows")
    return written.drop("_slice", "_at"), _index(written, order)
