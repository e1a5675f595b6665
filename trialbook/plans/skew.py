"""Joining a large table with few-valued keys to a small one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialbook.session import stage

BROADCAST_BYTES = 64 * 1024 * 1024
# Bytes in memory for a byte of a written table, at most about.
UNPACKED = 8
SALTS = 256


def written_bytes(df: DataFrame) -> int:
    """The size of a frame's files, as the plan knows it from their listing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded(staged: DataFrame) -> DataFrame:
    """A written table for a join: broadcast where its measured size is under the limit, and merged beyond."""
    return F.broadcast(staged) if written_bytes(staged) * UNPACKED <= BROADCAST_BYTES else staged.hint("merge")


def join_by_cell(large: DataFrame, small: DataFrame, keys: Sequence[str], spread: str) -> DataFrame:
    """Inner join where one key value may hold most of ``large``.

    The small side is written and its files measured: under the limit it is broadcast; beyond, it is repeated per salt
    and the large side is spread over the salts by ``spread``.
    """
    small = stage(small, "small-side")
    if written_bytes(small) * UNPACKED <= BROADCAST_BYTES:
        return large.join(F.broadcast(small), list(keys))
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread_out = large.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return spread_out.join(salted, [*keys, "_salt"]).drop("_salt")
