"""Ordered operations over groups of any size.

A plain window puts a whole group in one task. Here the rows are cut into ordered slices that
ignore group borders, each slice is worked on alone, and only the totals of groups that cross
a slice border are carried over. The carried table has at most two rows per slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialbook.session import stage

_FOLD = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}


def _merge(kind: str, carried: Column, local: Column) -> Column:
    if kind == "min":
        return F.least(carried, local)
    if kind == "max":
        return F.greatest(carried, local)
    return F.when(carried.isNull(), local).when(local.isNull(), carried).otherwise(carried + local)


def _by_range(df: DataFrame, order: Sequence[Column], slices: int | None) -> DataFrame:
    """Ordered slices. Their number is left to Spark (at most its shuffle partitions, and AQE joins
    neighbours that are small) unless it is given."""
    return df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    measures: Mapping[str, tuple[str, str | Column]],
    slices: int | None = None,
) -> DataFrame:
    """Add running (inclusive) sum / min / max / count columns per group.

    ``order`` must end in something unique within a group, so that equal sort values neither
    pile up in one slice nor make the result depend on the layout.
    """
    inputs = {f"_in_{name}": (kind, F.col(c) if isinstance(c, str) else c)
              for name, (kind, c) in measures.items()}
    order = [F.col(o) if isinstance(o, str) else o for o in order]

    sliced = df.select("*", *[c.alias(name) for name, (_, c) in inputs.items()])
    sliced = _by_range(sliced, [*[F.col(k) for k in keys], *order], slices)
    sliced = stage(sliced.withColumn("_slice", F.spark_partition_id()), "slices")

    def folded(name: str) -> Column:
        return _FOLD[inputs[name][0]](name)

    group = F.struct(*keys) if keys else F.lit(0)
    ends = sliced.groupBy("_slice").agg(F.min(group).alias("_first"), F.max(group).alias("_last"))
    edges = (
        sliced.join(F.broadcast(ends), "_slice")  # one row per slice
        .filter(group.eqNullSafe(F.col("_first")) | group.eqNullSafe(F.col("_last")))
        .groupBy("_slice", *keys)
        .agg(*[folded(name).alias(name) for name in inputs])
    )
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        F.col("_slice").alias("_c_slice"),
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        *[(F.sum(name) if kind == "count" else _FOLD[kind](name)).over(before).alias(f"_c{name}")
          for name, (kind, _) in inputs.items()],
    )
    here = (
        Window.partitionBy("_slice", *keys).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = sliced.select("*", *[folded(name).over(here).alias(f"_l{name}") for name in inputs])
    on = F.col("_slice") == F.col("_c_slice")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    joined = local.join(F.broadcast(carried), on, "left")  # at most two rows per slice
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[_merge(kind, F.col(f"_c_in_{name}"), F.col(f"_l_in_{name}")).alias(name)
          for name, (kind, _) in measures.items()],
    )


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str, slices: int | None = None
) -> DataFrame:
    """Position (from 1) of each row within its group; without keys, within the whole frame.

    For the whole frame the sorted slices are written with each row's offset, so only the slice
    sizes are left to add and no second shuffle is needed.
    """
    if keys:
        return running(df, keys, order, {name: ("count", F.lit(1))}, slices)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    sliced = _by_range(df, order, slices).sortWithinPartitions(*order)
    written = stage(sliced.withColumns({"_slice": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "sorted")
    sizes = written.groupBy("_slice").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row per slice.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_slice", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return written.join(F.broadcast(starts), "_slice").select(
        *[F.col(c) for c in df.columns], (F.col("_at") + F.col("_shift")).alias(name))


def hash_counts(
    df: DataFrame, keys: Sequence[str], digest: str, tie: str, flags: Mapping[str, Column], digits: int = 4
) -> DataFrame:
    """For each flag, how many flagged rows of the group come earlier in the order of a digest.

    Leading digits of a hexadecimal digest cut every group, however large, into even buckets; the
    counts per bucket give each bucket its start. Aggregation, join and window all go by the
    same (group, bucket) columns, so the rows are shuffled once.
    """
    # NULL is a group of its own, and plain equality lets the join and the window share a shuffle.
    groups = {f"_g{i}": F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for i, k in enumerate(keys)}
    cut = df.withColumns({**groups, **{f"_f{i}": c.cast("long") for i, c in enumerate(flags.values())},
                          "_bucket": F.substring(digest, 1, digits)})
    by = [*groups, "_bucket"]
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(*by).agg(*[F.sum(f"_f{i}").alias(f"_n{i}") for i in range(len(flags))])
    starts = sums.select(*by, *[F.coalesce(F.sum(f"_n{i}").over(before), F.lit(0)).alias(f"_s{i}") for i in range(len(flags))])
    within = Window.partitionBy(*by).orderBy(digest, tie).rowsBetween(Window.unboundedPreceding, -1)
    return cut.join(starts, by).select(
        *df.columns,
        *[(F.col(f"_s{i}") + F.coalesce(F.sum(f"_f{i}").over(within), F.lit(0))).alias(name) for i, name in enumerate(flags)])


def hash_positions(
    df: DataFrame, keys: Sequence[str], digest: str, tie: str, name: str, digits: int = 4
) -> DataFrame:
    """0-based position within a group in the order of a hexadecimal digest."""
    return hash_counts(df, keys, digest, tie, {name: F.lit(1)}, digits)


def value_counts_running(df: DataFrame, keys: Sequence[str], value: str, descending: bool = False) -> DataFrame:
    """Distinct values per group with their count ``n`` and the running count ``upto``."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    by = F.col(value).desc() if descending else F.col(value).asc()
    return running(counts, keys, [by], {"upto": ("sum", "n")})


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on group keys where NULL is a group like any other."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, on).drop(*[f"_r_{k}" for k in keys])


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: Mapping[str, float]) -> DataFrame:
    """Linearly interpolated quantiles without holding a group's values in one task.

    Distinct values are counted and cut into ordered slices. The counts per slice tell where each
    quantile lies, and only the slices that hold one are ranked.
    """
    if not keys:
        return exact_quantiles(df.withColumn("_all", F.lit(0)), ["_all"], value, shares).drop("_all")
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    sliced = _by_range(counts, [*[F.col(k) for k in keys], F.col(value)], None)
    sliced = stage(sliced.withColumn("_slice", F.spark_partition_id()), "values")

    # One row per group and slice it touches.
    group = Window.partitionBy(*keys)
    sizes = sliced.groupBy(*keys, "_slice").agg(F.sum("n").alias("_n"))
    before = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*keys, "_slice", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                         F.sum("_n").over(group).alias("_total"))
    spots = {name: (F.col("_total") - 1) * F.lit(float(share)) for name, share in shares.items()}

    def within(position: Column, start: Column, count: Column) -> Column:
        return (start <= position) & (position < start + count)

    holds = F.lit(False)
    for spot in spots.values():
        for position in (F.floor(spot), F.ceil(spot)):
            holds = holds | within(position, F.col("_before"), F.col("_n"))
    rows = join_groups(sliced, sizes.filter(holds).drop("_n"), [*keys, "_slice"])
    ordered = Window.partitionBy("_slice", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("_from", F.col("_before") + F.coalesce(F.sum("n").over(ordered), F.lit(0)))

    def at(position: Column) -> Column:
        return F.max(F.when(within(position, F.col("_from"), F.col("n")), F.col(value)))

    wide = ranked.groupBy(*keys).agg(F.first("_total").alias("_total"), *[
        c for name, spot in spots.items() for c in (at(F.floor(spot)).alias(f"_lo_{name}"), at(F.ceil(spot)).alias(f"_hi_{name}"))])
    return wide.select(*keys, *[
        (F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (spot - F.floor(spot))).alias(name)
        for name, spot in spots.items()])
