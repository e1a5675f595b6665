"""Result analysis: summaries, comparisons, landscapes, ranks and importance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialbook.functions.params import as_number
from trialbook.plans.scan import exact_quantiles, join_groups, row_numbers, value_counts_running
from trialbook.session import stage


def evaluation_summary(fold_scores: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Mean and population deviation over folds per repeat, then the mean of both over repeats."""
    per_repeat = fold_scores.groupBy(*ids, "repeat").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
    means = per_repeat.groupBy(*ids).agg(F.avg("m").alias("mean"), F.avg("s").alias("std"))
    # Rounding to 12 places first takes off what the order of summation left behind. format_number
    # rounds the exact binary value, as printf does; format_string would not.
    return means.selectExpr(*ids, "concat(format_number(round(mean, 12), '0.0000'), ' +- ', "
                            "format_number(round(std, 12), '0.0000')) AS summary")


def scopes(evaluations: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Values per sample, per fold and per run; what is NULL in (repeat, fold, sample) tells the scope."""
    cells = evaluations.groupBy(*ids, "repeat", "fold", "sample").agg(
        F.sum("value").alias("_s"), F.count("value").alias("_n"))
    r, f, s = F.col("repeat"), F.col("fold"), F.col("sample")
    own = [F.col(i) for i in ids]
    return cells.groupingSets(
        [[*own, r, f, s], [*own, r, f], own], *own, r, f, s,
    ).agg((F.sum("_s") / F.sum("_n")).alias("value"))


def pivot_flows(evaluations: DataFrame, flow_ids: Sequence[int], aggregate: Column, complete: bool = True) -> DataFrame:
    """Dataset x flow matrix; the caller chooses how several values of one cell are combined."""
    wanted = evaluations.filter(F.col("flow_id").isin(list(flow_ids)))
    wide = wanted.groupBy("did").pivot("flow_id", list(flow_ids)).agg(aggregate)
    return wide.dropna(subset=[str(f) for f in flow_ids]) if complete else wide


def compare_pair(wide: DataFrame, left: str, right: str, margin: float = 0.0) -> DataFrame:
    """Difference of two flows and who wins; a difference within ``margin`` is a tie."""
    gap = F.col(left) - F.col(right)
    outcome = F.when(gap.isNull(), F.lit(None)).when(gap > margin, "win").when(gap < -margin, "loss").otherwise("tie")
    return wide.withColumn("difference", gap).withColumn("outcome", outcome)


def flow_summary(evaluations: DataFrame, flows: int, approximate: bool = False) -> DataFrame:
    """Count, extremes and quartiles of the flows with the best values."""
    best = (
        evaluations.groupBy("flow_id").agg(
            F.count("value").alias("n"), F.min("value").alias("lowest"), F.max("value").alias("best"))
        .orderBy(F.col("best").desc(), "flow_id").limit(flows)
    )
    kept = evaluations.join(best.select("flow_id"), "flow_id", "left_semi")
    if approximate:
        q = kept.groupBy("flow_id").agg(F.percentile_approx("value", [0.25, 0.5, 0.75], 10_000).alias("q"))
        quartiles = q.select("flow_id", *[F.col("q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))])
    else:
        quartiles = exact_quantiles(kept, ["flow_id"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return best.join(quartiles, "flow_id")


def cdf(evaluations: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Share of values up to each distinct value."""
    table = value_counts_running(evaluations, keys, value)
    totals = table.groupBy(*keys).agg(F.sum("n").alias("_total"))
    return join_groups(table, totals, keys).select(*keys, value, "n", (F.col("upto") / F.col("_total")).alias("share"))


def binned_cdf(evaluations: DataFrame, keys: Sequence[str], low: float, high: float, bins: int) -> DataFrame:
    """The same over fixed bins, for metrics with very many distinct values.

    Bin 0 holds what lies below the range and bin ``bins + 1`` what lies above, so nothing is lost.
    """
    binned = evaluations.filter(F.col("value").isNotNull()).withColumn("bin", F.width_bucket(
        F.col("value"), F.lit(float(low)), F.lit(float(high)), F.lit(bins)))
    return cdf(binned, keys, "bin")


def landscape(frame: DataFrame, x: Column, y: Column, value: str, x_range, y_range, bins: int) -> DataFrame:
    """Mean value per square cell of two (log-scaled) parameters."""
    def cell(c: Column, bounds) -> Column:
        return F.width_bucket(c, F.lit(float(bounds[0])), F.lit(float(bounds[1])), F.lit(bins))

    return frame.groupBy(cell(x, x_range).alias("bx"), cell(y, y_range).alias("by")).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"))


def varying_numeric_parameters(parameters: DataFrame) -> DataFrame:
    """Long (setup_id, name, number) without the parameters that are not numeric or never change."""
    typed = parameters.withColumn("number", as_number(F.col("value")))
    useful = (
        typed.groupBy("name").agg(
            F.count_if(F.col("number").isNull() & F.col("value").isNotNull()).alias("texts"),
            F.min("number").alias("lo"), F.max("number").alias("hi"))
        .filter("texts = 0 AND lo < hi").select("name")
    )
    return typed.join(useful, "name", "left_semi").select("setup_id", "name", "number")


def widen(long: DataFrame, key: str, names: Sequence[str] | DataFrame) -> DataFrame:
    """One column per parameter; the names come from the flow table or a given list.

    Columns are a schema, so their names are the driver's; ``sparse_blocks`` holds any number of them.
    """
    if isinstance(names, DataFrame):
        names = [row[0] for row in names.distinct().collect()]
    return long.groupBy(key).pivot("name", sorted(names)).agg(F.max("number"))


def name_dictionary(names: DataFrame) -> DataFrame:
    """(name, position): the distinct names numbered from 0 in their order."""
    first = names.select(F.col(names.columns[0]).alias("name")).filter("name IS NOT NULL").distinct()
    return row_numbers(first, [], ["name"], "_n").select("name", (F.col("_n") - 1).alias("position"))


def sparse_blocks(long: DataFrame, key: str, dictionary: DataFrame, width: int = 4096) -> DataFrame:
    """(key, block, entries) of (key, name, number): a matrix of any width, cut into blocks of columns.

    Column ``position`` of the dictionary is ``place`` position % width of block position / width. An entry is (place,
    number), the largest number of a name; a block holds ``width`` of them at most, and one without any is absent.
    """
    cells = long.groupBy(key, "name").agg(F.max("number").alias("number")).filter("number IS NOT NULL").join(dictionary, "name")
    entry = F.struct((F.col("position") % width).cast("int").alias("place"), "number")
    return cells.groupBy(key, F.floor(F.col("position") / width).alias("block")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))


def block_columns(blocks: DataFrame, key: str, dictionary: DataFrame, names: Sequence[str], width: int = 4096) -> DataFrame:
    """Some columns of a blocked matrix by name, a row per key that has one of them."""
    found = dictionary.filter(F.col("name").isin(list(names)))
    entries = blocks.select(key, "block", F.explode("entries").alias("e")).select(key, (F.col("block") * width + F.col("e.place")).alias("position"), "e.number")
    return widen(entries.join(found, "position"), key, names)


def importance(frame: DataFrame, parameter: str, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Share of the variance of ``value`` that lies between bins of one parameter.

    A one-way measure of our own definition, not a forest-based one.
    """
    per_bin = frame.filter(F.col(value).isNotNull() & F.col(parameter).isNotNull()).groupBy(
        F.width_bucket(F.col(parameter).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins)).alias("bin")
    ).agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v"))
    # The bins are few, so this second step is one small group.
    grand = per_bin.agg(
        F.collect_list(F.struct("n", "m", "v")).alias("b"), F.sum("n").alias("n"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"))
    zero = F.lit(0.0)
    between = F.aggregate("b", zero, lambda a, e: a + e["n"] * (e["m"] - F.col("mean")) * (e["m"] - F.col("mean")))
    within = F.aggregate("b", zero, lambda a, e: a + e["n"] * e["v"])
    return grand.select(F.lit(parameter).alias("parameter"), F.col("n"),
                        F.when(between + within > 0, between / (between + within)).alias("importance"))


def flow_ranks(evaluations: DataFrame, descending: bool = True) -> DataFrame:
    """Mean rank of each flow over datasets (1 is best; equal values share the lower rank)."""
    # Written once, so that both sides of the join have the very same values.
    evaluations = stage(evaluations.select("did", "flow_id", "value"), "values")
    table = value_counts_running(evaluations, ["did"], "value", descending)
    ranks = table.select("did", "value", (F.col("upto") - F.col("n") + 1).alias("rank"))
    return evaluations.join(ranks, ["did", "value"]).groupBy("flow_id").agg(
        F.avg("rank").alias("mean_rank"), F.count("rank").alias("n_datasets"))
