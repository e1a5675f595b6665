"""Optimisation traces: selection, merging, incumbents and times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialbook.functions.params import decode_json_text, strip_prefix
from trialbook.plans.scan import running

CELL = ["run_id", "repeat", "fold"]
PREFIX = "parameter_"


def selected_iterations(trace: DataFrame) -> DataFrame:
    """First selected iteration per (run, repeat, fold); NULL where none is selected."""
    return trace.groupBy(*CELL).agg(F.min(F.when(F.col("selected"), F.col("iteration"))).alias("iteration"))


def require_selected(trace: DataFrame, *, repeat: int, fold) -> DataFrame:
    """The selected iteration of one cell per run; a cell without one is an error.

    Arguments go by name, since (repeat, fold) and (fold, repeat) are easily swapped.
    """
    chosen = selected_iterations(trace.filter((F.col("repeat") == repeat) & (F.col("fold") == fold)))
    message = F.concat_ws(" ", F.lit("no selected iteration for repeat/fold"), F.col("repeat").cast("string"), F.col("fold").cast("string"))
    return chosen.withColumn("iteration", F.when(F.col("iteration").isNull(), F.raise_error(message)).otherwise(F.col("iteration")))


def merge(traces: Sequence[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The traces as one, and what forbids it: duplicate keys and runs with differing parameter names."""
    out = traces[0]
    for more in traces[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    twice = out.groupBy(*CELL, "iteration").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    duplicates = twice.select("run_id", F.lit("duplicate iteration").alias("problem"), "n")
    names = F.to_json(F.array_sort(F.map_keys("parameters")))
    shapes = out.groupBy("run_id").agg(F.count_distinct(names).alias("n")).filter("n > 1")
    differing = shapes.select("run_id", F.lit("parameter names differ").alias("problem"), "n")
    return out, duplicates.unionByName(differing)


def best_iterations(trace: DataFrame) -> DataFrame:
    """Highest evaluation per cell, the lowest iteration on ties."""
    best = F.max(F.struct("evaluation", (-F.col("iteration")).alias("back")))
    return trace.filter(F.col("evaluation").isNotNull()).groupBy(*CELL).agg(best.alias("b")).select(
        *CELL, (-F.col("b.back")).alias("iteration"), F.col("b.evaluation").alias("evaluation"))


def mark_selected(trace: DataFrame) -> DataFrame:
    """Set ``selected`` on the best iteration of each cell."""
    best = best_iterations(trace).select(*CELL, F.col("iteration").alias("_best"))
    return trace.join(best, CELL, "left").withColumn(
        "selected", F.coalesce(F.col("iteration") == F.col("_best"), F.lit(False))).drop("_best")


def incumbent(scores: DataFrame, keys: Sequence[str], order: Sequence[str], score: Column, seconds: Column) -> DataFrame:
    """Running best loss (1 - score) and running time."""
    return running(scores, keys, order, {"incumbent": ("min", F.lit(1.0) - score), "elapsed": ("sum", seconds)})


def regret(scores: DataFrame, keys: Sequence[str], order: Sequence[str], score: str) -> DataFrame:
    """1 - the best score so far."""
    out = running(scores, keys, order, {"_best": ("max", score)})
    return out.withColumn("regret", F.lit(1.0) - F.col("_best")).drop("_best")


def parameters(trace: DataFrame) -> DataFrame:
    """Parameter maps without their prefix, values decoded from JSON text where they are JSON."""
    plain = F.transform_values(
        strip_prefix(F.col("parameters"), PREFIX), lambda _, v: F.coalesce(decode_json_text(v), v))
    return trace.withColumn("parameters", plain)


def refit_time(fold_values: DataFrame, ids: Sequence[str], total: str, train: str, test: str) -> DataFrame:
    """Total time less search training and testing, per fold."""
    def of(name: str) -> Column:
        return F.max(F.when(F.col("function") == name, F.col("value")))

    return fold_values.filter(F.col("function").isin(total, train, test)).groupBy(*ids).agg(
        (of(total) - of(train) - of(test)).alias("refit_time"))


def chosen_parameters(trace: DataFrame, iterations: DataFrame | None = None) -> DataFrame:
    """Parameters per cell of the given iterations, else of the selected ones."""
    wanted = iterations if iterations is not None else selected_iterations(trace)
    picked = trace.join(wanted.select(*CELL, "iteration"), [*CELL, "iteration"], "left_semi")
    return parameters(picked).select(*CELL, "iteration", "parameters")
