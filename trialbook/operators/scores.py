"""Scoring of prediction tables (repeat, fold, sample, row_id, prediction, correct or truth, ...).

Scores are aggregated per sample first and the last sample is picked from the few results, so
prediction rows are never joined or collected by fold.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialbook.operators import mergeable
from trialbook.plans.scan import running

CELL = ["repeat", "fold"]


def accuracy() -> Column:
    return F.avg(F.col("prediction").eqNullSafe(F.col("correct")).cast("double"))


def mean_absolute_error() -> Column:
    return F.avg(F.abs(F.col("prediction") - F.col("truth")))


def root_mean_squared_error() -> Column:
    return F.sqrt(F.avg((F.col("prediction") - F.col("truth")) * (F.col("prediction") - F.col("truth"))))


def by_sample(predictions: DataFrame, ids: Sequence[str], metric: Column) -> DataFrame:
    return predictions.groupBy(*ids, *CELL, "sample").agg(metric.alias("value"))


def last_sample(scores: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One value per (repeat, fold): that of the highest sample."""
    return scores.groupBy(*ids, *CELL).agg(F.max_by("value", "sample").alias("value"))


def metric_by_fold(predictions: DataFrame, ids: Sequence[str], metric: Column) -> DataFrame:
    """A metric given as an aggregate column, one score per fold."""
    return last_sample(by_sample(predictions, ids, metric), ids)


def python_metric_by_fold(predictions: DataFrame, ids: Sequence[str], truth: str, metric: Any) -> DataFrame:
    """A metric in Python for folds of any size, one score per fold.

    ``metric`` has ``partial(y_true, y_pred)``, a state of some rows as arrays, ``merge(a, b)`` of two
    states, and ``finish(state)``, the score. Every batch of a task becomes one state per fold; only
    states travel, and a task holds some thousands of them at most.
    """
    keys = [*ids, *CELL]
    last = predictions.groupBy(*keys).agg(F.max("sample").alias("_last"))
    kept = predictions.join(last, keys).filter(F.col("sample") == F.col("_last")).select(*keys, truth, "prediction")
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, state, types in mergeable.merged(batches, keys, metric.merge):
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*key, float(metric.finish(state))), (*types, pa.float64()), strict=True)], names=[*keys, "value"])

    states = mergeable.states(kept, keys, [truth, "prediction"], lambda rows: metric.partial(rows[truth], rows["prediction"]), metric.merge, keys)
    kinds = dict(predictions.dtypes)
    return states.mapInArrow(scored, ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "value double"]))


def domain_violations(predictions: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Labels that occur as prediction or truth but are not declared."""
    seen = predictions.select(F.explode(F.array(
        F.struct(F.lit("prediction").alias("column"), F.col("prediction").alias("label")),
        F.struct(F.lit("correct").alias("column"), F.col("correct").alias("label")))).alias("s")).select("s.*")
    return seen.filter(~F.col("label").isin(list(labels))).groupBy("column", "label").agg(F.count(F.lit(1)).alias("n"))


def confusion(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    return predictions.groupBy(*by, "correct", "prediction").agg(F.count(F.lit(1)).alias("n"))


def class_scores(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """Precision, recall and F1 per class of a confusion table; undefined ones are 0."""
    rows = table.select(*by, F.explode(F.array(
        F.struct(F.col("correct").alias("label"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("correct") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("prediction").alias("label"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("hits")))).alias("r")).select(*by, "r.*")
    sums = rows.groupBy(*by, "label").agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hits")])
    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))

    out = sums.withColumn("precision", share("hits", "predicted")).withColumn("recall", share("hits", "actual"))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("hits"), F.col("actual") + F.col("predicted")), F.lit(0.0))
    return out.withColumn("f1", f1)


def classification_summary(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """Accuracy, kappa, and class-weighted and plain means of precision, recall and F1."""
    c = class_scores(table, by)
    n = F.sum("actual").cast("double")

    def weighted(name: str) -> Column:
        return (F.sum(F.col("actual") * F.col(name)) / n).alias(f"weighted_{name}")

    chance = F.sum(F.col("actual").cast("double") * F.col("predicted")) / (n * n)
    agreed = F.sum("hits") / n
    return c.groupBy(*by).agg(
        agreed.alias("accuracy"),
        F.when(chance < 1, (agreed - chance) / (1 - chance)).otherwise(F.lit(0.0)).alias("kappa"),
        *[F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")],
        *[weighted(m) for m in ("precision", "recall", "f1")])


def class_auc(predictions: DataFrame, by: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Area under the ROC curve of each class against the rest, by rank sums.

    Rows are counted per distinct confidence first, so ties cost nothing and the running sums go
    over values, not over rows. A class that all or no rows belong to has no area.
    """
    long = predictions.select(*by, F.explode(F.array(*[
        F.struct(F.lit(v).alias("label"), (F.col("correct") == v).alias("own"), F.col(f"`confidence.{v}`").alias("score"))
        for v in labels])).alias("c")).select(*by, "c.*")
    counts = long.groupBy(*by, "label", "score").agg(
        F.count_if("own").alias("pos"), F.count_if(~F.col("own")).alias("neg"))
    below = running(counts, [*by, "label"], ["score"], {"_neg": ("sum", "neg")})
    sums = below.groupBy(*by, "label").agg(
        F.sum(F.col("pos") * (F.col("_neg") - F.col("neg") / 2)).alias("u"), F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    return sums.select(*by, "label", F.col("p").alias("n_class"), F.try_divide(F.col("u"), F.col("p") * F.col("q")).alias("auc"))


def weighted_auc(predictions: DataFrame, by: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """The class areas, weighted by class size."""
    areas = class_auc(predictions, by, labels).filter("auc IS NOT NULL")
    return areas.groupBy(*by).agg((F.sum(F.col("auc") * F.col("n_class")) / F.sum("n_class")).alias("auc"))


def local_measures(predictions: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(per sample, per fold) of accuracy or absolute error; a fold has its last sample's value."""
    if kind == "classification":
        name, metric = "predictive_accuracy", accuracy()
    elif kind == "regression":
        name, metric = "mean_absolute_error", mean_absolute_error()
    else:
        raise ValueError(f"no local measure for {kind}")
    each = by_sample(predictions, [], metric).withColumn("measure", F.lit(name))
    return each, last_sample(each, ["measure"])


def format_classification(predictions: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Columns in file order from ``probabilities MAP<label, p>``; every class needs an entry."""
    declared = F.array_sort(F.array(*[F.lit(v) for v in labels]))
    complete = F.array_sort(F.map_keys("probabilities")) == declared
    checked = F.when(complete, F.col("probabilities")).otherwise(F.raise_error(F.lit("each class needs a predicted probability")))
    out = predictions.withColumn("probabilities", checked)
    return out.select(
        "repeat", "fold", F.coalesce("sample", F.lit(0)).alias("sample"), "row_id", "prediction", "correct",
        *[F.col("probabilities")[v].alias(f"confidence.{v}") for v in labels])


def format_regression(predictions: DataFrame) -> DataFrame:
    return predictions.select("repeat", "fold", "row_id", "prediction", "truth")


def format_clustering(predictions: DataFrame) -> DataFrame:
    return predictions.select("repeat", "fold", "row_id", "cluster")
