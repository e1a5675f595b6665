"""Running models over all cells of a task.

The built-in baselines score every cell in one job: per-fold sums are aggregated once and the
training sums of a fold are the totals less its own. Any ``pyspark.ml`` estimator runs cell by
cell, each cell a distributed fit.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialbook.operators import neighbours, scores, splits, traces
from trialbook.plans.scan import join_groups
from trialbook.plans.skew import bounded, join_by_cell
from trialbook.session import stage

CELL = ["repeat", "fold"]
# Files that hold the rows of one repeat and fold, at most.
FILES_PER_CELL = 64


def _train_totals(per_fold: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """For each (repeat, fold, by): the sums over all other folds. Works on per-fold sums only."""
    totals = per_fold.groupBy("repeat", *by).agg(*[F.sum(c).alias(f"_t_{c}") for c in columns])
    grid = per_fold.select(*CELL).distinct().join(totals, "repeat")
    own = per_fold.select(*CELL, *by, *columns)
    joined = grid.join(own, [*CELL, *by], "left").fillna(0, list(columns))
    return joined.select(*CELL, *by, *[(F.col(f"_t_{c}") - F.col(c)).alias(c) for c in columns])


def majority_class(rows: DataFrame, test_folds: DataFrame) -> DataFrame:
    """Predict the most frequent training class; the lowest label wins a tie."""
    placed = place(rows.select("rowid", "label"), test_folds)
    per_fold = placed.filter("label IS NOT NULL").groupBy(*CELL, "label").agg(F.count(F.lit(1)).alias("n"))
    train = _train_totals(per_fold, ["label"], ["n"])
    most = train.groupBy(*CELL).agg(F.max("n").alias("n"))
    chosen = train.join(most, [*CELL, "n"]).groupBy(*CELL).agg(F.min("label").alias("prediction"))
    out = join_by_cell(placed, chosen, CELL, "rowid")
    return out.select(*CELL, F.lit(0).alias("sample"), F.col("rowid").alias("row_id"), "prediction", F.col("label").alias("correct"))


def nearest_centroid(rows: DataFrame, test_folds: DataFrame, dims: int) -> DataFrame:
    """Predict the class of the nearest training mean; the lowest label wins a tie.

    ``rows`` is (rowid, label, embedding). The model of a cell is one row of class means, and a
    test row meets exactly that one row.
    """
    placed = place(rows.select("rowid", "label", "embedding"), test_folds)
    # Position 0 counts the rows, the others sum the dimensions. After this aggregate there are only
    # cells x classes x dimensions numbers left, and those go on as rows.
    sums = placed.filter("label IS NOT NULL").groupBy(*CELL, "label").agg(F.array(
        F.count(F.lit(1)).cast("double"), *[F.sum(F.expr(f"double(embedding[{i}])")) for i in range(dims)]).alias("s"))
    long = sums.select(*CELL, "label", F.posexplode("s").alias("i", "v"))
    train = _train_totals(long, ["label", "i"], ["v"]).groupBy(*CELL, "label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda e: e["v"]).alias("s")).filter(F.col("s")[0] > 0)
    means = train.select(*CELL, "label", F.transform(F.slice("s", 2, dims), lambda v: v / F.col("s")[0]).alias("mean"))
    model = means.groupBy(*CELL).agg(F.collect_list(F.struct("label", "mean")).alias("model"))

    def distance(mean: Column) -> Column:
        gaps = F.zip_with("embedding", mean, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
        return F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g)

    nearest = F.array_min(F.transform("model", lambda m: F.struct(distance(m["mean"]).alias("d"), m["label"].alias("label"))))
    out = join_by_cell(placed, model, CELL, "rowid")
    return out.select(*CELL, F.lit(0).alias("sample"), F.col("rowid").alias("row_id"),
                      nearest["label"].alias("prediction"), F.col("label").alias("correct"))


def mean_regressor(rows: DataFrame, test_folds: DataFrame) -> DataFrame:
    """Predict the training mean of ``y``."""
    placed = place(rows.select("rowid", "y"), test_folds)
    per_fold = placed.groupBy(*CELL).agg(F.sum("y").alias("s"), F.count("y").alias("n"))
    train = _train_totals(per_fold, [], ["s", "n"])
    model = train.select(*CELL, F.try_divide("s", "n").alias("prediction"))
    out = join_by_cell(placed, model, CELL, "rowid")
    return out.select(*CELL, F.col("rowid").alias("row_id"), "prediction", F.col("y").alias("truth"))


def one_hot(predictions: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Add ``probabilities`` of a model that gives none: 1 for the predicted class."""
    entries = [x for v in labels for x in (F.lit(v), (F.col("prediction") == v).cast("double"))]
    return predictions.withColumn("probabilities", F.create_map(*entries))


@dataclass(frozen=True)
class Run:
    """Predictions in file order, and seconds per cell and phase."""

    predictions: DataFrame
    timings: list[tuple[int, int, int, str, float]]

    def timing_rows(self) -> DataFrame:
        return self.predictions.sparkSession.createDataFrame(
            self.timings, "repeat int, fold int, sample int, measure string, seconds double")


def place(rows: DataFrame, test_folds: DataFrame) -> DataFrame:
    """Rows with their test fold per repeat, written once by repeat and fold: a cell reads its own folders only."""
    placed = rows.join(test_folds, "rowid")
    # A task that holds many cells would write a file for each: a cell's rows meet in a few tasks first.
    return stage(placed.repartition("repeat", "fold", F.pmod(F.xxhash64("rowid"), F.lit(FILES_PER_CELL))), "placed", ["repeat", "fold"])


def place_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows per (repeat, fold, sample, type), for splits whose TRAIN part is not the complement."""
    return stage(rows.join(cells.select("repeat", "fold", "sample", "type", "rowid"), "rowid"), "placed")


def place_ranked(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """Rows with their TEST fold and their ranks per fold (``splits.learning_ranks``): one row per row, whatever the samples."""
    return place(rows, ranks)


def _cell_rows(placed: DataFrame, repeat: int, fold: int, size: int | None, sample: int) -> tuple[DataFrame, DataFrame]:
    one = placed.filter(F.col("repeat") == repeat)
    if size is not None:
        return one.filter((F.col("fold") != fold) & (F.get("ranks", F.lit(fold)) < size)), one.filter(F.col("fold") == fold)
    if "type" not in placed.columns:
        return one.filter(F.col("fold") != fold), one.filter(F.col("fold") == fold)
    one = one.filter((F.col("fold") == fold) & (F.col("sample") == sample))
    return one.filter("type = 'TRAIN'"), one.filter("type = 'TEST'")


def run_cells(estimator, placed: DataFrame, cells: Iterable[tuple[int, ...]], labels: Sequence[str] | None = None, sizes: Sequence[int] | None = None) -> Run:
    """Fit and predict each (repeat, fold) or (repeat, fold, sample) with any ``pyspark.ml`` estimator.

    ``placed`` comes from ``place``, ``place_cells`` or, with the ``sizes`` of the samples, ``place_ranked``, and has ``features``. With ``labels`` it is a
    classification of ``label``, whose position in ``labels`` is what the estimator sees; without,
    a regression of ``y``, or a clustering where there is none. Predictions of a cell are written
    before the next begins, so the timing of a phase covers its work.
    """
    parts, timings = [], []
    domain = F.array(*[F.lit(v) for v in labels]) if labels is not None else None
    target = "_y" if labels is not None else "y"
    learner = estimator.copy({estimator.labelCol: target}) if estimator.hasParam("labelCol") else estimator
    for repeat, fold, *rest in cells:
        sample = rest[0] if rest else 0
        train, test = _cell_rows(placed, repeat, fold, None if sizes is None else sizes[sample], sample)
        if labels is not None:
            train = train.withColumn("_y", (F.array_position(domain, F.col("label").cast("string")) - 1).cast("double"))
        begin = time.perf_counter()
        model = learner.fit(train)
        fitted = time.perf_counter()
        scored = model.transform(test)
        place_of = ["repeat", "fold", F.lit(sample).alias("sample"), F.col("rowid").alias("row_id")]
        if labels is not None:
            chance = vector_to_array("probability")
            out = scored.select(
                *place_of, F.get(domain, F.col("prediction").cast("int")).alias("prediction"), F.col("label").cast("string").alias("correct"),
                *[F.coalesce(F.get(chance, F.lit(i)), F.lit(0.0)).alias(f"confidence.{v}") for i, v in enumerate(labels)])
        elif "y" in placed.columns:
            out = scored.select(*place_of, "prediction", F.col("y").alias("truth"))
        else:
            out = scored.select(*place_of, F.col("prediction").alias("cluster"))
        parts.append(stage(out, "predictions"))
        done = time.perf_counter()
        timings += [(repeat, fold, sample, "wall_clock_time_millis_training", 1000 * (fitted - begin)),
                    (repeat, fold, sample, "wall_clock_time_millis_testing", 1000 * (done - fitted)),
                    (repeat, fold, sample, "wall_clock_time_millis", 1000 * (done - begin))]
    return Run(reduce(DataFrame.unionByName, parts), timings)


def fit_lines(rows: DataFrame, keys: Sequence[str], fold: str, x: str, y: str) -> DataFrame:
    """A least-squares line of ``y`` on ``x`` for every cell, fitted without the cell's own fold, at its own rows.

    ``rows`` is (keys.., fold, rowid, x, y), each row in one fold; NULL is a key and a fold like any other. A cell may
    have any size, and no row is copied. Whole numbers are summed exactly, and the training sums of a fold are the
    totals less its own; fractions go by means and sums of deviations of every fold, which are put together for all
    folds but one. Where x never varies the prediction is the mean; where a cell has no training row, or x is NULL,
    it is NULL.
    """
    kinds = dict(rows.dtypes)
    whole = all(kinds[c] in ("tinyint", "smallint", "int", "bigint") or kinds[c].endswith(",0)") for c in (x, y))
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    given = rows.select(*keys, fold, F.when(both, F.col(x)).alias("_a"), F.when(both, F.col(y)).alias("_b"))
    train, guess = (_whole_lines if whole else _fraction_lines)(given, list(keys), fold, F.col(x).cast("double"))
    out = join_groups(rows, bounded(stage(train, "lines")), [*keys, fold])
    return out.select(*keys, fold, F.col("rowid").alias("row_id"), F.when(F.col(x).isNotNull(), guess).alias("prediction"), F.col(y).cast("double").alias("truth"))


def _whole_lines(given: DataFrame, keys: list[str], fold: str, at: Column) -> tuple[DataFrame, Column]:
    """(keys.., fold, exact training sums) and the prediction at a place; decimals do not overflow."""
    a, b = F.col("_a").cast("decimal(38,0)"), F.col("_b").cast("decimal(38,0)")
    sums = {"n": F.count("_a"), "sx": F.sum(a), "sy": F.sum(b), "sxy": F.sum(a * b), "sxx": F.sum(a * a)}
    own = given.groupBy(*keys, fold).agg(*[F.coalesce(c, F.lit(0)).alias(k) for k, c in sums.items()])
    totals = own.groupBy(*keys).agg(*[F.sum(k).alias(f"_{k}") for k in sums])
    train = join_groups(own, totals, keys).select(*keys, fold, *[(F.col(f"_{k}") - F.col(k)).cast("double").alias(f"_{k}") for k in sums])
    spread = F.expr("_n * _sxx - _sx * _sx")
    line = (F.expr("_sy * _sxx - _sx * _sxy") + F.expr("_n * _sxy - _sx * _sy") * at) / spread
    return train, F.when(spread > 0, line).when(F.col("_n") > 0, F.expr("_sy / _n"))


def _fraction_lines(given: DataFrame, keys: list[str], fold: str, at: Column) -> tuple[DataFrame, Column]:
    """(keys.., fold, means and slope of all other folds) and the prediction at a place."""
    a, b = F.col("_a").cast("double"), F.col("_b").cast("double")
    n = F.count("_a")
    own = given.groupBy(*keys, fold).agg(
        n.alias("n"), F.avg(a).alias("x"), F.avg(b).alias("y"), (F.var_pop(a) * n).alias("xx"), (F.covar_pop(a, b) * n).alias("xy"), F.min(a).alias("least"), F.max(a).alias("most"))
    # One entry per fold of a cell.
    folds = own.groupBy(*keys).agg(F.collect_list(F.struct(fold, "n", "x", "y", "xx", "xy", "least", "most")).alias("_folds"))
    each = folds.select(*keys, "_folds", F.explode(F.transform("_folds", lambda f: f[fold])).alias(fold))
    others = F.filter("_folds", lambda f: ~f[fold].eqNullSafe(F.col(fold)) & (f["n"] > 0))

    def total(value) -> Column:
        return F.aggregate("_others", F.lit(0.0), lambda s, f: s + value(f))

    train = each.withColumn("_others", others).withColumn("_n", total(lambda f: f["n"].cast("double")))
    train = train.withColumns({"_x": total(lambda f: f["n"] * f["x"]) / F.nullif("_n", F.lit(0.0)), "_y": total(lambda f: f["n"] * f["y"]) / F.nullif("_n", F.lit(0.0))})
    xx = total(lambda f: f["xx"] + f["n"] * (f["x"] - F.col("_x")) * (f["x"] - F.col("_x")))
    xy = total(lambda f: f["xy"] + f["n"] * (f["x"] - F.col("_x")) * (f["y"] - F.col("_y")))
    varies = F.array_min(F.transform("_others", lambda f: f["least"])) < F.array_max(F.transform("_others", lambda f: f["most"]))
    train = train.select(*keys, fold, "_x", "_y", F.when(varies, xy / xx).alias("_slope"))
    return train, F.when(F.col("_slope").isNotNull(), F.col("_y") + F.col("_slope") * (at - F.col("_x"))).otherwise(F.col("_y"))


def search(
    candidates: Sequence[tuple[dict[str, object], object]], placed: DataFrame, cells: Iterable[tuple[int, int]],
    labels: Sequence[str], inner_folds: int, seed: int = 0,
) -> tuple[DataFrame, Run]:
    """Hyperparameter search per outer cell: (trace with the selected candidate, refitted run).

    Inner folds are drawn inside the TRAIN rows of each outer cell, and the refit uses what the
    trace selected.
    """
    spark = placed.sparkSession
    rows, parts, timings = [], [], []
    for repeat, fold in cells:
        outer = placed.filter((F.col("repeat") == repeat) & (F.col("fold") != fold)).drop("repeat", "fold")
        inner = place(outer, splits.cross_validation(outer, 1, inner_folds, seed, "label"))
        found = []
        for i, (parameters, estimator) in enumerate(candidates):
            run = run_cells(estimator, inner, [(0, f) for f in range(inner_folds)], labels)
            value = run.predictions.agg(scores.accuracy().alias("a")).first()["a"]
            found.append((0, repeat, fold, i, float(value), {f"{traces.PREFIX}{k}": str(v) for k, v in parameters.items()}))
        best = max(found, key=lambda t: (t[4], -t[3]))[3]
        rows += found
        refit = run_cells(candidates[best][1], placed, [(repeat, fold)], labels)
        parts.append(refit.predictions)
        timings += refit.timings
    trace = spark.createDataFrame(rows, "run_id long, repeat int, fold int, iteration long, evaluation double, parameters map<string,string>")
    return traces.mark_selected(trace), Run(reduce(DataFrame.unionByName, parts), timings)


def landmarkers(learners: Sequence[tuple[str, object]], placed: DataFrame, cells: Sequence[tuple[int, int]], labels: Sequence[str]) -> DataFrame:
    """(name, value): area, error rate and kappa of simple learners under cross-validation."""
    return reduce(DataFrame.unionByName, [landmarks(name, run_cells(estimator, placed, cells, labels).predictions, labels) for name, estimator in learners])


def landmarks(name: str, predictions: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(name, value): area, error rate and kappa of predictions with confidences."""
    p = predictions.withColumn("_all", F.lit(0))
    summary = scores.classification_summary(scores.confusion(p, ["_all"]), ["_all"])
    both = summary.join(scores.weighted_auc(p, ["_all"], labels), "_all", "left")
    return both.select(F.explode(F.array(
        F.struct(F.lit(f"{name}AUC").alias("name"), F.col("auc").alias("value")),
        F.struct(F.lit(f"{name}ErrRate").alias("name"), (1 - F.col("accuracy")).alias("value")),
        F.struct(F.lit(f"{name}Kappa").alias("name"), F.col("kappa").alias("value")))).alias("q")).select("q.*")


def nearest_neighbour_landmarks(rows: DataFrame, test_folds: DataFrame, labels: Sequence[str], name: str = "kNN1N") -> DataFrame:
    """(name, value) of the nearest neighbour over rows (rowid, label, features as an array) and one repeat of folds."""
    found = stage(neighbours.predictions(rows.join(test_folds.select("rowid", "fold"), "rowid")), "neighbours")
    certain = [(F.coalesce(F.col("prediction") == v, F.lit(False))).cast("double").alias(f"confidence.{v}") for v in labels]
    return landmarks(name, found.select("*", *certain), labels)


def surrogate(frame: DataFrame, numeric: Sequence[str], nominal: Sequence[str], target: str, trees: int = 10, seed: int = 0):
    """A forest that predicts a metric from hyperparameters: (model, frame with predictions, RMSE).

    Missing numbers become -1 and missing categories their own value.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    filled = stage(frame.fillna(-1.0, list(numeric)).fillna("-1", list(nominal)), "surrogate")
    encoded = [f"{c}_vec" for c in nominal]
    stages = [
        StringIndexer(inputCols=list(nominal), outputCols=[f"{c}_idx" for c in nominal], handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}_idx" for c in nominal], outputCols=encoded),
        VectorAssembler(inputCols=[*numeric, *encoded], outputCol="_features"),
        RandomForestRegressor(featuresCol="_features", labelCol=target, numTrees=trees, seed=seed),
    ]
    model = Pipeline(stages=stages if nominal else stages[2:]).fit(filled)
    scored = model.transform(filled)
    rmse = scored.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col(target), 2))).alias("rmse"))
    return model, scored, rmse
