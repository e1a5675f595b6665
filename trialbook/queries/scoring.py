"""Split, run and score queries (SPL, SET-05, RUN, AGG-02/03/04/07)."""

import numpy as np
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from trialbook.operators import lookups, mergeable, models, neighbours, scores, splits
from trialbook.queries import query
from trialbook.queries.analysis import round_to

CLASSES = ["A", "N", "R"]
DIGITS = [str(i) for i in range(10)]


def predictions(r):
    """A prediction table the size of lineitem: correct label for small quantities, else a guess."""
    guess = F.element_at(F.array(*[F.lit(c) for c in CLASSES]), (F.col("l_partkey") % 3 + 1).cast("int"))
    chosen = F.when(F.col("l_quantity") <= 25, F.col("l_returnflag")).otherwise(guess)
    return r.table("lineitem").select(
        (F.col("l_suppkey") % 2).alias("repeat"), F.col("l_linenumber").alias("fold"),
        (F.round(F.col("l_tax") * 100).cast("long") % 3).alias("sample"), F.col("l_orderkey").alias("row_id"),
        chosen.alias("prediction"), F.col("l_returnflag").alias("correct"),
        F.when(chosen == "A", 1 - F.col("l_discount")).otherwise(F.col("l_discount")).alias("confidence.A"),
        F.when(chosen == "N", 1 - F.col("l_discount")).otherwise(F.col("l_discount")).alias("confidence.N"),
        F.when(chosen == "R", 1 - F.col("l_discount")).otherwise(F.col("l_discount")).alias("confidence.R"),
        (F.col("l_quantity") * 1500).alias("estimate"), F.col("l_extendedprice").alias("truth"))


P = """p AS (SELECT repeat, fold, sample, row_id, prediction, correct, l_discount, estimate, truth,
 CASE WHEN prediction = 'A' THEN 1 - l_discount ELSE l_discount END AS c_a, CASE WHEN prediction = 'N' THEN 1 - l_discount ELSE l_discount END AS c_n,
 CASE WHEN prediction = 'R' THEN 1 - l_discount ELSE l_discount END AS c_r FROM (
 SELECT l_suppkey % 2 AS repeat, l_linenumber AS fold, CAST(round(l_tax * 100) AS BIGINT) % 3 AS sample, l_orderkey AS row_id,
 CASE WHEN l_quantity <= 25 THEN l_returnflag ELSE ['A', 'N', 'R'][CAST(l_partkey % 3 + 1 AS INT)] END AS prediction, l_returnflag AS correct,
 l_discount, l_quantity * 1500 AS estimate, l_extendedprice AS truth FROM lineitem))"""
FOLDS = "(row_number() OVER (PARTITION BY r.repeat, label ORDER BY md5('{seed}-' || r.repeat || '-' || rowid), rowid) - 1) % {k}"
POINT_FOLDS = f"SELECT r.repeat, rowid, CAST({FOLDS.format(seed=3, k=5)} AS INT) AS fold FROM points, (SELECT unnest(range({{n}})) AS repeat) r"


@query("spl_03_cross_validation", needs=["points"], sql=POINT_FOLDS.format(n=3))
def _(r):
    return splits.cross_validation(r.points().select("rowid", "label"), 3, 5, seed=3, stratify="label")


@query("spl_03_cross_validation_plain", sql="""
SELECT 0 AS repeat, o_orderkey AS rowid, CAST((row_number() OVER (ORDER BY md5('5-0-' || o_orderkey), o_orderkey) - 1) % 10 AS INT) AS fold FROM orders""")
def _(r):
    return splits.cross_validation(r.table("orders").select(F.col("o_orderkey").alias("rowid")), 1, 10, seed=5)


@query("spl_04_holdout", sql="""
SELECT 0 AS repeat, rowid, 0 AS fold, CASE WHEN rk < round(0.33 * n) THEN 'TEST' ELSE 'TRAIN' END AS type FROM (
SELECT o_orderkey AS rowid, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('9-0-' || o_orderkey), o_orderkey) - 1 AS rk,
 count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)""")
def _(r):
    rows = r.table("orders").select(F.col("o_orderkey").alias("rowid"), F.col("o_orderstatus").alias("label"))
    return splits.holdout(rows, 0.33, seed=9, stratify="label")


@query("spl_05_learning_curve", sql="""
WITH f AS (SELECT o_orderkey AS rowid, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('1-0-' || o_orderkey), o_orderkey) - 1) % 3 AS INT) AS t FROM orders),
tr AS (SELECT k.fold, rowid, row_number() OVER (PARTITION BY k.fold ORDER BY md5('1-train-' || rowid), rowid) - 1 AS rk FROM f JOIN (SELECT unnest([0, 1, 2]) AS fold) k ON k.fold <> f.t),
s AS (SELECT * FROM (VALUES (0, 64), (1, 91), (2, 5000)) v(sample, size))
SELECT 0 AS repeat, fold, sample, 'TRAIN' AS type, rowid FROM tr JOIN s ON rk < size
UNION ALL SELECT 0, t, sample, 'TEST', rowid FROM f, s""")
def _(r):
    rows = r.table("orders").select(F.col("o_orderkey").alias("rowid"), F.col("o_orderstatus").alias("label"))
    return splits.learning_curve(rows, 3, [64, 91, 5000], seed=1, stratify="label")


def line_splits(r):
    """A split table read off lineitem, overlaps and all."""
    return r.table("lineitem").select(
        (F.col("l_suppkey") % 2).alias("repeat"), F.col("l_linenumber").alias("fold"), F.lit(0).alias("sample"),
        F.when(F.col("l_quantity") < 6, "TEST").otherwise("TRAIN").alias("type"), F.col("l_orderkey").alias("rowid"))


S = "s AS (SELECT l_suppkey % 2 AS repeat, l_linenumber AS fold, 0 AS sample, CASE WHEN l_quantity < 6 THEN 'TEST' ELSE 'TRAIN' END AS type, l_orderkey AS rowid FROM lineitem)"


@query("spl_01_cell", sql=f"WITH {S} SELECT type, rowid FROM s WHERE repeat = 1 AND fold = 3 AND sample = 0")
def _(r):
    return splits.cell(line_splits(r), repeat=1, fold=3)


@query("spl_02_dimensions", sql=f"""
WITH {S} SELECT count(*) AS repeats, CASE WHEN min(f) = max(f) THEN max(f) END AS folds, max(n) AS samples
FROM (SELECT repeat, count(DISTINCT fold) AS f, count(DISTINCT sample) AS n FROM s GROUP BY 1)""")
def _(r):
    return splits.dimensions(line_splits(r))


@query("spl_06_violations", sql=f"""
WITH {S}, pr AS (SELECT repeat, fold, sample, rowid, count(*) FILTER (WHERE type = 'TEST') AS t, count(*) AS c FROM s GROUP BY 1, 2, 3, 4)
SELECT 'overlap' AS "check", repeat, fold, sample, count(*) AS n FROM pr WHERE c > 1 GROUP BY 2, 3, 4
UNION ALL SELECT 'not tested once', repeat, NULL, sample, count(*) FROM (SELECT repeat, sample, rowid FROM pr GROUP BY 1, 2, 3 HAVING sum(t) <> 1) GROUP BY 2, 4
UNION ALL SELECT 'incomplete', repeat, fold, sample, 6000 - count(*) FROM pr GROUP BY 2, 3, 4 HAVING count(*) <> 6000""")
def _(r):
    return splits.violations(line_splits(r), 6000)


@query("spl_06_generated_split_is_sound", sql="""
SELECT 'incomplete' AS "check", i AS repeat, j AS fold, 0 AS sample, 1 AS n FROM (SELECT unnest(range(2)) AS i), (SELECT unnest(range(5)) AS j)""")
def _(r):
    made = splits.cross_validation(r.points().select("rowid", "label"), 2, 5, seed=3, stratify="label")
    long = splits.long_form(made, 5).withColumn("sample", F.lit(0))
    return splits.violations(long, r.points().count() + 1)


@query("set_05_split_difference", sql=f"""
WITH {S}, o AS (SELECT repeat, fold, sample, CASE WHEN rowid % 10 = 0 THEN 'TEST' ELSE type END AS type, rowid FROM s)
SELECT *, 'left' AS side FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM o) UNION ALL SELECT *, 'right' FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM s)""")
def _(r):
    s = line_splits(r)
    other = s.withColumn("type", F.when(F.col("rowid") % 10 == 0, "TEST").otherwise(F.col("type")))
    return splits.difference(s, other)


@query("agg_02_metric_by_fold", sql=f"""
WITH {P} SELECT repeat, fold, round(avg((prediction = correct)::INT), 9) AS value FROM p
WHERE (repeat, fold, sample) IN (SELECT (repeat, fold, max(sample)) FROM p GROUP BY repeat, fold) GROUP BY 1, 2""")
def _(r):
    return round_to(scores.metric_by_fold(predictions(r), [], scores.accuracy()), 9, "value")


class Median:
    """The median absolute error from counts of distinct errors, as an example of a metric in parts."""

    def partial(self, truth, prediction):
        values, counts = np.unique(np.abs(prediction - truth), return_counts=True)
        return values, counts

    def merge(self, a, b):
        values, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
        return values, np.bincount(at, weights=np.concatenate([a[1], b[1]])).astype(np.int64)

    def finish(self, state):
        values, upto = state[0], np.cumsum(state[1])
        low, high = (values[np.searchsorted(upto, k, side="right")] for k in ((upto[-1] - 1) // 2, upto[-1] // 2))
        return (low + high) / 2


@query("agg_02_python_metric", sql=f"""
WITH {P} SELECT repeat, fold, round(quantile_cont(abs(estimate - truth), 0.5), 4) AS value FROM p
WHERE (repeat, fold, sample) IN (SELECT (repeat, fold, max(sample)) FROM p GROUP BY repeat, fold) GROUP BY 1, 2""")
def _(r):
    p = predictions(r).withColumn("prediction", F.col("estimate"))
    return round_to(scores.python_metric_by_fold(p, [], "truth", Median()), 4, "value")


@query("agg_02_domain_violations", sql=f"""
WITH {P} SELECT 'prediction' AS "column", prediction AS label, count(*) AS n FROM p WHERE prediction NOT IN ('A', 'R') GROUP BY 2
UNION ALL SELECT 'correct', correct, count(*) FROM p WHERE correct NOT IN ('A', 'R') GROUP BY 2""")
def _(r):
    return scores.domain_violations(predictions(r), ["A", "R"])


@query("agg_03_regression_errors", sql=f"""
WITH {P} SELECT repeat, fold, sample, round(avg(abs(estimate - truth)), 5) AS mae, round(sqrt(avg((estimate - truth) * (estimate - truth))), 5) AS rmse FROM p GROUP BY 1, 2, 3""")
def _(r):
    p = predictions(r).withColumn("prediction", F.col("estimate"))
    both = p.groupBy("repeat", "fold", "sample").agg(scores.mean_absolute_error().alias("mae"), scores.root_mean_squared_error().alias("rmse"))
    return round_to(both, 5, "mae", "rmse")


_CLASS = f"""WITH {P}, l AS (SELECT repeat, fold, c AS label, count(*) FILTER (WHERE correct = c) AS actual, count(*) FILTER (WHERE prediction = c) AS predicted,
 count(*) FILTER (WHERE prediction = c AND correct = c) AS hits FROM p, (SELECT unnest(['A', 'N', 'R']) AS c) GROUP BY 1, 2, 3),
 k AS (SELECT *, coalesce(hits / nullif(predicted, 0), 0) AS pr, coalesce(hits / nullif(actual, 0), 0) AS re, coalesce(2 * hits / nullif(actual + predicted, 0), 0) AS f FROM l)"""


@query("agg_03_classification_summary", sql=f"""{_CLASS}
SELECT repeat, fold, round(sum(hits) / sum(actual), 9) AS accuracy,
 round((sum(hits) / sum(actual) - sum(actual * predicted) / (sum(actual) * sum(actual))) / (1 - sum(actual * predicted) / (sum(actual) * sum(actual))), 9) AS kappa,
 round(avg(pr), 9) AS macro_precision, round(avg(re), 9) AS macro_recall, round(avg(f), 9) AS macro_f1,
 round(sum(actual * pr) / sum(actual), 9) AS weighted_precision, round(sum(actual * re) / sum(actual), 9) AS weighted_recall, round(sum(actual * f) / sum(actual), 9) AS weighted_f1
FROM k GROUP BY 1, 2""")
def _(r):
    out = scores.classification_summary(scores.confusion(predictions(r), ["repeat", "fold"]), ["repeat", "fold"])
    return round_to(out, 9, *[c for c in out.columns if c not in ("repeat", "fold")])


@query("agg_03_weighted_auc", sql=f"""
WITH {P}, s AS (SELECT repeat, fold, c AS label, correct = c AS own, CASE c WHEN 'A' THEN c_a WHEN 'N' THEN c_n ELSE c_r END AS score FROM p, (SELECT unnest(['A', 'N', 'R']) AS c)),
k AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY repeat, fold, label, score) - 1) / 2 AS rk FROM s WINDOW w AS (PARTITION BY repeat, fold, label ORDER BY score)),
a AS (SELECT repeat, fold, label, count(*) FILTER (WHERE own) AS np, (sum(rk) FILTER (WHERE own) - count(*) FILTER (WHERE own) * (count(*) FILTER (WHERE own) + 1) / 2)
 / (count(*) FILTER (WHERE own) * count(*) FILTER (WHERE NOT own)) AS auc FROM k GROUP BY 1, 2, 3)
SELECT repeat, fold, round(sum(auc * np) / sum(np), 9) AS auc FROM a GROUP BY 1, 2""")
def _(r):
    return round_to(scores.weighted_auc(predictions(r), ["repeat", "fold"], CLASSES), 9, "auc")


@query("agg_04_class_scores", sql=f"""{_CLASS}
SELECT repeat, fold, label, actual, predicted, hits, round(pr, 9) AS precision, round(re, 9) AS recall, round(f, 9) AS f1 FROM k""")
def _(r):
    return round_to(scores.class_scores(scores.confusion(predictions(r), ["repeat", "fold"]), ["repeat", "fold"]), 9, "precision", "recall", "f1")


_CENTROID = f"""f AS ({POINT_FOLDS.format(n=2)}),
x AS (SELECT repeat, fold, rowid, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM points JOIN f USING (rowid)),
cell AS (SELECT DISTINCT repeat, fold FROM f),
c AS (SELECT cell.repeat, cell.fold, x.label, i, avg(v) AS m FROM cell JOIN x ON x.repeat = cell.repeat AND x.fold <> cell.fold GROUP BY 1, 2, 3, 4),
d AS (SELECT x.repeat, x.fold, x.rowid, x.label, c.label AS guess, sum((v - m) * (v - m)) AS dist FROM x JOIN c ON c.repeat = x.repeat AND c.fold = x.fold AND c.i = x.i GROUP BY 1, 2, 3, 4, 5),
pred AS (SELECT repeat, fold, 0 AS sample, rowid AS row_id, guess AS prediction, label AS correct FROM d
 QUALIFY row_number() OVER (PARTITION BY repeat, fold, rowid ORDER BY dist, guess) = 1)"""


def centroid_run(r):
    points = r.points()
    folds = splits.cross_validation(points.select("rowid", "label"), 2, 5, seed=3, stratify="label")
    return models.nearest_centroid(points, folds, dims=64)


@query("run_02_nearest_centroid", needs=["points"], sql=f"WITH {_CENTROID} SELECT * FROM pred")
def _(r):
    return centroid_run(r)


@query("run_02_majority_class", needs=["points"], sql=f"""
WITH f AS ({POINT_FOLDS.format(n=2)}), x AS (SELECT * FROM points JOIN f USING (rowid)), cell AS (SELECT DISTINCT repeat, fold FROM f),
c AS (SELECT cell.repeat, cell.fold, x.label FROM cell JOIN x ON x.repeat = cell.repeat AND x.fold <> cell.fold GROUP BY 1, 2, 3
 QUALIFY row_number() OVER (PARTITION BY cell.repeat, cell.fold ORDER BY count(*) DESC, x.label) = 1)
SELECT x.repeat, x.fold, 0 AS sample, rowid AS row_id, c.label AS prediction, x.label AS correct FROM x JOIN c ON c.repeat = x.repeat AND c.fold = x.fold""")
def _(r):
    folds = splits.cross_validation(r.points().select("rowid", "label"), 2, 5, seed=3, stratify="label")
    return models.majority_class(r.points(), folds)


@query("run_02_mean_regressor", needs=["line_rows"], sql="""
WITH f AS (SELECT rowid, l_extendedprice AS y, CAST((row_number() OVER (ORDER BY md5('2-0-' || rowid), rowid) - 1) % 5 AS INT) AS fold FROM line_rows),
t AS (SELECT sum(y) AS s, count(*) AS n FROM f), m AS (SELECT fold, sum(y) AS s, count(*) AS n FROM f GROUP BY 1)
SELECT 0 AS repeat, f.fold, rowid AS row_id, round((t.s - m.s) / (t.n - m.n), 4) AS prediction, y AS truth FROM f JOIN m ON m.fold = f.fold, t""")
def _(r):
    rows = r.line_rows().select("rowid", F.col("l_extendedprice").alias("y"))
    folds = splits.cross_validation(rows.select("rowid"), 1, 5, seed=2)
    return round_to(models.mean_regressor(rows, folds), 4, "prediction")


@query("run_03_format_predictions", needs=["points"], sql=f"""
WITH {_CENTROID} SELECT repeat, fold, sample, row_id, CAST(prediction AS VARCHAR) AS prediction, CAST(correct AS VARCHAR) AS correct,
 {", ".join(f'CAST(prediction = {d} AS INT) AS "confidence.{d}"' for d in DIGITS)} FROM pred""")
def _(r):
    text = centroid_run(r).withColumns({"prediction": F.col("prediction").cast("string"), "correct": F.col("correct").cast("string")})
    return scores.format_classification(models.one_hot(text, DIGITS), DIGITS)


@query("run_04_local_measures", needs=["points"], sql=f"""
WITH {_CENTROID} SELECT 'predictive_accuracy' AS measure, repeat, fold, round(avg((prediction = correct)::INT), 9) AS value FROM pred GROUP BY 2, 3""")
def _(r):
    return round_to(scores.local_measures(centroid_run(r), "classification")[1], 9, "value")


@query("run_04_measures_per_sample", sql=f"""
WITH {P} SELECT repeat, fold, sample, 'predictive_accuracy' AS measure, round(avg((prediction = correct)::INT), 9) AS value FROM p GROUP BY 1, 2, 3""")
def _(r):
    return round_to(scores.local_measures(predictions(r), "classification")[0], 9, "value")


def placed_points(r, folds):
    rows = r.points().select("rowid", F.col("label").cast("string").alias("label"),
                             array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return models.place(rows, splits.cross_validation(rows.select("rowid", "label"), 1, folds, seed=3, stratify="label"))


@query("run_01_decision_tree")
def _(r):
    return models.run_cells(DecisionTreeClassifier(maxDepth=3, seed=1), placed_points(r, 3), [(0, f) for f in range(3)], DIGITS).predictions


@query("run_01_linear_regression", sql="""
WITH x AS (SELECT o_orderkey AS row_id, o_totalprice AS y, month(o_orderdate) AS m, CAST((row_number() OVER (ORDER BY md5('4-0-' || o_orderkey), o_orderkey) - 1) % 3 AS INT) AS fold FROM orders),
l AS (SELECT k.fold, regr_intercept(y, m) AS a, regr_slope(y, m) AS b FROM x JOIN (SELECT unnest([0, 1, 2]) AS fold) k ON k.fold <> x.fold GROUP BY 1)
SELECT 0 AS repeat, x.fold, row_id, round(l.a + l.b * m, 3) AS prediction, y AS truth FROM x JOIN l ON l.fold = x.fold""")
def _(r):
    rows = r.table("orders").select(F.col("o_orderkey").alias("rowid"), F.col("o_totalprice").alias("y"),
                                    array_to_vector(F.array(F.month("o_orderdate").cast("double"))).alias("features"))
    placed = models.place(rows, splits.cross_validation(rows.select("rowid"), 1, 3, seed=4))
    run = models.run_cells(LinearRegression(solver="normal"), placed, [(0, f) for f in range(3)])
    return round_to(scores.format_regression(run.predictions), 3, "prediction")


@query("run_01_clustering")
def _(r):
    rows = r.points().select("rowid", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    placed = models.place(rows, splits.cross_validation(rows.select("rowid"), 1, 2, seed=4))
    return scores.format_clustering(models.run_cells(KMeans(k=3, seed=1, maxIter=5), placed, [(0, 0), (0, 1)]).predictions)


def curve_points(r):
    return r.document_points().select("rowid", F.col("label").cast("string").alias("label"), array_to_vector(F.array("x")).alias("features"))


@query("run_01_learning_curve")
def _(r):
    rows = curve_points(r)
    placed = models.place_ranked(rows, splits.learning_ranks(rows.select("rowid", "label"), 2, seed=1, stratify="label"))
    cells = [(0, f, s) for f in range(2) for s in range(2)]
    return models.run_cells(DecisionTreeClassifier(maxDepth=2, seed=1), placed, cells, ["0", "1"], sizes=[50, 100]).predictions


_CURVE = """f AS (SELECT rowid, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('1-0-' || rowid), rowid) - 1) % 2 AS INT) AS fold FROM document_points),
tr AS (SELECT k.fold, rowid, label, row_number() OVER (PARTITION BY k.fold ORDER BY md5('1-train-' || rowid), rowid) - 1 AS rk FROM f JOIN (SELECT unnest([0, 1]) AS fold) k ON k.fold <> f.fold)"""


@query("run_01_learning_curve_cells", needs=["document_points"], sql=f"""
WITH {_CURVE}, s AS (SELECT unnest([0, 1, 2]) AS sample, unnest([50, 100, 10000]) AS size),
m AS (SELECT fold, sample, label, count(*) AS n FROM tr JOIN s ON rk < size GROUP BY ALL), best AS (SELECT fold, sample, arg_min(label, (-n, label)) AS label FROM m GROUP BY 1, 2)
SELECT b.fold, b.sample, f.rowid AS row_id, CAST(b.label AS VARCHAR) AS prediction, CAST(f.label AS VARCHAR) AS correct FROM best b JOIN f ON f.fold = b.fold""")
def _(r):
    """A tree without splits predicts the majority of its prefix, which tells the TRAIN rows of every cell."""
    rows = curve_points(r)
    placed = models.place_ranked(rows, splits.learning_ranks(rows.select("rowid", "label"), 2, seed=1, stratify="label"))
    cells = [(0, f, s) for f in range(2) for s in range(3)]
    run = models.run_cells(DecisionTreeClassifier(maxDepth=0, seed=1), placed, cells, ["0", "1"], sizes=[50, 100, 10_000])
    return run.predictions.select("fold", "sample", "row_id", "prediction", "correct")


def _lines_sql(task: str) -> str:
    return f"""
WITH x AS (SELECT {task} AS task_id, l_linenumber % 2 AS part, l_orderkey * 10 + l_linenumber AS row_id, CAST(l_quantity AS BIGINT) AS q, CAST(round(l_extendedprice * 100) AS BIGINT) AS y FROM lineitem),
s AS (SELECT task_id, part, count(*) AS n, sum(q) AS sq, sum(y) AS sy, sum(q * y) AS sqy, sum(q * q) AS sqq FROM x GROUP BY 1, 2),
m AS (SELECT task_id, part, CAST(sum(n) OVER t - n AS DOUBLE) AS n, CAST(sum(sq) OVER t - sq AS DOUBLE) AS sq, CAST(sum(sy) OVER t - sy AS DOUBLE) AS sy,
  CAST(sum(sqy) OVER t - sqy AS DOUBLE) AS sqy, CAST(sum(sqq) OVER t - sqq AS DOUBLE) AS sqq FROM s WINDOW t AS (PARTITION BY task_id))
SELECT x.task_id, x.part AS fold, x.row_id, CASE WHEN n * sqq - sq * sq > 0 THEN round((sy * sqq - sq * sqy + (n * sqy - sq * sy) * q) / (n * sqq - sq * sq), 3) WHEN n > 0 THEN round(sy / n, 3) END AS prediction,
 CAST(x.y AS DOUBLE) AS truth FROM x JOIN m ON m.task_id = x.task_id AND m.part = x.part"""


def _lines(r, task):
    """A least-squares line per task and fold, in whole cents; a row's fold is its line number's parity."""
    rows = r.table("lineitem").select(
        task.alias("task_id"), (F.col("l_linenumber") % 2).alias("fold"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rowid"),
        F.col("l_quantity").cast("long").alias("q"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("y"))
    return round_to(models.fit_lines(rows, ["task_id"], "fold", "q", "y"), 3, "prediction")


@query("run_01_many_small_tasks", sql=_lines_sql("l_partkey"))
def _(r):
    return _lines(r, F.col("l_partkey"))


@query("run_01_one_large_task", sql=_lines_sql("CAST(0 AS BIGINT)"))
def _(r):
    return _lines(r, F.lit(0).cast("long"))


@query("run_01_lines_of_fractions", sql="""
WITH x AS (SELECT CASE WHEN l_partkey % 10 > 0 THEN l_partkey END AS task_id, l_linenumber % 3 AS part, l_orderkey * 10 + l_linenumber AS row_id, CASE WHEN l_tax < 0.08 THEN l_discount END AS a, l_extendedprice AS b FROM lineitem),
cell AS (SELECT DISTINCT task_id, part FROM x),
m AS (SELECT c.task_id, c.part, CASE WHEN min(a) < max(a) THEN regr_slope(b, a) END AS slope, avg(a) AS ma, avg(b) AS mb
 FROM cell c JOIN x ON x.task_id IS NOT DISTINCT FROM c.task_id AND x.part <> c.part AND a IS NOT NULL GROUP BY 1, 2)
SELECT x.task_id, x.part AS fold, x.row_id, CASE WHEN a IS NOT NULL THEN round(mb + coalesce(slope * (a - ma), 0) + 0.0137, 1) END AS prediction, b AS truth
FROM x LEFT JOIN m ON m.task_id IS NOT DISTINCT FROM x.task_id AND m.part = x.part""")
def _(r):
    """Lines through discounts and prices as they are, with parts without a key as one task and rows without a discount.

    Predictions are shifted before they are rounded, since means of few prices lie on halves.
    """
    rows = r.table("lineitem").select(
        F.when(F.col("l_partkey") % 10 > 0, F.col("l_partkey")).alias("task_id"), (F.col("l_linenumber") % 3).alias("fold"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rowid"), F.when(F.col("l_tax") < 0.08, F.col("l_discount")).alias("a"), F.col("l_extendedprice").alias("b"))
    lines = models.fit_lines(rows, ["task_id"], "fold", "a", "b")
    return round_to(lines.withColumn("prediction", F.col("prediction") + 0.0137), 1, "prediction")


def _cells(r, *columns):
    """Lines by part, those of every tenth part as one cell without a key; a row's fold is its order's remainder."""
    return r.table("lineitem").select(
        F.when(F.col("l_partkey") % 10 > 0, F.col("l_partkey")).alias("task_id"), (F.col("l_orderkey") % 3).alias("fold"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rowid"), *columns)


@query("run_01_bayes_per_part", sql="""
WITH x AS (SELECT CASE WHEN l_partkey % 10 > 0 THEN l_partkey END AS task_id, l_orderkey % 3 AS fold, l_orderkey * 10 + l_linenumber AS row_id, l_linestatus AS s,
  CASE WHEN l_linenumber < 7 THEN CAST(l_linenumber AS VARCHAR) END AS k, l_returnflag AS y, row_number() OVER () AS i FROM lineitem),
cell AS (SELECT DISTINCT task_id, fold FROM x), label AS (SELECT unnest(['A', 'N', 'R']) AS c),
tr AS (SELECT cell.task_id, cell.fold, x.s, x.k, x.y FROM cell JOIN x ON x.task_id IS NOT DISTINCT FROM cell.task_id AND x.fold <> cell.fold),
n AS (SELECT task_id, fold, count(*) AS n FROM tr GROUP BY 1, 2),
nc AS (SELECT n.task_id, n.fold, c, n, (SELECT count(*) FROM tr WHERE tr.task_id IS NOT DISTINCT FROM n.task_id AND tr.fold = n.fold AND y = c) AS nc FROM n, label),
ns AS (SELECT task_id, fold, y AS c, s, count(*) AS m FROM tr GROUP BY ALL), nk AS (SELECT task_id, fold, y AS c, k, count(*) AS m FROM tr WHERE k IS NOT NULL GROUP BY ALL),
kt AS (SELECT task_id, fold, c, sum(m) AS t FROM nk GROUP BY ALL),
sc AS (SELECT x.task_id, x.fold, x.row_id, x.i, x.y, nc.c, round(ln((nc + 1.0) / (n + 3.0)) + (ln((coalesce(ns.m, 0) + 1.0) / (nc + 2.0))
   + CASE WHEN x.k IS NULL THEN 0 ELSE ln((coalesce(nk.m, 0) + 1.0) / (coalesce(kt.t, 0) + 6.0)) END), 9) AS score
 FROM x JOIN nc ON nc.task_id IS NOT DISTINCT FROM x.task_id AND nc.fold = x.fold
 LEFT JOIN ns ON ns.task_id IS NOT DISTINCT FROM x.task_id AND ns.fold = x.fold AND ns.c = nc.c AND ns.s = x.s
 LEFT JOIN nk ON nk.task_id IS NOT DISTINCT FROM x.task_id AND nk.fold = x.fold AND nk.c = nc.c AND nk.k = x.k
 LEFT JOIN kt ON kt.task_id IS NOT DISTINCT FROM x.task_id AND kt.fold = x.fold AND kt.c = nc.c)
SELECT task_id, fold, row_id, c AS prediction, y AS truth FROM (SELECT *, row_number() OVER (PARTITION BY task_id, fold, row_id, i ORDER BY score DESC, c) AS place FROM sc) WHERE place = 1
UNION ALL SELECT task_id, fold, row_id, NULL, y FROM x WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.task_id IS NOT DISTINCT FROM x.task_id AND n.fold = x.fold)""")
def _(r):
    rows = _cells(r, F.col("l_linestatus").alias("s"), F.when(F.col("l_linenumber") < 7, F.col("l_linenumber").cast("string")).alias("k"), F.col("l_returnflag").alias("y"))
    model = mergeable.CountedBayes("y", {"s": ["F", "O"], "k": ["1", "2", "3", "4", "5", "6"]}, ["A", "N", "R"])
    return mergeable.cross_validated(model, rows, ["task_id"], "fold", "y", ["s", "k"])


@query("run_01_ridge_per_part", sql="""
WITH x AS (SELECT CASE WHEN l_partkey % 10 > 0 THEN l_partkey END AS task_id, l_orderkey % 3 AS fold, l_orderkey * 10 + l_linenumber AS row_id, l_quantity AS a, l_extendedprice AS b FROM lineitem),
cell AS (SELECT DISTINCT task_id, fold FROM x),
m AS (SELECT c.task_id, c.fold, covar_pop(b, a) * count(*) / (var_pop(a) * count(*) + 10) AS slope, avg(a) AS ma, avg(b) AS mb
 FROM cell c JOIN x ON x.task_id IS NOT DISTINCT FROM c.task_id AND x.fold <> c.fold GROUP BY 1, 2)
SELECT x.task_id, x.fold, x.row_id, round(mb + slope * (a - ma), 1) AS prediction, b AS truth FROM x LEFT JOIN m ON m.task_id IS NOT DISTINCT FROM x.task_id AND m.fold = x.fold""")
def _(r):
    rows = _cells(r, F.col("l_quantity").alias("a"), F.col("l_extendedprice").alias("b"))
    return round_to(mergeable.cross_validated(mergeable.RidgeLine("b", ["a"], penalty=10.0), rows, ["task_id"], "fold", "b", ["a"], "double"), 1, "prediction")


def _sound(predictions, labels, *keys):
    """Rows of a prediction table without the prediction itself, and whether label and confidences are sound."""
    confidences = [F.col(f"`confidence.{v}`") for v in labels]
    total = sum(confidences[1:], confidences[0])
    highest = F.greatest(*confidences) == F.element_at(F.create_map(*[x for v, c in zip(labels, confidences, strict=True) for x in (F.lit(v), c)]), F.col("prediction"))
    return predictions.select(*keys, "row_id", "correct", F.col("prediction").isin(labels).alias("in_domain"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"), highest.alias("is_highest"))


@query("run_01_decision_tree_soundness", needs=["points"], sql=f"""
WITH f AS ({POINT_FOLDS.replace('% 5', '% 3').format(n=1)}) SELECT repeat, fold, 0 AS sample, rowid AS row_id, CAST(label AS VARCHAR) AS correct, true AS in_domain, true AS sums_to_one, true AS is_highest FROM f JOIN points USING (rowid)""")
def _(r):
    run = models.run_cells(DecisionTreeClassifier(maxDepth=3, seed=1), placed_points(r, 3), [(0, f) for f in range(3)], DIGITS)
    return _sound(run.predictions, DIGITS, "repeat", "fold", "sample")


@query("run_01_clustering_soundness", sql="""
SELECT 0 AS repeat, CAST((row_number() OVER (ORDER BY md5('4-0-' || vec_id), vec_id) - 1) % 2 AS INT) AS fold, vec_id AS row_id, true AS in_range FROM embeddings""")
def _(r):
    rows = r.points().select("rowid", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    placed = models.place(rows, splits.cross_validation(rows.select("rowid"), 1, 2, seed=4))
    found = models.run_cells(KMeans(k=3, seed=1, maxIter=5), placed, [(0, 0), (0, 1)]).predictions
    return scores.format_clustering(found).select("repeat", "fold", "row_id", F.col("cluster").between(0, 2).alias("in_range"))


@query("run_05_timings_soundness", sql="""
SELECT 0 AS repeat, f AS fold, 0 AS sample, m AS measure, true AS sound FROM (SELECT unnest([0, 1]) AS f), (SELECT unnest(['wall_clock_time_millis_training', 'wall_clock_time_millis_testing', 'wall_clock_time_millis']) AS m)""")
def _(r):
    run = models.run_cells(DecisionTreeClassifier(maxDepth=1, seed=1), placed_points(r, 2), [(0, 0), (0, 1)], DIGITS)
    part = F.when(F.col("measure") == "wall_clock_time_millis", 0.0).otherwise(F.col("seconds"))
    whole = F.when(F.col("measure") == "wall_clock_time_millis", F.col("seconds")).otherwise(0.0)
    rows = run.timing_rows()
    adds_up = rows.groupBy("repeat", "fold", "sample").agg((F.abs(F.sum(part) - F.sum(whole)) < 1e-6).alias("adds_up"))
    return rows.join(adds_up, ["repeat", "fold", "sample"]).select("repeat", "fold", "sample", "measure", ((F.col("seconds") >= 0) & F.col("adds_up")).alias("sound"))


@query("run_07_search_soundness", sql="SELECT 0 AS repeat, f AS fold, 2 AS candidates, 1 AS chosen, true AS chosen_is_best, 'max_depth' AS parameter FROM (SELECT unnest([0, 1]) AS f)")
def _(r):
    rows = curve_points(r)
    placed = models.place(rows, splits.cross_validation(rows.select("rowid", "label"), 1, 2, seed=3, stratify="label"))
    candidates = [({"max_depth": d}, DecisionTreeClassifier(maxDepth=d, seed=1)) for d in (1, 3)]
    trace = models.search(candidates, placed, [(0, 0), (0, 1)], ["0", "1"], inner_folds=2)[0]
    first = F.min(F.when(F.col("selected"), F.struct(-F.col("evaluation"), "iteration")))
    return trace.groupBy("repeat", "fold").agg(
        F.count(F.lit(1)).cast("int").alias("candidates"), F.count_if("selected").cast("int").alias("chosen"),
        (first == F.min(F.struct(-F.col("evaluation"), "iteration"))).alias("chosen_is_best"), F.replace(F.min(F.map_keys("parameters")[0]), F.lit("parameter_"), F.lit("")).alias("parameter"))


@query("run_08_surrogate_soundness", needs=["evaluations", "setups"], sql="""
SELECT e.run_id, CAST(s.tax AS DOUBLE) AS tax, s.ship, e.value, true AS within FROM (SELECT run_id, setup_id, value FROM evaluations WHERE function = 'A') e JOIN setups s ON s.setup_id = e.setup_id""")
def _(r):
    """The surrogate's predictions lie within the values it has seen."""
    evals = lookups.evaluations_setups(r.evaluations().filter("function = 'A'"), r.setup_parameters())
    named = F.transform_keys("parameters", lambda k, _: F.substring_index(k, "_", -1))
    frame = evals.select("run_id", "value", named["tax"].try_cast("double").alias("tax"), named["ship"].alias("ship"))
    out = models.surrogate(frame, ["tax"], ["ship"], "value")[1]
    ends = frame.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    return out.join(F.broadcast(ends)).select("run_id", "tax", "ship", F.round("value", 6).alias("value"), F.col("prediction").between(F.col("lo") - 1e-9, F.col("hi") + 1e-9).alias("within"))  # one row


@query("agg_07_landmarkers_soundness", sql="""
SELECT l || m AS name, true AS sound FROM (SELECT unnest(['DecisionStump', 'REPTreeDepth2', 'NaiveBayes']) AS l), (SELECT unnest(['AUC', 'ErrRate', 'Kappa']) AS m)""")
def _(r):
    found = models.landmarkers([("DecisionStump", DecisionTreeClassifier(maxDepth=1, seed=1)), ("REPTreeDepth2", DecisionTreeClassifier(maxDepth=2, seed=1)),
                                ("NaiveBayes", NaiveBayes(modelType="gaussian"))], placed_points(r, 2), [(0, 0), (0, 1)], DIGITS)
    low = F.when(F.col("name").endswith("Kappa"), -1.0).otherwise(0.0)
    return found.select("name", F.col("value").between(low, F.lit(1.0)).alias("sound"))


@query("run_05_timings")
def _(r):
    run = models.run_cells(DecisionTreeClassifier(maxDepth=1, seed=1), placed_points(r, 2), [(0, 0), (0, 1)], DIGITS)
    return run.timing_rows()


@query("run_07_search_trace")
def _(r):
    rows = r.document_points().select("rowid", F.col("label").cast("string").alias("label"), array_to_vector(F.array("x")).alias("features"))
    placed = models.place(rows, splits.cross_validation(rows.select("rowid", "label"), 1, 2, seed=3, stratify="label"))
    candidates = [({"max_depth": d}, DecisionTreeClassifier(maxDepth=d, seed=1)) for d in (1, 3)]
    return models.search(candidates, placed, [(0, 0), (0, 1)], ["0", "1"], inner_folds=2)[0]


@query("run_08_surrogate")
def _(r):
    evals = lookups.evaluations_setups(r.evaluations().filter("function = 'A'"), r.setup_parameters())
    named = F.transform_keys("parameters", lambda k, _: F.substring_index(k, "_", -1))
    frame = evals.select("run_id", "value", named["tax"].try_cast("double").alias("tax"), named["ship"].alias("ship"))
    return models.surrogate(frame, ["tax"], ["ship"], "value")[1].select("run_id", "tax", "ship", "value", "prediction")


@query("agg_07_landmarkers")
def _(r):
    learners = [("DecisionStump", DecisionTreeClassifier(maxDepth=1, seed=1)), ("REPTreeDepth2", DecisionTreeClassifier(maxDepth=2, seed=1)),
                ("NaiveBayes", NaiveBayes(modelType="gaussian"))]
    return models.landmarkers(learners, placed_points(r, 2), [(0, 0), (0, 1)], DIGITS)


_SQUARE = "list_dot_product(a.v, a.v) - 2 * list_dot_product(a.v, b.v) + list_dot_product(b.v, b.v)"
_NEAREST = f"""f AS ({POINT_FOLDS.format(n=1)}), x AS MATERIALIZED (SELECT rowid, label, fold, [floor(4096 * CAST(e AS DOUBLE)) FOR e IN embedding] AS v FROM points JOIN f USING (rowid)),
d AS MATERIALIZED (SELECT a.rowid, min({{'d': {_SQUARE}, 'r': b.rowid}}) AS near FROM x a JOIN x b ON a.fold <> b.fold GROUP BY 1)"""


def whole_points(r):
    """Points with whole components, so that distances are exact."""
    whole = F.transform("embedding", lambda e: F.floor(e.cast("double") * 4096).cast("double"))
    rows = r.points().select("rowid", F.col("label").cast("string").alias("label"), whole.alias("features"))
    return rows, splits.cross_validation(rows.select("rowid", "label"), 1, 5, seed=3, stratify="label")


@query("agg_07_nearest_neighbours", needs=["points"], sql=f"WITH {_NEAREST} SELECT rowid, near.r AS neighbour, near.d AS square FROM d")
def _(r):
    rows, folds = whole_points(r)
    return neighbours.nearest(rows.join(folds.select("rowid", "fold"), "rowid"))


@query("agg_07_nearest_neighbour_landmarks", needs=["points"], sql=f"""
WITH {_NEAREST}, p AS (SELECT a.label AS correct, b.label AS prediction FROM d JOIN x a ON a.rowid = d.rowid JOIN x b ON b.rowid = d.near.r),
c AS (SELECT label, count(*) FILTER (correct = label) AS actual, count(*) FILTER (prediction = label) AS predicted, count(*) FILTER (correct = label AND prediction = label) AS hits FROM p, (SELECT DISTINCT label FROM x) GROUP BY 1),
s AS (SELECT sum(hits) / sum(actual) AS agreed, sum(actual * predicted) / (sum(actual) * sum(actual)) AS chance, sum(actual) AS n,
 sum(CASE WHEN actual > 0 AND actual < t THEN actual * ((hits / actual) + 1 - (predicted - hits) / (t - actual)) / 2 END) / sum(actual) FILTER (actual > 0 AND actual < t) AS auc
 FROM c, (SELECT count(*) AS t FROM p))
SELECT 'kNN1NErrRate' AS name, round(1 - agreed, 9) AS value FROM s UNION ALL SELECT 'kNN1NKappa', round((agreed - chance) / (1 - chance), 9) FROM s UNION ALL SELECT 'kNN1NAUC', round(auc, 9) FROM s""")
def _(r):
    rows, folds = whole_points(r)
    return round_to(models.nearest_neighbour_landmarks(rows, folds, DIGITS), 9, "value")
