"""Result-analysis and trace queries (AGG without qualities and scores, WIN)."""

from pyspark.sql import functions as F

from trialbook.operators import analysis, traces
from trialbook.plans.scan import exact_quantiles
from trialbook.queries import query

_BEST = "SELECT task_id AS did, flow_id, max(value) AS value FROM evaluations WHERE function = 'A' GROUP BY 1, 2"


def best_per_flow(r, function="A"):
    return r.evaluations().filter(F.col("function") == function).groupBy(
        F.col("task_id").alias("did"), "flow_id").agg(F.max("value").alias("value"))


def round_to(df, digits, *names):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query("agg_01_evaluation_summary", needs=["lines"], sql="""
WITH f AS (SELECT run_id, function, task_id % 2 AS repeat, fold, round(avg(value), 6) AS value FROM lines GROUP BY 1, 2, 3, 4),
p AS (SELECT run_id, function, repeat, avg(value) AS m, stddev_pop(value) AS s FROM f GROUP BY 1, 2, 3)
SELECT run_id, function, printf('%.4f +- %.4f', round(avg(m), 12), round(avg(s), 12)) AS summary FROM p GROUP BY 1, 2""")
def _(r):
    folds = r.lines().groupBy("run_id", "function", (F.col("task_id") % 2).alias("repeat"), "fold").agg(F.round(F.avg("value"), 6).alias("value"))
    return analysis.evaluation_summary(folds, ["run_id", "function"])


@query("agg_05_scopes", needs=["lines"], sql="""
SELECT run_id % 50 AS run_group, function, repeat, fold, sample, round(avg(value), 9) AS value
FROM (SELECT run_id, function, flow_id % 2 AS repeat, fold, tax % 3 AS sample, value FROM lines)
GROUP BY GROUPING SETS ((run_group, function, repeat, fold, sample), (run_group, function, repeat, fold), (run_group, function))""")
def _(r):
    cells = r.lines().select(
        (F.col("run_id") % 50).alias("run_group"), "function", (F.col("flow_id") % 2).alias("repeat"), "fold",
        (F.col("tax") % 3).alias("sample"), "value")
    return round_to(analysis.scopes(cells, ["run_group", "function"]), 9, "value")


@query("agg_08_pivot_flows", needs=["evaluations"], sql=f"""
SELECT did, max(value) FILTER (WHERE flow_id = 1) AS "1", max(value) FILTER (WHERE flow_id = 2) AS "2"
FROM ({_BEST}) WHERE flow_id IN (1, 2) GROUP BY 1 HAVING count(DISTINCT flow_id) = 2""")
def _(r):
    return analysis.pivot_flows(best_per_flow(r), [1, 2], F.max("value"))


@query("agg_09_compare_pair", needs=["evaluations"], sql="""
SELECT flow_id AS did, "A", "N", round("A" - "N", 6) AS difference,
 CASE WHEN "A" - "N" > 0.001 THEN 'win' WHEN "A" - "N" < -0.001 THEN 'loss' WHEN "A" IS NOT NULL AND "N" IS NOT NULL THEN 'tie' END AS outcome
FROM (SELECT flow_id, task_id, max(value) FILTER (WHERE function = 'A') AS "A", max(value) FILTER (WHERE function = 'N') AS "N"
 FROM evaluations GROUP BY 1, 2)""")
def _(r):
    wide = r.evaluations().groupBy("task_id", F.col("flow_id").alias("did")).pivot("function", ["A", "N"]).agg(F.max("value")).drop("task_id")
    return round_to(analysis.compare_pair(wide, "A", "N", 0.001), 6, "difference")


@query("agg_09_win_counts", needs=["evaluations"], sql="""
SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN a - n > 0.001 THEN 'win' WHEN a - n < -0.001 THEN 'loss' ELSE 'tie' END AS outcome
FROM (SELECT flow_id, task_id, max(value) FILTER (WHERE function = 'A') AS a, max(value) FILTER (WHERE function = 'N') AS n
 FROM evaluations GROUP BY 1, 2) WHERE a IS NOT NULL AND n IS NOT NULL) GROUP BY 1""")
def _(r):
    wide = r.evaluations().groupBy("task_id", "flow_id").pivot("function", ["A", "N"]).agg(F.max("value")).dropna(subset=["A", "N"])
    return analysis.compare_pair(wide, "A", "N", 0.001).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("agg_10_flow_summary", needs=["evaluations"], sql="""
WITH t AS (SELECT flow_id, count(value) AS n, min(value) AS lowest, max(value) AS best FROM evaluations WHERE function = 'A'
 GROUP BY 1 ORDER BY best DESC, flow_id LIMIT 20)
SELECT t.*, q.q1, q.median, q.q3 FROM t JOIN (SELECT flow_id, round(quantile_cont(value, 0.25), 6) AS q1,
 round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3
 FROM evaluations WHERE function = 'A' GROUP BY 1) q ON q.flow_id = t.flow_id""")
def _(r):
    return round_to(analysis.flow_summary(r.evaluations().filter("function = 'A'"), 20), 6, "q1", "median", "q3")


@query("agg_10_quantiles_of_continuous_values", sql="""
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1), 6) AS p10, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
 round(quantile_cont(l_extendedprice, 0.99), 6) AS p99 FROM lineitem GROUP BY 1""")
def _(r):
    out = exact_quantiles(r.table("lineitem").select("l_returnflag", "l_extendedprice"), ["l_returnflag"], "l_extendedprice",
                          {"p10": 0.1, "p50": 0.5, "p99": 0.99})
    return round_to(out, 6, "p10", "p50", "p99")


@query("agg_11_cdf", needs=["evaluations"], sql="""
SELECT function, value, n, round(sum(n) OVER (PARTITION BY function ORDER BY value) / sum(n) OVER (PARTITION BY function), 9) AS share
FROM (SELECT function, value, count(*) AS n FROM evaluations GROUP BY 1, 2)""")
def _(r):
    return round_to(analysis.cdf(r.evaluations(), ["function"]), 9, "share")


@query("agg_11_binned_cdf", sql="""
SELECT k, bin, n, round(sum(n) OVER (PARTITION BY k ORDER BY bin) / sum(n) OVER (PARTITION BY k), 9) AS share FROM (
SELECT event_type AS k, CASE WHEN value < 0.5 THEN 0 WHEN value >= 40.5 THEN 81 ELSE CAST(floor(80 * (value - 0.5) / 40) AS INT) + 1 END AS bin,
 count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1, 2)""")
def _(r):
    e = r.table("events").select(F.col("event_type").alias("k"), "value")
    return round_to(analysis.binned_cdf(e, ["k"], 0.5, 40.5, 80), 9, "share")


@query("agg_12_landscape", sql="""
SELECT CASE WHEN x < 0 THEN 0 WHEN x >= 1.75 THEN 13 ELSE CAST(floor(12 * x / CAST(1.75 AS DOUBLE)) AS INT) + 1 END AS bx,
 CASE WHEN y < 2.5 THEN 0 WHEN y >= 5.1 THEN 13 ELSE CAST(floor(12 * (y - 2.5) / (CAST(5.1 AS DOUBLE) - CAST(2.5 AS DOUBLE))) AS INT) + 1 END AS by,
 count(*) AS n, round(avg(l_discount), 9) AS mean
FROM (SELECT log10(l_quantity) AS x, log10(l_extendedprice) AS y, l_discount FROM lineitem) GROUP BY 1, 2""")
def _(r):
    out = analysis.landscape(r.table("lineitem"), F.log10("l_quantity"), F.log10("l_extendedprice"), "l_discount", (0, 1.75), (2.5, 5.1), 12)
    return round_to(out, 9, "mean")


@query("agg_13_varying_parameters", needs=["setups"], sql="""
SELECT setup_id, CAST(tax AS DOUBLE) AS tax FROM setups""")
def _(r):
    p = r.setup_parameters().select("setup_id", F.explode(F.array(
        F.struct(F.col("parameter_name").alias("name"), F.col("value").alias("value")),
        F.struct(F.lit("constant").alias("name"), F.lit("1.5").alias("value")))).alias("p")).select("setup_id", "p.*")
    varying = analysis.varying_numeric_parameters(p)
    return analysis.widen(varying, "setup_id", varying.select("name"))


@query("agg_14_importance", sql="""
WITH b AS (SELECT p, CASE WHEN x < lo THEN 0 WHEN x >= hi THEN 9 ELSE CAST(floor(8 * (x - lo) / (hi - lo)) AS INT) + 1 END AS bin, y FROM (
 SELECT 'l_quantity' AS p, l_quantity AS x, CAST(0.5 AS DOUBLE) AS lo, CAST(50.5 AS DOUBLE) AS hi, l_extendedprice AS y FROM lineitem
 UNION ALL SELECT 'l_tax', l_tax, CAST(-0.005 AS DOUBLE), CAST(0.085 AS DOUBLE), l_extendedprice FROM lineitem)),
g AS (SELECT p, bin, count(*) AS n, avg(y) AS m FROM b GROUP BY 1, 2), t AS (SELECT p, count(*) AS n, avg(y) AS m, var_pop(y) AS v FROM b GROUP BY 1)
SELECT t.p AS parameter, t.n, round(sum(g.n * (g.m - t.m) * (g.m - t.m)) / t.n / t.v, 6) AS importance
FROM g JOIN t ON g.p = t.p GROUP BY t.p, t.n, t.v""")
def _(r):
    l = r.table("lineitem")
    a = analysis.importance(l, "l_quantity", "l_extendedprice", 0.5, 50.5, 8)
    b = analysis.importance(l, "l_tax", "l_extendedprice", -0.005, 0.085, 8)
    return round_to(a.unionByName(b), 6, "importance")


@query("agg_15_flow_ranks", needs=["evaluations"], sql=f"""
SELECT flow_id, round(avg(rank), 9) AS mean_rank, count(*) AS n_datasets FROM (
SELECT flow_id, rank() OVER (PARTITION BY did ORDER BY value DESC) AS rank FROM ({_BEST})) GROUP BY 1""")
def _(r):
    return round_to(analysis.flow_ranks(best_per_flow(r)), 9, "mean_rank")


def flagged_trace(r):
    return r.trace().withColumn("selected", F.element_at("parameters", "parameter_k").cast("int") % 40 == 0)


def map_text(column):
    return F.array_join(F.transform(F.array_sort(F.map_entries(column)), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")


@query("win_01_selected_iterations", needs=["trace"], sql="""
SELECT run_id, repeat, fold, min(iteration) FILTER (WHERE CAST(k AS INT) % 40 = 0) AS iteration FROM trace GROUP BY 1, 2, 3""")
def _(r):
    return traces.selected_iterations(flagged_trace(r))


@query("win_02_merge_traces", needs=["trace"], sql="""
WITH u AS (SELECT run_id, repeat, fold, iteration, 'k' AS names FROM trace WHERE iteration % 3 <> 0
 UNION ALL SELECT run_id, repeat, fold, iteration, CASE WHEN run_id % 4 = 0 THEN 'j' ELSE 'k' END FROM trace WHERE iteration % 3 = 0 OR iteration % 7 = 1)
SELECT run_id, 'duplicate iteration' AS problem, count(*) AS n FROM u GROUP BY run_id, repeat, fold, iteration HAVING count(*) > 1
UNION ALL SELECT run_id, 'parameter names differ', count(DISTINCT names) FROM u GROUP BY run_id HAVING count(DISTINCT names) > 1""")
def _(r):
    t = r.trace()
    renamed = F.transform_keys("parameters", lambda k, _: F.when(F.col("run_id") % 4 == 0, "parameter_j").otherwise(k))
    second = t.filter("iteration % 3 = 0 OR iteration % 7 = 1").withColumn("parameters", renamed)
    return traces.merge([t.filter("iteration % 3 <> 0"), second])[1]


@query("win_03_best_iterations", needs=["trace"], sql="""
SELECT run_id, repeat, fold, iteration, evaluation FROM trace
QUALIFY row_number() OVER (PARTITION BY run_id, repeat, fold ORDER BY evaluation DESC, iteration) = 1""")
def _(r):
    return traces.best_iterations(r.trace())


@query("win_03_mark_selected", needs=["trace"], sql="""
SELECT run_id, repeat, fold, iteration, row_number() OVER (PARTITION BY run_id, repeat, fold ORDER BY evaluation DESC, iteration) = 1 AS selected FROM trace""")
def _(r):
    return traces.mark_selected(r.trace()).select("run_id", "repeat", "fold", "iteration", "selected")


@query("win_04_incumbent", needs=["trace"], sql="""
SELECT run_id, iteration, round(min(1 - evaluation) OVER w, 6) AS incumbent, CAST(sum(CAST(k AS BIGINT)) OVER w AS BIGINT) AS elapsed
FROM trace WINDOW w AS (PARTITION BY run_id ORDER BY iteration ROWS UNBOUNDED PRECEDING)""")
def _(r):
    t = r.trace().select("run_id", "iteration", "evaluation", F.element_at("parameters", "parameter_k").cast("long").alias("k"))
    return round_to(traces.incumbent(t, ["run_id"], ["iteration"], F.col("evaluation"), F.col("k")), 6, "incumbent").select(
        "run_id", "iteration", "incumbent", "elapsed")


@query("win_05_regret", needs=["evaluations"], sql="""
SELECT e.flow_id, e.run_id, e.task_id, e.setup_id, round(1 - max(e.value) OVER (PARTITION BY e.flow_id
 ORDER BY o.o_orderdate, e.run_id, e.task_id, e.setup_id ROWS UNBOUNDED PRECEDING), 6) AS regret
FROM evaluations e JOIN orders o ON o.o_orderkey = e.run_id WHERE e.function = 'A'""")
def _(r):
    times = r.table("orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("upload_time"))
    e = r.evaluations().filter("function = 'A'").join(times, "run_id").select("flow_id", "run_id", "task_id", "setup_id", "upload_time", "value")
    out = traces.regret(e, ["flow_id"], ["upload_time", "run_id", "task_id", "setup_id"], "value")
    return round_to(out, 6, "regret").drop("upload_time", "value")


@query("win_06_trace_parameters", needs=["trace"], sql="SELECT run_id, iteration, 'k=' || k AS parameters FROM trace")
def _(r):
    return traces.parameters(r.trace()).select("run_id", "iteration", map_text("parameters").alias("parameters"))


@query("win_07_refit_time", needs=["fold_evaluations"], sql="""
SELECT run_id, repeat, fold, round(max(value) FILTER (WHERE function = 'A') - max(value) FILTER (WHERE function = 'N')
 - max(value) FILTER (WHERE function = 'R'), 6) AS refit_time FROM fold_evaluations GROUP BY 1, 2, 3""")
def _(r):
    return round_to(traces.refit_time(r.fold_evaluations(), ["run_id", "repeat", "fold"], "A", "N", "R"), 6, "refit_time")


@query("agg_13_sparse_blocks", sql="""
WITH p AS (SELECT l_suppkey AS setup_id, 'p' || (l_orderkey * 7 + l_linenumber) AS name, max(l_quantity) AS number FROM lineitem GROUP BY 1, 2),
d AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS position FROM (SELECT DISTINCT name FROM p))
SELECT setup_id, position // 1000 AS block, CAST(position % 1000 AS INTEGER) AS place, number FROM p JOIN d USING (name)""")
def _(r):
    """A parameter per order line: tens of thousands of names as blocks of a thousand columns."""
    long = r.table("lineitem").select(F.col("l_suppkey").alias("setup_id"), F.concat(F.lit("p"), (F.col("l_orderkey") * 7 + F.col("l_linenumber")).cast("string")).alias("name"), F.col("l_quantity").alias("number"))
    blocks = analysis.sparse_blocks(long, "setup_id", analysis.name_dictionary(long.select("name")), 1000)
    return blocks.select("setup_id", "block", F.explode("entries").alias("e")).select("setup_id", "block", "e.place", "e.number")
