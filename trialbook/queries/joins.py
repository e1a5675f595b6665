"""Join queries (JN)."""

from pyspark.sql import functions as F

from trialbook.operators import listing, lookups, members, splits
from trialbook.queries import query


def map_text(column):
    """A map as sorted ``key=value`` text, for comparison with SQL."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(column)), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")


@query("jn_01_evaluations_setups_top", needs=["evaluations", "setups", "flows"], sql="""
SELECT e.*, f.name || '_ship=' || s.ship || ';' || f.name || '_tax=' || s.tax AS parameters
FROM (SELECT * FROM evaluations WHERE function = 'A' ORDER BY value DESC, run_id, task_id, setup_id LIMIT 10) e
LEFT JOIN setups s ON e.setup_id = s.setup_id LEFT JOIN flows f ON s.flow_id = f.flow_id""")
def _(r):
    best = listing.top(r.evaluations().filter("function = 'A'"), "value", "desc", ["run_id", "task_id", "setup_id"], 10)
    order = [F.col("value").desc(), "run_id", "task_id", "setup_id"]
    return lookups.evaluations_setups(best, r.setup_parameters(), order, few=True).withColumn("parameters", map_text("parameters"))


@query("jn_01_evaluations_setups", needs=["evaluations", "setups", "flows"], sql="""
SELECT e.*, coalesce(f.name || '_ship=' || s.ship || ';' || f.name || '_tax=' || s.tax, '') AS parameters
FROM evaluations e LEFT JOIN setups s ON e.setup_id = s.setup_id AND s.flow_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
LEFT JOIN flows f ON s.flow_id = f.flow_id WHERE e.function = 'R'""")
def _(r):
    solvent = r.table("supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("flow_id"))
    stored = r.setup_parameters().join(solvent, "flow_id", "left_semi")
    out = lookups.evaluations_setups(r.evaluations().filter("function = 'R'"), stored)
    return out.withColumn("parameters", map_text("parameters"))


@query("jn_02_parameters_to_columns", needs=["evaluations", "setups"], sql="""
SELECT e.*, CAST(NULL AS VARCHAR) AS seed, s.ship, CAST(s.tax AS VARCHAR) AS tax FROM evaluations e
LEFT JOIN setups s ON e.setup_id = s.setup_id WHERE e.flow_id = 7""")
def _(r):
    joined = lookups.evaluations_setups(r.evaluations().filter("flow_id = 7"), r.setup_parameters().filter("flow_id = 7"))
    renamed = joined.withColumn("parameters", F.transform_keys("parameters", lambda k, _: F.substring_index(k, "_", -1)))
    return lookups.parameters_to_columns(renamed, r.flow_parameters(), 7)


@query("jn_03_evaluations_users", needs=["evaluations", "runs", "users"], sql="""
SELECT e.*, r.uploader, u.username FROM evaluations e JOIN runs r ON e.run_id = r.run_id
LEFT JOIN users u ON u.uploader = r.uploader WHERE e.function = 'N'""")
def _(r):
    evals = r.evaluations().filter("function = 'N'").join(r.runs().select("run_id", "uploader"), "run_id")
    return lookups.with_usernames(evals, r.users())[0]


@query("jn_03_unknown_uploaders", needs=["runs"], sql="""
SELECT DISTINCT uploader FROM runs WHERE uploader NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def _(r):
    solvent = r.table("customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("uploader"), F.col("c_name").alias("username"))
    return lookups.with_usernames(r.runs(), solvent)[1]


@query("jn_04_tasks_procedures", needs=["tasks", "procedures"], sql="""
SELECT t.*, p.procedure_name AS estimation_procedure FROM tasks t LEFT JOIN procedures p USING (procedure_id)""")
def _(r):
    return listing.with_procedure_names(r.tasks(), r.procedures())


@query("jn_05_flow_comparison_qualities", needs=["evaluations", "q_wide"], sql="""
SELECT e.did, e.flow_id, e.value, q."NumberOfInstances", q."NumberOfMissingValues"
FROM (SELECT task_id AS did, flow_id, max(value) AS value FROM evaluations WHERE function = 'A' GROUP BY 1, 2) e
JOIN q_wide q ON e.did = q.did""")
def _(r):
    best = r.evaluations().filter("function = 'A'").groupBy(F.col("task_id").alias("did"), "flow_id").agg(F.max("value").alias("value"))
    return lookups.flow_comparison(best, listing.quality_columns(r.qualities(), ["NumberOfInstances", "NumberOfMissingValues"]))


@query("jn_06_rows_of_cell", needs=["points"], sql="""
WITH folds AS (SELECT rowid, label, (row_number() OVER (PARTITION BY label ORDER BY md5('7-0-' || rowid), rowid) - 1) % 5 AS fold FROM points)
SELECT p.rowid, p.label, f.fold, CASE WHEN f.fold = 2 THEN 'TEST' ELSE 'TRAIN' END AS type, array_to_string(list_transform(p.embedding, lambda v: CAST(round(CAST(v AS DOUBLE) * 1000000) AS BIGINT)), ',') AS x
FROM points p JOIN folds f ON p.rowid = f.rowid""")
def _(r):
    millionths = F.transform("embedding", lambda v: F.round(v.cast("double") * 1_000_000).cast("long").cast("string"))
    rows = r.points().select("rowid", "label", F.array_join(millionths, ",").alias("x"))
    folds = splits.cross_validation(r.points().select("rowid", "label"), repeats=1, folds=5, seed=7, stratify="label")
    train, test = lookups.rows_of_cell(rows, folds, 0, 2)
    return members.concat([train.withColumn("type", F.lit("TRAIN")), test.withColumn("type", F.lit("TEST"))])


@query("jn_07_runs_exist", needs=["runs", "lines"], sql="""
WITH c AS (SELECT DISTINCT task_id, CASE WHEN ship = 'F' THEN setup_id ELSE -1 END AS setup_id FROM lines)
SELECT c.task_id, c.setup_id, r.run_id FROM c LEFT JOIN runs r ON r.task_id = c.task_id AND r.setup_id = c.setup_id AND c.setup_id > 0""")
def _(r):
    asked = r.lines().select("task_id", F.when(F.col("ship") == "F", F.col("setup_id")).otherwise(-1).alias("setup_id")).distinct()
    found, absent = lookups.runs_exist(asked, r.runs())
    return members.concat([found, absent])


@query("jn_08_flow_exists", needs=["flows"], sql="""
WITH c AS (SELECT DISTINCT 'Supplier#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS name, 'v' || (event_id % 25) AS external_version FROM events)
SELECT c.name, c.external_version, f.flow_id FROM c LEFT JOIN flows f ON f.name = c.name AND f.external_version = c.external_version""")
def _(r):
    asked = r.table("events").select(
        F.concat(F.lit("Supplier#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("name"),
        F.concat(F.lit("v"), (F.col("event_id") % 25).cast("string")).alias("external_version")).distinct()
    return lookups.flow_exists(asked, r.flows())


@query("jn_08_flow_ids_by_name", sql="""
SELECT p_name AS name, p_brand AS external_version, p_partkey AS flow_id FROM part WHERE p_name IN (SELECT p_name FROM part WHERE p_size = 50)""")
def _(r):
    flows = r.table("part").select(F.col("p_name").alias("name"), F.col("p_brand").alias("external_version"), F.col("p_partkey").alias("flow_id"))
    return lookups.flow_ids(r.table("part").filter("p_size = 50").select(F.col("p_name").alias("name")), flows)


@query("jn_09_setups_exist", needs=["setups"], sql="""
WITH c AS (SELECT DISTINCT l_suppkey AS flow_id, l_linenumber AS tax, l_linestatus AS ship FROM lineitem)
SELECT c.flow_id, 'ship=' || c.ship || ';tax=' || c.tax AS parameters, s.setup_id FROM c
LEFT JOIN setups s ON s.flow_id = c.flow_id AND s.tax = c.tax AND s.ship = c.ship""")
def _(r):
    asked = r.table("lineitem").select(F.col("l_suppkey").alias("flow_id"), F.col("l_linenumber").cast("string").alias("tax"), F.col("l_linestatus").alias("ship")).distinct()
    asked = asked.select("flow_id", F.create_map(F.lit("ship"), F.col("ship"), F.lit("tax"), F.col("tax")).alias("parameters"))
    return lookups.setups_exist(asked, r.setups()).withColumn("parameters", map_text("parameters"))


@query("jn_10_equal_tasks", needs=["tasks"], sql="""
WITH stored AS (SELECT *, CASE WHEN ttid = 1 THEN NULL ELSE 'rmse' END AS measure FROM tasks),
c AS (SELECT DISTINCT l_partkey AS did, l_linenumber AS procedure_id, CASE WHEN l_linestatus = 'F' THEN 'rmse' END AS measure FROM lineitem)
SELECT c.did, c.procedure_id, c.measure, s.task_id FROM c LEFT JOIN stored s
ON s.did = c.did AND s.procedure_id = c.procedure_id AND s.measure IS NOT DISTINCT FROM c.measure""")
def _(r):
    stored = r.tasks().withColumn("measure", F.when(F.col("ttid") != 1, "rmse"))
    asked = r.table("lineitem").select(
        F.col("l_partkey").alias("did"), F.col("l_linenumber").alias("procedure_id"),
        F.when(F.col("l_linestatus") == "F", "rmse").alias("measure")).distinct()
    return lookups.equal_tasks(asked, stored, ["did", "procedure_id", "measure"])
