"""Flow queries (FLW)."""

from pyspark.sql import functions as F

from trialbook.operators import flows, traces
from trialbook.queries import query
from trialbook.queries.analysis import flagged_trace, map_text

TREE = """WITH RECURSIVE tree AS (SELECT flow_id AS root_id, '' AS path, flow_id, 0 AS depth FROM flows
 UNION ALL SELECT t.root_id, CASE WHEN t.depth = 0 THEN e.identifier ELSE t.path || '.' || e.identifier END, e.child, t.depth + 1 FROM tree t JOIN flow_edges e ON e.parent = t.flow_id)"""

# Ways down chains of a hundred flows.
CHAINS = """WITH RECURSIVE chain AS (SELECT p_partkey AS root_id, '' AS path, p_partkey AS flow_id, 0 AS depth FROM part
 UNION ALL SELECT c.root_id, CASE WHEN c.depth = 0 THEN e.identifier ELSE c.path || '.' || e.identifier END, e.child, c.depth + 1 FROM chain c JOIN chain_edges e ON e.parent = c.flow_id)"""


def tree_of(r):
    return flows.components(r.flows(), r.flow_edges())


@query("flw_01_components", needs=["flows", "flow_edges"], sql=f"{TREE} SELECT * FROM tree")
def _(r):
    return tree_of(r).withColumn("path", F.concat_ws(".", "path"))


@query("flw_01_chains", needs=["chain_edges"], sql=f"{CHAINS} SELECT root_id, md5(path) AS path, flow_id, depth FROM chain")
def _(r):
    """Chains of a hundred flows, with a round of joins per binary digit of the depth."""
    tree = flows.components(r.table("part").select(F.col("p_partkey").alias("flow_id")), r.chain_edges())
    return tree.withColumn("path", F.md5(F.concat_ws(".", "path")))


@query("flw_02_subflow", needs=["flows", "flow_edges"], sql=f"{TREE} SELECT root_id, flow_id FROM tree WHERE path = 'left.right'")
def _(r):
    return flows.subflow(tree_of(r), ["left", "right"])


def attribute_rows(r, changed):
    """Long form of the flows; ``changed`` gives the second side of a comparison."""
    f = r.flows()
    custom = F.when(F.col("flow_id") % 4 == 0, F.lit(None)).otherwise(F.lit("c")) if changed else F.lit("c")
    version = F.when(F.col("flow_id") % 10 == 3, F.concat("external_version", F.lit("b"))).otherwise(F.col("external_version")) if changed else F.col("external_version")
    fields = f.select("flow_id", F.explode(F.array(
        F.struct(F.lit("name").alias("name"), F.col("name").alias("value")),
        F.struct(F.lit("external_version").alias("name"), version.alias("value")),
        F.struct(F.lit("description").alias("name"), F.lit("new" if changed else "old").alias("value")),
        F.struct(F.lit("custom_name").alias("name"), custom.alias("value")))).alias("a")).select("flow_id", F.lit("field").alias("kind"), "a.*")
    p = r.flow_parameters()
    if changed:
        p = p.filter("NOT (flow_id % 7 = 1 AND name = 'seed')").withColumn(
            "default_value", F.when((F.col("flow_id") % 5 == 0) & (F.col("name") == "ship"), "O").otherwise(F.col("default_value")))
    parameters = p.select("flow_id", F.lit("parameter").alias("kind"), "name", F.col("default_value").alias("value"))
    types = p.select("flow_id", F.lit("meta").alias("kind"), "name", F.when(F.col("flow_id") % 2 == (1 if changed else 3), F.lit(None)).otherwise(F.col("data_type")).alias("value"))
    e = r.flow_edges()
    if changed:
        e = e.filter("child % 9 <> 1")
    parts = e.select(F.col("parent").alias("flow_id"), F.lit("component").alias("kind"), F.col("identifier").alias("name"), F.lit("x").alias("value"))
    rows = fields.unionByName(parameters).unionByName(types).unionByName(parts)
    return rows.select(F.col("flow_id").alias("root_id"), F.lit("").alias("path"), "kind", "name", "value")


DIFF = """WITH base AS (SELECT f.flow_id AS root_id, '' AS path, 'field' AS kind, a.name, CASE a.name WHEN 'name' THEN f.name WHEN 'external_version' THEN external_version ELSE 'c' END AS v,
  CASE a.name WHEN 'name' THEN f.name WHEN 'external_version' THEN CASE WHEN flow_id % 10 = 3 THEN external_version || 'b' ELSE external_version END WHEN 'custom_name' THEN CASE WHEN flow_id % 4 <> 0 THEN 'c' END END AS w,
  true AS l, true AS r FROM flows f, (SELECT unnest(['name', 'external_version', 'custom_name']) AS name) a
 UNION ALL SELECT flow_id, '', 'parameter', name, default_value, CASE WHEN flow_id % 7 = 1 AND name = 'seed' THEN NULL WHEN flow_id % 5 = 0 AND name = 'ship' THEN 'O' ELSE default_value END, true, NOT (flow_id % 7 = 1 AND name = 'seed') FROM flow_parameters
 UNION ALL SELECT flow_id, '', 'meta', name, data_type, CASE WHEN flow_id % 7 = 1 AND name = 'seed' OR flow_id % 2 = 1 THEN NULL ELSE data_type END, true, NOT (flow_id % 7 = 1 AND name = 'seed') FROM flow_parameters
 UNION ALL SELECT parent, '', 'component', identifier, 'x', CASE WHEN child % 9 <> 1 THEN 'x' END, true, child % 9 <> 1 FROM flow_edges)
SELECT root_id, path, kind, name, v AS left_value, w AS right_value, CASE WHEN r THEN 'differs' ELSE 'only left' END AS problem FROM base
WHERE (NOT r) OR (v IS DISTINCT FROM w AND NOT (kind = 'meta' AND (v IS NULL OR w IS NULL)) AND {extra})"""


@query("flw_03_differences", needs=["flows", "flow_parameters", "flow_edges"], sql=DIFF.format(extra="true"))
def _(r):
    return flows.differences(attribute_rows(r, False), attribute_rows(r, True))


@query("flw_03_differences_lenient", needs=["flows", "flow_parameters", "flow_edges"],
       sql=DIFF.format(extra="kind <> 'parameter' AND NOT (name = 'custom_name' AND (v IS NULL OR w IS NULL))"))
def _(r):
    return flows.differences(attribute_rows(r, False), attribute_rows(r, True), ignore_parameter_values=True, ignore_custom_name_if_none=True)


@query("flw_03_older_children", needs=["flows", "flow_parameters", "flow_edges"], sql=DIFF.format(extra="NOT (kind = 'parameter' AND root_id % 3 = 2)"))
def _(r):
    older = r.flows().filter("flow_id % 3 = 2").select(F.col("flow_id").alias("root_id"), F.lit("").alias("path"))
    return flows.differences(attribute_rows(r, False), attribute_rows(r, True), older_children=older)


@query("flw_03_older_children_by_date", needs=["flows", "flow_edges"], sql=f"""{TREE},
d AS (SELECT flow_id, CASE WHEN flow_id % 6 > 0 THEN TIMESTAMP '2020-01-01' + INTERVAL 1 DAY * (flow_id * 7 % 11) END AS at FROM flows)
SELECT t.root_id, CASE WHEN t.depth = 0 THEN e.identifier ELSE t.path || '.' || e.identifier END AS path
FROM tree t JOIN flow_edges e ON e.parent = t.flow_id JOIN d p ON p.flow_id = e.parent JOIN d c ON c.flow_id = e.child WHERE c.at < p.at""")
def _(r):
    """Sub-flows older than their parent, by upload dates written as text, some of them missing."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("flow_id") * 7 % 11).cast("int")).cast("string")
    dated = r.flows().withColumn("upload_date", F.when(F.col("flow_id") % 6 > 0, F.concat(day, F.lit("T00:00:00"))))
    return flows.older_children(dated, r.flow_edges()).withColumn("path", F.concat_ws(".", "path"))


@query("flw_04_effective_parameters", needs=["flows", "flow_edges", "flow_parameters", "setups"], sql=f"""{TREE}
SELECT s.setup_id, t.path, t.flow_id, p.name, CASE WHEN t.depth = 0 AND p.name = 'tax' THEN CAST(s.tax AS VARCHAR) WHEN t.depth = 0 AND p.name = 'ship' THEN s.ship ELSE p.default_value END AS value
FROM setups s JOIN tree t ON t.root_id = s.flow_id JOIN flow_parameters p ON p.flow_id = t.flow_id""")
def _(r):
    out = flows.effective_parameters(tree_of(r), r.flow_parameters(), r.setup_parameters(), r.setups())
    return out.withColumn("path", F.concat_ws(".", "path"))


@query("flw_05_nodes_without_id", needs=["flow_edges"], sql="""
SELECT e.parent AS root_id, e.identifier AS path FROM flow_edges e LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON s.s_suppkey = e.child WHERE s.s_suppkey IS NULL""")
def _(r):
    stored = r.table("supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("child"), F.col("s_suppkey").alias("flow_id"))
    nodes = r.flow_edges().join(stored, "child", "left").select(F.col("parent").alias("root_id"), F.col("identifier").alias("path"), "flow_id")
    return flows.nodes_without_id(nodes).drop("flow_id")


@query("flw_06_parameters_from_trace", needs=["trace"], sql="""
WITH s AS (SELECT run_id, repeat, fold, min(iteration) AS iteration FROM trace WHERE CAST(k AS INT) % 40 = 0 GROUP BY 1, 2, 3)
SELECT t.run_id, t.repeat, t.fold, t.iteration, 'k=' || t.k AS parameters FROM trace t JOIN s ON s.run_id = t.run_id AND s.fold = t.fold AND s.iteration = t.iteration""")
def _(r):
    return traces.chosen_parameters(flagged_trace(r)).withColumn("parameters", map_text("parameters"))
