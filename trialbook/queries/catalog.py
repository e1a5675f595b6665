"""Listing and membership queries (LST, SET)."""

from pyspark.sql import functions as F

from trialbook.operators import listing, members, pages
from trialbook.plans.bindings import QUALITY_NAMES
from trialbook.queries import query
from trialbook.queries.analysis import round_to
from trialbook.session import new_path
from trialbook.sources import documents

_Q4 = """"NumberOfInstances", "NumberOfClasses", "NumberOfFeatures", "NumberOfMissingValues\""""


@query("lst_01_list_datasets", needs=["versioned", "dataset_tags", "q_wide"], sql=f"""
SELECT d.did, d.name, d.format, d.status, d.uploader, d.version, {_Q4}
FROM versioned d LEFT JOIN q_wide q ON d.did = q.did
WHERE d.status = 'active' AND d.did IN (SELECT did FROM dataset_tags WHERE tag IN ('Brand#1', 'Brand#2', 'Brand#3'))
  AND "NumberOfInstances" BETWEEN 10 AND 40 AND "NumberOfClasses" = 3""")
def _(r):
    return listing.list_datasets(
        r.versioned_datasets(), r.qualities(), r.dataset_tags(), QUALITY_NAMES,
        tag=["Brand#1", "Brand#2", "Brand#3"],
        ranges={"NumberOfInstances": "10..40", "NumberOfClasses": 3})


@query("lst_01_list_datasets_any_status", needs=["versioned", "q_wide"], sql=f"""
SELECT d.did, d.name, d.format, d.status, d.uploader, d.version, {_Q4}
FROM versioned d LEFT JOIN q_wide q ON d.did = q.did WHERE d.name = 'small ring' AND d.version = 1""")
def _(r):
    return listing.list_datasets(
        r.versioned_datasets(), r.qualities(), r.dataset_tags(), QUALITY_NAMES,
        status="all", data_name="small ring", data_version=1)


@query("lst_02_list_tasks", needs=["tasks", "datasets", "q_wide", "procedures", "dataset_tags"], sql=f"""
SELECT t.*, d.name, d.status, p.procedure_name AS estimation_procedure,
  coalesce(q."NumberOfInstances", 0) AS "NumberOfInstances", coalesce(q."NumberOfClasses", 0) AS "NumberOfClasses",
  coalesce(q."NumberOfFeatures", 0) AS "NumberOfFeatures", coalesce(q."NumberOfMissingValues", 0) AS "NumberOfMissingValues"
FROM tasks t JOIN datasets d ON t.did = d.did LEFT JOIN procedures p ON t.procedure_id = p.procedure_id
LEFT JOIN q_wide q ON t.did = q.did
WHERE t.ttid = 1 AND d.status = 'active' AND t.did IN (SELECT did FROM dataset_tags WHERE tag = 'Brand#1')
  AND q."NumberOfInstances" BETWEEN 5 AND 60""")
def _(r):
    return listing.list_tasks(
        r.tasks(), r.datasets(), r.qualities(), r.procedures(), r.dataset_tags(), QUALITY_NAMES,
        task_type=1, data_tag="Brand#1", status="active", ranges={"NumberOfInstances": (5, 60)})


@query("lst_03_list_runs", needs=["runs", "tasks", "study_members"], sql="""
SELECT * FROM runs WHERE error_message = '' AND flow_id IN (1, 2, 3, 5, 8)
  AND run_id IN (SELECT run_id FROM study_members WHERE study_id = 2)
  AND task_id IN (SELECT task_id FROM tasks WHERE ttid IN (1, 2))""")
def _(r):
    return listing.list_runs(r.runs(), flow=[1, 2, 3, 5, 8], study=2, study_members=r.study_members(),
                             tasks=r.tasks(), task_type=[1, 2])


@query("lst_03_list_runs_with_errors", needs=["runs", "tasks"], sql="""
SELECT * FROM runs WHERE task_id IN (SELECT task_id FROM tasks WHERE procedure_id = 2)""")
def _(r):
    wanted = r.tasks().filter("procedure_id = 2").select("task_id")
    return listing.list_runs(r.runs(), task=wanted, display_errors=True)


@query("lst_04_list_flows", needs=["flows", "flow_tags"], sql="""
SELECT * FROM flows WHERE uploader IN (1, 2, 3, 15, 20, 6) AND flow_id IN (SELECT flow_id FROM flow_tags WHERE tag = 'low')""")
def _(r):
    return listing.list_flows(r.flows(), r.flow_tags(), tag="low", uploader=[1, 2, 3, 15, 20, 6])


@query("lst_05_list_setups", needs=["setups", "flows"], sql="""
SELECT s.setup_id, s.flow_id, f.name || '_ship=' || s.ship || ';' || f.name || '_tax=' || s.tax AS parameters
FROM setups s JOIN flows f ON s.flow_id = f.flow_id""")
def _(r):
    out = listing.list_setups(r.setup_parameters())
    text = F.transform(F.array_sort(F.map_entries("parameters")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return out.withColumn("parameters", F.array_join(text, ";"))


@query("lst_06_list_evaluations", needs=["evaluations", "runs"], sql="""
SELECT e.*, NULL AS values FROM evaluations e WHERE e.function = 'A'
  AND e.flow_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)
  AND e.run_id IN (SELECT run_id FROM runs WHERE uploader IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))""")
def _(r):
    flows = r.table("supplier").filter("s_acctbal > 5000").select("s_suppkey")
    builders = r.table("customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    out = listing.list_evaluations(r.fold_evaluations(), "A", flows=flows, uploaders=builders, run_table=r.runs())
    return round_to(out.withColumn("values", F.lit(None).cast("string")), 6, "value")


@query("lst_06_list_evaluations_per_fold", needs=["fold_evaluations"], sql="""
SELECT run_id, task_id, flow_id, setup_id, function, CAST(NULL AS DOUBLE) AS value,
  string_agg(CAST(CAST(round(value * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY repeat, fold) AS values
FROM fold_evaluations WHERE function = 'R' GROUP BY 1, 2, 3, 4, 5""")
def _(r):
    out = listing.list_evaluations(r.fold_evaluations(), "R", per_fold=True)
    millionths = F.transform("values", lambda v: F.round(v * 1_000_000).cast("long").cast("string"))
    return out.withColumn("values", F.array_join(millionths, ","))


@query("lst_07_evaluations_by_run", needs=["evaluations"], sql="""
SELECT run_id, task_id, flow_id, setup_id, function, value FROM evaluations WHERE function = 'N'
QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY task_id DESC, flow_id DESC, setup_id DESC) = 1""")
def _(r):
    return listing.by_run(r.evaluations().filter("function = 'N'"), ["task_id", "flow_id", "setup_id"])


@query("lst_08_list_studies", needs=["studies"], sql="""
SELECT s.study_id, s.name, s.main_entity_type, s.status, s.uploader, count(*) AS n_customers
FROM studies s JOIN nation ON n_regionkey = s.study_id JOIN customer ON c_nationkey = n_nationkey
WHERE s.main_entity_type = 'run' AND s.status = 'active' GROUP BY 1, 2, 3, 4, 5""")
def _(r):
    listed = listing.list_studies(r.studies(), entity="run", status="active")
    per_nation = r.table("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    sizes = (r.table("nation").join(per_nation, "n_nationkey").groupBy(F.col("n_regionkey").alias("study_id"))
             .agg(F.sum("n").alias("n_customers")))
    return listed.join(sizes, "study_id")


@query("lst_08_list_suites", needs=["studies", "study_members"], sql="""
SELECT s.*, m.n_runs FROM studies s JOIN (SELECT study_id, count(*) AS n_runs FROM study_members GROUP BY 1) m
ON s.study_id = m.study_id WHERE s.main_entity_type = 'task'""")
def _(r):
    listed = listing.list_studies(r.studies(), entity="task", status="all")
    return listed.join(r.study_members().groupBy("study_id").agg(F.count(F.lit(1)).alias("n_runs")), "study_id")


@query("lst_09_list_qualities", needs=["qualities"], sql="SELECT DISTINCT name FROM qualities")
def _(r):
    return listing.list_qualities(r.qualities())


@query("lst_09_list_measures", needs=["fold_evaluations"], sql="SELECT DISTINCT function FROM fold_evaluations")
def _(r):
    return listing.list_measures(r.lines())


@query("lst_09_list_procedures", needs=["procedures", "tasks"], sql="""
SELECT * FROM procedures WHERE ttid IN (SELECT ttid FROM tasks)""")
def _(r):
    return listing.list_procedures(r.procedures(), r.tasks())


@query("lst_09_vocabularies_xml", needs=["procedures"], sql="""
SELECT 'quality' AS kind, p_name AS name, NULL AS ttid, NULL AS folds FROM (SELECT DISTINCT p_name FROM part) UNION ALL SELECT 'measure', event_type, NULL, NULL FROM (SELECT DISTINCT event_type FROM events)
UNION ALL SELECT 'procedure', procedure_name || ' ' || p_partkey, CASE WHEN ttid < 9 THEN ttid END, folds FROM procedures, part""")
def _(r):
    """Vocabularies of qualities, measures and procedures, written and read back; procedures of unknown task types come second."""
    path = new_path(r.spark, "vocabularies")
    documents.write_vocabulary(r.table("part").select("p_name").distinct(), f"{path}/q", "quality", "data_qualities_list")
    documents.write_vocabulary(r.table("events").select("event_type").distinct(), f"{path}/m", "measure", "measures")
    each = F.concat_ws(" ", "procedure_name", F.col("p_partkey").cast("string"))
    many = r.table("part").select("p_partkey").join(F.broadcast(r.procedures()))  # five rows
    kind = F.when(F.col("ttid") < 9, F.col("ttid").cast("string")).otherwise("none")
    documents.write_procedures(many.select(F.col("p_partkey").alias("procedure_id"), kind.alias("ttid"), each.alias("procedure_name"), "repeats", "folds"), f"{path}/p")
    known, others = documents.procedures(r.spark, f"{path}/p")
    none = [F.lit(None).cast("int").alias(c) for c in ("ttid", "folds")]
    parts = [documents.quality_names(r.spark, f"{path}/q").select(F.lit("quality").alias("kind"), "name", *none), documents.measures(r.spark, f"{path}/m").select(F.lit("measure").alias("kind"), "name", *none)]
    parts += [p.select(F.lit("procedure").alias("kind"), F.col("procedure_name").alias("name"), "ttid", "folds") for p in (known, others)]
    return members.concat(parts)


@query("lst_10_page_of_runs", needs=["runs"], sql="SELECT * FROM runs ORDER BY run_id LIMIT 100 OFFSET 250")
def _(r):
    return listing.page(r.runs(), ["run_id"], 100, 250)


@query("lst_10_late_page", needs=["evaluations"], sql="""
SELECT * FROM evaluations ORDER BY run_id, task_id, flow_id, setup_id, function LIMIT 500 OFFSET 30000""")
def _(r):
    return listing.page(r.evaluations(), ["run_id", "task_id", "flow_id", "setup_id", "function"], 500, 30_000)


@query("lst_10_late_page_by_value", needs=["evaluations"], sql="""
SELECT run_id, task_id, flow_id, setup_id, function, value FROM evaluations ORDER BY value DESC, run_id, task_id, setup_id, function LIMIT 300 OFFSET 25000""")
def _(r):
    return listing.top(r.evaluations().withColumn("value", F.round("value", 6)), "value", "desc", ["run_id", "task_id", "setup_id", "function"], 300, 25_000)


@query("lst_10_written_pages", sql="""
SELECT *, 'early' AS page FROM (SELECT event_id, user_id, event_type FROM events ORDER BY event_type DESC, user_id, event_id LIMIT 40 OFFSET 60)
UNION ALL SELECT *, 'late' FROM (SELECT event_id, user_id, event_type FROM events ORDER BY event_type DESC, user_id, event_id LIMIT 250 OFFSET 9000)
UNION ALL SELECT *, 'last' FROM (SELECT event_id, user_id, event_type FROM events ORDER BY event_type DESC, user_id, event_id LIMIT 100 OFFSET (SELECT count(*) - 30 FROM events))""")
def _(r):
    """Three pages of one written order."""
    order = [("event_type", "desc"), "user_id", "event_id"]
    events = r.table("events").select("event_id", "user_id", "event_type")
    path = new_path(r.spark, "pages")
    index = pages.write_pages(events, order, path)
    rows, _ = pages.open_pages(r.spark, order, path)
    n = sum(count for count, _, _ in index.slices)
    parts = [index.page(rows, size, offset).withColumn("page", F.lit(name)) for name, size, offset in (("early", 40, 60), ("late", 250, 9000), ("last", 100, max(0, n - 30)))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("lst_02_tagged_tasks", needs=["tasks", "datasets", "procedures"], sql="""
SELECT t.task_id, t.did, d.status, p.procedure_name AS estimation_procedure FROM tasks t JOIN datasets d ON t.did = d.did LEFT JOIN procedures p ON t.procedure_id = p.procedure_id
WHERE t.task_id IN (SELECT p_partkey FROM part WHERE p_type = (SELECT min(p_type) FROM part))""")
def _(r):
    """Tasks that carry a tag of their own."""
    part = r.table("part")
    first = part.agg(F.min("p_type").alias("p_type"))
    tags = part.join(first, "p_type").select(F.col("p_partkey").alias("task_id"), F.lit("first").alias("tag"))
    out = listing.list_tasks(r.tasks(), r.datasets(), r.qualities(), r.procedures(), r.dataset_tags(), QUALITY_NAMES, tags=tags, tag="first")
    return out.select("task_id", "did", "status", "estimation_procedure")


@query("lst_06_tagged_evaluations", needs=["evaluations"], sql="""
SELECT run_id, task_id, flow_id, setup_id, function, value FROM evaluations WHERE function = 'R' AND run_id IN (SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW'))""")
def _(r):
    """Evaluations of runs that carry one of two tags."""
    tags = r.table("orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("tag"))
    out = listing.list_evaluations(r.fold_evaluations(), "R", tags=tags, tag=["1-URGENT", "5-LOW"])
    return round_to(out.drop("values"), 6, "value")


@query("lst_10_page_after_key", needs=["datasets"], sql="SELECT * FROM datasets WHERE did > 77 ORDER BY did LIMIT 50")
def _(r):
    return listing.page_after(r.datasets(), "did", 77, 50)


@query("lst_11_top_evaluations", needs=["evaluations"], sql="""
SELECT * FROM evaluations WHERE function = 'A' ORDER BY value DESC, run_id, task_id, setup_id LIMIT 100""")
def _(r):
    return listing.top(r.evaluations().filter("function = 'A'"), "value", "desc", ["run_id", "task_id", "setup_id"], 100)


@query("lst_12_adhoc_predicates", needs=["tasks", "q_wide", "lines"], sql="""
SELECT t.*, q."NumberOfInstances" FROM tasks t JOIN q_wide q USING (did)
WHERE q."NumberOfInstances" > 20 AND q."NumberOfInstances" < 36 AND q."NumberOfClasses" = 3
  AND t.task_id IN (SELECT task_id FROM lines WHERE flow_id IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3))""")
def _(r):
    q = listing.quality_columns(r.qualities(), ["NumberOfInstances", "NumberOfClasses"])
    picked = r.tasks().join(q, "did").filter("NumberOfInstances > 20 AND NumberOfInstances < 36 AND NumberOfClasses = 3")
    third = r.table("supplier").filter("s_nationkey = 3").select("s_suppkey")
    suite = listing.matches(r.lines(), "flow_id", third).select("task_id")
    return listing.matches(picked, "task_id", suite).drop("NumberOfClasses")


@query("lst_13_datasets_active", needs=["datasets"], sql="""
SELECT l_suppkey * 30 AS did, status = 'active' AS is_active, CASE WHEN d.did IS NULL THEN 'missing' ELSE 'known' END AS found
FROM (SELECT DISTINCT l_suppkey FROM lineitem) LEFT JOIN datasets d ON d.did = l_suppkey * 30""")
def _(r):
    ids = r.lines().select((F.col("flow_id") * 30).alias("did")).distinct()
    active, missing = listing.datasets_active(ids, r.datasets())
    return members.concat([active.withColumn("found", F.lit("known")), missing.withColumn("found", F.lit("missing"))])


@query("lst_14_name_to_id", needs=["versioned"], sql="""
SELECT n.name, CAST(NULL AS BIGINT) AS version, min(v.did) AS did, count(v.did) AS n_matches
FROM (SELECT DISTINCT name FROM versioned) n LEFT JOIN versioned v ON v.name = n.name AND v.status = 'active' GROUP BY 1
UNION ALL
SELECT n.name, 3, min(v.did), count(v.did)
FROM (SELECT DISTINCT name FROM versioned) n LEFT JOIN versioned v ON v.name = n.name AND v.version = 3 GROUP BY 1""")
def _(r):
    names = r.datasets().select("name").distinct()
    asked = names.select("name", F.explode(F.array(F.lit(None).cast("long"), F.lit(3).cast("long"))).alias("version"))
    return listing.name_to_id(asked, r.versioned_datasets())


@query("lst_15_oldest_task", needs=["tasks", "datasets"], sql="""
SELECT d.did, min(t.task_id) AS task_id FROM datasets d LEFT JOIN tasks t ON t.did = d.did AND t.procedure_id = 2
WHERE d.status = 'active' GROUP BY 1""")
def _(r):
    oldest, missing = listing.oldest_task(r.tasks(), r.datasets().filter("status = 'active'").select("did"), 2)
    return members.concat([oldest, missing])


@query("lst_16_lookup_runs", needs=["runs"], sql="""
WITH ids AS (SELECT DISTINCT user_id * 37 AS run_id FROM events)
SELECT i.run_id, r.task_id, r.flow_id, r.setup_id, r.uploader, r.upload_time, r.error_message
FROM ids i LEFT JOIN runs r ON i.run_id = r.run_id""")
def _(r):
    ids = r.table("events").select((F.col("user_id") * 37).alias("run_id"))
    found, missing = listing.lookup(ids, r.runs(), "run_id")
    return members.concat([found, missing])


@query("lst_17_random_subset", needs=["runs"], sql="""
SELECT * FROM runs ORDER BY md5('42-' || CAST(run_id AS VARCHAR)), run_id LIMIT 500""")
def _(r):
    return listing.random_subset(r.runs(), "run_id", 500, 42)


@query("set_01_concat_pages", needs=["datasets", "runs"], sql="""
SELECT did, name, format, status, uploader, NULL AS tag FROM datasets WHERE status = 'active'
UNION ALL SELECT p_partkey, p_name, NULL, NULL, NULL, p_brand FROM part WHERE p_size % 3 <> 0""")
def _(r):
    first = r.datasets().filter("status = 'active'")
    second = r.table("part").filter("p_size % 3 <> 0").select(
        F.col("p_partkey").alias("did"), F.col("p_name").alias("name"), F.col("p_brand").alias("tag"))
    return members.concat([first, second])


@query("set_02_missing_ids", needs=["runs"], sql="""
SELECT DISTINCT user_id * 1000 AS run_id FROM events WHERE user_id * 1000 NOT IN (SELECT o_orderkey FROM orders)""")
def _(r):
    wanted = r.table("events").select((F.col("user_id") * 1000).alias("run_id"))
    return members.missing_ids(wanted, r.table("orders").select(F.col("o_orderkey").alias("run_id")), "run_id")


@query("set_03_attach", needs=["study_members", "runs"], sql="""
SELECT study_id, count(*) AS n_members FROM (SELECT * FROM study_members UNION SELECT 2, run_id FROM runs WHERE flow_id < 20) GROUP BY 1""")
def _(r):
    new = r.runs().filter("flow_id < 20").select(F.lit(2).alias("study_id"), "run_id")
    return members.attach(r.study_members(), new)[1]


@query("set_03_detach", needs=["study_members", "runs"], sql="""
SELECT s.study_id, count(*) FILTER (WHERE s.run_id NOT IN (SELECT run_id FROM runs WHERE error_message <> '')) AS n_members
FROM study_members s GROUP BY 1""")
def _(r):
    gone = members.concat([r.study_members()]).join(r.runs().filter("error_message <> ''"), "run_id", "left_semi")
    return members.detach(r.study_members(), gone)[1]


@query("set_04_study_closure", needs=["study_members", "runs", "tasks"], sql="""
WITH r AS (SELECT s.study_id, r.*, t.did FROM study_members s JOIN runs r ON s.run_id = r.run_id LEFT JOIN tasks t ON t.task_id = r.task_id)
SELECT study_id, 'run' AS entity_type, run_id AS entity_id FROM r UNION SELECT study_id, 'task', task_id FROM r
UNION SELECT study_id, 'flow', flow_id FROM r UNION SELECT study_id, 'setup', setup_id FROM r
UNION SELECT study_id, 'data', did FROM r WHERE did IS NOT NULL""")
def _(r):
    return members.closure(r.study_members(), r.runs(), r.tasks())


@query("set_06_create_study", needs=["studies", "runs"], sql="""
WITH asked AS (SELECT DISTINCT user_id * 50 AS run_id FROM events)
SELECT 100 AS study_id, a.run_id, CASE WHEN o.o_orderkey IS NULL THEN 'rejected' ELSE 'member' END AS outcome,
 (SELECT count(*) FROM studies) + 1 AS n_studies FROM asked a LEFT JOIN orders o ON o.o_orderkey = a.run_id""")
def _(r):
    new = r.spark.createDataFrame([(100, "mine", "run", "in_preparation", 1)],
                                  "study_id int, name string, main_entity_type string, status string, uploader int")
    asked = r.table("events").select(F.lit(100).alias("study_id"), (F.col("user_id") * 50).alias("run_id")).distinct()
    known_runs = r.table("orders").select(F.col("o_orderkey").alias("run_id"))
    studies, added, rejected = members.create_study(r.studies(), new, asked, known_runs, "run_id")
    n = studies.agg(F.count(F.lit(1)).alias("n_studies"))
    out = members.concat([added.withColumn("outcome", F.lit("member")), rejected.withColumn("outcome", F.lit("rejected"))])
    return out.join(F.broadcast(n))  # one row
