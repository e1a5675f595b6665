"""Source and sink queries (SRC, SNK, RUN-06): tables are written in a format and read back.

Every file is derived from the given tables and lies in the shared folder.
"""

from pyspark.sql import functions as F

from trialbook.operators import datasets as ds
from trialbook.operators import members, splits, traces
from trialbook.queries import query
from trialbook.queries.analysis import map_text
from trialbook.queries.columns import FEATURE_TABLE, feature_table, line_features
from trialbook.queries.flows import CHAINS, TREE
from trialbook.queries.scoring import CLASSES, P, POINT_FOLDS, predictions
from trialbook.session import brief, new_path
from trialbook.sources import arff, documents, tables

STATES = ["F", "O", "P"]
ORDERS = """SELECT o_orderkey - (SELECT min(o_orderkey) FROM orders) AS rowid, o_orderkey, o_orderstatus, o_totalprice, nullif(o_orderpriority, '1-URGENT') AS o_orderpriority FROM orders"""


def orders(r):
    return r.table("orders").select(
        F.col("o_orderkey").alias("rowid"), "o_orderkey", "o_orderstatus", "o_totalprice",
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")).alias("o_orderpriority"))


@query("src_01_dense_arff", sql=ORDERS)
def _(r):
    path = new_path(r.spark, "orders")
    arff.write_dense(orders(r), path, "orders", {"o_orderstatus": STATES})
    return arff.read_dense(r.spark, path)[0]


@query("src_01_dense_arff_free_text", sql="""
SELECT doc_id, replace(replace(text, chr(10), '|'), chr(13), '!') AS text, lang FROM documents
UNION ALL SELECT page_id, replace(replace(html, chr(10), '|'), chr(13), '!'), NULL FROM pages""")
def _(r):
    path = new_path(r.spark, "documents")
    texts = members.concat([r.table("documents").select("doc_id", "text", "lang"), r.table("pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))])
    arff.write_dense(texts, path, "free text", order=None)
    out = arff.read_dense(r.spark, path, None)[0]
    return out.withColumn("text", F.translate("text", "\n\r", "|!"))


@query("src_02_sparse_arff", sql="""
SELECT rk AS rowid, i - 1 AS col, CAST(v AS FLOAT) AS value FROM (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS rk, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) WHERE abs(v) >= 0.125""")
def _(r):
    path = new_path(r.spark, "vectors")
    kept = F.transform("embedding", lambda v: F.when(F.abs(v) >= 0.125, v).otherwise(F.lit(0.0).cast("float")))
    wide = r.table("embeddings").select(F.col("vec_id").alias("rowid"), kept.alias("e"))
    arff.write_sparse(wide.select("rowid", *[F.col("e")[i].alias(f"x{i}") for i in range(64)]), path, "vectors")
    return arff.read_sparse(r.spark, path)[0]


@query("src_05_sparse_dataset", sql="""
SELECT rk AS rowid, CAST(count(*) FILTER (abs(v) >= 0.3) AS BIGINT) AS n, coalesce(sum(i - 1) FILTER (abs(v) >= 0.3), 0)::BIGINT AS places, 64 AS width
FROM (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS rk, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY rk""")
def _(r):
    """Vectors of a sparse file, those of rows without an entry too."""
    path = new_path(r.spark, "vectors")
    kept = F.transform("embedding", lambda v: F.when(F.abs(v) >= 0.3, v).otherwise(F.lit(0.0).cast("float")))
    wide = r.table("embeddings").select(F.col("vec_id").alias("rowid"), kept.alias("e"))
    arff.write_sparse(wide.select("rowid", *[F.col("e")[i].alias(f"x{i}") for i in range(64)]), path, "vectors")
    vector = F.from_json(F.to_json(F.struct("features")), "features struct<size: int, indices: array<int>, values: array<double>>")["features"]
    read = tables.read_preferred(r.spark, None, path).select("rowid", vector.alias("v"))
    places = F.aggregate("v.indices", F.lit(0).cast("long"), lambda a, i: a + i)
    return read.select("rowid", F.size("v.indices").cast("long").alias("n"), places.alias("places"), F.col("v.size").alias("width"))


@query("src_05_sparse_gaps", sql="""
SELECT rk AS rowid, i - 1 AS col, CASE WHEN v <= 0.3 THEN CAST(v AS DOUBLE) END AS value FROM (
SELECT row_number() OVER (ORDER BY vec_id) - 1 AS rk, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) WHERE abs(v) >= 0.2""")
def _(r):
    """Entries of sparse vectors, of which the large ones are missing: they stay missing and are not zero."""
    path = new_path(r.spark, "vectors")
    kept = F.transform("embedding", lambda v: F.when(F.abs(v) < 0.2, F.lit(0.0).cast("float")).when(v <= 0.3, v))
    wide = r.table("embeddings").select(F.col("vec_id").alias("rowid"), kept.alias("e"))
    arff.write_sparse(wide.select("rowid", *[F.col("e")[i].alias(f"x{i}") for i in range(64)]), path, "vectors")
    vector = F.from_json(F.to_json(F.struct("features")), "features struct<indices: array<int>, values: array<double>>")["features"]
    pairs = tables.read_preferred(r.spark, None, path).select("rowid", F.explode(F.arrays_zip(vector["indices"].alias("col"), vector["values"].alias("value"))).alias("e"))
    return pairs.select("rowid", F.col("e.col").alias("col"), F.nanvl(F.col("e.value"), F.lit(None).cast("double")).cast("float").cast("double").alias("value"))


@query("src_03_gzipped_arff", sql=ORDERS)
def _(r):
    path = new_path(r.spark, "orders-gz")
    arff.write_dense(orders(r), path, "orders", {"o_orderstatus": STATES}, compression="gzip")
    return arff.read_dense(r.spark, path)[0]


@query("src_05_parquet_first", sql=ORDERS + " UNION ALL " + ORDERS)
def _(r):
    folder = new_path(r.spark, "both")
    arff.write_dense(orders(r), f"{folder}/a", "orders", {"o_orderstatus": STATES})
    orders(r).write.parquet(f"{folder}/b.parquet")
    columns = ["rowid", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    low = r.table("orders").agg(F.min("o_orderkey").alias("lo"))
    first = tables.read_preferred(r.spark, f"{folder}/b.parquet", f"{folder}/a").join(F.broadcast(low)).withColumn("rowid", F.col("rowid") - F.col("lo"))  # one row
    second = tables.read_preferred(r.spark, f"{folder}/absent.parquet", f"{folder}/a")
    return first.select(*columns).unionByName(second.select(*columns))


@query("src_06_features_xml", sql=f"""
WITH {FEATURE_TABLE} SELECT did, idx AS "index", did || '_' || name AS name, data_type, CASE WHEN has_values THEN ' a|b' WHEN data_type = 'nominal' THEN '' END AS nominal_values,
 idx * 3 AS number_of_missing_values, idx = 2 AS is_target, is_ignore, is_row_identifier FROM ft""")
def _(r):
    path = new_path(r.spark, "features")
    t = feature_table(r).withColumns({
        "name": F.concat_ws("_", "did", "name"), "is_target": F.col("index") == 2, "number_of_missing_values": F.col("index") * 3,
        "nominal_values": F.when(F.col("nominal_values").isNotNull(), F.array(F.lit(" a"), F.lit("b")))})
    documents.write_features(t, path)
    back = documents.features(r.spark, path)
    return back.withColumns({"did": F.substring_index("name", "_", 1).cast("long"), "nominal_values": F.array_join("nominal_values", "|")}).drop("ontologies")


@query("src_07_qualities_xml", needs=["qualities"], sql="""
SELECT name || '_' || did AS name, CASE WHEN value <> 3 THEN value END AS value FROM qualities""")
def _(r):
    path = new_path(r.spark, "qualities")
    q = r.qualities().select(F.concat_ws("_", "name", "did").alias("name"),
                             F.when(F.col("value") == 3, F.when(F.col("did") % 2 == 0, "null")).otherwise(F.col("value").cast("string")).alias("value"))
    documents.write_qualities(q, path)
    return documents.qualities(r.spark, path, 0).drop("did")


@query("src_08_descriptions_xml", needs=["versioned"], sql="""
SELECT did, version, name, format, 'a <b> & "c"' AS description, 'x' || (did % 3) || ',y' AS ignore_attribute, TIMESTAMP '2020-01-02 03:04:05' AS upload_date, NULL AS md5_checksum FROM versioned""")
def _(r):
    path = new_path(r.spark, "descriptions")
    d = r.versioned_datasets().withColumns({
        "description": F.lit(' a <b> & "c" '), "ignore_attribute": F.array(F.concat(F.lit("x"), (F.col("did") % 3).cast("string")), F.lit("y")),
        "upload_date": F.lit("2020-01-02T03:04:05"), "md5_checksum": F.lit("")})
    documents.write_descriptions(d, path)
    back = documents.descriptions(r.spark, path)
    return back.select("did", "version", "name", "format", "description", F.array_join("ignore_attribute", ",").alias("ignore_attribute"), "upload_date", "md5_checksum")


@query("src_09_split_file", needs=["points"], sql=f"""
WITH f AS ({POINT_FOLDS.format(n=2)}) SELECT f.repeat, k.fold, 0 AS sample, CASE WHEN k.fold = f.fold THEN 'TEST' ELSE 'TRAIN' END AS type, rowid FROM f, (SELECT unnest(range(5)) AS fold) k""")
def _(r):
    path = new_path(r.spark, "splits")
    made = splits.cross_validation(r.points().select("rowid", "label"), 2, 5, seed=3, stratify="label")
    long = splits.long_form(made, 5).select("type", "rowid", "repeat", "fold")
    arff.write_dense(long, path, "splits", {"type": ["TRAIN", "TEST"]}, order=None)
    return arff.read_splits(r.spark, path)


@query("src_10_tasks_xml", needs=["tasks", "procedures"], sql="""
SELECT t.task_id, t.ttid, 'type ' || t.ttid AS task_type, t.did, t.target, p.procedure_id AS est_id, p.procedure_name AS est_type,
 'number_folds=' || p.folds || ';number_repeats=' || p.repeats || ';percentage=' AS parameters, CASE WHEN t.did % 2 = 0 THEN 'auc' END AS measure
FROM tasks t JOIN procedures p USING (procedure_id)""")
def _(r):
    path = new_path(r.spark, "tasks")
    p = r.procedures().drop("ttid")
    parameters = F.create_map(F.lit("number_repeats"), F.col("repeats").cast("string"), F.lit("number_folds"), F.col("folds").cast("string"), F.lit("percentage"), F.lit(None).cast("string"))
    t = r.tasks().join(p, "procedure_id").select(
        "task_id", "ttid", F.concat(F.lit("type "), F.col("ttid").cast("string")).alias("task_type"), "did", "target",
        F.struct(F.col("procedure_id").alias("id"), F.col("procedure_name").alias("type"), parameters.alias("parameters")).alias("estimation"),
        F.lit("splits").alias("data_splits_url"), F.when(F.col("did") % 2 == 0, "auc").alias("measure"), F.array(F.lit("t")).alias("tags"))
    documents.write_tasks(t, path)
    back, _ = documents.tasks(r.spark, path)
    return back.select("task_id", "ttid", "task_type", "did", "target", F.col("estimation.id").alias("est_id"), F.col("estimation.type").alias("est_type"),
                       map_text(F.col("estimation.parameters")).alias("parameters"), "measure")


def run_documents(r):
    path = new_path(r.spark, "runs")
    with brief(r.spark) as put:
        folds = put(r.fold_evaluations().groupBy("run_id", "function", "repeat", "fold").agg(F.round(F.avg("value"), 6).alias("value")), "folds")
        means = folds.groupBy("run_id", "function").agg(F.max("value").alias("value"))
        both = members.concat([folds.withColumn("sample", F.when(F.col("fold") == 1, 0)), means]).withColumn("array_data", F.lit(None).cast("string"))
        documents.write_runs(r.runs(), both, path, compression="gzip")
    return documents.run_documents(r.spark, path)


def repeated_runs(r):
    """Run documents of which some come twice, every third of these with another uploader."""
    path = new_path(r.spark, "runs")
    runs = r.runs()
    again = runs.filter("run_id % 5 = 0").withColumn("uploader", F.when(F.col("run_id") % 3 == 0, F.col("uploader") + 1).otherwise(F.col("uploader")))
    none = r.spark.createDataFrame([], "run_id long, function string, repeat int, fold int, sample int, value double, array_data string")
    documents.write_runs(runs, none, f"{path}/a")
    documents.write_runs(again, none, f"{path}/b")
    return documents.run_documents(r.spark, f"{path}/*")


@query("src_11_repeated_runs_xml", needs=["runs"], sql="""
SELECT run_id, uploader, false AS conflict FROM runs WHERE run_id % 15 <> 0 UNION ALL SELECT run_id, uploader + k, true FROM runs, (SELECT unnest([0, 1]) AS k) WHERE run_id % 15 = 0""")
def _(r):
    docs = repeated_runs(r)
    return documents.runs(docs).select("run_id", "uploader", F.lit(False).alias("conflict")).unionByName(
        documents.run_conflicts(docs).select("run_id", "uploader", F.lit(True).alias("conflict")))


@query("src_11_runs_xml", needs=["runs"], sql="SELECT run_id, task_id, flow_id, setup_id, uploader, error_message FROM runs")
def _(r):
    return documents.runs(run_documents(r)).select("run_id", "task_id", "flow_id", "setup_id", "uploader", "error_message")


@query("src_11_run_evaluations_xml", needs=["fold_evaluations"], sql="""
WITH f AS (SELECT run_id, function, repeat, fold, round(avg(value), 6) AS value FROM fold_evaluations GROUP BY 1, 2, 3, 4)
SELECT run_id, function, repeat, fold, CASE WHEN fold = 1 THEN 0 END AS sample, value FROM f UNION ALL SELECT run_id, function, NULL, NULL, NULL, max(value) FROM f GROUP BY 1, 2""")
def _(r):
    return documents.run_evaluations(run_documents(r)).drop("array_data")


TRACE_SQL = """SELECT run_id, repeat, fold, iteration, evaluation, k = '1' AS selected, 'k=' || k AS parameters FROM t"""


def small_trace(r):
    t = r.trace().withColumn("selected", F.element_at("parameters", "parameter_k") == "1")
    number = F.when(F.col("fold") == "click", 0).when(F.col("fold") == "error", 1).when(F.col("fold") == "view", 2).otherwise(3)
    return t.withColumn("fold", number)


_TRACE = "WITH t AS (SELECT run_id, repeat, CASE fold WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'view' THEN 2 ELSE 3 END AS fold, iteration, evaluation, k FROM trace)"


@query("src_12_trace_file", needs=["trace"], sql=f"{_TRACE} {TRACE_SQL.replace('run_id', 'NULL AS run_id', 1)}")
def _(r):
    path = new_path(r.spark, "trace")
    t = small_trace(r).select("repeat", "fold", "iteration", "evaluation", F.when(F.col("selected"), "true").otherwise("false").alias("selected"),
                              F.concat(F.lit('"'), F.element_at("parameters", "parameter_k"), F.lit('"')).alias("parameter_k"))
    arff.write_dense(t, path, "Trace", {"selected": ["true", "false"]}, order=None)
    back = arff.read_trace(r.spark, path)
    return traces.parameters(back).withColumn("parameters", map_text("parameters"))


@query("src_13_traces_xml", needs=["trace"], sql=f"{_TRACE} {TRACE_SQL}")
def _(r):
    path = new_path(r.spark, "traces")
    documents.write_traces(small_trace(r), path)
    return traces.parameters(documents.traces(r.spark, path)).withColumn("parameters", map_text("parameters"))


@query("src_14_setups_xml", needs=["setup_parameters"], sql="SELECT setup_id, flow_id, flow_name, full_name, parameter_name, value FROM setup_parameters")
def _(r):
    path = new_path(r.spark, "setups")
    documents.write_setups(r.setup_parameters(), path)
    return documents.setups(r.spark, path).select("setup_id", "flow_id", "flow_name", "full_name", "parameter_name", "value")


@query("src_15_flows_xml", needs=["flows", "flow_edges"], sql=f"""{TREE}
SELECT t.root_id, t.path, t.flow_id, f.name, f.external_version, t.flow_id % 7 AS seed FROM tree t JOIN flows f ON f.flow_id = t.flow_id
WHERE t.root_id NOT IN (SELECT child FROM flow_edges)""")
def _(r):
    path = new_path(r.spark, "flows")
    seed = F.array(F.struct(F.lit("seed").alias("name"), F.lit("integer").alias("data_type"), (F.col("flow_id") % 7).cast("string").alias("default_value")))
    nodes = r.flows().select("flow_id", "name", "external_version", seed.alias("parameter"))
    documents.write_flows(nodes, r.flow_edges(), path)
    back = documents.flow_nodes(r.spark, path)
    return back.select("root_id", F.array_join("path", ".").alias("path"), "flow_id", "name", "external_version",
                       F.col("parameters")[0]["default_value"].cast("int").alias("seed"))


@query("src_15_flow_chains_xml", needs=["chain_edges"], sql=f"""{CHAINS}
SELECT c.root_id, c.path, c.flow_id, p.p_name AS name, p.p_size % 7 AS seed FROM chain c JOIN part p ON p.p_partkey = c.flow_id
WHERE c.root_id NOT IN (SELECT child FROM chain_edges)""")
def _(r):
    """Documents of flows nested a hundred deep."""
    path = new_path(r.spark, "chains")
    seed = F.array(F.struct(F.lit("seed").alias("name"), F.lit("integer").alias("data_type"), (F.col("p_size") % 7).cast("string").alias("default_value")))
    nodes = r.table("part").select(F.col("p_partkey").alias("flow_id"), F.col("p_name").alias("name"), seed.alias("parameter"))
    documents.write_flows(nodes, r.chain_edges(), path)
    back = documents.flow_nodes(r.spark, path)
    return back.select("root_id", F.array_join("path", ".").alias("path"), "flow_id", "name", F.col("parameters")[0]["default_value"].cast("int").alias("seed"))


@query("src_15_flows_without_ids_xml", needs=["chain_edges"], sql=f"""{CHAINS}
SELECT any_value(p.p_name) FILTER (c.depth = 0) AS root, count(*) AS flows, max(c.depth) AS depth, count(*) FILTER (c.flow_id % 2 = 1) AS named, count(DISTINCT c.root_id) AS documents
FROM chain c JOIN part p ON p.p_partkey = c.flow_id WHERE c.root_id NOT IN (SELECT child FROM chain_edges) GROUP BY c.root_id""")
def _(r):
    """Trees whose flows mostly have no id are told apart by their documents."""
    path = new_path(r.spark, "chains")
    documents.write_flows(r.table("part").select(F.col("p_partkey").alias("flow_id"), F.col("p_name").alias("name")), r.chain_edges(), f"{path}/all")
    # The ids of even flows are taken out of the text, whose lines keep their order.
    lines = r.spark.read.text(f"{path}/all").select("slice", "value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = lines.withColumn("value", F.regexp_replace("value", r"<oml:id>\d*[02468]</oml:id>", ""))
    lines.repartition("slice").sortWithinPartitions("slice", "block", "line").select("slice", "value").write.partitionBy("slice").text(f"{path}/some")
    back = documents.flow_nodes(r.spark, f"{path}/some")
    return back.groupBy("document").agg(
        F.max(F.when(F.size("path") == 0, F.col("name"))).alias("root"), F.count(F.lit(1)).alias("flows"), F.max(F.size("path")).alias("depth"),
        F.count("flow_id").alias("named"), F.count_if(F.size("path") == 0).alias("documents")).drop("document")


def study_documents(r):
    path = new_path(r.spark, "studies")
    runs = r.study_members().select("study_id", F.lit("run").alias("entity_type"), F.col("run_id").alias("entity_id"))
    data = r.study_members().select("study_id", F.lit("data").alias("entity_type"), (F.col("run_id") % 100).alias("entity_id")).distinct()
    documents.write_studies(r.studies(), runs.unionByName(data), path)
    return documents.studies(r.spark, path)


@query("src_16_studies_xml", needs=["studies", "study_members"], sql="""
SELECT s.study_id, s.name, s.main_entity_type, s.status, count(*) AS n FROM studies s JOIN study_members USING (study_id) GROUP BY 1, 2, 3, 4""")
def _(r):
    table, found = study_documents(r)
    n = found.filter("entity_type = 'run'").groupBy("study_id").agg(F.count(F.lit(1)).alias("n"))
    return table.join(n, "study_id").select("study_id", "name", "main_entity_type", "status", "n")


@query("src_16_study_members_xml", needs=["study_members"], sql="""
SELECT study_id, 'run' AS entity_type, run_id AS entity_id FROM study_members UNION ALL SELECT DISTINCT study_id, 'data', run_id % 100 FROM study_members""")
def _(r):
    return study_documents(r)[1]


@query("src_17_dataset_listing", needs=["versioned", "q_wide"], sql="""
SELECT d.did, d.name, d.version, d.status, coalesce(q."NumberOfInstances", 0) AS n, q.did IS NOT NULL AS has_qualities FROM versioned d LEFT JOIN q_wide q ON q.did = d.did""")
def _(r):
    path = new_path(r.spark, "listing")
    maps = r.qualities().groupBy("did").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("qualities"))
    documents.write_listing(r.versioned_datasets().join(maps, "did", "left"), path, "dataset")
    rows, _ = documents.listing(r.spark, path, "dataset")
    n = F.try_element_at("qualities", F.lit("NumberOfInstances"))
    return rows.select("did", "name", "version", "status", F.coalesce(n, F.lit(0.0)).alias("n"), n.isNotNull().alias("has_qualities"))


@query("src_17_task_listing_rejects", needs=["tasks"], sql="SELECT count(*) FILTER (WHERE ttid <> 3) AS good, count(*) FILTER (WHERE ttid = 3) AS bad FROM tasks")
def _(r):
    path = new_path(r.spark, "listing")
    t = r.tasks().withColumns({"task_type_id": F.when(F.col("ttid") == 3, "third").otherwise(F.col("ttid").cast("string")),
                               "inputs": F.create_map(F.lit("estimation_procedure"), F.col("procedure_id").cast("string"))})
    documents.write_listing(t, path, "task")
    rows, rejects = documents.listing(r.spark, path, "task")
    both = rows.select(F.lit(1).alias("g"), F.lit(0).alias("b")).unionByName(rejects.select(F.lit(0).alias("g"), F.lit(1).alias("b")))
    return both.agg(F.sum("g").alias("good"), F.sum("b").alias("bad"))


@query("src_17_task_listing_rejected_rows", needs=["tasks"], sql="""
SELECT CAST(task_id AS VARCHAR) AS task_id, CASE WHEN ttid = 3 THEN 'third' ELSE CAST(ttid AS VARCHAR) END AS task_type_id, ttid <> 3 AS good FROM tasks""")
def _(r):
    """What is kept and what is rejected, row by row."""
    path = new_path(r.spark, "listing")
    t = r.tasks().withColumns({"task_type_id": F.when(F.col("ttid") == 3, "third").otherwise(F.col("ttid").cast("string")),
                               "inputs": F.create_map(F.lit("estimation_procedure"), F.col("procedure_id").cast("string"))})
    documents.write_listing(t, path, "task")
    rows, rejects = documents.listing(r.spark, path, "task")
    return rows.select(F.col("task_id").cast("string").alias("task_id"), F.col("task_type_id").cast("string").alias("task_type_id"), F.lit(True).alias("good")).unionByName(
        rejects.select("task_id", "task_type_id", F.lit(False).alias("good")))


@query("src_17_run_listing", needs=["runs"], sql="SELECT run_id, task_id, setup_id, flow_id, uploader, error_message FROM runs")
def _(r):
    path = new_path(r.spark, "listing")
    documents.write_listing(r.runs().withColumn("error_message", F.nullif("error_message", F.lit(""))), path, "run")
    return documents.listing(r.spark, path, "run")[0].select("run_id", "task_id", "setup_id", "flow_id", "uploader", "error_message")


@query("src_17_evaluation_listing", needs=["evaluations"], sql="SELECT run_id, task_id, setup_id, flow_id, function, value FROM evaluations")
def _(r):
    path = new_path(r.spark, "listing")
    documents.write_listing(r.evaluations(), path, "evaluation", compression="gzip")
    return documents.listing(r.spark, path, "evaluation")[0].select("run_id", "task_id", "setup_id", "flow_id", "function", "value")


@query("src_17_flow_and_study_listing", needs=["flows", "studies"], sql="""
SELECT flow_id AS id, name, external_version AS detail FROM flows UNION ALL SELECT study_id, name, main_entity_type FROM studies""")
def _(r):
    path = new_path(r.spark, "listing")
    documents.write_listing(r.flows().withColumnRenamed("flow_id", "id"), f"{path}/flows", "flow")
    documents.write_listing(r.studies().withColumnRenamed("study_id", "id"), f"{path}/studies", "study")
    flows = documents.listing(r.spark, f"{path}/flows", "flow")[0].select("id", "name", F.col("external_version").alias("detail"))
    return flows.unionByName(documents.listing(r.spark, f"{path}/studies", "study")[0].select("id", "name", F.col("main_entity_type").alias("detail")))


@query("src_18_checksum_mismatches", sql="SELECT count(*) AS n_bad FROM (SELECT DISTINCT p_brand FROM part) WHERE CAST(substr(p_brand, 7) AS INT) % 3 = 0")
def _(r):
    path = new_path(r.spark, "brands")
    lines = r.table("part").select("p_brand", F.col("p_name").alias("value"))
    lines.repartition("p_brand").sortWithinPartitions("p_brand", "value").write.partitionBy("p_brand").text(path)
    files = r.spark.read.format("binaryFile").load(path).drop("p_brand")
    number = F.regexp_extract("path", r"p_brand=Brand(?:#|%23)(\d+)/", 1).cast("int")
    catalog = files.select("path", F.when(number % 3 == 0, F.md5(F.col("path"))).when(number % 3 == 1, F.md5("content")).otherwise("").alias("md5_checksum"))
    return tables.checksum_mismatches(files, catalog, limit=4_000).agg(F.count(F.lit(1)).alias("n_bad"))


@query("snk_01_arff_lines", sql="""
SELECT l_orderkey || ',' || l_linenumber || ',' || CASE WHEN l_discount = 0 THEN '?' ELSE CAST(l_discount AS VARCHAR) END || ',' || l_returnflag || ',' || CASE WHEN l_tax > 0.04 THEN 'True' ELSE 'False' END AS value FROM lineitem""")
def _(r):
    path = new_path(r.spark, "lines")
    rows = r.table("lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("d"), "l_returnflag", (F.col("l_tax") > 0.04).alias("t"))
    arff.write_dense(rows, path, "lines", {"l_returnflag": CLASSES}, order=None)
    return r.spark.read.text(f"{path}/rows")


@query("snk_02_dataset_cache", sql="SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_linestatus, l_returnflag, 6 AS n_features FROM lineitem")
def _(r):
    path = new_path(r.spark, "cache")
    features = line_features()
    tables.write_cache(r.table("lineitem").select(*[f.name for f in features]), features, path)
    data, back = tables.read_cache(r.spark, path)
    return ds.get_data(data, back, include_row_id=True, include_ignore_attribute=True).X.withColumn("n_features", F.lit(len(back)))


@query("snk_03_export_elements", needs=["runs"], sql="""
SELECT 'run_id' AS element, count(*) AS n FROM runs UNION ALL SELECT 'error_message', count(*) FROM runs WHERE error_message <> ''""")
def _(r):
    path = new_path(r.spark, "export")
    runs = r.runs().withColumn("error_message", F.nullif("error_message", F.lit("")))
    none = r.fold_evaluations().filter("fold < 0").select("run_id", "function", "repeat", "fold", F.lit(0).alias("sample"), "value", F.lit("").alias("array_data"))
    documents.write_runs(runs, none, path)
    element = F.regexp_extract("value", r"<[a-z]+:(run_id|error_message)>", 1)
    return r.spark.read.text(path).select(element.alias("element")).filter("element <> ''").groupBy("element").agg(F.count(F.lit(1)).alias("n"))


@query("snk_03_one_large_run", sql="""
SELECT 1 AS run_id, l_returnflag AS function, l_linenumber AS repeat, CAST(l_orderkey AS INTEGER) AS fold, CASE WHEN l_linenumber = 2 THEN 3 END AS sample, CASE WHEN l_tax > 0 THEN l_extendedprice END AS value,
 CASE WHEN l_tax = 0 THEN '[' || l_suppkey || ',"a<b"]' END AS array_data, 1 AS documents FROM lineitem""")
def _(r):
    """All lines as evaluations of one run, written as one document and read back whole."""
    path = new_path(r.spark, "large")
    e = r.table("lineitem").select(
        F.lit(1).cast("long").alias("run_id"), F.col("l_returnflag").alias("function"), F.col("l_linenumber").alias("repeat"), F.col("l_orderkey").cast("int").alias("fold"),
        F.when(F.col("l_linenumber") == 2, 3).alias("sample"), F.when(F.col("l_tax") > 0, F.col("l_extendedprice")).alias("value"),
        F.when(F.col("l_tax") == 0, F.concat(F.lit("["), "l_suppkey", F.lit(',"a<b"]'))).alias("array_data"))
    documents.write_runs(r.runs().limit(1).withColumn("run_id", F.lit(1).cast("long")), e, path)
    docs = documents.run_documents(r.spark, path)
    n = docs.heads.groupBy("run_id").agg(F.count(F.lit(1)).cast("int").alias("documents"))
    return documents.run_evaluations(docs).join(n, "run_id")


@query("snk_03_traces_and_studies", needs=["trace", "study_members"], sql="""
SELECT 'trace' AS kind, count(*) AS n, sum(iteration)::BIGINT AS total FROM trace UNION ALL SELECT 'run', count(*), sum(run_id)::BIGINT FROM study_members""")
def _(r):
    """One trace and one study that hold everything."""
    path = new_path(r.spark, "large")
    documents.write_traces(small_trace(r).withColumn("run_id", F.lit(9).cast("long")), f"{path}/t")
    one = r.studies().limit(1).withColumn("study_id", F.lit(4).cast("long"))
    documents.write_studies(one, r.study_members().select(F.lit(4).cast("long").alias("study_id"), F.lit("run").alias("entity_type"), F.col("run_id").alias("entity_id")), f"{path}/s")
    iterations = documents.traces(r.spark, f"{path}/t").filter("run_id = 9").agg(F.lit("trace").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum("iteration").alias("total"))
    found = documents.studies(r.spark, f"{path}/s")[1].filter("study_id = 4").groupBy(F.col("entity_type").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.sum("entity_id").alias("total"))
    return iterations.unionByName(found)


@query("run_06_stored_predictions", sql=f"""
WITH {P} SELECT repeat, fold, sample, row_id, prediction, correct, c_a AS "confidence.A", c_n AS "confidence.N", c_r AS "confidence.R" FROM p""")
def _(r):
    path = new_path(r.spark, "predictions")
    arff.write_dense(predictions(r).drop("estimate", "truth"), path, "predictions", {"prediction": CLASSES, "correct": CLASSES}, order=None)
    return arff.read_predictions(r.spark, path)
