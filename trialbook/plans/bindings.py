"""Registry entities over the star-schema tables, as DataFrames and as SQL.

``Registry`` gives each entity as a frame; ``CTE`` holds the same definition in SQL, so a query
and its SQL twin start from equal inputs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialbook.plans.scan import row_numbers

# Estimation procedures (id, name, task type, repeats, folds).
PROCEDURES = [
    (1, "10-fold Crossvalidation", 1, 1, 10),
    (2, "5 times 2-fold Crossvalidation", 1, 5, 2),
    (3, "10 times 10-fold Crossvalidation", 2, 10, 10),
    (4, "33% Holdout set", 3, 1, 1),
    (5, "Test on training data", 9, 1, 1),
]

# ARFF-style attributes of the lineitem features with their declared domains.
LINE_FEATURES = [
    (0, "l_quantity", "numeric", None, False, False, False),
    (1, "l_discount", "numeric", None, False, False, False),
    (2, "l_linestatus", "nominal", ["F", "O"], False, False, False),
    (3, "l_returnflag", "nominal", ["A", "N", "R", "X"], True, False, False),
    (4, "l_linenumber", "numeric", None, False, True, False),
    (5, "l_orderkey", "numeric", None, False, False, True),
]


class Registry:
    """The registry entities read from one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def datasets(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("did"), F.col("p_name").alias("name"),
            F.col("p_type").alias("format"),
            F.when(F.col("p_size") % 3 == 0, "active").when(F.col("p_size") % 3 == 1, "deactivated")
            .otherwise("in_preparation").alias("status"),
            (F.col("p_partkey") % 10).alias("uploader"),
        )

    def versioned_datasets(self) -> DataFrame:
        """Datasets with ``version`` counted per name; a name may hold most of the catalog."""
        return row_numbers(self.datasets(), ["name"], ["did"], "version")

    def qualities(self) -> DataFrame:
        wide = self.table("lineitem").groupBy(F.col("l_partkey").alias("did")).agg(
            F.count(F.lit(1)).cast("double").alias("NumberOfInstances"),
            F.size(F.collect_set("l_returnflag")).cast("double").alias("NumberOfClasses"),
            F.size(F.collect_set("l_linenumber")).cast("double").alias("NumberOfFeatures"),
            F.count_if(F.col("l_discount") == 0).cast("double").alias("NumberOfMissingValues"),
        )
        return wide.unpivot(["did"], QUALITY_NAMES, "name", "value")

    def dataset_tags(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("did"), F.col("p_brand").alias("tag"))

    def users(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("uploader"), F.col("c_name").alias("username"))

    def flows(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("flow_id"), F.col("s_name").alias("name"),
            F.concat(F.lit("v"), F.col("s_nationkey").cast("string")).alias("external_version"),
            F.col("s_nationkey").alias("uploader"),
        )

    def flow_tags(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("flow_id"),
            F.when(F.col("s_acctbal") < 5000, "low").otherwise("high").alias("tag"))

    def flow_edges(self) -> DataFrame:
        """Flows come in blocks of 40; flow p of a block has the sub-flows 3p+1 (left) and 3p+2 (right) there."""
        s = self.table("supplier").select(F.col("s_suppkey").alias("child"), (F.col("s_suppkey") % 40).alias("c"))
        return s.filter("c > 0 AND c % 3 IN (1, 2)").select(
            (F.col("child") - F.col("c") + F.floor((F.col("c") - 1) / 3)).cast("long").alias("parent"),
            F.when(F.col("c") % 3 == 1, "left").otherwise("right").alias("identifier"), "child")

    def chain_edges(self) -> DataFrame:
        """Parts as flows that come in chains of a hundred, each the component of the one before."""
        p = self.table("part").select(F.col("p_partkey").alias("child"))
        return p.filter("child % 100 <> 0").select(
            (F.col("child") - 1).alias("parent"), F.concat(F.lit("step"), (F.col("child") % 7).cast("string")).alias("identifier"), "child")

    def flow_parameters(self) -> DataFrame:
        s = self.table("supplier")
        return s.select(
            F.col("s_suppkey").alias("flow_id"),
            F.explode(F.array(
                F.struct(F.lit("tax").alias("name"), F.lit("0").alias("default_value"), F.lit("integer").alias("data_type")),
                F.struct(F.lit("ship").alias("name"), F.lit("F").alias("default_value"), F.lit("string").alias("data_type")),
                F.struct(F.lit("seed").alias("name"), F.col("s_nationkey").cast("string").alias("default_value"), F.lit("integer").alias("data_type")),
            )).alias("p"),
        ).select("flow_id", "p.*")

    def procedures(self) -> DataFrame:
        return self.spark.createDataFrame(
            PROCEDURES, "procedure_id int, procedure_name string, ttid int, repeats int, folds int")

    def tasks(self) -> DataFrame:
        used = self.table("lineitem").select(F.col("l_partkey").alias("p_partkey"))
        return self.table("part").join(used, "p_partkey", "left_semi").select(
            F.col("p_partkey").alias("task_id"), F.col("p_partkey").alias("did"),
            (1 + F.col("p_size") % 3).alias("ttid"), (1 + F.col("p_size") % 4).alias("procedure_id"),
            F.lit("l_returnflag").alias("target"),
        )

    def lines(self) -> DataFrame:
        """lineitem under registry names."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("run_id"), F.col("l_partkey").alias("task_id"),
            F.col("l_suppkey").alias("flow_id"),
            (F.col("l_suppkey") * 100 + F.round(F.col("l_tax") * 100).cast("long")).alias("setup_id"),
            F.round(F.col("l_tax") * 100).cast("long").alias("tax"), F.col("l_linestatus").alias("ship"),
            F.col("l_returnflag").alias("function"), F.col("l_linenumber").alias("fold"),
            F.col("l_discount").alias("value"),
        )

    def runs(self) -> DataFrame:
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("uploader"),
            F.col("o_orderdate").alias("upload_time"),
            F.when(F.col("o_orderstatus") == "P", "failed").otherwise("").alias("error_message"),
        )
        what = self.lines().groupBy("run_id").agg(
            F.min(F.struct("task_id", "flow_id", "setup_id")).alias("w"))
        return orders.join(what, "run_id").select(
            "run_id", "w.task_id", "w.flow_id", "w.setup_id", "uploader", "upload_time", "error_message")

    def setups(self) -> DataFrame:
        return self.lines().groupBy("setup_id", "flow_id", "tax").agg(F.min("ship").alias("ship")).select(
            "setup_id", "flow_id",
            F.create_map(F.lit("tax"), F.col("tax").cast("string"), F.lit("ship"), F.col("ship")).alias("parameters"))

    def setup_parameters(self) -> DataFrame:
        return (
            self.setups().join(self.flows().select("flow_id", F.col("name").alias("flow_name")), "flow_id")
            .select("setup_id", "flow_id", "flow_name", F.explode("parameters").alias("parameter_name", "value"))
            .withColumn("full_name", F.concat_ws("_", "flow_name", "parameter_name"))
        )

    def fold_evaluations(self) -> DataFrame:
        return self.lines().groupBy("run_id", "task_id", "flow_id", "setup_id", "function", "fold").agg(
            F.round(F.avg("value"), 6).alias("value")).withColumn("repeat", F.lit(0))

    def evaluations(self) -> DataFrame:
        return self.fold_evaluations().groupBy("run_id", "task_id", "flow_id", "setup_id", "function").agg(
            F.round(F.avg("value"), 6).alias("value"))

    def trace(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").alias("run_id"), F.lit(0).alias("repeat"), F.col("event_type").alias("fold"),
            F.col("event_id").alias("iteration"), F.col("value").alias("evaluation"),
            F.create_map(F.lit("parameter_k"), F.get_json_object("props", "$.k")).alias("parameters"))

    def study_members(self) -> DataFrame:
        nations = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("study_id"))
        customers = self.table("customer").select("c_custkey", "c_nationkey").join(nations, "c_nationkey")
        return self.table("orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("c_custkey")).join(
            customers, "c_custkey").select("study_id", "run_id")

    def studies(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").alias("study_id"), F.col("r_name").alias("name"),
            F.when(F.col("r_regionkey") % 2 == 0, "run").otherwise("task").alias("main_entity_type"),
            F.when(F.col("r_regionkey") < 3, "active").otherwise("in_preparation").alias("status"),
            (F.col("r_regionkey") * 7).alias("uploader"))

    def points(self) -> DataFrame:
        """Classification data: rowid, label, vector."""
        return self.table("embeddings").select(F.col("vec_id").alias("rowid"), "label", "embedding")

    def document_points(self) -> DataFrame:
        """Classification data with one numeric feature: rowid, label (quality), n_chars."""
        return self.table("labels").join(self.table("documents").select("doc_id", "n_chars"), "doc_id").select(
            F.col("doc_id").alias("rowid"), F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("x"))

    def line_rows(self) -> DataFrame:
        """lineitem rows addressed by position; rows are ordered over all columns."""
        base = self.table("lineitem")
        return row_numbers(base, [], base.columns, "rowid").withColumn("rowid", F.col("rowid") - 1)


QUALITY_NAMES = ["NumberOfInstances", "NumberOfClasses", "NumberOfFeatures", "NumberOfMissingValues"]

_PROCEDURE_ROWS = ", ".join(f"({i}, '{n}', {t}, {r}, {k})" for i, n, t, r, k in PROCEDURES)

CTE = {
    "datasets": """SELECT p_partkey AS did, p_name AS name, p_type AS format,
        CASE p_size % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'deactivated' ELSE 'in_preparation' END AS status,
        p_partkey % 10 AS uploader FROM part""",
    "versioned": "SELECT *, row_number() OVER (PARTITION BY name ORDER BY did) AS version FROM datasets",
    "q_wide": """SELECT l_partkey AS did, CAST(count(*) AS DOUBLE) AS "NumberOfInstances",
        CAST(count(DISTINCT l_returnflag) AS DOUBLE) AS "NumberOfClasses",
        CAST(count(DISTINCT l_linenumber) AS DOUBLE) AS "NumberOfFeatures",
        CAST(count(*) FILTER (WHERE l_discount = 0) AS DOUBLE) AS "NumberOfMissingValues"
        FROM lineitem GROUP BY 1""",
    "qualities": """SELECT did, 'NumberOfInstances' AS name, "NumberOfInstances" AS value FROM q_wide
        UNION ALL SELECT did, 'NumberOfClasses', "NumberOfClasses" FROM q_wide
        UNION ALL SELECT did, 'NumberOfFeatures', "NumberOfFeatures" FROM q_wide
        UNION ALL SELECT did, 'NumberOfMissingValues', "NumberOfMissingValues" FROM q_wide""",
    "dataset_tags": "SELECT p_partkey AS did, p_brand AS tag FROM part",
    "users": "SELECT c_custkey AS uploader, c_name AS username FROM customer",
    "flows": """SELECT s_suppkey AS flow_id, s_name AS name, 'v' || s_nationkey AS external_version,
        s_nationkey AS uploader FROM supplier""",
    "flow_tags": "SELECT s_suppkey AS flow_id, CASE WHEN s_acctbal < 5000 THEN 'low' ELSE 'high' END AS tag FROM supplier",
    "flow_edges": """SELECT s_suppkey - c + (c - 1) // 3 AS parent, CASE WHEN c % 3 = 1 THEN 'left' ELSE 'right' END AS identifier,
        s_suppkey AS child FROM (SELECT s_suppkey, s_suppkey % 40 AS c FROM supplier) WHERE c > 0 AND c % 3 IN (1, 2)""",
    "chain_edges": "SELECT p_partkey - 1 AS parent, 'step' || (p_partkey % 7) AS identifier, p_partkey AS child FROM part WHERE p_partkey % 100 <> 0",
    "flow_parameters": """SELECT s_suppkey AS flow_id, 'tax' AS name, '0' AS default_value, 'integer' AS data_type FROM supplier
        UNION ALL SELECT s_suppkey, 'ship', 'F', 'string' FROM supplier
        UNION ALL SELECT s_suppkey, 'seed', CAST(s_nationkey AS VARCHAR), 'integer' FROM supplier""",
    "procedures": f"SELECT * FROM (VALUES {_PROCEDURE_ROWS}) t(procedure_id, procedure_name, ttid, repeats, folds)",
    "tasks": """SELECT p_partkey AS task_id, p_partkey AS did, 1 + p_size % 3 AS ttid,
        1 + p_size % 4 AS procedure_id, 'l_returnflag' AS target
        FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)""",
    "lines": """SELECT l_orderkey AS run_id, l_partkey AS task_id, l_suppkey AS flow_id,
        l_suppkey * 100 + CAST(round(l_tax * 100) AS BIGINT) AS setup_id,
        CAST(round(l_tax * 100) AS BIGINT) AS tax, l_linestatus AS ship,
        l_returnflag AS function, l_linenumber AS fold, l_discount AS value FROM lineitem""",
    "runs": """SELECT o_orderkey AS run_id, w.task_id, w.flow_id, w.setup_id, o_custkey AS uploader,
        o_orderdate AS upload_time, CASE o_orderstatus WHEN 'P' THEN 'failed' ELSE '' END AS error_message
        FROM orders JOIN (SELECT run_id, task_id, flow_id, setup_id FROM lines
          QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY task_id, flow_id, setup_id) = 1) w
        ON o_orderkey = w.run_id""",
    "setups": "SELECT setup_id, flow_id, tax, min(ship) AS ship FROM lines GROUP BY 1, 2, 3",
    "setup_parameters": """SELECT u.*, f.name AS flow_name, f.name || '_' || u.parameter_name AS full_name FROM (
        SELECT setup_id, flow_id, 'tax' AS parameter_name, CAST(tax AS VARCHAR) AS value FROM setups
        UNION ALL SELECT setup_id, flow_id, 'ship', ship FROM setups) u JOIN flows f USING (flow_id)""",
    "fold_evaluations": """SELECT run_id, task_id, flow_id, setup_id, function, fold, 0 AS repeat,
        round(avg(value), 6) AS value FROM lines GROUP BY 1, 2, 3, 4, 5, 6""",
    "evaluations": """SELECT run_id, task_id, flow_id, setup_id, function, round(avg(value), 6) AS value
        FROM fold_evaluations GROUP BY 1, 2, 3, 4, 5""",
    "trace": """SELECT user_id AS run_id, 0 AS repeat, event_type AS fold, event_id AS iteration,
        value AS evaluation, json_extract_string(props, '$.k') AS k FROM events""",
    "study_members": """SELECT n_regionkey AS study_id, o_orderkey AS run_id FROM orders
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "studies": """SELECT r_regionkey AS study_id, r_name AS name,
        CASE WHEN r_regionkey % 2 = 0 THEN 'run' ELSE 'task' END AS main_entity_type,
        CASE WHEN r_regionkey < 3 THEN 'active' ELSE 'in_preparation' END AS status,
        r_regionkey * 7 AS uploader FROM region""",
    "points": "SELECT vec_id AS rowid, label, embedding FROM embeddings",
    "document_points": """SELECT l.doc_id AS rowid, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS x
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    "line_rows": """SELECT *, row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
        l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS rowid FROM lineitem""",
}

_NEEDS = {
    "versioned": ["datasets"], "qualities": ["q_wide"], "runs": ["lines"], "setups": ["lines"],
    "setup_parameters": ["lines", "setups", "flows"], "fold_evaluations": ["lines"],
    "evaluations": ["lines", "fold_evaluations"],
}


def with_entities(names: Iterable[str], body: str) -> str:
    """Prefix a SQL body with the CTEs of the named entities, in dependency order."""
    wanted: list[str] = []
    for name in names:
        for part in [*_NEEDS.get(name, []), name]:
            if part not in wanted:
                wanted.append(part)
    text = body.strip()
    if not wanted:
        return text
    head = ", ".join(f"{name} AS ({CTE[name]})" for name in wanted)
    if text.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head}, {text[15:]}"
    if text.upper().startswith("WITH "):
        return f"WITH {head}, {text[5:]}"
    return f"WITH {head} {text}"
