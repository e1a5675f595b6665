"""Catalog change-set queries (CHG)."""

from pyspark.sql import functions as F

from trialbook.operators import changes, members
from trialbook.queries import query

_OP = "CASE event_type WHEN 'signup' THEN 'add' WHEN 'error' THEN 'remove' ELSE event_type END"


def tag_log(r):
    op = F.when(F.col("event_type") == "signup", "add").when(F.col("event_type") == "error", "remove").otherwise(F.col("event_type"))
    return r.table("events").select(
        F.when(F.col("user_id") % 11 == 0, "study").otherwise("run").alias("kind"), F.col("user_id").alias("id"),
        F.concat(F.lit("t"), F.get_json_object("props", "$.k").cast("int") % 10).alias("tag"), op.alias("op"), F.col("event_id").alias("seq"))


LOG = f"""log AS (SELECT CASE WHEN user_id % 11 = 0 THEN 'study' ELSE 'run' END AS kind, user_id AS id, 't' || (CAST(json_extract_string(props, '$.k') AS INT) % 10) AS tag, {_OP} AS op, event_id AS seq FROM events)"""


@query("chg_01_apply_tags", sql=f"""
WITH {LOG}, e AS (SELECT kind, id, tag, op, seq FROM log WHERE kind = 'run' AND op IN ('add', 'remove') UNION ALL SELECT 'run', o_orderkey, 't1', 'add', -1 FROM orders WHERE o_orderstatus = 'F')
SELECT kind, id, tag FROM (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY kind, id, tag ORDER BY seq DESC) = 1) WHERE op = 'add'""")
def _(r):
    current = r.table("orders").filter("o_orderstatus = 'F'").select(F.lit("run").alias("kind"), F.col("o_orderkey").alias("id"), F.lit("t1").alias("tag"))
    return changes.apply_tags(current, tag_log(r))[0]


@query("chg_01_rejected_tags", sql=f"""
WITH {LOG} SELECT *, CASE WHEN kind = 'study' THEN 'unknown kind' ELSE 'unknown operation' END AS reason FROM log WHERE kind = 'study' OR op NOT IN ('add', 'remove')""")
def _(r):
    current = r.table("orders").select(F.lit("run").alias("kind"), F.col("o_orderkey").alias("id"), F.lit("t1").alias("tag"))
    return changes.apply_tags(current, tag_log(r))[1]


def status_log(r):
    status = F.when(F.col("event_type") == "signup", "active").when(F.col("event_type") == "error", "deactivated").otherwise("in_preparation")
    return r.table("events").select((F.col("user_id") * 20).alias("did"), status.alias("status"), F.col("event_id").alias("seq"))


STATUS = "sl AS (SELECT user_id * 20 AS did, CASE event_type WHEN 'signup' THEN 'active' WHEN 'error' THEN 'deactivated' ELSE 'in_preparation' END AS status, event_id AS seq FROM events)"


@query("chg_02_apply_status", needs=["datasets"], sql=f"""
WITH {STATUS}, last AS (SELECT did, arg_max(status, seq) AS status FROM sl WHERE status <> 'in_preparation' GROUP BY 1)
SELECT d.did, d.name, d.format, coalesce(l.status, d.status) AS status, d.uploader FROM datasets d LEFT JOIN last l ON l.did = d.did""")
def _(r):
    return changes.apply_status(r.datasets(), "did", status_log(r))[0]


@query("chg_02_rejected_status", needs=["datasets"], sql=f"""
WITH {STATUS} SELECT *, CASE WHEN status = 'in_preparation' THEN 'illegal status' ELSE 'unknown id' END AS reason FROM sl
WHERE status = 'in_preparation' OR did NOT IN (SELECT did FROM datasets)""")
def _(r):
    return changes.apply_status(r.datasets(), "did", status_log(r))[1]


def edited(r):
    datasets = r.datasets().withColumns({"description": F.lit("old"), "default_target_attribute": F.lit("class")})
    edits = r.table("events").select(
        (F.col("user_id") * 20).alias("did"), (F.col("event_id") % 10).alias("user"), F.col("event_id").alias("seq"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("description"),
        F.when(F.col("event_type").isin("purchase", "click"), F.concat(F.lit("y"), F.col("event_id").cast("string"))).alias("default_target_attribute"))
    return changes.edit_datasets(datasets, edits, r.tasks().filter("procedure_id = 1"))


EDITS = """e AS (SELECT user_id * 20 AS did, event_id % 10 AS "user", event_id AS seq, nullif(event_type, 'view') AS description,
 CASE WHEN event_type IN ('purchase', 'click') THEN 'y' || event_id END AS default_target_attribute FROM events),
j AS (SELECT e.*, CASE WHEN d.did IS NULL THEN 'unknown id' WHEN default_target_attribute IS NOT NULL AND e."user" <> d.uploader THEN 'not the owner'
 WHEN default_target_attribute IS NOT NULL AND e.did IN (SELECT did FROM tasks WHERE procedure_id = 1) THEN 'used by tasks' END AS reason FROM e LEFT JOIN datasets d ON d.did = e.did)"""


@query("chg_03_edit_datasets", needs=["datasets", "tasks"], sql=f"""
WITH {EDITS}, n AS (SELECT did, arg_max(description, seq) FILTER (WHERE description IS NOT NULL) AS description,
 arg_max(default_target_attribute, seq) FILTER (WHERE default_target_attribute IS NOT NULL) AS t FROM j WHERE reason IS NULL GROUP BY 1)
SELECT d.*, coalesce(n.description, 'old') AS description, coalesce(n.t, 'class') AS default_target_attribute FROM datasets d LEFT JOIN n ON n.did = d.did""")
def _(r):
    return edited(r)[0]


@query("chg_03_rejected_edits", needs=["datasets", "tasks"], sql=f"WITH {EDITS} SELECT * FROM j WHERE reason IS NOT NULL")
def _(r):
    return edited(r)[1]


@query("chg_04_fork_datasets", needs=["datasets", "versioned"], sql="""
WITH f AS (SELECT DISTINCT user_id * 9 AS did, user_id % 4 AS u FROM events), s AS (SELECT f.u, v.* FROM f JOIN versioned v ON v.did = f.did)
SELECT * FROM versioned UNION ALL
SELECT (SELECT max(did) FROM datasets) + row_number() OVER (ORDER BY did, u), name, format, status, u,
 (SELECT max(version) FROM versioned v WHERE v.name = s.name) + row_number() OVER (PARTITION BY name ORDER BY did, u) FROM s""")
def _(r):
    forks = r.table("events").select((F.col("user_id") * 9).alias("did"), (F.col("user_id") % 4).alias("user")).distinct()
    return changes.fork_datasets(r.versioned_datasets(), forks)[0]


def deleted(r):
    requests = r.table("events").select((F.col("user_id") * 13).alias("did"), (F.col("user_id") * 3 % 10).alias("user")).distinct()
    busy = r.tasks().filter("procedure_id IN (1, 2)").select("did")
    return changes.delete(r.datasets(), "did", requests, {"used by tasks": busy})


DEL = """q AS (SELECT DISTINCT user_id * 13 AS did, user_id * 3 % 10 AS "user" FROM events),
j AS (SELECT q.*, CASE WHEN d.did IS NULL THEN 'unknown id' WHEN q."user" <> d.uploader THEN 'not the owner'
 WHEN q.did IN (SELECT did FROM tasks WHERE procedure_id IN (1, 2)) THEN 'used by tasks' END AS reason FROM q LEFT JOIN datasets d ON d.did = q.did)"""


@query("chg_05_delete_datasets", needs=["datasets", "tasks"], sql=f"WITH {DEL} SELECT * FROM datasets WHERE did NOT IN (SELECT did FROM j WHERE reason IS NULL)")
def _(r):
    return deleted(r)[0]


@query("chg_05_rejected_deletes", needs=["datasets", "tasks"], sql=f"WITH {DEL} SELECT * FROM j WHERE reason IS NOT NULL")
def _(r):
    return deleted(r)[1]


@query("chg_06_apply_ontologies", sql=f"""
WITH c AS (SELECT user_id AS did, user_id % 5 AS "index", repeat('http://o/' || json_extract_string(props, '$.k'), CASE WHEN event_id % 17 = 0 THEN 30 ELSE 1 END) AS url, {_OP} AS op, event_id AS seq FROM events),
e AS (SELECT did, "index", url, op, seq FROM c WHERE length(url) <= 256 AND op IN ('add', 'remove') UNION ALL SELECT p_partkey, p_partkey % 5, 'http://o/1', 'add', -1 FROM part)
SELECT did, "index", url FROM (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY did, "index", url ORDER BY seq DESC) = 1) WHERE op = 'add'""")
def _(r):
    c = r.table("events").select(
        F.expr(_OP).alias("op"), F.col("user_id").alias("did"), (F.col("user_id") % 5).alias("index"), F.col("event_id").alias("seq"),
        F.expr("repeat(concat('http://o/', get_json_object(props, '$.k')), IF(event_id % 17 = 0, 30, 1))").alias("url"))
    current = r.table("part").select(F.col("p_partkey").alias("did"), (F.col("p_partkey") % 5).alias("index"), F.lit("http://o/1").alias("url"))
    return changes.apply_ontologies(current, c)[0]


@query("chg_07_compare_datasets", needs=["datasets"], sql="SELECT did, did % 6 <> 0 AND did % 10 <> 1 AS equal FROM datasets")
def _(r):
    d = r.datasets()
    other = d.filter("did % 10 <> 1").withColumns({
        "name": F.when(F.col("did") % 6 == 0, "changed").otherwise(F.col("name")), "uploader": F.col("uploader") + 1})
    return changes.compare_datasets(d, other, "did", ignore=["uploader"])


_KINDS = """ent AS (SELECT 'data' AS kind, did AS id, uploader FROM datasets UNION ALL SELECT 'task', task_id, task_id % 4 FROM tasks UNION ALL SELECT 'flow', flow_id, uploader % 4 FROM flows
 UNION ALL SELECT 'run', run_id, uploader % 4 FROM runs UNION ALL SELECT 'study', study_id, study_id % 4 FROM studies),
uses AS (SELECT 'task' AS kind, task_id AS id, 'data' AS used_kind, did AS used_id FROM tasks UNION ALL SELECT 'run', run_id, 'task', task_id FROM runs UNION ALL SELECT 'run', run_id, 'flow', flow_id FROM runs
 UNION ALL SELECT 'flow', parent, 'flow', child FROM flow_edges UNION ALL SELECT 'study', study_id, 'run', run_id FROM study_members WHERE run_id % 3 = 0),
req AS (SELECT DISTINCT CASE event_type WHEN 'click' THEN 'data' WHEN 'view' THEN 'task' WHEN 'purchase' THEN 'flow' WHEN 'signup' THEN 'run' ELSE 'study' END AS kind,
 CASE WHEN event_type = 'error' THEN event_id % 7 ELSE event_id % 3000 END AS id, event_id % 4 AS "user" FROM events)"""
_ENTITIES = ["datasets", "tasks", "flows", "runs", "studies", "flow_edges", "study_members"]


def all_kinds(r):
    """Entities of all kinds, what uses what, and requests to delete."""
    def of(frame, kind, key, owner):
        return frame.select(F.lit(kind).alias("kind"), F.col(key).cast("long").alias("id"), owner.cast("long").alias("uploader"))

    entities = members.concat([
        of(r.datasets(), "data", "did", F.col("uploader")), of(r.tasks(), "task", "task_id", F.col("task_id") % 4), of(r.flows(), "flow", "flow_id", F.col("uploader") % 4),
        of(r.runs(), "run", "run_id", F.col("uploader") % 4), of(r.studies(), "study", "study_id", F.col("study_id") % 4)])

    def uses(frame, kind, key, used_kind, used):
        return frame.select(F.lit(kind).alias("kind"), F.col(key).cast("long").alias("id"), F.lit(used_kind).alias("used_kind"), F.col(used).cast("long").alias("used_id"))

    graph = members.concat([
        uses(r.tasks(), "task", "task_id", "data", "did"), uses(r.runs(), "run", "run_id", "task", "task_id"), uses(r.runs(), "run", "run_id", "flow", "flow_id"),
        uses(r.flow_edges(), "flow", "parent", "flow", "child"), uses(r.study_members().filter("run_id % 3 = 0"), "study", "study_id", "run", "run_id")])
    kind = F.col("event_type")
    requests = r.table("events").select(
        F.when(kind == "click", "data").when(kind == "view", "task").when(kind == "purchase", "flow").when(kind == "signup", "run").otherwise("study").alias("kind"),
        F.when(kind == "error", F.col("event_id") % 7).otherwise(F.col("event_id") % 3000).alias("id"), (F.col("event_id") % 4).alias("user")).distinct()
    return entities, requests, graph


@query("chg_05_delete_of_any_kind", needs=_ENTITIES, sql=f"""
WITH {_KINDS}, u AS (SELECT used_kind AS kind, used_id AS id, min(CASE uses.kind WHEN 'task' THEN 1 WHEN 'run' THEN 2 WHEN 'flow' THEN 3 ELSE 5 END) AS k FROM uses SEMI JOIN ent USING (kind, id) GROUP BY 1, 2),
j AS (SELECT req.*, CASE WHEN ent.id IS NULL THEN 'unknown id' WHEN ent.uploader <> req."user" THEN 'not the owner' WHEN u.k IS NOT NULL THEN 'used by a ' || ['task', 'run', 'flow', 'setup', 'study'][u.k] END AS reason
 FROM req LEFT JOIN ent USING (kind, id) LEFT JOIN u USING (kind, id))
SELECT kind, id, "user", reason FROM j WHERE reason IS NOT NULL UNION ALL
SELECT kind, id, uploader, 'still there' FROM ent WHERE (kind, id) NOT IN (SELECT (kind, id) FROM j WHERE reason IS NULL)""")
def _(r):
    left, refused = changes.delete_any(*all_kinds(r))
    return refused.unionByName(left.select("kind", "id", F.col("uploader").alias("user"), F.lit("still there").alias("reason")))


_REACH = """reach AS (SELECT q.kind, q.id, u.kind AS by_kind, u.id AS by_id FROM (SELECT DISTINCT kind, id FROM req) q JOIN uses u ON u.used_kind = q.kind AND u.used_id = q.id
 UNION SELECT r.kind, r.id, u.kind, u.id FROM reach r JOIN uses u ON u.used_kind = r.by_kind AND u.used_id = r.by_id)"""


@query("chg_05_dependents", needs=_ENTITIES, sql=f"WITH RECURSIVE {_KINDS}, {_REACH} SELECT kind, id, by_kind, count(*) AS n, sum(by_id)::BIGINT AS ids FROM reach GROUP BY 1, 2, 3")
def _(r):
    """All that depends on what is to be deleted, through tasks, runs, flows and studies."""
    _, requests, graph = all_kinds(r)
    return changes.dependents(requests, graph).groupBy("kind", "id", "by_kind").agg(F.count(F.lit(1)).alias("n"), F.sum("by_id").alias("ids"))


@query("chg_05_delete_with_dependents", needs=_ENTITIES, sql=f"""
WITH RECURSIVE {_KINDS}, {_REACH}, w AS (SELECT r.kind, r.id, min(e.uploader) AS lo, max(e.uploader) AS hi FROM reach r JOIN ent e ON e.kind = r.by_kind AND e.id = r.by_id GROUP BY 1, 2),
j AS (SELECT req.*, CASE WHEN ent.id IS NULL THEN 'unknown id' WHEN ent.uploader <> req."user" THEN 'not the owner' WHEN w.lo <> req."user" OR w.hi <> req."user" THEN 'others own what depends on it' END AS reason
 FROM req LEFT JOIN ent USING (kind, id) LEFT JOIN w USING (kind, id)),
gone AS (SELECT kind, id FROM j WHERE reason IS NULL UNION SELECT r.by_kind, r.by_id FROM reach r JOIN j ON j.kind = r.kind AND j.id = r.id WHERE j.reason IS NULL)
SELECT kind, id, "user", reason FROM j WHERE reason IS NOT NULL UNION ALL SELECT kind, id, uploader, 'still there' FROM ent WHERE (kind, id) NOT IN (SELECT (kind, id) FROM gone)""")
def _(r):
    left, refused = changes.delete_any(*all_kinds(r), cascade=True)
    return refused.unionByName(left.select("kind", "id", F.col("uploader").alias("user"), F.lit("still there").alias("reason")))


@query("chg_02_study_status", needs=["studies"], sql="""
WITH c AS (SELECT event_id % 6 AS study_id, CASE event_type WHEN 'click' THEN 'active' WHEN 'view' THEN 'deactivated' ELSE 'in_preparation' END AS status, event_id AS seq FROM events),
l AS (SELECT study_id, arg_max(status, seq) AS status FROM c WHERE status <> 'in_preparation' GROUP BY 1)
SELECT s.study_id, s.name, coalesce(l.status, s.status) AS status FROM studies s LEFT JOIN l USING (study_id)""")
def _(r):
    """Status updates of studies and suites."""
    kind = F.col("event_type")
    log = r.table("events").select((F.col("event_id") % 6).alias("study_id"), F.when(kind == "click", "active").when(kind == "view", "deactivated").otherwise("in_preparation").alias("status"), F.col("event_id").alias("seq"))
    return changes.apply_status(r.studies().select("study_id", "name", "status"), "study_id", log)[0]
