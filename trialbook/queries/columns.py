"""Column metadata, typing and quality queries (PRJ, AGG-06, SRC-04)."""

from pyspark.sql import functions as F

from trialbook.operators import datasets as ds
from trialbook.operators import qualities
from trialbook.plans.bindings import LINE_FEATURES
from trialbook.queries import query


def line_features():
    return [ds.Feature(i, n, t, tuple(v) if v else None, a, b, c) for i, n, t, v, a, b, c in LINE_FEATURES]


def feature_table(r):
    """Features derived from lineitem: dataset = part, index = line number - 1."""
    g = r.table("lineitem").groupBy(F.col("l_partkey").alias("did"), (F.col("l_linenumber") - 1).alias("index")).agg(
        F.min("l_returnflag").alias("f"), F.min("l_linestatus").alias("s"), F.count_if(F.col("l_tax") > 0.04).alias("m"))
    kind = F.when(F.col("f") == "A", "numeric").when(F.col("f") == "N", "nominal").otherwise("text")
    return g.select(
        "did", "index", F.concat(F.lit("f"), F.col("index").cast("string")).alias("name"), kind.alias("data_type"),
        F.when(F.col("s") == "F", F.array(F.lit("a"), F.lit("b"))).alias("nominal_values"),
        (F.col("m") == 0).alias("is_ignore"), (F.col("index") == 6).alias("is_row_identifier"))


FEATURE_TABLE = """ft AS (SELECT did, idx, 'f' || idx AS name, CASE WHEN f = 'A' THEN 'numeric' WHEN f = 'N' THEN 'nominal' ELSE 'text' END AS data_type,
 s = 'F' AS has_values, m = 0 AS is_ignore, idx = 6 AS is_row_identifier FROM (
 SELECT l_partkey AS did, l_linenumber - 1 AS idx, min(l_returnflag) AS f, min(l_linestatus) AS s,
 count(*) FILTER (WHERE l_tax > 0.04) AS m FROM lineitem GROUP BY 1, 2))"""


@query("src_04_parquet_scan", sql="SELECT * FROM lineitem")
def _(r):
    return r.table("lineitem")


@query("prj_01_get_data", sql="SELECT l_quantity, l_discount, l_linestatus FROM lineitem")
def _(r):
    return ds.get_data(r.table("lineitem"), line_features(), "l_returnflag").X


@query("prj_01_get_target_and_ignored", sql="SELECT l_returnflag, count(*) AS n, count(DISTINCT l_linenumber) AS n_ignored FROM lineitem GROUP BY 1")
def _(r):
    data = ds.get_data(r.table("lineitem"), line_features(), None, include_ignore_attribute=True)
    return data.X.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_linenumber").alias("n_ignored"))


@query("prj_02_features_by_type", sql=f"""
WITH {FEATURE_TABLE}, k AS (SELECT *, row_number() OVER (PARTITION BY did ORDER BY idx) - 1 AS position FROM ft
 WHERE NOT is_ignore AND NOT is_row_identifier AND name <> 'f2')
SELECT did, position, name FROM k WHERE data_type = 'nominal'""")
def _(r):
    return ds.features_by_type(feature_table(r), "nominal", exclude=["f2"])


@query("prj_03_class_labels", sql="""
SELECT o_orderpriority AS label, row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS position FROM orders GROUP BY 1""")
def _(r):
    rows = r.table("orders").withColumnRenamed("o_orderkey", "rowid")
    return ds.class_labels(rows, ds.Feature(0, "o_orderpriority", "string"))


@query("prj_04_decode_nominal", sql="""
SELECT l_orderkey, l_linenumber, CASE l_linenumber - 2 WHEN 0 THEN 'zero' WHEN 1 THEN 'one' WHEN 3 THEN 'three' END AS label FROM lineitem""")
def _(r):
    rows = r.table("lineitem").select("l_orderkey", "l_linenumber", (F.col("l_linenumber") - 2).alias("code"))
    return ds.decode_nominal(rows, "code", ["zero", "one", None, "three", "nan"], "label").drop("code")


@query("prj_04_codes_outside", sql="SELECT count(*) FILTER (WHERE l_linenumber - 2 < 0 OR l_linenumber - 2 >= 4) AS n_outside FROM lineitem")
def _(r):
    return ds.outside_domain(r.table("lineitem").select((F.col("l_linenumber") - 2).alias("code")), "code", ["zero", "one", None, "three"])


@query("prj_05_boolean_nominals", sql="""
SELECT event_id, CASE WHEN user_id % 3 = 0 THEN true WHEN user_id % 3 = 1 THEN false END AS flag, event_type FROM events""")
def _(r):
    e = r.table("events").select("event_id", F.when(F.col("user_id") % 3 == 0, "TRUE").when(F.col("user_id") % 3 == 1, "False").alias("flag"), "event_type")
    return ds.decode_booleans(e, [ds.Feature(0, "flag", "nominal", ("True", "FALSE")), ds.Feature(1, "event_type", "nominal", ("click", "view"))])


@query("prj_06_narrowing_facts", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS name, coalesce(count({c}) = count(*) AND min({c}) >= 0 AND max({c}) <= 255 AND sum(CASE WHEN {c} <> floor({c}) THEN 1 ELSE 0 END) = 0, false) AS narrow FROM lineitem"
    for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber", "l_orderkey")))
def _(r):
    return ds.narrowing_facts(r.table("lineitem"), ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_orderkey"])


@query("prj_06_narrowed", sql="SELECT l_orderkey, CAST(l_quantity AS SMALLINT) AS l_quantity, l_discount FROM lineitem")
def _(r):
    return ds.narrow(r.table("lineitem").select("l_orderkey", "l_quantity", "l_discount"), ["l_quantity", "l_discount"])


@query("prj_07_attributes", sql="""
SELECT 'l_quantity' AS name, 'REAL' AS type, count(l_quantity) AS n FROM lineitem UNION ALL SELECT 'l_linenumber', 'INTEGER', count(l_linenumber) FROM lineitem
UNION ALL SELECT 'l_returnflag', '{A,N,R}', count(l_returnflag) FROM lineitem UNION ALL SELECT 'l_linestatus', 'STRING', count(l_linestatus) FROM lineitem
UNION ALL SELECT 'taxed', '{True,False}', count(l_tax > 0) FROM lineitem""")
def _(r):
    rows = r.table("lineitem").select("l_quantity", "l_linenumber", "l_returnflag", "l_linestatus", (F.col("l_tax") > 0).alias("taxed"))
    found = ds.attributes_of(rows, {"l_returnflag": ["A", "N", "R"]})
    text = {n: t if isinstance(t, str) else "{" + ",".join(t) + "}" for n, t in found}
    one = rows.agg(*[F.count(n).alias(n) for n in text])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.col(n).alias("n")) for n, t in text.items()])).alias("a")).select("a.*")


@query("prj_08_describe_dataset", sql="""
WITH m AS (SELECT count(*) FILTER (WHERE l_discount = 0) AS d FROM lineitem)
SELECT 9 AS did, i AS "index", n AS name, t AS data_type, v AS nominal_values, CASE WHEN n = 'discount' THEN d ELSE 0 END AS number_of_missing_values,
 n = 'flag' AS is_target, n IN ('line', 'shipped') AS is_ignore, n = 'orderkey' AS is_row_identifier
FROM m, (VALUES (0, 'orderkey', 'numeric', NULL), (1, 'line', 'nominal', '1,2,3,4,5,6,7'), (2, 'discount', 'numeric', NULL), (3, 'flag', 'nominal', 'A,N,R'), (4, 'shipped', 'string', NULL)) t(i, n, t, v)""")
def _(r):
    rows = r.table("lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("line"),
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("discount"), F.col("l_returnflag").alias("flag"),
        F.col("l_shipdate").cast("string").alias("shipped"))
    described = ds.describe_dataset(rows, target="flag", ignore="line , shipped", row_id="orderkey",
                                    nominal={"flag": ["A", "N", "R"]}, overrides={"line": [str(i) for i in range(1, 8)]})
    return ds.feature_rows(rows, described, 9).withColumn("nominal_values", F.array_join("nominal_values", ","))


@query("prj_09_text_violations", sql="""
SELECT doc_id, 'text' AS field, list_aggregate(list_sort(list_distinct(regexp_extract_all(text, '[^\\x00-\\x7f]'))), 'string_agg', '') AS offenders
FROM documents WHERE regexp_matches(text, '[^\\x00-\\x7f]')
UNION ALL SELECT doc_id, 'source', list_aggregate(list_sort(list_distinct(regexp_extract_all(source, '[^a-zA-Z0-9_\\-\\.\\(\\),]'))), 'string_agg', '')
FROM documents WHERE regexp_matches(source, '[^a-zA-Z0-9_\\-\\.\\(\\),]')""")
def _(r):
    return ds.text_violations(r.table("documents"), "doc_id", ["text"], name="source")


@query("prj_10_task_inputs", needs=["tasks"], sql="""
SELECT t.task_id, t.did, l.l_orderkey, l.l_quantity, CASE WHEN t.ttid <> 5 THEN CASE t.target WHEN 'l_returnflag' THEN l.l_returnflag ELSE l.l_linestatus END END AS y
FROM (SELECT task_id, did, CASE WHEN ttid = 3 THEN 5 ELSE ttid END AS ttid, CASE WHEN procedure_id = 1 THEN 'l_linestatus' ELSE target END AS target FROM tasks) t
JOIN lineitem l ON l.l_partkey = t.did""")
def _(r):
    tasks = r.tasks().withColumns({
        "ttid": F.when(F.col("ttid") == 3, 5).otherwise(F.col("ttid")),
        "target": F.when(F.col("procedure_id") == 1, "l_linestatus").otherwise(F.col("target"))})
    rows = r.table("lineitem").select(F.col("l_partkey").alias("did"), "l_orderkey", "l_quantity", "l_returnflag", "l_linestatus")
    return ds.task_inputs(tasks, rows, ["l_returnflag", "l_linestatus"]).drop("l_returnflag", "l_linestatus")


@query("prj_11_profile", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS name, count(*) AS n, count(*) - count({e}) AS missing, count(DISTINCT {e}) AS distinct FROM lineitem"
    for c, e in (("l_partkey", "l_partkey"), ("l_discount", "nullif(l_discount, 0)"), ("l_returnflag", "l_returnflag"))))
def _(r):
    rows = r.table("lineitem").withColumn("l_discount", F.when(F.col("l_discount") != 0, F.col("l_discount")))
    return ds.profile(rows, ["l_partkey", "l_discount", "l_returnflag"])


@query("prj_11_domains", sql="""
SELECT 'l_returnflag' AS name, l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY 2
UNION ALL SELECT 'l_suppkey', CAST(l_suppkey AS VARCHAR), count(*) FROM lineitem GROUP BY 2""")
def _(r):
    return ds.domains(r.table("lineitem"), ["l_returnflag", "l_suppkey"])


@query("prj_12_create_tasks", sql="""
SELECT p_partkey AS did, 1 + p_size % 6 AS ttid, coalesce(CASE WHEN p_size % 2 = 0 THEN 4 END, CASE 1 + p_size % 6 WHEN 1 THEN 1 WHEN 2 THEN 7 WHEN 3 THEN 13 WHEN 5 THEN 17 END) AS procedure_id,
 CASE WHEN 1 + p_size % 6 IN (1, 2, 3, 5) THEN 'accepted' ELSE 'rejected' END AS outcome FROM part""")
def _(r):
    wanted = r.table("part").select(F.col("p_partkey").alias("did"), (1 + F.col("p_size") % 6).alias("ttid"),
                                    F.when(F.col("p_size") % 2 == 0, 4).alias("procedure_id"))
    accepted, rejected = ds.create_tasks(wanted)
    return accepted.withColumn("outcome", F.lit("accepted")).unionByName(rejected.withColumn("outcome", F.lit("rejected")))


@query("prj_13_feature_violations", sql=f"""
WITH {FEATURE_TABLE}
SELECT did, name, problem FROM (SELECT did, name, CASE WHEN data_type = 'text' THEN 'illegal type' WHEN data_type = 'nominal' AND NOT has_values THEN 'nominal without values'
 WHEN data_type <> 'nominal' AND has_values THEN 'values without nominal' END AS problem FROM ft) WHERE problem IS NOT NULL
UNION ALL SELECT did, NULL, 'indices are not 0..n-1' FROM ft GROUP BY did HAVING min(idx) <> 0 OR max(idx) <> count(*) - 1""")
def _(r):
    return ds.feature_violations(feature_table(r))


def _moment_sql(c, e):
    return f"""(SELECT avg(x) AS m0, stddev_pop(x) AS m1, avg(pow(x - mu, 3)) / pow(stddev_pop(x), 3) AS m2, avg(pow(x - mu, 4)) / pow(var_pop(x), 2) - 3 AS m3
      FROM (SELECT {e} AS x, (SELECT avg({e}) FROM rows) AS mu FROM rows))"""


@query("agg_06_qualities", sql=f"""
WITH rows AS (SELECT l_quantity, nullif(l_discount, 0) AS l_discount, l_linestatus, l_returnflag, CASE WHEN l_tax > 0.06 THEN NULL WHEN l_tax < 0.03 THEN 'low' ELSE 'mid' END AS bracket FROM lineitem),
b AS (SELECT count(*) AS n, sum((l_discount IS NULL)::INT + (bracket IS NULL)::INT) AS missing, sum((l_discount IS NULL OR bracket IS NULL)::INT) AS incomplete FROM rows),
m AS (SELECT avg(m0) AS m0, avg(m1) AS m1, avg(m2) AS m2, avg(m3) AS m3 FROM (SELECT * FROM {_moment_sql('q', 'l_quantity')} UNION ALL SELECT * FROM {_moment_sql('d', 'l_discount')})),
c AS (SELECT count(*) AS n FROM rows GROUP BY l_returnflag), h AS (SELECT log2(sum(n)) - sum(n * log2(n)) / sum(n) AS hy, max(n) AS most, sum(n) AS total FROM c),
j AS (SELECT 'l_linestatus' AS a, l_linestatus AS x, l_returnflag AS y, count(*) AS n FROM rows GROUP BY 2, 3 UNION ALL SELECT 'bracket', bracket, l_returnflag, count(*) FROM rows WHERE bracket IS NOT NULL GROUP BY 2, 3),
i AS (SELECT avg(hx) AS h, avg(hx + hy - hxy) AS mi FROM (SELECT a, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS hxy FROM j GROUP BY a)
 JOIN (SELECT a, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS hx FROM (SELECT a, x, sum(n) AS n FROM j GROUP BY 1, 2) GROUP BY a) USING (a)
 JOIN (SELECT a, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS hy FROM (SELECT a, y, sum(n) AS n FROM j GROUP BY 1, 2) GROUP BY a) USING (a))
SELECT name, round(CAST(value AS DOUBLE), 6) AS value FROM (
SELECT unnest(['NumberOfInstances', 'NumberOfFeatures', 'NumberOfMissingValues', 'NumberOfInstancesWithMissingValues', 'NumberOfNumericFeatures', 'NumberOfSymbolicFeatures', 'NumberOfBinaryFeatures',
 'PercentageOfMissingValues', 'PercentageOfInstancesWithMissingValues', 'PercentageOfNumericFeatures', 'PercentageOfSymbolicFeatures', 'PercentageOfBinaryFeatures', 'Dimensionality']) AS name,
 unnest([n::DOUBLE, 5, missing, incomplete, 2, 3, 1, 100.0::DOUBLE * missing / (n * 5), 100.0::DOUBLE * incomplete / n, 40, 60, 20, 5::DOUBLE / n]) AS value FROM b
UNION ALL SELECT unnest(['MeanMeansOfNumericAtts', 'MeanStdDevOfNumericAtts', 'MeanSkewnessOfNumericAtts', 'MeanKurtosisOfNumericAtts']), unnest([m0, m1, m2, m3]) FROM m
UNION ALL SELECT unnest(['NumberOfClasses', 'MajorityClassSize', 'MinorityClassSize', 'DefaultAccuracy', 'MajorityClassPercentage', 'MinorityClassPercentage', 'ClassEntropy']),
 unnest([4::DOUBLE, most, 0, most::DOUBLE / total, 100.0::DOUBLE * most / total, 0, hy]) FROM h
UNION ALL SELECT unnest(['MeanNominalAttDistinctValues', 'MinNominalAttDistinctValues', 'MaxNominalAttDistinctValues', 'StdvNominalAttDistinctValues', 'MeanAttributeEntropy', 'MeanMutualInformation',
 'EquivalentNumberOfAtts']), unnest([2.5::DOUBLE, 2, 3, 0.5, i.h, mi, round(hy / mi)]) FROM i, h)""")
def _(r):
    bracket = F.when(F.col("l_tax") > 0.06, None).when(F.col("l_tax") < 0.03, "low").otherwise("mid")
    rows = r.table("lineitem").select(
        "l_quantity", F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("l_discount"), "l_linestatus", "l_returnflag", bracket.alias("bracket"))
    features = [*[f for f in line_features() if f.index < 4], ds.Feature(4, "bracket", "nominal", ("low", "mid", "high"))]
    out = qualities.all_qualities(rows, features)
    # The ratio of class entropy to a tiny mutual information is compared whole; its noise ratio is left to the tests.
    value = F.when(F.col("name") == "EquivalentNumberOfAtts", F.round("value")).otherwise(F.round("value", 6))
    return out.filter("name <> 'MeanNoiseToSignalRatio'").withColumn("value", value)


@query("agg_06_informative_qualities", sql="""
WITH rows AS (SELECT l_quantity, l_returnflag, CASE WHEN l_returnflag = 'A' AND l_quantity < 45 THEN 'x' WHEN l_quantity < 10 THEN 'y' WHEN l_quantity > 5 THEN 'z' END AS hint, l_linestatus FROM lineitem),
c AS (SELECT l_returnflag AS y, count(*) AS n FROM rows GROUP BY 1), h AS (SELECT log2(sum(n)) - sum(n * log2(n)) / sum(n) AS hy, max(n) AS most, min(n) AS least, sum(n) AS total FROM c),
j AS (SELECT 'hint' AS a, hint AS x, l_returnflag AS y, count(*) AS n FROM rows WHERE hint IS NOT NULL GROUP BY 2, 3 UNION ALL SELECT 'l_linestatus', l_linestatus, l_returnflag, count(*) FROM rows GROUP BY 2, 3),
e AS (SELECT avg(hx) AS h, avg(greatest(hx + hy - hxy, 0)) AS mi FROM (SELECT a, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS hxy FROM j GROUP BY a)
 JOIN (SELECT a, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS hx FROM (SELECT a, x, sum(n) AS n FROM j GROUP BY 1, 2) GROUP BY a) USING (a)
 JOIN (SELECT a, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS hy FROM (SELECT a, y, sum(n) AS n FROM j GROUP BY 1, 2) GROUP BY a) USING (a))
SELECT unnest(['MajorityClassPercentage', 'MinorityClassPercentage', 'MeanAttributeEntropy', 'MeanMutualInformation', 'EquivalentNumberOfAtts', 'MeanNoiseToSignalRatio']) AS name,
 unnest([round(100.0::DOUBLE * most / total, 6), round(100.0::DOUBLE * least / total, 6), round(e.h, 6), round(mi, 6), round(hy / mi, 6), round((e.h - mi) / mi, 6)]) AS value FROM h, e""")
def _(r):
    """An attribute that tells much of the class, so that ratios to the information are well defined; both class shares."""
    hint = F.when((F.col("l_returnflag") == "A") & (F.col("l_quantity") < 45), "x").when(F.col("l_quantity") < 10, "y").when(F.col("l_quantity") > 5, "z")
    rows = r.table("lineitem").select("l_quantity", "l_returnflag", hint.alias("hint"), "l_linestatus")
    features = [ds.Feature(0, "l_quantity", "numeric"), ds.Feature(1, "l_returnflag", "nominal", ("A", "N", "R"), True),
                ds.Feature(2, "hint", "nominal", ("x", "y", "z")), ds.Feature(3, "l_linestatus", "nominal", ("F", "O"))]
    wanted = ["MajorityClassPercentage", "MinorityClassPercentage", "MeanAttributeEntropy", "MeanMutualInformation", "EquivalentNumberOfAtts", "MeanNoiseToSignalRatio"]
    return qualities.all_qualities(rows, features).filter(F.col("name").isin(wanted)).withColumn("value", F.round("value", 6))


@query("agg_06_moments_of_many_columns", sql="""
WITH x AS (SELECT i, CASE WHEN v > 0.3 THEN NULL ELSE CAST(v AS DOUBLE) + (i % 3) END AS v FROM (SELECT unnest(embedding || embedding || embedding || embedding) AS v, generate_subscripts(embedding || embedding || embedding || embedding, 1) AS i FROM embeddings)),
m AS (SELECT i, avg(v) AS mu FROM x GROUP BY 1),
c AS (SELECT x.i, avg(v) AS m0, stddev_pop(v) AS m1, avg(pow(v - mu, 3)) / pow(stddev_pop(v), 3) AS m2, avg(pow(v - mu, 4)) / pow(var_pop(v), 2) - 3 AS m3 FROM x JOIN m USING (i) GROUP BY 1)
SELECT i - 1 AS i, round(m0, 9) AS m0, round(m1, 9) AS m1, round(m2, 6) AS m2, round(m3, 6) AS m3 FROM c""")
def _(r):
    """256 columns with gaps, in one pass."""
    value = lambda i: F.col("embedding")[i % 64]
    wide = r.table("embeddings").select(*[F.when(value(i) <= 0.3, value(i).cast("double") + (i + 1) % 3).alias(f"x{i}") for i in range(256)])
    found = qualities.column_moments(wide, [f"x{i}" for i in range(256)])
    return found.select(F.col("i").cast("long").alias("i"), F.round("m0", 9).alias("m0"), F.round("m1", 9).alias("m1"), F.round("m2", 6).alias("m2"), F.round("m3", 6).alias("m3"))
