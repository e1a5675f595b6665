"""Registry documents on small files of our own."""

import pytest

from trialbook.sources import documents

NS = 'xmlns:oml="http://example.org/ns"'


def put(tmp_path, name, body):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(body)
    return str(path)


def test_features_keep_spaces_and_default_counts(spark, tmp_path):
    path = put(tmp_path, "12/features.xml", f"""<oml:data_features {NS}>
  <oml:feature><oml:index>0</oml:index><oml:name>x</oml:name><oml:data_type>numeric</oml:data_type><oml:is_target>false</oml:is_target>
    <oml:number_of_missing_values>13</oml:number_of_missing_values></oml:feature>
  <oml:feature><oml:index>1</oml:index><oml:name>y</oml:name><oml:data_type>nominal</oml:data_type>
    <oml:nominal_value> under ten </oml:nominal_value><oml:nominal_value> ten and over</oml:nominal_value><oml:is_target>true</oml:is_target></oml:feature>
</oml:data_features>""")
    a, b = documents.features(spark, path).orderBy("index").collect()
    assert (a["did"], a["name"], a["nominal_values"], a["number_of_missing_values"], a["is_target"]) == (12, "x", None, 13, False)
    assert (b["nominal_values"], b["number_of_missing_values"], b["is_target"]) == ([" under ten ", " ten and over"], 0, True)


def test_qualities(spark, tmp_path):
    path = put(tmp_path, "q.xml", f"""<oml:data_qualities {NS}><oml:quality><oml:name>a</oml:name><oml:value>0.5</oml:value></oml:quality>
<oml:quality><oml:name>b</oml:name><oml:value>null</oml:value></oml:quality><oml:quality><oml:name>c</oml:name></oml:quality></oml:data_qualities>""")
    assert sorted(tuple(r) for r in documents.qualities(spark, path, 3).collect()) == [(3, "a", 0.5), (3, "b", None), (3, "c", None)]


def test_description(spark, tmp_path):
    path = put(tmp_path, "d.xml", f"""<oml:data_set_description {NS}><oml:id>-7</oml:id><oml:name>words</oml:name><oml:version>1</oml:version>
<oml:upload_date></oml:upload_date><oml:md5_checksum></oml:md5_checksum><oml:ignore_attribute>p</oml:ignore_attribute><oml:ignore_attribute>q</oml:ignore_attribute>
</oml:data_set_description>""")
    r = documents.descriptions(spark, path).first()
    assert (r["did"], r["name"], r["version"], r["upload_date"], r["md5_checksum"], r["ignore_attribute"]) == (-7, "words", 1, None, None, ["p", "q"])


TASK = """<oml:task {ns}><oml:task_id>{tid}</oml:task_id><oml:task_type_id>{ttid}</oml:task_type_id><oml:task_type>T</oml:task_type>
<oml:input name="source_data"><oml:data_set><oml:data_set_id>2</oml:data_set_id><oml:target_feature>class</oml:target_feature></oml:data_set></oml:input>
<oml:input name="estimation_procedure"><oml:estimation_procedure><oml:id>3</oml:id><oml:type>crossvalidation</oml:type>
<oml:parameter name="number_repeats">3</oml:parameter><oml:parameter name="percentage"></oml:parameter></oml:estimation_procedure></oml:input>
<oml:input name="evaluation_measures"><oml:evaluation_measures><oml:evaluation_measure>acc</oml:evaluation_measure></oml:evaluation_measures></oml:input></oml:task>"""


def test_tasks(spark, tmp_path):
    put(tmp_path, "t/1.xml", TASK.format(ns=NS, tid=4711, ttid=1))
    put(tmp_path, "t/2.xml", TASK.format(ns=NS, tid=9, ttid=4))
    good, other = documents.tasks(spark, str(tmp_path / "t"))
    r = good.first()
    assert good.count() == 1 and other.first()["task_id"] == 9
    assert (r["task_id"], r["did"], r["target"], r["measure"], r["estimation"]["id"]) == (4711, 2, "class", "acc", 3)
    assert r["estimation"]["parameters"] == {"number_repeats": "3", "percentage": ""}


RUN = """<oml:run {ns}><oml:run_id>5</oml:run_id><oml:uploader>1</oml:uploader><oml:task_id>2</oml:task_id><oml:flow_id>3</oml:flow_id><oml:setup_id>4</oml:setup_id>
<oml:parameter_setting><oml:name>depth</oml:name><oml:value>7</oml:value><oml:component>60</oml:component></oml:parameter_setting>
<oml:input_data><oml:dataset><oml:did>8</oml:did></oml:dataset></oml:input_data>
<oml:output_data><oml:file><oml:file_id>11</oml:file_id><oml:name>predictions</oml:name><oml:url>u</oml:url></oml:file>
<oml:evaluation><oml:name>acc</oml:name><oml:value>0.5</oml:value></oml:evaluation>
<oml:evaluation repeat="0" fold="1"><oml:name>acc</oml:name><oml:value>0.25</oml:value></oml:evaluation>
<oml:evaluation repeat="0" fold="1" sample="2"><oml:name>acc</oml:name>{last}</oml:evaluation></oml:output_data></oml:run>"""


def test_runs(spark, tmp_path):
    path = put(tmp_path, "r.xml", RUN.format(ns=NS, last="<oml:array_data>[1,2]</oml:array_data>"))
    docs = documents.run_documents(spark, path)
    r = documents.runs(docs).first()
    assert (r["run_id"], r["did"], r["predictions_file_id"], r["error_message"], r["parameters"]) == (5, 8, 11, "", {"60/depth": "7"})
    got = [tuple(e) for e in documents.run_evaluations(docs).collect()]
    assert got == [(5, "acc", None, None, None, 0.5, None), (5, "acc", 0, 1, None, 0.25, None), (5, "acc", 0, 1, 2, None, "[1,2]")]
    bad = put(tmp_path, "bad.xml", RUN.format(ns=NS, last=""))
    with pytest.raises(Exception, match="neither value nor array_data"):
        documents.run_evaluations(documents.run_documents(spark, bad)).collect()


def test_long_documents_stay_whole(spark, tmp_path):
    t = spark.range(55).selectExpr("1L AS run_id", "0 AS repeat", "0 AS fold", "id AS iteration", "id / 10.0D AS evaluation", "id = 3 AS selected", "map('k', string(id)) AS parameters")
    documents.write_traces(t, str(tmp_path / "t"))
    back = documents.traces(spark, str(tmp_path / "t"))
    assert [r["iteration"] for r in back.collect() if r["run_id"] == 1 and r["parameters"] == {"k": str(r["iteration"])}].__len__() == 55
    members = spark.range(40).selectExpr("7L AS study_id", "IF(id % 4 = 0, 'task', 'run') AS entity_type", "id AS entity_id")
    table = spark.createDataFrame([(7, "s <&>", "run"), (8, "empty", "task")], "study_id long, name string, main_entity_type string")
    documents.write_studies(table, members, str(tmp_path / "s"))
    studies, found = documents.studies(spark, str(tmp_path / "s"))
    assert sorted((r["study_id"], r["name"]) for r in studies.collect()) == [(7, "s <&>"), (8, "empty")]
    assert sorted((r["study_id"], r["entity_id"], r["entity_type"]) for r in found.collect()) == [(7, i, "run" if i % 4 else "task") for i in range(40)]
    assert sum(p.read_text().count("<oml:study>") for p in (tmp_path / "s").rglob("part-*")) == 2
    with pytest.raises(Exception, match="expected a study of run"):
        documents.studies(spark, str(tmp_path / "s"), entity="run")[0].collect()


def test_files_are_whole_documents(spark, tmp_path):
    """Every file can be read by any XML reader."""
    import xml.etree.ElementTree as ET

    e = spark.range(3000).selectExpr("id % 40 AS run_id", "'f' AS function", "0 AS repeat", "int(id) AS fold", "0 AS sample", "1.5D AS value", "'<x>' AS array_data")
    runs = spark.range(40).selectExpr("id AS run_id", "1L AS task_id", "2L AS flow_id", "3L AS setup_id")
    documents.write_runs(runs, e, str(tmp_path / "r"), namespace="http://example.org/ns")
    seen = []
    for file in (tmp_path / "r").rglob("part-*"):
        for run in ET.parse(file).getroot():
            folds = [int(x.attrib["fold"]) for x in run.iter() if x.tag.endswith("}evaluation")]
            assert folds == sorted(folds) and len(folds) == 75
            seen.append(run[0].text)
    assert sorted(map(int, seen)) == list(range(40))


@pytest.mark.parametrize("split", [97, 1024, 100_000])
def test_splits_lose_nothing(spark, tmp_path, split):
    """Elements, entries and trees that lie over the splits of a file, under another prefix and after comments."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = "".join(f"<r:run><r:run_id>{i}</r:run_id><r:task_id>2</r:task_id></r:run>\n<r:run/>" if i % 9 == 0 else f"<r:run a='x>y'><r:run_id>{i}</r:run_id></r:run>" for i in range(300))
        path = put(tmp_path, "l.xml", f'<?xml version="1.0"?>\n<!-- <x> -->\n<r:runs xmlns:r="u">{rows}</r:runs>')
        good, bad = documents.listing(spark, path, "run")
        assert sorted(r["run_id"] for r in good.collect()) == list(range(300)) and bad.count() == 34
        body = "".join(f"<r:run><r:run_id>{i}</r:run_id><r:output_data>" + "".join(
            f"<r:evaluation repeat='0' fold='{k}'><r:name>m</r:name><r:value>{i}.5</r:value></r:evaluation>" for k in range(i % 7)) + f"</r:output_data><r:error_message>{i}</r:error_message></r:run>" for i in range(60))
        docs = documents.run_documents(spark, put(tmp_path, "r.xml", f"<r:runs>{body}</r:runs>"))
        assert sorted((r["run_id"], r["error_message"]) for r in documents.runs(docs).collect()) == [(i, str(i)) for i in range(60)]
        assert sorted((r["run_id"], r["fold"], r["value"]) for r in documents.run_evaluations(docs).collect()) == [(i, k, i + 0.5) for i in range(60) for k in range(i % 7)]

        def flow(depth, width):
            return f"<r:flow><r:name>n{depth}</r:name>" + "".join(f"<r:component><r:identifier>c{k}&amp;</r:identifier>{flow(depth - 1, width)}</r:component>" for k in range(width if depth else 0)) + "<r:version>7</r:version></r:flow>"

        text = "<r:flows>" + flow(4, 3) + flow(0, 1) + flow(30, 1) + "</r:flows>"
        got = documents.flow_nodes(spark, put(tmp_path, "f.xml", text)).collect()
        assert len(got) == 121 + 1 + 31 and len({r["document"] for r in got}) == 3 and {r["version"] for r in got} == {"7"}
        assert all(r["name"] == f"n{ {121: 4, 1: 0, 31: 30}[n] - len(r['path'])}" for d in {r["document"] for r in got}
                   for n in [sum(x["document"] == d for x in got)] for r in got if r["document"] == d)
        assert len({(r["document"], tuple(r["path"])) for r in got}) == len(got) and all(p.startswith("c") and p.endswith("&") for r in got for p in r["path"])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_large_file_is_many_partitions(spark, tmp_path):
    body = "".join(f"<oml:evaluation><oml:run_id>{i}</oml:run_id><oml:function>f</oml:function><oml:value>{i}.25</oml:value></oml:evaluation>\n" for i in range(90_000))
    path = put(tmp_path, "e.xml", f"<oml:evaluations {NS}>{body}</oml:evaluations>")
    assert len(body) > 9 << 20
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        good, bad = documents.listing(spark, path, "evaluation")
        assert good.rdd.getNumPartitions() >= 9
        assert good.count() == 90_000 and bad.count() == 0
        assert good.agg({"value": "sum"}).first()[0] == sum(i + 0.25 for i in range(90_000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_elements_that_cannot_be_told_apart(spark, tmp_path):
    for name, text in {"prefix": "<a:qs><a:quality><a:name>x</a:name></a:quality><b:quality/></a:qs>", "blank": "<qs><quality><name>x</name></quality ><quality></quality></qs>",
                       "nested": "<qs><quality><quality></quality></quality></qs>", "cdata": "<qs><quality><name><![CDATA[</quality>]]></name></quality></qs>"}.items():
        path = put(tmp_path, f"{name}.xml", text)
        with pytest.raises(Exception, match="cannot be told apart"):
            documents.qualities(spark, path, 1).collect()


def test_setup_without_parameters(spark, tmp_path):
    path = put(tmp_path, "s.xml", f"<oml:setups {NS}><oml:setup><oml:setup_id>1</oml:setup_id><oml:flow_id>2</oml:flow_id></oml:setup></oml:setups>")
    r = documents.setups(spark, path).first()
    assert (r["setup_id"], r["flow_id"], r["parameter_name"]) == (1, 2, None)


FLOW = """<oml:flow {ns}><oml:id>1</oml:id><oml:name>a</oml:name><oml:parameter><oml:name>p</oml:name><oml:default_value>3</oml:default_value></oml:parameter>
<oml:component><oml:identifier>x</oml:identifier><oml:flow><oml:id>2</oml:id><oml:name>b</oml:name>
<oml:component><oml:identifier>y</oml:identifier><oml:flow><oml:id>3</oml:id><oml:name>c</oml:name></oml:flow></oml:component></oml:flow></oml:component></oml:flow>"""


def test_flow_tree(spark, tmp_path):
    path = put(tmp_path, "f.xml", FLOW.format(ns=NS))
    rows = sorted((tuple(r["path"]), r["flow_id"], r["name"]) for r in documents.flow_nodes(spark, path).collect())
    assert rows == [((), 1, "a"), (("x",), 2, "b"), (("x", "y"), 3, "c")]


def test_flows_without_ids(spark, tmp_path):
    """Two documents, neither of which has an id."""
    for k in (1, 2):
        put(tmp_path, f"f/{k}.xml", FLOW.format(ns=NS).replace("<oml:id>1</oml:id>", "").replace("<oml:id>2</oml:id>", ""))
    rows = documents.flow_nodes(spark, str(tmp_path / "f")).collect()
    assert len({r["document"] for r in rows}) == 2
    for d in {r["document"] for r in rows}:
        assert sorted((tuple(r["path"]), r["root_id"], r["flow_id"]) for r in rows if r["document"] == d) == [((), None, None), (("x",), None, None), (("x", "y"), None, 3)]


def test_listing_rejects_and_namespace(spark, tmp_path):
    path = put(tmp_path, "l.xml", f"""<oml:runs {NS}><oml:run><oml:run_id>1</oml:run_id><oml:task_id>2</oml:task_id></oml:run>
<oml:run><oml:run_id>2</oml:run_id><oml:task_id>two</oml:task_id></oml:run><oml:run><oml:task_id>3</oml:task_id></oml:run></oml:runs>""")
    rows, rejects = documents.listing(spark, path, "run")
    assert [(r["run_id"], r["error_message"]) for r in rows.collect()] == [(1, "")]
    assert rejects.count() == 2
    assert documents.foreign_documents(spark, path, "http://example.org/ns").count() == 0
    assert documents.foreign_documents(spark, path, "http://elsewhere").count() == 1


def test_flows_of_any_depth(spark, tmp_path):
    """A chain of nine flows is written whole; a flow that contains itself, or an unknown one, is an error."""
    nodes = spark.range(1, 10).selectExpr("id AS flow_id", "concat('f', id) AS name", "'1' AS external_version")
    edges = spark.range(1, 9).selectExpr("id AS parent", "'part' AS identifier", "id + 1 AS child")
    documents.write_flows(nodes, edges, str(tmp_path / "chain"))
    text = "".join(p.read_text() for p in (tmp_path / "chain").rglob("part-*"))
    assert all(text.count(f">f{k}<") == 1 for k in range(1, 10))
    for extra in ((9, "part", 1), (9, "part", 77)):
        with pytest.raises(ValueError, match="contain themselves"):
            documents.write_flows(nodes, edges.union(spark.createDataFrame([extra], edges.schema)), str(tmp_path / f"bad{extra[2]}"))


@pytest.mark.parametrize("split, batch", [(97, 3), (1000, 7), (100_000, 10_000)])
def test_rows_are_numbered_while_they_are_read(spark, tmp_path, split, batch):
    """Sums over all rows before, over splits, files and batches, and the text of the files is neither shuffled nor sorted."""
    from pyspark.sql import functions as F

    from trialbook.sources import elements

    for k in range(3):
        put(tmp_path, f"d/{k}.xml", "".join(f"<a>{k}-{i}</a>" for i in range(200)))
    settings = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": 0, "spark.sql.execution.arrow.maxRecordsPerBatch": batch}
    for key, value in settings.items():
        spark.conf.set(key, str(value))
    try:
        cut = elements.pieces(spark, str(tmp_path / "d"), "</a>")
        # Every row adds 1, and its number to a sum that starts anew in each file.
        out = elements.numbered(cut, {"place": F.lit(1), "own": F.regexp_extract("value", r"-(\d+)", 1).cast("int")}, ["own"])
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert "line#" in plan and not any("line#" in step for step in plan.splitlines() if "Sort " in step or "Window " in step)
        rows = [(r["value"], r["place"], r["own"]) for r in out.collect()]
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert sorted(rows, key=lambda r: r[1]) == [(f"<a>{k}-{i}", 200 * k + i, i * (i - 1) // 2) for k in range(3) for i in range(200)]


def test_listing_text_is_cleaned_once(spark, tmp_path):
    """Each field of a row is trimmed once, not anew for every filter and column, and as the pattern of blanks does."""
    from pyspark.sql import functions as F

    path = put(tmp_path, "e.xml", f"""<oml:evaluations {NS}><oml:evaluation><oml:run_id> 1
</oml:run_id><oml:function>\t f&lt;![CDATA[ </oml:function><oml:value> 2.5</oml:value></oml:evaluation>
<oml:evaluation/><oml:evaluation><oml:run_id>x</oml:run_id></oml:evaluation></oml:evaluations>""")
    good, bad = documents.listing(spark, path, "evaluation")
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    # Neither filter nor columns trim: that is done where the rows are made.
    above, rows = plan.split("Generate")
    assert "trim" not in above and "regexp_replace" not in above and "trim" in rows
    assert [(r["run_id"], r["function"], r["value"]) for r in good.collect()] == [(1, "f<![CDATA[", 2.5)]
    assert bad.columns == good.columns + [documents.CORRUPT, "_metadata"] and sorted((r["run_id"] or "") for r in bad.collect()) == ["", "x"]

    texts = ["", " ", "a", " a b\n", "\x0ba\f\r", "a  ", "a\u0085 ", "  ", " a\x1c ", None]
    got = spark.createDataFrame([(x,) for x in texts], "v string").select("v", documents.text("v").alias("t"), F.regexp_replace("v", r"^\s+|\s+$", "").alias("o"))
    assert all(r["t"] == (r["o"] or None) for r in got.collect())


def lines_of(folder):
    """The text of each folder's one file."""
    files = sorted(folder.rglob("part-*"))
    assert len({f.parent for f in files}) == len(files)
    return {f.parent.name: f.read_bytes() for f in files}


WRITE_ONE = """
import sys
from pyspark.sql import SparkSession
from trialbook.sources import elements
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.memory", "1g").config("spark.sql.shuffle.partitions", "8")
  .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k").config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k").config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false")
  .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.dir", "file://" + sys.argv[1]).getOrCreate())
lines = spark.range(40000).selectExpr("1 AS entity", "id % 5 AS a", "id % 3 AS b", "format_string('<e>%d %d %05d</e>', id % 5, id % 3, id) AS line")
elements.write_lines(lines, sys.argv[2], "es", ["a", "b"])
"""


def test_a_document_is_written_by_many_tasks(tmp_path):
    """One document of 40,000 lines is one file in order, and no task reads as much as a third of it, though few keys differ."""
    import json
    import subprocess
    import sys
    from pathlib import Path

    (tmp_path / "events").mkdir()
    subprocess.run([sys.executable, "-c", WRITE_ONE, str(tmp_path / "events"), str(tmp_path / "out")], check=True, timeout=300, cwd=Path(__file__).parents[1])
    events = [json.loads(line) for p in (tmp_path / "events").iterdir() for line in p.open()]
    read = [e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"] for e in events if e["Event"] == "SparkListenerTaskEnd"]
    assert sum(read) >= 40_000 and max(read) < 40_000 / 3
    texts = [t for t in lines_of(tmp_path / "out").values() if b"<e>" in t]
    assert len(texts) == 1
    body = texts[0].decode().splitlines()
    assert body[:2] == ['<?xml version="1.0" encoding="UTF-8"?>', "<oml:es>"] and body[-1] == "</oml:es>"
    assert body[2:-1] == sorted(f"<e>{i % 5} {i % 3} {i:05d}</e>" for i in range(40_000))


@pytest.mark.parametrize("block, batch", [(1, 3), (300, 7), (4 << 20, 10_000)])
def test_parts_of_a_file_are_in_their_places(spark, tmp_path, monkeypatch, block, batch):
    """What many tasks write is what one task writes, where the store takes a file from one only, byte for byte."""
    from trialbook.sources import elements

    # Places of an entity differ, since lines of one place have no order among them; equal lines need none.
    rows = {(None if i % 11 == 0 else i % 4, None if i % 7 == 0 else i): f"é{'x' * (i * 37 % 900)}\n{i}" if i % 5 else "" for i in range(400)}
    rows = [(*key, line) for key, line in rows.items()] + [(2, 5000, "<a/>")] * 3 + [(3, 5000, None)] * 2
    lines = spark.createDataFrame(rows, "entity int, at int, line string").repartition(5)
    monkeypatch.setattr(elements, "BLOCK_BYTES", block)
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": batch, "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
                f"fs.viewfs.mounttable.m{block}.link./out": f"file://{tmp_path}"}
    for key, value in settings.items():
        spark.conf.set(key, str(value))
    try:
        elements.write_lines(lines, f"{tmp_path}/many", "es", ["at"], namespace="u")
        elements.write_lines(lines, f"viewfs://m{block}/out/one", "es", ["at"], namespace="u")
    finally:
        for key in settings:
            spark.conf.unset(key)
    many, one = lines_of(tmp_path / "many"), lines_of(tmp_path / "one")
    assert many == one and len(one) == 8 and sum(t.count(b"<a/>\n") for t in one.values()) == 3
    assert sorted(p.name for p in tmp_path.iterdir()) == ["many", "one"] and (tmp_path / "many" / "_SUCCESS").exists()


def test_documents_appear_whole_or_not_at_all(spark, tmp_path):
    from pyspark.sql import functions as F

    from trialbook.sources import elements

    lines = spark.range(50).selectExpr("id AS entity", "concat('<e>', id, '</e>') AS line")
    elements.write_lines(lines, f"{tmp_path}/a b/c", "es", [])
    before = lines_of(tmp_path / "a b")
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        elements.write_lines(lines.limit(3), f"{tmp_path}/a b/c", "es", [])
    assert lines_of(tmp_path / "a b") == before and sum(t.count(b"<e>") for t in before.values()) == 50
    with pytest.raises(Exception, match="no such line"):
        elements.write_lines(lines.withColumn("line", F.when(F.col("entity") == 49, F.raise_error(F.lit("no such line")).cast("string")).otherwise(F.col("line"))), f"{tmp_path}/a b/d", "es", [])
    assert [p.name for p in (tmp_path / "a b").iterdir()] == ["c"]


def test_a_compressed_listing_is_small_whole_files(spark, tmp_path, monkeypatch):
    """Every row comes back, in files of few rows that any XML reader reads, at a small part of the size of the plain text."""
    import gzip
    import xml.etree.ElementTree as ET

    monkeypatch.setattr(documents, "PACKED_ROWS", 700)
    rows = spark.range(4000).selectExpr("id AS run_id", "id % 50 AS task_id", "IF(id % 3 = 0, NULL, 'a <b> & \" c') AS function", "id / 8 AS value", "IF(id % 5 = 0, '[1.0,2.5]', NULL) AS `values`").repartition(2)
    documents.write_listing(rows, str(tmp_path / "packed"), "evaluation", compression="gzip", namespace="u")
    documents.write_listing(rows, str(tmp_path / "plain"), "evaluation", namespace="u")
    files = list((tmp_path / "packed").glob("part-*"))
    assert len(files) == 6 and max(len(ET.fromstring(gzip.decompress(f.read_bytes()))) for f in files) == 700
    text = b"".join(f.read_bytes() for f in (tmp_path / "plain").glob("part-*"))
    assert b"\n   " not in text and sum(f.stat().st_size for f in files) * 5 < len(text)
    good, bad = documents.listing(spark, str(tmp_path / "packed"), "evaluation")
    want = [(i, i % 50, None if i % 3 == 0 else 'a <b> & " c', i / 8, [1.0, 2.5] if i % 5 == 0 else None) for i in range(4000)]
    assert bad.count() == 0 and sorted(tuple(r) for r in good.select("run_id", "task_id", "function", "value", "values").collect()) == want


@pytest.mark.parametrize("block, batch, most", [(1, 3, 1 << 30), (300, 7, 1 << 30), (4 << 20, 10_000, 1 << 30), (300, 7, 2500)])
def test_compressed_documents_are_the_same_text(spark, tmp_path, monkeypatch, block, batch, most):
    """Each file's text is that of the plain one, byte for byte, whatever tasks wrote it; only files of much text stay plain."""
    import gzip

    from trialbook.sources import elements

    e = spark.range(300).selectExpr("id * id % 23 AS run_id", "IF(id % 4 = 0, NULL, 'é<f>') AS function", "0 AS repeat", "int(id % 9) AS fold", "IF(id % 2 = 0, 1, NULL) AS sample", "id / 8 AS value", "IF(id % 5 = 0, ' [1,\n2] ', NULL) AS array_data")
    e = e.unionByName(e.limit(5).withColumn("run_id", e["run_id"] * 0 + 999)).repartition(5)
    runs = spark.range(23).selectExpr("IF(id = 22, NULL, id) AS run_id", "1L AS task_id", "2L AS flow_id", "IF(id % 2 = 0, NULL, 3L) AS setup_id")
    monkeypatch.setattr(elements, "BLOCK_BYTES", block)
    monkeypatch.setattr(elements, "PACKED_BYTES", most)
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": batch, "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    for key, value in settings.items():
        spark.conf.set(key, str(value))
    try:
        documents.write_runs(runs, e, f"{tmp_path}/plain", namespace="u")
        documents.write_runs(runs, e, f"{tmp_path}/packed", namespace="u", compression="gzip")
    finally:
        for key in settings:
            spark.conf.unset(key)
    plain, packed = lines_of(tmp_path / "plain"), lines_of(tmp_path / "packed")
    zipped = {f.parent.name for f in (tmp_path / "packed").rglob("part-*.gz")}
    assert zipped == {k for k, t in plain.items() if len(t) <= most} and (most > 2500) == (len(zipped) == len(plain)) and zipped
    assert {k: gzip.decompress(t) if k in zipped else t for k, t in packed.items()} == plain
    # Readers take both, also side by side.
    got = [sorted(map(str, documents.run_evaluations(documents.run_documents(spark, f"{tmp_path}/{k}")).collect())) for k in ("plain", "packed")]
    assert got[0] == got[1] and len(got[0]) == 300 - sum(i * i % 23 == 22 for i in range(300))
    with pytest.raises(ValueError, match="not lz4"):
        documents.write_runs(runs, e, f"{tmp_path}/other", compression="lz4")
    assert not (tmp_path / "other").exists()


LEFT_BEHIND = """
import sys, time
from pathlib import Path
from pyspark.sql import SparkSession
from trialbook.session import CLEANUP_KEY, stage
from trialbook.sources import documents
out = Path(sys.argv[1])
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.memory", "1g").config("spark.sql.shuffle.partitions", "4")
  .config("spark.local.dir", str(out / "local")).config("spark.checkpoint.dir", str(out / "kept")).getOrCreate())
def shuffled():
    return [p for p in (out / "local").rglob("shuffle_*") if p.stat().st_size]
def gone():
    until = time.time() + 30
    while shuffled() and time.time() < until:
        time.sleep(0.2)
    return not shuffled()
counts = spark.range(5000).selectExpr("id % 700 AS k").groupBy("k").count()
made = stage(counts, "counts")
assert gone(), shuffled()
# The frame itself may still be used, and the setting is as before.
assert made.count() == counts.count() == counts.count() == 700 and shuffled() and spark.conf.get(CLEANUP_KEY) == "false"
e = spark.range(3000).selectExpr("id % 40 AS run_id", "'f' AS function", "0 AS repeat", "int(id) AS fold", "0 AS sample", "1.5D AS value", "'x' AS array_data")
documents.write_runs(counts.selectExpr("k AS run_id", "1L AS task_id", "2L AS flow_id", "3L AS setup_id"), e, str(out / "r"), compression="gzip")
labels = {p.name.rsplit("-", 1)[0] for p in (out / "kept").iterdir()}
assert "counts" in labels and not labels & {"run-table", "blocks"}, labels
docs = documents.run_documents(spark, str(out / "r"))
assert documents.runs(docs).count() == 700 and documents.run_evaluations(docs).count() == 3000
"""


def test_what_is_passing_leaves_the_disk(tmp_path):
    """What was shuffled for a table goes when it is written, and tables of a writer go with it."""
    import subprocess
    import sys
    from pathlib import Path

    done = subprocess.run([sys.executable, "-c", LEFT_BEHIND, str(tmp_path)], timeout=300, cwd=Path(__file__).parents[1], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
