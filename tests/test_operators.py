"""Edge cases of the operators on small literal tables."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from trialbook.functions import params
from trialbook.operators import analysis, changes, flows, listing, lookups, members, models, qualities, scores, splits, traces
from trialbook.operators import datasets as ds


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


# Datasets

FEATURES = [ds.Feature(0, "id", "numeric", is_row_identifier=True), ds.Feature(1, "skip", "string", is_ignore=True),
            ds.Feature(2, "x", "numeric"), ds.Feature(3, "c", "nominal", ("a", "b"), is_target=True)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(0, 1, "s", 1.0, "a"), (1, 2, "t", 2.5, "b"), (2, 3, "u", None, "a")], "rowid long, id long, skip string, x double, c string")


def test_get_data(table):
    d = ds.get_data(table, FEATURES, "c")
    assert (d.X.columns, d.y.columns, d.names, d.categorical) == (["rowid", "x"], ["rowid", "c"], ["x"], [False])
    d = ds.get_data(table, FEATURES, include_row_id=True, include_ignore_attribute=True)
    assert d.names == ["id", "skip", "x", "c"] and d.y is None and d.categorical == [False, False, False, True]
    with pytest.raises(NotImplementedError):
        ds.get_data(table, FEATURES, "x,c")
    with pytest.raises(ValueError):
        ds.get_data(table, FEATURES, "nothing")


def test_features_by_type_renumbers(spark):
    t = spark.createDataFrame([(1, f.index, f.name, f.data_type, f.is_ignore, f.is_row_identifier) for f in FEATURES],
                              "did long, index int, name string, data_type string, is_ignore boolean, is_row_identifier boolean")
    assert rows(ds.features_by_type(t, "nominal")) == [(1, 1, "c")]
    assert rows(ds.features_by_type(t, "nominal", exclude_ignore_attribute=False, exclude_row_id_attribute=False)) == [(1, 3, "c")]
    assert rows(ds.features_by_type(t, "nominal", exclude=["x"])) == [(1, 0, "c")]
    with pytest.raises(TypeError):
        ds.features_by_type(t, "colour")


def test_class_labels(spark, table):
    assert rows(ds.class_labels(table, FEATURES[3])) == [("a", 0), ("b", 1)]
    assert rows(ds.class_labels(table, ds.Feature(0, "skip", "string"))) == [("s", 0), ("t", 1), ("u", 2)]
    assert ds.class_labels(table, FEATURES[2]) is None


def test_decode_nominal(spark):
    t = spark.createDataFrame([("0",), ("1",), ("2",), ("3",), (None,), ("word",), ("-1",)], "code string")
    got = {r["code"]: r["label"] for r in ds.decode_nominal(t, "code", ["a", "nan", "b"], "label").collect()}
    assert got == {"0": "a", "1": None, "2": "b", "3": None, None: None, "word": None, "-1": None}
    assert ds.outside_domain(t, "code", ["a", "nan", "b"]).first()[0] == 2


def test_narrowing(spark):
    t = spark.createDataFrame([(0.0, 0.5, -1.0, 1.0, 256.0), (255.0, 1.0, 1.0, None, 1.0)], "a double, b double, c double, d double, e double")
    assert dict(ds.narrow(t, list("abcde")).dtypes) == {"a": "smallint", "b": "double", "c": "double", "d": "double", "e": "double"}


def test_attributes_and_description(spark, table):
    t = spark.createDataFrame([(1, 1.0, "s", "c", True)], "i int, f double, s string, c string, b boolean")
    assert ds.attributes_of(t, {"c": ["c", "d"]}) == [("i", "INTEGER"), ("f", "REAL"), ("s", "STRING"), ("c", ["c", "d"]), ("b", ["True", "False"])]
    with pytest.raises(ValueError):
        ds.attributes_of(t.withColumn("when", F.current_timestamp()))
    with pytest.raises(ValueError):
        ds.attributes_of(t, {"c": ["c", 1]})
    made = ds.describe_dataset(t, target="c", ignore="i, s", row_id="f", nominal={"c": ["c"]})
    assert [(f.name, f.is_target, f.is_ignore, f.is_row_identifier) for f in made][:4] == [
        ("i", False, True, False), ("f", False, False, True), ("s", False, True, False), ("c", True, False, False)]
    for wrong in ({"target": "z"}, {"ignore": "i,z"}, {"row_id": "z"}):
        with pytest.raises(ValueError):
            ds.describe_dataset(t, **wrong)


def test_qualities_of_five_thousand_columns(spark, tmp_path):
    """One scan reads all columns (20,000 take two minutes to plan)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 5_000)).round(3)
    names = [f"a{i}" for i in range(5_000)]
    table = pa.table({n: pa.array([None if v > 2 else v for v in x[:, i].tolist()]) for i, n in enumerate(names)} | {"y": pa.array(["p", "n"] * 20)})
    pq.write_table(table, tmp_path / "w.parquet")
    df = spark.read.parquet(str(tmp_path / "w.parquet"))
    found = qualities.column_moments(df, names)
    assert found._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    known = [x[:, i][x[:, i] <= 2] for i in range(5_000)]
    got = {r["i"]: r for r in found.collect()}
    assert len(got) == 5_000
    for i in range(0, 5_000, 97):
        gaps = known[i] - known[i].mean()
        want = (known[i].mean(), known[i].std(), (gaps**3).mean() / known[i].std() ** 3, (gaps**4).mean() / known[i].var() ** 2 - 3)
        assert np.allclose([got[i][f"m{k}"] for k in range(4)], want)


def test_qualities_of_a_small_table(spark):
    t = spark.createDataFrame([(1.0, "a", "p"), (2.0, "a", "p"), (3.0, "b", "q"), (None, "b", "q")], "x double, c string, y string")
    f = [ds.Feature(0, "x", "numeric"), ds.Feature(1, "c", "nominal", ("a", "b", "z")), ds.Feature(2, "y", "nominal", ("p", "q", "r"), is_target=True)]
    got = dict(rows(qualities.all_qualities(t, f)))
    assert got["NumberOfInstances"] == 4 and got["NumberOfMissingValues"] == 1 and got["NumberOfInstancesWithMissingValues"] == 1
    assert got["PercentageOfMissingValues"] == pytest.approx(100 / 12)
    assert got["MinorityClassSize"] == 0 and got["MajorityClassSize"] == 2 and got["NumberOfClasses"] == 3
    assert got["ClassEntropy"] == pytest.approx(1.0) and got["MeanMutualInformation"] == pytest.approx(1.0)
    assert got["MeanMeansOfNumericAtts"] == 2.0 and got["MeanStdDevOfNumericAtts"] == pytest.approx(np.std([1, 2, 3]))
    assert got["MeanNoiseToSignalRatio"] == pytest.approx(0.0) and got["EquivalentNumberOfAtts"] == pytest.approx(1.0)


# Listing and lookups


def test_ranges_and_filters(spark):
    t = spark.range(10).toDF("n")
    for wanted, found in ((3, [3]), ("3", [3]), ("2..4", [2, 3, 4]), ((8, 99), [8, 9])):
        assert [r[0] for r in t.filter(listing.in_range("n", wanted)).orderBy("n").collect()] == found
    assert listing.matches(t, "n", []).count() == 0
    assert listing.matches(t, "n", None).count() == 10


def test_pages_are_disjoint_and_whole(spark, monkeypatch):
    t = spark.range(101).toDF("id").repartition(7)
    pages = [[r[0] for r in listing.page(t, ["id"], 10, k).collect()] for k in range(0, 110, 10)]
    assert [x for p in pages for x in p] == list(range(101))
    monkeypatch.setattr(listing, "TOP_ROWS", 5)
    assert sorted(r[0] for r in listing.page(t, ["id"], 10, 95).collect()) == list(range(95, 101))
    assert listing.page(t, ["id"], None, 100).count() == 1
    assert [r[0] for r in listing.page_after(t, "id", 97, 10).collect()] == [98, 99, 100]


def test_unknown_setup_has_an_empty_map(spark):
    e = spark.createDataFrame([(1, 5), (2, 6)], "run_id long, setup_id long")
    p = spark.createDataFrame([(5, "f_C", "0.9")], "setup_id long, full_name string, value string")
    got = {r["run_id"]: r["parameters"] for r in lookups.evaluations_setups(e, p).collect()}
    assert got == {1: {"f_C": "0.9"}, 2: {}}


def test_runs_exist_needs_a_stored_setup(spark):
    c = spark.createDataFrame([(1, 5), (1, 0), (2, 5)], "task_id long, setup_id long")
    r = spark.createDataFrame([(1, 5, 100), (1, 0, 101)], "task_id long, setup_id long, run_id long")
    found, absent = lookups.runs_exist(c, r)
    assert rows(found) == [(1, 5, 100)] and rows(absent) == [(1, 0), (2, 5)]


def test_setup_key_ignores_entry_order(spark):
    t = spark.sql("SELECT map('a', '1', 'b', '2') AS x, map('b', '2', 'a', '1') AS y, map('a', '1') AS z")
    k = t.select(*[params.canonical_key(F.col(c)) for c in "xyz"]).first()
    assert k[0] == k[1] != k[2]


def test_concat_fills_absent_columns(spark):
    out = members.concat([spark.sql("SELECT 1 AS a"), spark.sql("SELECT 2 AS a, 'x' AS b")])
    assert rows(out) == [(1, None), (2, "x")]


# Splits


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(103).selectExpr("id AS rowid", "CASE WHEN id % 10 = 0 THEN 'rare' ELSE 'hot' END AS label")


def test_cross_validation_is_balanced(labelled):
    t = splits.cross_validation(labelled, 3, 5, seed=1, stratify="label").join(labelled, "rowid")
    counts = t.groupBy("repeat", "label", "fold").count().collect()
    for label in ("hot", "rare"):
        sizes = [r["count"] for r in counts if r["label"] == label]
        assert len(sizes) == 15 and max(sizes) - min(sizes) <= 1
    assert t.groupBy("repeat", "rowid").count().filter("count <> 1").count() == 0
    long = splits.long_form(t.select("repeat", "rowid", "fold"), 5).withColumn("sample", F.lit(0))
    assert splits.violations(long, 103).count() == 0
    assert tuple(splits.dimensions(long).first()) == (3, 5, 1)


def test_learning_curve_is_nested(labelled):
    c = splits.learning_curve(labelled, 3, [5, 20, 60], seed=1, stratify="label").persist()
    cells = {(r["fold"], r["sample"], r["type"]): set(r["ids"]) for r in c.groupBy("fold", "sample", "type").agg(F.collect_set("rowid").alias("ids")).collect()}
    for fold in range(3):
        assert [len(cells[fold, s, "TRAIN"]) for s in range(3)] == [5, 20, 60]
        assert cells[fold, 0, "TRAIN"] < cells[fold, 1, "TRAIN"] < cells[fold, 2, "TRAIN"]
        assert cells[fold, 0, "TEST"] == cells[fold, 2, "TEST"] and not cells[fold, 2, "TRAIN"] & cells[fold, 2, "TEST"]


def test_holdout_share(labelled):
    h = splits.holdout(labelled, 0.33, seed=1, stratify="label").join(labelled, "rowid")
    sizes = {(r["label"], r["type"]): r["count"] for r in h.groupBy("label", "type").count().collect()}
    assert sizes["rare", "TEST"] == round(0.33 * 11) and sizes["hot", "TEST"] == round(0.33 * 92)
    assert splits.holdout(labelled, 0.5).filter("type = 'TEST'").count() == 52


def test_cell_names_the_unknown_index(labelled):
    t = splits.long_form(splits.cross_validation(labelled, 1, 2), 2).withColumn("sample", F.lit(0))
    assert splits.cell(t, 0, 1, 0).count() == 103
    for bad, name in (((9, 0, 0), "Repeat 9"), ((0, 9, 0), "Fold 9"), ((0, 0, 9), "Sample 9")):
        with pytest.raises(ValueError, match=name):
            splits.cell(t, *bad)


# Scores and models


def test_last_sample_counts(spark):
    p = spark.createDataFrame([(0, 0, 0, "a", "b"), (0, 0, 2, "a", "a"), (0, 1, 0, "b", "a")], "repeat int, fold int, sample int, prediction string, correct string")
    each, fold = scores.local_measures(p, "classification")
    assert rows(fold, "repeat", "fold", "value") == [(0, 0, 1.0), (0, 1, 0.0)]

    class Accuracy:
        def partial(self, truth, guess):
            return int((truth == guess).sum()), len(truth)

        def merge(self, a, b):
            return a[0] + b[0], a[1] + b[1]

        def finish(self, state):
            return state[0] / state[1]

    assert rows(scores.python_metric_by_fold(p, [], "correct", Accuracy())) == [(0, 0, 1.0), (0, 1, 0.0)]
    many = p.filter("fold = 1").crossJoin(spark.range(1000)).drop("id").union(p.filter("fold = 0")).repartition(7)
    assert rows(scores.python_metric_by_fold(many, [], "correct", Accuracy())) == [(0, 0, 1.0), (0, 1, 0.0)]
    assert rows(scores.domain_violations(p, ["a"])) == [("correct", "b", 1), ("prediction", "b", 1)]


def test_auc_with_ties(spark):
    p = spark.createDataFrame([("a", 0.9), ("a", 0.5), ("b", 0.5), ("b", 0.1)], "correct string, `confidence.a` double")
    got = rows(scores.class_auc(p.withColumn("g", F.lit(0)), ["g"], ["a"]))
    assert got == [(0, "a", 2, 0.875)]


def test_formats(spark):
    p = spark.sql("SELECT 0 AS repeat, 1 AS fold, CAST(NULL AS INT) AS sample, 5L AS row_id, 'a' AS prediction, 'b' AS correct, map('b', 0.25D, 'a', 0.75D) AS probabilities, 3.0D AS truth, 2 AS cluster")
    assert rows(scores.format_classification(p, ["a", "b"])) == [(0, 1, 0, 5, "a", "b", 0.75, 0.25)]
    assert scores.format_regression(p).columns == ["repeat", "fold", "row_id", "prediction", "truth"]
    assert rows(scores.format_clustering(p)) == [(0, 1, 5, 2)]
    with pytest.raises(Exception, match="each class"):
        scores.format_classification(p, ["a", "b", "c"]).collect()


def test_baselines_against_numpy(spark):
    rng = np.random.default_rng(0)
    data = [(i, int(rng.integers(3)), [float(v) for v in rng.normal(size=4)]) for i in range(60)]
    t = spark.createDataFrame(data, "rowid long, label int, embedding array<float>")
    folds = splits.cross_validation(t.select("rowid", "label"), 2, 3, 1, "label").persist()
    fold = {(r["repeat"], r["rowid"]): r["fold"] for r in folds.collect()}
    got = {(r["repeat"], r["row_id"]): r["prediction"] for r in models.nearest_centroid(t, folds, 4).collect()}
    most = {(r["repeat"], r["row_id"]): r["prediction"] for r in models.majority_class(t, folds).collect()}
    assert len(got) == len(most) == 120
    x = np.array([d[2] for d in data], dtype=np.float32).astype(float)
    y = np.array([d[1] for d in data])
    for repeat in range(2):
        f = np.array([fold[repeat, i] for i in range(60)])
        for i in range(60):
            train = f != f[i]
            means = np.array([x[train & (y == c)].mean(axis=0) for c in range(3)])
            assert got[repeat, i] == int(np.argmin(((means - x[i]) ** 2).sum(axis=1)))
            assert most[repeat, i] == int(np.argmax(np.bincount(y[train], minlength=3)))


def test_lines_by_cell_of_any_size(spark):
    t = spark.range(3_000).selectExpr("CASE WHEN id < 2500 THEN 'hot' ELSE concat('k', id % 100) END AS task", "id AS rowid", "id % 3 AS fold",
                                      "id * 3000000000 + 7 AS y", "id * 1000 AS x").union(spark.sql("SELECT 'alone', 1L, 0L, 5L, 5L"))
    found = {(r["task"], r["row_id"]): r for r in models.fit_lines(t, ["task"], "fold", "x", "y").collect()}
    assert len(found) == 3_001 and found["alone", 1]["prediction"] is None
    assert all(abs(r["prediction"] - r["truth"]) < 1e-3 * max(1.0, r["truth"]) for (task, _), r in found.items() if task == "hot")


def test_run_cells_gives_every_class_a_confidence(spark):
    t = spark.range(40).selectExpr("id AS rowid", "CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS label", "array(double(id % 2)) AS x")
    t = t.select("rowid", "label", array_to_vector("x").alias("features"))
    placed = models.place(t, splits.cross_validation(t.select("rowid", "label"), 1, 2, 0, "label"))
    run = models.run_cells(DecisionTreeClassifier(maxDepth=1), placed, [(0, 0), (0, 1)], ["a", "b", "never"])
    assert run.predictions.count() == 40
    assert run.predictions.filter("prediction <> correct").count() == 0
    assert run.predictions.filter("`confidence.never` <> 0").count() == 0
    assert run.timing_rows().count() == 6


# Traces, flows, changes, analysis


def test_trace_selection_and_merge(spark):
    t = spark.createDataFrame([(1, 0, 0, 0, 0.5, False, {"parameter_a": "1"}), (1, 0, 0, 1, 0.9, True, {"parameter_a": "2"}), (1, 0, 0, 2, 0.9, True, {"parameter_a": '"x"'}),
                               (1, 0, 1, 0, 0.1, False, {"parameter_a": "word"})],
                              "run_id long, repeat int, fold int, iteration long, evaluation double, selected boolean, parameters map<string,string>")
    assert rows(traces.selected_iterations(t)) == [(1, 0, 0, 1), (1, 0, 1, None)]
    assert traces.require_selected(t, repeat=0, fold=0).first()["iteration"] == 1
    with pytest.raises(Exception, match="no selected iteration"):
        traces.require_selected(t, repeat=0, fold=1).collect()
    assert rows(traces.mark_selected(t).filter("selected"), "fold", "iteration") == [(0, 1), (1, 0)]
    assert [r["parameters"]["a"] for r in traces.parameters(t).orderBy("fold", "iteration").collect()] == ["1", "2", "x", "word"]
    both, problems = traces.merge([t, t.filter("fold = 1").withColumn("parameters", F.create_map(F.lit("b"), F.lit("1")))])
    assert both.count() == 5
    assert rows(problems) == [(1, "duplicate iteration", 2), (1, "parameter names differ", 2)]


def test_flow_cycles_are_errors(spark):
    f = spark.createDataFrame([(1,), (2,)], "flow_id long")
    e = spark.createDataFrame([(1, "x", 2), (2, "y", 1)], "parent long, identifier string, child long")
    with pytest.raises(ValueError, match="contain themselves"):
        flows.components(f, e)
    ring = spark.range(70).selectExpr("id AS parent", "'x' AS identifier", "(id + 1) % 70 AS child")
    with pytest.raises(ValueError, match="contain themselves"):
        flows.components(f, ring)


def test_flows_of_any_depth(spark):
    """A chain longer than any level limit, and a flow that is reached in two ways."""
    edges = [(i, "s", i + 1) for i in range(130)] + [(0, "a", 200), (0, "b", 201), (200, "c", 202), (201, "c", 202)]
    e = spark.createDataFrame(edges, "parent long, identifier string, child long")
    f = spark.createDataFrame([(i,) for i in [*range(131), 200, 201, 202]], "flow_id long")
    got = flows.components(f, e).filter("root_id = 0").collect()
    assert sorted(r["depth"] for r in got if r["flow_id"] < 200) == list(range(131))
    assert sorted(tuple(r["path"]) for r in got if r["flow_id"] == 202) == [("a", "c"), ("b", "c")]
    assert len(got) == 131 + 4


def test_older_children(spark):
    """A sub-flow counts as older by the upload times of it and of its parent; an unknown time tells nothing."""
    f = spark.createDataFrame([(1, "2020-01-02T00:00:00"), (2, "2020-01-01T23:59:59"), (3, "2020-01-03T00:00:00"), (4, None), (5, "no date")], "flow_id long, upload_date string")
    e = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (3, "c", 2), (1, "d", 4), (1, "e", 5)], "parent long, identifier string, child long")
    got = flows.older_children(f, e).collect()
    assert sorted((r["root_id"], tuple(r["path"])) for r in got) == [(1, ("a",)), (1, ("b", "c")), (3, ("c",))]


def test_flow_differences_options(spark):
    s = "root_id long, path string, kind string, name string, value string"
    a = spark.createDataFrame([(1, "", "field", "name", "n"), (1, "", "field", "version", "1"), (1, "", "field", "custom_name", None), (1, "", "parameter", "p", "1"),
                               (1, "x", "parameter", "q", "1"), (1, "", "meta", "p", None), (1, "", "component", "x", "x")], s)
    b = spark.createDataFrame([(1, "", "field", "name", "n"), (1, "", "field", "version", "2"), (1, "", "field", "custom_name", "c"), (1, "", "parameter", "p", "2"),
                               (1, "x", "parameter", "q", "2"), (1, "", "meta", "p", "int")], s)
    names = lambda **k: sorted(r["name"] for r in flows.differences(a, b, **k).collect())
    assert names() == ["custom_name", "p", "q", "x"]
    assert names(ignore_custom_name_if_none=True) == ["p", "q", "x"]
    assert names(ignore_parameter_values=True) == ["custom_name", "x"]
    assert names(older_children=spark.createDataFrame([(1, "x")], "root_id long, path string")) == ["custom_name", "p", "x"]
    assert names(ignore_fields=()) == ["custom_name", "p", "q", "version", "x"]


def test_edits_and_forks(spark):
    d = spark.createDataFrame([(1, "n", 1, 7, "old", "c"), (2, "n", 2, 8, "old", "c")], "did long, name string, version long, uploader long, description string, default_target_attribute string")
    e = spark.createDataFrame([(1, 9, 1, "new", None), (1, 9, 2, None, "y"), (2, 8, 3, None, "z"), (3, 1, 4, "q", None)],
                              "did long, user long, seq long, description string, default_target_attribute string")
    after, refused = changes.edit_datasets(d, e, spark.createDataFrame([(1,)], "did long"))
    assert rows(after, "did", "description", "default_target_attribute") == [(1, "new", "c"), (2, "old", "z")]
    assert rows(refused, "seq", "reason") == [(2, "not the owner"), (4, "unknown id")]
    _, used = changes.edit_datasets(d, e, spark.createDataFrame([(2,)], "did long"))
    assert (3, "used by tasks") in rows(used, "seq", "reason")
    forked, unknown = changes.fork_datasets(d, spark.createDataFrame([(1, 5), (2, 6), (9, 6)], "did long, user long"))
    assert rows(forked, "did", "version", "uploader") == [(1, 1, 7), (2, 2, 8), (3, 3, 5), (4, 4, 6)]
    assert unknown.count() == 1


def test_delete_reasons(spark):
    t = spark.createDataFrame([(1, 7), (2, 7), (3, 8)], "did long, uploader long")
    q = spark.createDataFrame([(1, 7), (2, 7), (3, 7), (4, 7)], "did long, user long")
    left, refused = changes.delete(t, "did", q, {"used by tasks": spark.createDataFrame([(2,), (2,)], "did long")})
    assert rows(left, "did") == [(2,), (3,)]
    assert rows(refused, "did", "reason") == [(2, "used by tasks"), (3, "not the owner"), (4, "unknown id")]


def test_ontology_length(spark):
    c = spark.createDataFrame([(1, 0, "u" * 256, "add", 1), (1, 0, "u" * 257, "add", 2)], "did long, index int, url string, op string, seq long")
    now, refused = changes.apply_ontologies(c.limit(0).select("did", "index", "url"), c)
    assert now.count() == 1 and refused.first()["reason"] == "longer than 256 characters"


def test_summary_and_pair(spark):
    f = spark.createDataFrame([(1, 0, 0.5), (1, 0, 1.0), (1, 1, 0.2), (1, 1, 0.4)], "run_id long, repeat int, value double")
    assert rows(analysis.evaluation_summary(f, ["run_id"])) == [(1, "0.5250 +- 0.1750")]
    w = spark.createDataFrame([(1, 0.5, 0.4), (2, 0.4, 0.4), (3, 0.3, 0.4), (4, None, 0.4)], "did long, a double, b double")
    assert [r["outcome"] for r in analysis.compare_pair(w, "a", "b").orderBy("did").collect()] == ["win", "tie", "loss", None]
    assert rows(analysis.flow_ranks(spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.9), (1, 3, 0.1)], "did long, flow_id long, value double"))) == [(1, 1.0, 1), (2, 1.0, 1), (3, 3.0, 1)]


def test_parameter_text(spark):
    t = spark.createDataFrame([("3.0",), ("3.5",), ("word",), ("true",)], "v string")
    got = t.select(params.integer_if_integral(F.col("v")), params.as_number(F.col("v")), params.as_boolean(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [("3", 3.0, None), ("3.5", 3.5, None), ("word", None, None), ("true", None, True)]
