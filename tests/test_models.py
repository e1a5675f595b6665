"""Models over many cells: lines of any numbers, and mergeable models against plain fits."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from trialbook.operators import mergeable, models


def test_lines_through_fractions(spark):
    rows = [(1, i % 3, i, i / 100, 2 * i / 100 + 0.25) for i in range(30)]
    rows += [(None, i % 2, 100 + i, 1e9 + i / 8, 3 * i / 8) for i in range(9)]  # far from zero, no key
    rows += [(2, 0, 200, 0.5, 1.5), (2, 1, 201, 0.5, 2.5), (2, 1, 202, 0.5, 2.25), (2, None, 203, 0.5, 0.0), (2, 0, 204, None, 7.0), (3, 0, 300, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "task long, fold int, rowid long, x double, y double")
    got = {r["row_id"]: r for r in models.fit_lines(df, ["task"], "fold", "x", "y").collect()}
    assert len(got) == len(rows)
    for i in range(30):
        assert math.isclose(got[i]["prediction"], 2 * i / 100 + 0.25, abs_tol=1e-9)
    for i in range(9):
        assert got[100 + i]["task"] is None and math.isclose(got[100 + i]["prediction"], 3 * i / 8, abs_tol=1e-4)
    # x never varies: the mean of the other folds, NULL being a fold like any other.
    assert math.isclose(got[200]["prediction"], (2.5 + 2.25 + 0.0) / 3) and math.isclose(got[203]["prediction"], (1.5 + 2.5 + 2.25) / 3)
    assert got[204]["prediction"] is None and got[300]["prediction"] is None


def test_whole_lines_take_null_keys(spark):
    df = spark.createDataFrame([(None, i % 2, i, i, 3 * i + 1) for i in range(10)], "task long, fold int, rowid long, x long, y long")
    assert all(math.isclose(r["prediction"], r["truth"]) for r in models.fit_lines(df, ["task"], "fold", "x", "y").collect())


@pytest.mark.parametrize("n", range(1, 9))
def test_all_but_one(n):
    merges = []

    def merge(a, b):
        merges.append(1)
        return a + b

    letters = [chr(97 + i) for i in range(n)]
    assert mergeable.all_but_one(letters, merge) == [("".join(letters[:i] + letters[i + 1 :]) or None) for i in range(n)]
    assert len(merges) <= 3 * n


@pytest.fixture(scope="module")
def table(spark):
    """A task that holds two thirds of the rows, many small ones, one without a key, and one of a single fold."""
    rnd = random.Random(1)
    rows = []
    for i in range(3000):
        task = 0 if i % 3 else rnd.choice([None, *range(1, 60)])
        rows.append((task, 0 if task == 59 else rnd.randrange(4), i, rnd.choice(["a", "b", None]), rnd.choice(["u", "v", "w"]), rnd.uniform(-5, 5), rnd.choice([None, 1.0, 2.0, 1e6]), rnd.choice("XYZ"), rnd.uniform(0, 9)))
    return rows, spark.createDataFrame(rows, "task long, fold int, rowid long, s string, t string, p double, q double, label string, y double").repartition(7)


def others(rows, row):
    return [r for r in rows if r[0] == row[0] and r[1] != row[1]]


@pytest.mark.parametrize("held", [3, 4096])
def test_bayes(table, monkeypatch, held):
    monkeypatch.setattr(mergeable, "HELD_STATES", held)
    rows, df = table
    model = mergeable.CountedBayes("label", {"s": "ab", "t": "uvw"}, "XYZ")
    got = {r["row_id"]: r["prediction"] for r in mergeable.cross_validated(model, df, ["task"], "fold", "label", ["s", "t"]).collect()}
    known = {}
    for r in rows:
        if (r[0], r[1]) not in known:
            known[r[0], r[1]] = others(rows, r)
        train = known[r[0], r[1]]
        if not train:
            assert got[r[2]] is None
            continue
        scores = []
        for c in "XYZ":
            own = [x for x in train if x[7] == c]
            score = math.log((len(own) + 1) / (len(train) + 3))
            for k, size in ((3, 2), (4, 3)):
                if r[k] is not None:
                    score += math.log((sum(x[k] == r[k] for x in own) + 1) / (sum(x[k] is not None for x in own) + size))
            scores.append(round(score, 7))
        assert scores["XYZ".index(got[r[2]])] == max(scores)
    assert len(got) == len(rows)


def test_ridge(table):
    rows, df = table
    model = mergeable.RidgeLine("y", ["p", "q"], penalty=2.0)
    got = {r["row_id"]: r["prediction"] for r in mergeable.cross_validated(model, df, ["task"], "fold", "y", ["p", "q"], "double").collect()}
    fits = {}
    for r in rows:
        if (r[0], r[1]) not in fits:
            train = np.array([[x[5], x[6], x[8]] for x in others(rows, r) if x[6] is not None]).reshape(-1, 3)
            if len(train):
                mean = train.mean(axis=0)
                gaps = train - mean
                slopes = np.linalg.lstsq(gaps[:, :2].T @ gaps[:, :2] + 2 * np.eye(2), gaps[:, :2].T @ gaps[:, 2], rcond=None)[0]
                fits[r[0], r[1]] = slopes, mean[2] - mean[:2] @ slopes
            else:
                fits[r[0], r[1]] = None
        if fits[r[0], r[1]] is None or r[6] is None:
            assert got[r[2]] is None
        else:
            slopes, start = fits[r[0], r[1]]
            assert math.isclose(got[r[2]], r[5] * slopes[0] + r[6] * slopes[1] + start, rel_tol=1e-6, abs_tol=1e-6)


def test_a_frame_without_keys_is_one_cell(spark):
    df = spark.range(40).selectExpr("id AS rowid", "int(id % 4) AS fold", "double(id) AS x", "id * 2.0D + 1 AS y")
    got = mergeable.cross_validated(mergeable.RidgeLine("y", ["x"]), df, [], "fold", "y", ["x"], "double").collect()
    assert len(got) == 40 and all(math.isclose(r["prediction"], r["truth"], abs_tol=1e-9) for r in got)
    assert mergeable.cross_validated(mergeable.RidgeLine("y", ["x"]), df.filter("false"), [], "fold", "y", ["x"], "double").collect() == []


def test_rows_of_one_large_task_are_not_shuffled(spark):
    """Few cells are broadcast whatever the size of the rows, so no task reads a whole fold; NULL cells are kept."""
    rows = spark.range(2000).selectExpr("IF(id % 2 = 0, NULL, 1L) AS task_id", "id % 2 + id % 3 AS fold", "id AS rowid", "id % 5 AS q", "id % 5 * 3 + 1 AS y")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        out = models.fit_lines(rows, ["task_id"], "fold", "q", "y")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
        assert out.count() == 2000 and all(abs(r["prediction"] - r["truth"]) < 1e-9 for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("batch", [7, 10_000])
def test_cells_are_fitted_at_once(spark, table, monkeypatch, batch):
    """Ridge lines cost no call per cell, and are those of states that are merged one by one, over batches of any size."""
    rows, df = table
    model = mergeable.RidgeLine("y", ["p", "q"], penalty=2.0)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        fitted = dict(mergeable.fit_arrays(model, df, ["task"], "fold", ["y", "p", "q"]).dtypes)
        assert fitted["model"] == "array<double>"
        got = {r["row_id"]: r["prediction"] for r in mergeable.cross_validated(model, df, ["task"], "fold", "y", ["p", "q"], "double").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)

    def columns(some):
        return {"p": np.array([r[5] for r in some]), "q": np.array([np.nan if r[6] is None else r[6] for r in some]), "y": np.array([r[8] for r in some])}

    cells = {(r[0], r[1]) for r in rows}
    for cell in cells:
        here = [r for r in rows if (r[0], r[1]) == cell]
        train = others(rows, here[0])
        want = model.predict(model.finish(model.partial(columns(train))), columns(here)) if train else [math.nan] * len(here)
        for r, x in zip(here, want, strict=True):
            assert got[r[2]] is None if math.isnan(x) else math.isclose(got[r[2]], x, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("sizes", [[1], [2], [1, 3, 1], [5, 2, 8, 1, 7]])
def test_all_but_one_of_many_groups(sizes):
    """Groups merged in pairs, and all others of each row in order, as for one group after the other."""
    states = np.array([[i, i] for i in range(sum(sizes))], dtype=float)
    begins = np.concatenate([[True] + [False] * (n - 1) for n in sizes])

    def merge_all(a, b):
        assert (a[:, 1] < b[:, 0]).all()  # the least and largest numbers so far
        return np.c_[a[:, 0], b[:, 1]]

    ends = np.cumsum(sizes)
    assert mergeable.merge_groups(states, begins, merge_all).tolist() == [[e - n, e - 1] for n, e in zip(sizes, ends, strict=True)]
    got, known = mergeable.others_of_groups(states, begins, merge_all)
    want = [[e - n + (k == 0), e - 1 - (k == n - 1)] for n, e in zip(sizes, ends, strict=True) for k in range(n)]
    assert known.tolist() == [n > 1 for n in sizes for _ in range(n)] and all(g == w for g, w, k in zip(got.tolist(), want, known, strict=True) if k)
