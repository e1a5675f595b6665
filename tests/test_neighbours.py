"""Nearest neighbours against all pairs, with copies, hot groups and ties."""

import numpy as np
import pytest

from trialbook.operators import neighbours


def plain(rows):
    out = {}
    for i, f, v in rows:
        near = [(sum((a - b) ** 2 for a, b in zip(v, w, strict=True)), j) for j, g, w in rows if g != f and w is not None] if v is not None else []
        out[i] = min(near)[::-1] if near else (None, None)
    return {i: x for i, x in out.items() if next(v for j, _, v in rows if j == i) is not None}


@pytest.mark.parametrize("dims, spread, block", [(2, 30, 1024), (8, 5, 7), (1, 50, 3)])
def test_all_pairs(spark, monkeypatch, dims, spread, block):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    rng = np.random.default_rng(dims)
    hot = [1.0] * dims
    rows = [(i, int(rng.integers(0, 3)), hot if i % 3 == 0 else rng.integers(-spread, spread, dims).astype(float).tolist()) for i in range(500)]
    rows += [(600, 1, None), (601, 0, [1000.0] * dims), (602, 0, [1001.0] * dims)]
    got = neighbours.nearest(spark.createDataFrame(rows, "rowid long, fold int, features array<double>").repartition(5)).collect()
    assert {r["rowid"]: (r["neighbour"], r["square"]) for r in got} == plain(rows) and len(got) == 502


def test_groups_far_apart_are_not_compared():
    rng = np.random.default_rng(1)
    block = lambda keys, x: neighbours.Block(len(x), keys.astype("<i8").tobytes(), (keys % 2).astype("<i8").tobytes(), np.sort(np.abs(x[:, 0])).astype("<f8").tobytes(), np.full(len(x), 4.0).tobytes(), x[np.argsort(np.abs(x[:, 0]))].astype("<f8").tobytes())
    x = np.zeros((1000, 3))
    x[:, 0] = rng.uniform(0, 1000, 1000)  # distances from the pivot, the origin, are the first components
    questions = neighbours.Questions(block(np.arange(1000), x))
    questions.ask(block(np.arange(1000), x))
    assert questions.compared < 0.02 * 1000 * 1000


def test_no_other_fold(spark):
    schema = "rowid long, fold int, features array<double>"
    got = neighbours.nearest(spark.createDataFrame([(1, 0, [1.0]), (2, 0, [2.0]), (3, None, [2.0])], schema)).collect()
    assert sorted(tuple(r) for r in got) == [(1, None, None), (2, None, None)]
    assert neighbours.nearest(spark.createDataFrame([], schema)).collect() == []


def test_questions_travel_once_per_part():
    """A block of questions that may be near to rows of 100 cells goes to the 4 parts that hold these, not to each cell."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    x, pivots = rng.normal(size=(50, 64)), rng.normal(size=(100, 64))
    numbers = [np.arange(50).astype("<i8").tobytes()] * 2 + [np.zeros(50).tobytes(), np.full(50, np.inf).tobytes(), x.tobytes()]
    batch = pa.RecordBatch.from_arrays([pa.array([7], pa.int32()), pa.array([50], pa.int32()), *[pa.array([b], pa.binary()) for b in numbers]], names=["cell", "n", "keys", "folds", "away", "bounds", "vectors"])
    parts = np.stack([np.arange(100) // 25] * 2, axis=1)
    sent = [p for b in neighbours.visits([batch], pivots, np.zeros(100), np.full(100, 20.0), parts) for p in b.column("part").to_pylist()]
    assert sent == [0, 1, 2, 3]


@pytest.mark.parametrize("far", [0.0, 1e6, 1e160])
def test_products_of_matrices_decide_nothing(spark, monkeypatch, far):
    """Distances are those of the differences, also far from the origin where a product of matrices has no digit left."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    monkeypatch.setattr(neighbours, "PART_ROWS", 40)
    monkeypatch.setattr(neighbours, "EXACT_ROWS", 11)
    rng = np.random.default_rng(3)
    x = far + rng.integers(-40, 40, (300, 3)) / 7
    got = neighbours.nearest(spark.createDataFrame([(i, i % 3, v.tolist()) for i, v in enumerate(x)], "rowid long, fold int, features array<double>")).collect()
    for r in got:
        i = r["rowid"]
        square = ((x - x[i]) ** 2).sum(axis=1)
        square[np.arange(300) % 3 == i % 3] = np.inf
        assert (r["square"], r["neighbour"]) == (square.min(), int(square.argmin()))
