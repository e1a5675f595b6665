"""Ordered operations against brute force, with one key holding most rows."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trialbook.plans.scan import exact_quantiles, hash_positions, row_numbers, running, value_counts_running
from trialbook.plans import skew


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    rows = []
    for i in range(3_000):
        key = "hot" if i % 3 else rng.choice(["a", "b", "c", None])
        rows.append((key, rng.randrange(50), i, None if i % 17 == 0 else float(rng.randrange(1000))))
    return rows, spark.createDataFrame(rows, "k string, o int, id long, v double").repartition(5).persist()


@pytest.mark.parametrize("slices", [None, 1, 4, 13])
def test_running_equals_brute_force(skewed, slices):
    rows, df = skewed
    out = running(df, ["k"], ["o", "id"], {"n": ("count", F.lit(1)), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v")}, slices)
    got = {r["id"]: (r["n"], r["s"], r["lo"], r["hi"]) for r in out.collect()}
    state: dict = {}
    assert len(got) == len(rows)
    for k, o, i, v in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        n, s, lo, hi = state.get(k, (0, None, None, None))
        n += 1
        if v is not None:
            s, lo, hi = (s or 0) + v, v if lo is None else min(lo, v), v if hi is None else max(hi, v)
        state[k] = (n, s, lo, hi)
        assert got[i] == state[k]


def test_running_descending(skewed):
    rows, df = skewed
    out = {r["id"]: r["n"] for r in running(df, ["k"], [F.col("o").desc(), "id"], {"n": ("count", F.lit(1))}, 6).collect()}
    seen: dict = {}
    for k, o, i, v in sorted(rows, key=lambda r: (-r[1], r[2])):
        seen[k] = seen.get(k, 0) + 1
        assert out[i] == seen[k]


@pytest.mark.parametrize("slices", [None, 7])
def test_row_numbers_of_the_whole_frame(skewed, slices):
    rows, df = skewed
    got = {r["id"]: r["n"] for r in row_numbers(df, [], [F.col("o").desc(), "id"], "n", slices).collect()}
    for n, row in enumerate(sorted(rows, key=lambda r: (-r[1], r[2])), 1):
        assert got[row[2]] == n


def test_hash_positions(skewed):
    rows, df = skewed
    out = hash_positions(df.withColumn("h", F.md5(F.col("id").cast("string"))), ["k"], "h", "id", "p", digits=2)
    got = {r["id"]: r["p"] for r in out.collect()}
    for key in {r[0] for r in rows}:
        ids = sorted((r[2] for r in rows if r[0] == key), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
        assert [got[i] for i in ids] == list(range(len(ids)))


def test_quantiles_match_numpy(skewed):
    rows, df = skewed
    got = {r["k"]: (r["a"], r["b"]) for r in exact_quantiles(df, ["k"], "v", {"a": 0.25, "b": 0.9}).collect()}
    for key in ("hot", "a", "b", "c", None):
        values = [r[3] for r in rows if r[0] == key and r[3] is not None]
        assert np.allclose(got[key], np.quantile(values, [0.25, 0.9]))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 5)), min_size=1, max_size=40))
def test_value_counts(spark, pairs):
    df = spark.createDataFrame(pairs, "k int, v int")
    got = {(r["k"], r["v"]): (r["n"], r["upto"]) for r in value_counts_running(df, ["k"], "v").collect()}
    assert len(got) == len(set(pairs))
    for (k, v), (n, upto) in got.items():
        assert n == pairs.count((k, v))
        assert upto == sum(1 for a, b in pairs if a == k and b <= v)


def test_join_by_cell_is_the_same_beyond_the_broadcast_limit(spark, monkeypatch):
    big = spark.range(1_000).select((F.col("id") % 3).alias("fold"), "id")
    small = spark.createDataFrame([(0, "x"), (1, "y")], "fold long, m string")
    near = skew.join_by_cell(big, small, ["fold"], "id")
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 1)
    far = skew.join_by_cell(big, small, ["fold"], "id")
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, far.select(*near.columns).collect()))
    assert near.count() == 667
