"""Pages through an index against a plain sort, and what a late page reads."""

import random

import pytest
from pyspark.sql import functions as F

from trialbook.operators import listing, pages


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    return [(rnd.choice([None, "a", "b", "c"]), rnd.choice([None, *range(40)]), i) for i in range(1200)]


def plain(rows, order):
    """Python's sort is stable, so the columns are sorted from the last one to the first."""
    out = list(rows)
    for by in reversed(order):
        name, falls = by if isinstance(by, tuple) else (by, "asc")
        k = ["s", "n", "id"].index(name)
        out.sort(key=lambda r: (r[k] is not None, r[k] if r[k] is not None else 0 if k else ""), reverse=falls == "desc")
    return out


@pytest.mark.parametrize("order", [["s", "n", "id"], [("s", "desc"), "n", ("id", "desc")], [("n", "desc"), "s", "id"], ["id"], [("id", "desc")]])
def test_pages_are_cut_from_the_order(spark, rows, order):
    df = spark.createDataFrame(rows, "s string, n int, id int").repartition(5)
    want = plain(rows, order)
    index = pages.page_index(df, order, 9)
    assert sum(n for n, _, _ in index.slices) == len(rows) and len(index.slices) > 5
    for size, offset in ((10, 0), (100, 333), (400, 650), (None, 1100), (50, 1190), (5, 1200), (None, 5000)):
        assert [tuple(r) for r in index.page(df, size, offset).collect()] == want[offset : None if size is None else offset + size]


def test_late_pages_of_a_listing(spark, rows, monkeypatch):
    monkeypatch.setattr(listing, "TOP_ROWS", 50)
    df = spark.createDataFrame(rows, "s string, n int, id int").withColumn("v", F.col("n") / 3.0)
    got = [r["id"] for r in listing.top(df, "v", "desc", ["id"], 40, 500).collect()]
    assert got == [r[2] for r in plain(rows, [("n", "desc"), "id"])[500:540]]
    assert listing.page(df.filter("false"), ["id"], 10, 500).collect() == []


def scanned(df):
    """Rows that the scans of an executed plan gave, and the files they read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    leaves, out = plan.collectLeaves(), []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        while leaf.getClass().getSimpleName().endswith("QueryStageExec"):
            leaf = leaf.plan().collectLeaves().apply(0)
        out.append((leaf.metrics().apply("numOutputRows").value()))
    return sum(out)


def test_a_late_page_reads_two_slices_at_most(spark, tmp_path):
    df = spark.range(1_000_000).select(((F.col("id") * 7919) % 1_000_003).alias("id"), F.lit("x").alias("s"))
    index = pages.write_pages(df, ["id"], str(tmp_path / "p"), slices=64)
    stored, again = pages.open_pages(spark, ["id"], str(tmp_path / "p"))
    assert again == index and len(index.slices) == 64
    page = index.page(stored, 100, 500_000)
    largest = sorted(n for n, _, _ in index.slices)[-2:]
    assert scanned(page) <= sum(largest)
    assert [r["id"] for r in page.collect()] == sorted(i * 7919 % 1_000_003 for i in range(1_000_000))[500_000:500_100]
