"""Plans keep to what scales: filters and columns reach the scan, no Python rows, no product joins."""

import io
from contextlib import redirect_stdout

import pytest

from __spark_entry__ import queries
from trialbook.operators import listing, splits
from trialbook.plans.bindings import Registry

FOLDER = "/root/testdata/sf0.001"
# These fit or score with pyspark.ml or user code, or hash large files.
PYTHON = {"agg_02_python_metric", "run_01_many_small_tasks", "src_18_checksum_mismatches"}


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_filters_and_columns_reach_the_scan(spark):
    r = Registry(spark, FOLDER)
    text = plan(listing.list_runs(r.runs(), uploader=7))
    assert "EqualTo(o_custkey,7)" in text and "o_totalprice" not in text
    text = plan(listing.page_after(r.datasets(), "did", 77, 5))
    assert "GreaterThan(p_partkey,77)" in text and "TakeOrderedAndProject" in text


def test_a_top_page_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(queries()["lst_11_top_evaluations"](spark, FOLDER))


def test_splits_use_no_window_over_a_whole_class(spark):
    r = Registry(spark, FOLDER)
    text = plan(splits.cross_validation(r.points().select("rowid", "label"), 2, 5, stratify="label"))
    assert "_bucket" in text and "SinglePartition" not in text


NAMES = sorted(n for n in queries() if n not in PYTHON and not n.startswith(("run_0", "agg_07")))


@pytest.mark.parametrize("name", [n for n in NAMES if n.startswith(("jn", "lst_0", "agg_0", "win", "chg", "set"))])
def test_no_python_and_no_products(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_partitions_are_joined_up_to_a_bound(spark):
    """Small partitions are joined up to 16 MB, not to 64: a task then sorts and tells apart about a million narrow rows."""
    from trialbook import session

    before = spark.conf.get(session.ADVISORY_KEY)
    try:
        spark.conf.unset(session.ADVISORY_KEY)
        session.tune(spark)
        assert spark.conf.get(session.ADVISORY_KEY) == "16m"
    finally:
        spark.conf.set(session.ADVISORY_KEY, before)
