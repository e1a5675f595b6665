"""Catalog listing: filters, paging, lookups and vocabularies.

Filters are ANDed, a list means IN, None means no filter, and no match is an empty frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialbook.operators.pages import By, page_index, sort_columns
from trialbook.session import stage

# Task type ids and names.
TASK_TYPES = {
    1: "Supervised Classification", 2: "Supervised Regression", 3: "Learning Curve",
    4: "Supervised Data Stream Classification", 5: "Clustering", 6: "Machine Learning Challenge",
    7: "Survival Analysis", 8: "Subgroup Discovery", 9: "Multitask Regression",
}
# The states a dataset may be in.
DATASET_STATES = ("active", "deactivated", "in_preparation")

# Pages that end within this many rows are cut by a top-n; later pages through an index, with the same rows in the same order.
TOP_ROWS = 20_000

Ids = int | str | Sequence | DataFrame | None


def matches(df: DataFrame, column: str, wanted: Ids) -> DataFrame:
    """Keep rows whose column is (in) ``wanted``: a value, a list, or a one-column frame of any size."""
    if wanted is None:
        return df
    if isinstance(wanted, DataFrame):
        return df.join(wanted.select(F.col(wanted.columns[0]).alias(column)), column, "left_semi")
    if isinstance(wanted, (int, str)):
        return df.filter(F.col(column) == wanted)
    return df.filter(F.col(column).isin(list(wanted)))


def in_range(column: str, wanted: int | str | tuple) -> Column:
    """``n``, ``"n"``, ``"a..b"`` or ``(a, b)``; both ends belong to the range."""
    if isinstance(wanted, str) and ".." in wanted:
        wanted = tuple(wanted.split("..", 1))
    if isinstance(wanted, tuple):
        low, high = (float(v) for v in wanted)
        return F.col(column).between(low, high)
    return F.col(column) == float(wanted)


def tagged(df: DataFrame, key: str, tags: DataFrame, tag: str | Sequence[str] | None, tag_key: str | None = None) -> DataFrame:
    """Keep rows that carry the tag."""
    if tag is None:
        return df
    holders = matches(tags, "tag", tag).select(F.col(tag_key or key).alias(key))
    return df.join(holders, key, "left_semi")


def page(df: DataFrame, order: Sequence[By], size: int | None = None, offset: int = 0) -> DataFrame:
    """Rows ``offset`` to ``offset + size``, ordered whatever the size of the page.

    A late page goes through an index of counts per slice, so only the slices that hold it are sorted, and the table is
    not written. Where floating-point numbers order the rows they are written once, unsorted, since sums
    made twice may differ in their last digit.
    """
    if size is None and not offset:
        return df
    if size is not None and offset + size <= TOP_ROWS:
        return df.orderBy(*sort_columns(order)).offset(offset).limit(size)
    kinds = {t for _, t in df.select(*[F.col(by[0]) if isinstance(by, tuple) else by for by in order]).dtypes}
    if kinds & {"float", "double"}:
        df = stage(df, "pages")
    return page_index(df, order).page(df, size, offset)


def page_after(df: DataFrame, key: str, last, size: int) -> DataFrame:
    """The next page by key: the filter reaches the scan, so a late page costs no more than the first."""
    return df.filter(F.col(key) > last).orderBy(key).limit(size)


def quality_columns(qualities: DataFrame, names: Sequence[str], of: DataFrame | None = None) -> DataFrame:
    """Named qualities as columns, one row per dataset; of the datasets in ``of`` only, if given."""
    if of is not None:
        qualities = qualities.join(of.select("did"), "did", "left_semi")
    return (
        qualities.filter(F.col("name").isin(list(names))).groupBy("did")
        .pivot("name", list(names)).agg(F.max("value"))
    )


def list_datasets(
    datasets: DataFrame, qualities: DataFrame, tags: DataFrame, quality_names: Sequence[str], *,
    data_id: Ids = None, status: str = "active", tag=None, data_name: str | None = None,
    data_version: int | None = None, ranges: dict[str, int | str | tuple] | None = None,
    offset: int = 0, size: int | None = None,
) -> DataFrame:
    """Datasets with their qualities; ``status="all"`` lifts the default of active ones."""
    out = datasets
    if status != "all":
        out = out.filter(F.col("status") == status)
    out = matches(matches(out, "did", data_id), "name", data_name)
    out = tagged(matches(out, "version", data_version), "did", tags, tag)
    narrowed = data_id is not None or data_name is not None or tag is not None
    out = out.join(quality_columns(qualities, quality_names, out if narrowed else None), "did", "left")
    for name, wanted in (ranges or {}).items():
        out = out.filter(in_range(name, wanted))
    return page(out, ["did"], size, offset)


def list_tasks(
    tasks: DataFrame, datasets: DataFrame, qualities: DataFrame, procedures: DataFrame,
    data_tags: DataFrame, quality_names: Sequence[str], *, task_type: Ids = None, data_tag=None,
    status: str | None = None, data_name: str | None = None, data_id: Ids = None,
    ranges: dict[str, int | str | tuple] | None = None, tags: DataFrame | None = None, tag=None,
    offset: int = 0, size: int | None = None,
) -> DataFrame:
    """Tasks of known types with procedure names and qualities (0 where a quality is absent).

    ``data_tags`` is (did, tag), ``tags`` (task_id, tag).
    """
    out = matches(tasks.filter(F.col("ttid").isin(list(TASK_TYPES))), "ttid", task_type)
    out = tagged(matches(out, "did", data_id), "did", data_tags, data_tag)
    if tag is not None:
        out = tagged(out, "task_id", tags, tag)
    about = datasets.select("did", "name", "status")
    out = out.join(matches(matches(about, "status", status), "name", data_name), "did")
    out = with_procedure_names(out, procedures)
    narrowed = data_id is not None or data_name is not None or data_tag is not None or tag is not None
    out = out.join(quality_columns(qualities, quality_names, out if narrowed else None), "did", "left").fillna(0.0, list(quality_names))
    for name, wanted in (ranges or {}).items():
        out = out.filter(in_range(name, wanted))
    return page(out, ["task_id"], size, offset)


def with_procedure_names(tasks: DataFrame, procedures: DataFrame) -> DataFrame:
    """Procedure id to name."""
    names = procedures.select("procedure_id", F.col("procedure_name").alias("estimation_procedure"))
    return tasks.join(names, "procedure_id", "left")


def list_runs(
    runs: DataFrame, *, run_id: Ids = None, task: Ids = None, setup: Ids = None, flow: Ids = None,
    uploader: Ids = None, study_members: DataFrame | None = None, study: int | None = None,
    tasks: DataFrame | None = None, task_type: Ids = None, tags: DataFrame | None = None, tag=None,
    display_errors: bool = False, offset: int = 0, size: int | None = None,
) -> DataFrame:
    """Runs by any of their ids; failed ones only on request."""
    out = runs
    for column, wanted in (("run_id", run_id), ("task_id", task), ("setup_id", setup),
                           ("flow_id", flow), ("uploader", uploader)):
        out = matches(out, column, wanted)
    if not display_errors:
        out = out.filter(F.col("error_message") == "")
    if study is not None:
        out = matches(out, "run_id", study_members.filter(F.col("study_id") == study).select("run_id"))
    if task_type is not None:
        out = matches(out, "task_id", matches(tasks, "ttid", task_type).select("task_id"))
    if tag is not None:
        out = tagged(out, "run_id", tags, tag)
    return page(out, ["run_id"], size, offset)


def list_flows(flows: DataFrame, tags: DataFrame, *, tag=None, uploader: Ids = None, offset: int = 0, size: int | None = None) -> DataFrame:
    return page(tagged(matches(flows, "uploader", uploader), "flow_id", tags, tag), ["flow_id"], size, offset)


def list_setups(
    parameters: DataFrame, *, flow: Ids = None, setup: Ids = None, tags: DataFrame | None = None, tag=None,
    offset: int = 0, size: int | None = None,
) -> DataFrame:
    """Setups with their parameters as a map; a setup has as many entries as its flow has parameters."""
    out = matches(matches(parameters, "flow_id", flow), "setup_id", setup)
    if tag is not None:
        out = tagged(out, "setup_id", tags, tag)
    entries = F.array_sort(F.collect_list(F.struct("full_name", "value")))
    out = out.groupBy("setup_id", "flow_id").agg(F.map_from_entries(entries).alias("parameters"))
    return page(out, ["setup_id"], size, offset)


def list_evaluations(
    fold_evaluations: DataFrame, function: str, *, tasks: Ids = None, setups: Ids = None, flows: Ids = None,
    runs: Ids = None, uploaders: Ids = None, run_table: DataFrame | None = None, study: int | None = None,
    study_members: DataFrame | None = None, tags: DataFrame | None = None, tag=None, per_fold: bool = False,
    sort_order: str | None = None, offset: int = 0, size: int | None = None,
) -> DataFrame:
    """One row per evaluation of a metric; ``per_fold`` gives ``values`` by fold in place of ``value``.

    ``tags`` is (run_id, tag); ``tag`` keeps the evaluations of runs that carry it.
    """
    if sort_order not in (None, "asc", "desc"):
        raise ValueError("sort_order is 'asc' or 'desc'")
    out = fold_evaluations.filter(F.col("function") == function)
    for column, wanted in (("task_id", tasks), ("setup_id", setups), ("flow_id", flows), ("run_id", runs)):
        out = matches(out, column, wanted)
    if uploaders is not None:
        out = matches(out, "run_id", matches(run_table, "uploader", uploaders).select("run_id"))
    if study is not None:
        out = matches(out, "run_id", study_members.filter(F.col("study_id") == study).select("run_id"))
    if tag is not None:
        out = tagged(out, "run_id", tags, tag)
    ids = ["run_id", "task_id", "flow_id", "setup_id", "function"]
    if per_fold:
        by_fold = F.array_sort(F.collect_list(F.struct("repeat", "fold", F.col("value").alias("v"))))
        out = out.groupBy(*ids).agg(F.transform(by_fold, lambda e: e["v"]).alias("values"))
        out = out.withColumn("value", F.lit(None).cast("double"))
        return page(out, ["run_id", "task_id", "setup_id"], size, offset)
    out = out.groupBy(*ids).agg(F.avg("value").alias("value"))
    out = out.withColumn("values", F.lit(None).cast("array<double>"))
    return top(out, "value", sort_order, ["run_id", "task_id", "setup_id"], size, offset)


def top(df: DataFrame, metric: str, sort_order: str | None, ids: Sequence[str], size: int | None = None, offset: int = 0) -> DataFrame:
    """Sort by a metric, ids breaking ties, then cut."""
    if sort_order is None:
        return page(df, list(ids), size, offset)
    order: list[By] = [(metric, sort_order), *ids]
    if size is None and not offset:
        return df.orderBy(*sort_columns(order))
    return page(df, order, size, offset)


def by_run(evaluations: DataFrame, order: Sequence[str]) -> DataFrame:
    """One evaluation per run: the last one in the given order."""
    rest = [c for c in evaluations.columns if c != "run_id"]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("e")
    return evaluations.groupBy("run_id").agg(last).select("run_id", "e.*")


def list_studies(
    studies: DataFrame, *, entity: str | None = None, status: str | None = None, uploader: Ids = None,
    benchmark_suite: Ids = None, offset: int = 0, size: int | None = None,
) -> DataFrame:
    """Studies (``entity="run"``) or suites (``entity="task"``)."""
    out = matches(matches(studies, "main_entity_type", entity), "uploader", uploader)
    if benchmark_suite is not None:
        out = matches(out, "benchmark_suite", benchmark_suite)
    if status != "all":
        out = matches(out, "status", status)
    return page(out, ["study_id"], size, offset)


def list_qualities(qualities: DataFrame) -> DataFrame:
    return qualities.select("name").distinct()


def list_measures(evaluations: DataFrame) -> DataFrame:
    return evaluations.select("function").distinct()


def list_procedures(procedures: DataFrame, tasks: DataFrame) -> DataFrame:
    """Procedures whose task type occurs."""
    return procedures.join(tasks.select("ttid"), "ttid", "left_semi")


def datasets_active(ids: DataFrame, datasets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(did, is_active) of the known ids, and the unknown ids."""
    state = datasets.select("did", (F.col("status") == "active").alias("is_active"))
    return ids.join(state, "did"), ids.join(datasets, "did", "left_anti")


def name_to_id(names: DataFrame, datasets: DataFrame) -> DataFrame:
    """Lowest id per (name, version) request; without a version only active datasets count.

    ``n_matches`` lets the caller refuse ambiguous names.
    """
    found = [F.min("did").alias("did"), F.count("did").alias("n_matches")]
    active = datasets.filter(F.col("status") == "active").groupBy("name").agg(*found)
    exact = datasets.groupBy("name", "version").agg(*found)
    out = names.filter("version IS NULL").join(active, "name", "left").unionByName(
        names.filter("version IS NOT NULL").join(exact, ["name", "version"], "left"))
    return out.fillna(0, ["n_matches"])


def oldest_task(tasks: DataFrame, dataset_ids: DataFrame, procedure_id: int) -> tuple[DataFrame, DataFrame]:
    """Lowest task id per dataset under a procedure, and the datasets without one."""
    oldest = tasks.filter(F.col("procedure_id") == procedure_id).groupBy("did").agg(F.min("task_id").alias("task_id"))
    return oldest.join(dataset_ids, "did", "left_semi"), dataset_ids.join(oldest, "did", "left_anti")


def lookup(ids: DataFrame, entities: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The records of the requested ids, and the ids that have none."""
    wanted = ids.select(key).distinct()
    return entities.join(wanted, key, "left_semi"), wanted.join(entities, key, "left_anti")


def random_subset(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows without replacement, the same ones on every run."""
    digest = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string")))
    return page(df, [digest, key], n)
