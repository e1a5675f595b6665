"""Joins between evaluations, setups, users, flows, runs, tasks and split rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialbook.functions.params import canonical_key, empty_map
from trialbook.session import stage


def setup_maps(parameters: DataFrame) -> DataFrame:
    """(setup_id, parameters) from the long table: as many entries as the flow has parameters."""
    entries = F.collect_list(F.struct("full_name", "value"))
    return parameters.groupBy("setup_id").agg(F.map_from_entries(entries).alias("parameters"))


def evaluations_setups(evaluations: DataFrame, parameters: DataFrame, order: Sequence[str | Column] = (), few: bool = False) -> DataFrame:
    """Every evaluation with its setup's parameters; an unknown setup has an empty map.

    A join does not keep the order of its input, so a wanted order is given. For ``few`` evaluations out of
    many, they are written once, and maps are built only for their setups.
    """
    if few:
        evaluations = stage(evaluations, "few")
        parameters = parameters.join(evaluations.select("setup_id").distinct(), "setup_id", "left_semi")
    out = evaluations.join(setup_maps(parameters), "setup_id", "left")
    out = out.withColumn("parameters", F.coalesce("parameters", empty_map()))
    return out.orderBy(*order) if order else out


def parameters_to_columns(evaluations_with_map: DataFrame, flow_parameters: DataFrame, flow_id: int, prefix: str = "") -> DataFrame:
    """The map as one column per parameter of a single flow.

    The names come from the flow's own parameter rows, not from the evaluations.
    """
    rows = flow_parameters.filter(F.col("flow_id") == flow_id).select("name").distinct().orderBy("name")
    names = [r["name"] for r in rows.collect()]  # the schema of the result
    one = evaluations_with_map.filter(F.col("flow_id") == flow_id)

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    # One text for all columns: a call for each would take longer than the query.
    values = [f"try_element_at(parameters, {quoted(prefix + n)}) AS `{n.replace('`', '``')}`" for n in names]
    return one.selectExpr(*[f"`{c}`" for c in one.columns if c != "parameters"], *values)


def with_usernames(frame: DataFrame, users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Uploader names, and the uploaders nobody knows."""
    named = frame.join(users.select("uploader", "username"), "uploader", "left")
    unknown = frame.select("uploader").distinct().join(users, "uploader", "left_anti")
    return named, unknown


def flow_comparison(evaluations: DataFrame, qualities: DataFrame) -> DataFrame:
    """Evaluations of datasets that have qualities."""
    return evaluations.join(qualities, "did")


def rows_of_cell(rows: DataFrame, test_folds: DataFrame, repeat: int, fold: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) rows of one cell. Only test folds are stored; train is the complement."""
    one = test_folds.filter(F.col("repeat") == repeat)
    placed = rows.join(one.select("rowid", "fold"), "rowid")
    return placed.filter(F.col("fold") != fold), placed.filter(F.col("fold") == fold)


def runs_exist(candidates: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(task, setup) pairs that have runs, with those runs; and the pairs that have none.

    A setup id of 0 or below stands for a setup that is not stored, so it has no runs.
    """
    keys = ["task_id", "setup_id"]
    stored = candidates.filter(F.col("setup_id") > 0)
    found = runs.select(*keys, "run_id").join(stored, keys, "left_semi")
    return found, candidates.join(found, keys, "left_anti")


def flow_exists(wanted: DataFrame, flows: DataFrame) -> DataFrame:
    """(name, external_version) pairs with the id of the flow, NULL where there is none."""
    ids = flows.groupBy("name", "external_version").agg(F.min("flow_id").alias("flow_id"))
    return wanted.join(ids, ["name", "external_version"], "left")


def flow_ids(names: DataFrame, flows: DataFrame, exact_versions: bool = False) -> DataFrame:
    """All flow ids of each name as rows, so that a name may have any number of versions."""
    columns = ["name", "external_version"] if exact_versions else ["name"]
    return flows.select("name", "external_version", "flow_id").join(names.select(*columns).distinct(), columns, "left_semi")


def setups_exist(candidates: DataFrame, setups: DataFrame) -> DataFrame:
    """Candidate (flow_id, parameters) with the stored setup of the same flow and parameter set."""
    stored = setups.groupBy("flow_id", canonical_key(F.col("parameters")).alias("_key")).agg(F.min("setup_id").alias("setup_id"))
    asked = candidates.withColumn("_key", canonical_key(F.col("parameters")))
    return asked.join(stored, ["flow_id", "_key"], "left").drop("_key")


def equal_tasks(candidates: DataFrame, tasks: DataFrame, definition: Sequence[str]) -> DataFrame:
    """Candidates with the lowest id of a task of the same definition; NULL equals NULL."""
    stored = tasks.groupBy(*definition).agg(F.min("task_id").alias("task_id"))
    stored = stored.select("task_id", *[F.col(c).alias(f"_t_{c}") for c in definition])
    on = F.lit(True)
    for c in definition:
        on = on & F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    return candidates.join(stored, on, "left").select(*candidates.columns, "task_id")
