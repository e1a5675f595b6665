"""Set operations: concatenation, differences, study membership and closure."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def concat(pages: Sequence[DataFrame]) -> DataFrame:
    """Pages of one listing as one frame; columns go by name and may be absent."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def missing_ids(wanted: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return wanted.select(key).distinct().join(known, key, "left_anti")


def attach(members: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members after adding, and the new size per study."""
    after = members.unionByName(new.select(*members.columns)).distinct()
    return after, after.groupBy("study_id").agg(F.count(F.lit(1)).alias("n_members"))


def detach(members: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members after removal, and the new size per study (0 when emptied)."""
    after = members.join(gone, members.columns, "left_anti")
    sizes = after.groupBy("study_id").agg(F.count(F.lit(1)).alias("n_members"))
    touched = members.select("study_id").distinct()
    return after, touched.join(sizes, "study_id", "left").fillna(0, ["n_members"])


def closure(members: DataFrame, runs: DataFrame, tasks: DataFrame) -> DataFrame:
    """(study_id, entity_type, entity_id): the runs of each study and what they point to."""
    r = members.join(runs, "run_id").join(tasks.select("task_id", "did"), "task_id", "left")
    kinds = F.explode(F.array(*[
        F.struct(F.lit(kind).alias("entity_type"), F.col(column).cast("long").alias("entity_id"))
        for kind, column in (("run", "run_id"), ("task", "task_id"), ("flow", "flow_id"),
                             ("setup", "setup_id"), ("data", "did"))
    ]))
    return r.select("study_id", kinds.alias("e")).select("study_id", "e.*").filter("entity_id IS NOT NULL").distinct()


def create_study(
    studies: DataFrame, new: DataFrame, requested: DataFrame, entities: DataFrame, key: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(studies with the new rows, their members, rejected member ids).

    ``requested`` is (study_id, key) and may be empty; a member that does not exist is rejected.
    """
    known = requested.join(entities, key, "left_semi").select("study_id", key).distinct()
    rejected = requested.join(entities, key, "left_anti")
    return studies.unionByName(new, allowMissingColumns=True), known, rejected
