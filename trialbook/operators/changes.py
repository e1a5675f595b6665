"""Batches of changes to catalog tables.

Each function takes current rows and a table of changes and returns new rows, and the changes it
refused with a reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialbook.plans.scan import row_numbers
from trialbook.session import stage

# Entity kinds that carry tags; states a change may set; longest ontology URI;
# dataset fields anybody may edit, and those only an owner may.
TAG_KINDS = ("data", "task", "flow", "setup", "run")
LEGAL_STATES = ("active", "deactivated")
MAX_ONTOLOGY = 256
OPEN_FIELDS = ("description", "creator", "contributor", "collection_date", "language", "citation", "original_data_url", "paper_url")
OWNER_FIELDS = ("default_target_attribute", "ignore_attribute", "row_id_attribute")


def apply_tags(current: DataFrame, log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tags (kind, id, tag) after a log (kind, id, tag, op, seq) of 'add' and 'remove'; later entries win."""
    legal = F.col("kind").isin(list(TAG_KINDS)) & F.col("op").isin("add", "remove")
    keys = ["kind", "id", "tag"]
    start = current.select(*keys, F.lit("add").alias("op"), F.lit(None).cast("long").alias("seq"))
    entries = start.unionByName(log.filter(legal).select(*keys, "op", F.col("seq").cast("long").alias("seq")))
    last = entries.groupBy(*keys).agg(F.max(F.struct("seq", "op")).alias("e"))
    reason = F.when(~F.col("kind").isin(list(TAG_KINDS)), "unknown kind").otherwise("unknown operation")
    return last.filter(F.col("e.op") == "add").select(*keys), log.filter(~F.coalesce(legal, F.lit(False))).withColumn("reason", reason)


def apply_status(entities: DataFrame, key: str, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entities after status changes (key, status, seq); the last legal one wins."""
    legal = F.coalesce(F.col("status").isin(list(LEGAL_STATES)), F.lit(False))
    last = changes.filter(legal).groupBy(key).agg(F.max(F.struct("seq", "status")).alias("_new"))
    after = entities.join(last, key, "left").withColumn("status", F.coalesce(F.col("_new.status"), F.col("status"))).drop("_new")
    illegal = changes.filter(~legal).withColumn("reason", F.lit("illegal status"))
    unknown = changes.filter(legal).join(entities, key, "left_anti").withColumn("reason", F.lit("unknown id"))
    return after, illegal.unionByName(unknown)


def edit_datasets(
    datasets: DataFrame, edits: DataFrame, tasks: DataFrame,
    open_fields: Sequence[str] = OPEN_FIELDS, owner_fields: Sequence[str] = OWNER_FIELDS,
) -> tuple[DataFrame, DataFrame]:
    """Datasets after edits (did, user, seq, fields..); a NULL field stays as it is.

    An edit that touches an owner field is refused whole unless the user owns the dataset and no
    task uses it.
    """
    fields = [f for f in (*open_fields, *owner_fields) if f in edits.columns]
    guarded = [F.col(f).isNotNull() for f in owner_fields if f in edits.columns]
    critical = F.lit(False)
    for g in guarded:
        critical = critical | g
    used = tasks.groupBy("did").agg(F.lit(True).alias("_used"))
    known = datasets.select("did", F.col("uploader").alias("_owner"), F.lit(True).alias("_known")).join(used, "did", "left")
    judged = edits.join(known, "did", "left").withColumn("reason", (
        F.when(F.col("_known").isNull(), "unknown id")
        .when(critical & ~F.col("user").eqNullSafe(F.col("_owner")), "not the owner")
        .when(critical & F.col("_used"), "used by tasks")))
    accepted = judged.filter("reason IS NULL").groupBy("did").agg(*[
        F.max(F.when(F.col(f).isNotNull(), F.struct("seq", f)))[f].alias(f"_new_{f}") for f in fields])
    after = datasets.join(accepted, "did", "left")
    after = after.withColumns({f: F.coalesce(f"_new_{f}", F.col(f)) for f in fields})
    return after.select(*datasets.columns), judged.filter("reason IS NOT NULL").select(*edits.columns, "reason")


def fork_datasets(datasets: DataFrame, forks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Datasets with a copy per fork (did, user): a new id, the next version of its name, a new owner."""
    source = forks.select("did", "user").join(datasets, "did")
    unknown = forks.join(datasets, "did", "left_anti").withColumn("reason", F.lit("unknown id"))
    top = datasets.agg(F.max("did").alias("_top"))
    newest = datasets.groupBy("name").agg(F.max("version").alias("_newest"))
    numbered = row_numbers(row_numbers(source, [], ["did", "user"], "_n"), ["name"], ["did", "user"], "_v")
    copies = numbered.join(F.broadcast(top)).join(newest, "name")  # one row of tops
    made = copies.withColumns({
        "did": F.col("_top") + F.col("_n"), "version": F.col("_newest") + F.col("_v"), "uploader": F.col("user")})
    return datasets.unionByName(made.select(*datasets.columns)), unknown


def delete(entities: DataFrame, key: str, requests: DataFrame, dependents: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Entities without those that were deleted by their owner and that nothing depends on.

    ``dependents`` maps a reason to a frame with the ``key`` of every entity in use.
    """
    judged = requests.join(entities.select(key, F.col("uploader").alias("_owner"), F.lit(True).alias("_known")), key, "left")
    reason = F.when(F.col("_known").isNull(), "unknown id").when(~F.col("user").eqNullSafe(F.col("_owner")), "not the owner")
    for i, (why, frame) in enumerate(dependents.items()):
        judged = judged.join(frame.groupBy(key).agg(F.lit(True).alias(f"_d{i}")), key, "left")
        reason = reason.when(F.col(f"_d{i}"), why)
    judged = judged.withColumn("reason", reason)
    gone = judged.filter("reason IS NULL").select(key)
    return entities.join(gone, key, "left_anti"), judged.filter("reason IS NOT NULL").select(*requests.columns, "reason")


# What depends on an entity, in the order in which a refusal names it.
DEPENDENTS = ("task", "run", "flow", "setup", "study")


def _what(kind: str, id_: str, to_kind: str, to_id: str) -> list:
    return [F.col(kind).alias(to_kind), F.col(id_).alias(to_id)]


def dependents(start: DataFrame, uses: DataFrame) -> DataFrame:
    """(kind, id, by_kind, by_id): everything that depends on the entities (kind, id) of ``start``, directly or through others.

    ``uses`` (kind, id, used_kind, used_id) is the graph over all kinds. Every round follows the edges of what the round
    before found new, so an edge is met once per entity, and cycles end.
    """
    keys = ["kind", "id", "by_kind", "by_id"]
    edges = uses.select(*_what("used_kind", "used_id", "on_kind", "on_id"), *_what("kind", "id", "by_kind", "by_id")).distinct()
    edges = stage(edges, "uses")
    found = new = stage(start.select("kind", "id").distinct().join(edges, (F.col("kind") == F.col("on_kind")) & (F.col("id") == F.col("on_id"))).select(*keys), "dependents")
    while not new.isEmpty():
        reached = new.select("kind", "id", *_what("by_kind", "by_id", "on_kind", "on_id")).join(edges, ["on_kind", "on_id"]).select(*keys).distinct()
        new = stage(reached.join(found, keys, "left_anti"), "dependents")
        found = found.unionByName(new)
    return found


def delete_any(entities: DataFrame, requests: DataFrame, uses: DataFrame, cascade: bool = False) -> tuple[DataFrame, DataFrame]:
    """Entities (kind, id, uploader, ..) of all kinds after deletions (kind, id, user), and the refused requests.

    A request is refused when the entity is unknown, when the user does not own it, or when something uses it; the reason names
    the first kind of ``DEPENDENTS`` that does. With ``cascade`` all that depends on an entity goes with it, unless
    some of it belongs to others.
    """
    owners = entities.select("kind", "id", F.col("uploader").alias("_owner"), F.lit(True).alias("_known"))
    judged = requests.join(owners, ["kind", "id"], "left")
    reason = F.when(F.col("_known").isNull(), "unknown id").when(~F.col("user").eqNullSafe(F.col("_owner")), "not the owner")
    if cascade:
        below = stage(dependents(requests, uses), "cascade")
        theirs = below.join(owners.select(*_what("kind", "id", "by_kind", "by_id"), F.col("_owner").alias("_by_owner")), ["by_kind", "by_id"])
        whose = theirs.groupBy("kind", "id").agg(F.min("_by_owner").alias("_least"), F.max("_by_owner").alias("_most"), F.count_if(F.col("_by_owner").isNull()).alias("_nobody"))
        judged = judged.join(whose, ["kind", "id"], "left")
        alone = F.col("_least").isNull() & (F.coalesce("_nobody", F.lit(0)) == 0) | (F.col("_least") == F.col("user")) & (F.col("_most") == F.col("user")) & (F.col("_nobody") == 0)
        reason = reason.when(~F.coalesce(alone, F.lit(False)), "others own what depends on it")
    else:
        used = uses.join(entities.select("kind", "id"), ["kind", "id"], "left_semi").groupBy(*_what("used_kind", "used_id", "kind", "id")).agg(
            F.min(F.array_position(F.array(*[F.lit(k) for k in DEPENDENTS]), F.col("kind"))).alias("_by"))
        judged = judged.join(used, ["kind", "id"], "left")
        reason = reason.when(F.col("_by").isNotNull(), F.concat(F.lit("used by a "), F.element_at(F.array(*[F.lit(k) for k in DEPENDENTS]), F.col("_by").cast("int"))))
    judged = stage(judged.withColumn("reason", reason), "judged")
    gone = judged.filter("reason IS NULL").select("kind", "id")
    if cascade:
        gone = gone.unionByName(below.join(gone, ["kind", "id"], "left_semi").select(*_what("by_kind", "by_id", "kind", "id")))
    return entities.join(gone, ["kind", "id"], "left_anti"), judged.filter("reason IS NOT NULL").select(*requests.columns, "reason")


def apply_ontologies(current: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(did, index, url) after changes (did, index, url, op, seq); one row per URL, however many."""
    short = F.length("url") <= MAX_ONTOLOGY
    legal = F.coalesce(short & F.col("op").isin("add", "remove"), F.lit(False))
    keys = ["did", "index", "url"]
    start = current.select(*keys, F.lit("add").alias("op"), F.lit(None).cast("long").alias("seq"))
    entries = start.unionByName(changes.filter(legal).select(*keys, "op", F.col("seq").cast("long").alias("seq")))
    last = entries.groupBy(*keys).agg(F.max(F.struct("seq", "op")).alias("e"))
    reason = F.when(~short, "longer than 256 characters").otherwise("unknown operation")
    return last.filter(F.col("e.op") == "add").select(*keys), changes.filter(~legal).withColumn("reason", reason)


def compare_datasets(left: DataFrame, right: DataFrame, key: str, ignore: Sequence[str] = ()) -> DataFrame:
    """(key, equal): same user-supplied metadata, NULL equal to NULL; a missing side is unequal."""
    columns = [c for c in left.columns if c != key and c not in ignore]
    a = left.select(key, F.struct(*columns).alias("_a"))
    b = right.select(key, F.struct(*columns).alias("_b"))
    return a.join(b, key, "full").select(key, F.col("_a").eqNullSafe(F.col("_b")).alias("equal"))
