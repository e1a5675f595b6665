"""Flow trees: structure, comparison and effective parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialbook.session import stage

# Fields a server sets, and fields that hold files or live objects.
SERVER_FIELDS = ("flow_id", "uploader", "version", "upload_date", "tags")
LOCAL_FIELDS = ("binary_url", "binary_format", "binary_md5", "model")


def ways(edges: DataFrame, flows: DataFrame) -> DataFrame:
    """(root_id, steps, flow_id): every way down to every flow from those that are no component of another.

    Steps are (identifier, child, main, known): the edge is the first one into its child, and where it begins is in
    ``flows``. No limit on the length of a way. Every flow starts from the edges into it, and jumps to the ways of where these begin,
    so the rounds are as many as the depth has binary digits, and a tree has one row per flow in all of them. A way that
    meets a flow twice is a flow that contains itself, an error.
    """
    numbered = stage(edges.select("parent", "identifier", "child").withColumn("_edge", F.monotonically_increasing_id()), "edges")
    first = numbered.groupBy("child").agg(F.min("_edge").alias("_first")).select(F.col("child").alias("_child"), "_first")
    inner = numbered.select(F.col("child").alias("parent"), F.lit(True).alias("_open")).distinct()
    known = flows.select(F.col("flow_id").alias("parent"), F.lit(True).alias("_known")).distinct()
    # Compact files say little about a table's size in memory: nothing here is broadcast.
    placed = numbered.join(first.hint("merge"), F.col("child") == F.col("_child"), "left").join(inner.hint("merge"), "parent", "left").join(known.hint("merge"), "parent", "left")
    step = F.struct("identifier", "child", F.coalesce(F.col("_edge") == F.col("_first"), F.lit(False)).alias("main"), F.coalesce("_known", F.lit(False)).alias("known"))
    found = stage(placed.select(F.col("parent").alias("root_id"), F.array(step).alias("steps"), F.col("child").alias("flow_id"), F.coalesce("_open", F.lit(False)).alias("_open")), "steps")
    jumps = 0
    while True:
        met = F.array_compact(F.array_append(F.transform("steps", lambda s: s["child"]), F.col("root_id")))
        cycle = found.filter(F.size(F.array_distinct(met)) < F.size(met)).first()
        if cycle is not None:
            raise ValueError(f"flows contain themselves, {cycle['flow_id']} for one")
        if found.filter("_open").isEmpty():
            return found.drop("_open")
        jumps += 1
        up = found.select(F.col("flow_id").alias("root_id"), F.col("root_id").alias("_above"), F.col("steps").alias("_before"), F.col("_open").alias("_on"))
        longer = found.filter("_open").join(up.hint("merge"), "root_id").select(
            F.col("_above").alias("root_id"), F.concat("_before", "steps").alias("steps"), "flow_id", F.col("_on").alias("_open"))
        found = stage(found.filter("NOT _open").unionByName(longer), f"ways-{jumps}")


def components(flows: DataFrame, edges: DataFrame) -> DataFrame:
    """(root_id, path, flow_id, depth): every flow with all its direct and indirect sub-flows, however deep.

    A flow that contains itself is an error. What is left of a way after some of its steps is a way down from where these
    end. It is taken where all of them are main ones, as there is one such beginning for every flow; so no way is
    shuffled again.
    """
    own = flows.select(F.col("flow_id").alias("root_id"), F.array().cast("array<string>").alias("path"), "flow_id", F.lit(0).alias("depth"))
    rest = F.slice("steps", F.col("_at") + 1, F.size("steps"))
    other = F.array_position(F.transform("steps", lambda s: s["main"]), F.lit(False)).cast("int")
    last = F.when(other > 0, other - 1).otherwise(F.size("steps") - 1)
    below = ways(edges, flows).select("root_id", "steps", "flow_id", F.explode(F.sequence(F.lit(0), last)).alias("_at")).filter(F.get("steps", F.col("_at"))["known"])
    return own.unionByName(below.select(
        F.when(F.col("_at") == 0, F.col("root_id")).otherwise(F.get("steps", F.col("_at") - 1)["child"]).alias("root_id"),
        F.transform(rest, lambda s: s["identifier"]).alias("path"), "flow_id", (F.size("steps") - F.col("_at")).alias("depth")))


def subflow(tree: DataFrame, path: Sequence[str]) -> DataFrame:
    """(root_id, flow_id) of the node at a path."""
    wanted = F.array(*[F.lit(p) for p in path]).cast("array<string>")
    return tree.filter(F.col("path") == wanted).select("root_id", "flow_id")


def older_children(flows: DataFrame, edges: DataFrame) -> DataFrame:
    """(root_id, path) of the sub-flows that were uploaded before the flow they are a component of, for ``differences``.

    ``flows`` has ``upload_date``, a timestamp or its text; a date that is missing or no date tells nothing.
    """
    at = flows.select("flow_id", F.col("upload_date").try_cast("timestamp").alias("at"))
    parent = at.select(F.col("flow_id").alias("parent"), F.col("at").alias("_parent_at"))
    child = at.select(F.col("flow_id").alias("child"), F.col("at").alias("_child_at"))
    older = edges.join(parent, "parent").join(child, "child").filter(F.col("_child_at") < F.col("_parent_at")).select("parent", "identifier", "child")
    own = older.select(F.col("parent").alias("root_id"), F.array("identifier").alias("path"))
    # The same edge below any flow that holds the parent.
    above = components(flows, edges).filter("depth > 0").select("root_id", F.col("path").alias("_path"), F.col("flow_id").alias("parent"))
    below = above.join(older, "parent").select("root_id", F.array_append("_path", F.col("identifier")).alias("path"))
    return own.unionByName(below)


def differences(
    left: DataFrame, right: DataFrame, *, ignore_fields: Sequence[str] = (*SERVER_FIELDS, *LOCAL_FIELDS, "description"),
    ignore_parameter_values: bool = False, ignore_custom_name_if_none: bool = False,
    older_children: DataFrame | None = None,
) -> DataFrame:
    """What differs between two sets of flows; empty means equal.

    Both sides are (root_id, path, kind, name, value). ``kind`` is 'field', 'parameter', 'meta'
    (the data type of a parameter) or 'component' (the presence of a sub-flow). A parameter or
    component must exist on both sides even where its value is not compared. ``older_children``
    lists the (root_id, path) of sub-flows uploaded before their parent, whose parameter values
    do not count.
    """
    keys = ["root_id", "path", "kind", "name"]

    def side(df: DataFrame, tag: str) -> DataFrame:
        kept = df.filter(~((F.col("kind") == "field") & F.col("name").isin(list(ignore_fields))))
        return kept.select(*keys, F.col("value").alias(f"{tag}_value"), F.lit(True).alias(f"in_{tag}"))

    both = side(left, "left").join(side(right, "right"), keys, "full")
    absent = F.col("in_left").isNull() | F.col("in_right").isNull()
    unequal = ~F.col("left_value").eqNullSafe(F.col("right_value"))
    either_null = F.col("left_value").isNull() | F.col("right_value").isNull()
    parameter = F.col("kind") == "parameter"
    if older_children is not None:
        both = both.join(older_children.select("root_id", "path", F.lit(True).alias("_older")), ["root_id", "path"], "left")
        unequal = unequal & ~(parameter & F.coalesce("_older", F.lit(False)))
    if ignore_parameter_values:
        unequal = unequal & ~parameter
    unequal = unequal & ~((F.col("kind") == "meta") & either_null)
    counts = absent & (F.col("kind") != "field")
    if ignore_custom_name_if_none:
        unequal = unequal & ~((F.col("name") == "custom_name") & (F.col("kind") == "field") & either_null)
    return both.filter(counts | unequal).select(
        *keys, "left_value", "right_value",
        F.when(F.col("in_right").isNull(), "only left").when(F.col("in_left").isNull(), "only right").otherwise("differs").alias("problem"))


def effective_parameters(tree: DataFrame, flow_parameters: DataFrame, setup_parameters: DataFrame, setups: DataFrame) -> DataFrame:
    """(setup_id, path, flow_id, name, value): defaults of every sub-flow, overridden by the setup."""
    nodes = setups.select("setup_id", F.col("flow_id").alias("root_id")).join(tree.select("root_id", "path", "flow_id"), "root_id")
    defaults = nodes.join(flow_parameters.select("flow_id", "name", "default_value"), "flow_id")
    given = setup_parameters.select("setup_id", "flow_id", F.col("parameter_name").alias("name"), F.col("value").alias("_given"), F.lit(True).alias("_set"))
    return defaults.join(given, ["setup_id", "flow_id", "name"], "left").select(
        "setup_id", "path", "flow_id", "name",
        F.when(F.col("_set"), F.col("_given")).otherwise(F.col("default_value")).alias("value"))


def nodes_without_id(tree: DataFrame) -> DataFrame:
    """Nodes that were never given an id."""
    return tree.filter(F.col("flow_id").isNull())
