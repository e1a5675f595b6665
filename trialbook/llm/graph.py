"""Connected components of links between rows, by labels that sink to the smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialbook.session import stage


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, label): the smallest node of its component for each node in ``links`` (a, b) or ``labels``.

    ``labels`` are the components known so far; new links join them. Each round passes the smallest
    label of the neighbours on and then follows labels of labels, so long chains need few rounds.
    Every table is written; nothing but the number of changes comes to the driver.
    """
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    if labels is None:
        labels = stage(ends.select("node", F.col("node").alias("label")), "labels")
    else:
        new = ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
        labels = stage(labels.unionByName(new), "labels")
    first = labels.withColumnsRenamed({"node": "a", "label": "u"})
    second = labels.withColumnsRenamed({"node": "b", "label": "v"})
    # Links between the components known so far.
    between = links.join(first, "a").join(second, "b").filter("u <> v").select("u", "v").distinct()
    between = stage(between.union(between.select("v", "u")), "between")
    roots = stage(between.select(F.col("u").alias("node")).distinct().select("node", F.col("node").alias("label")), "roots")
    while True:
        near = between.join(roots, between["u"] == roots["node"]).groupBy("v").agg(F.min("label").alias("near"))
        lower = roots.join(near, roots["node"] == near["v"], "left").select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        lower = stage(lower, "lower")
        target = lower.select(F.col("node").alias("t"), F.col("label").alias("of_label"))
        sunk = lower.join(target, lower["label"] == target["t"], "left").select("node", F.least("label", F.coalesce("of_label", "label")).alias("label"), "was")
        sunk = stage(sunk, "sunk")
        roots = sunk.select("node", "label")
        if sunk.filter("label <> was").isEmpty():
            break
    final = roots.select(F.col("node").alias("of"), F.col("label").alias("lowest"))
    return stage(labels.join(final, labels["label"] == final["of"], "left").select("node", F.coalesce("lowest", "label").alias("label")), "labels")
