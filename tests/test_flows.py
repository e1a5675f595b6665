"""Ways down flow graphs against a plain walk."""

from trialbook.operators import flows
from trialbook.sources import elements


def walk(edges, at):
    found = []
    for parent, identifier, child in edges:
        if parent == at:
            found.append(([identifier], child))
            found += [([identifier, *path], end) for path, end in walk(edges, child)] if child is not None else []
    return found


def test_flows_with_several_parents(spark):
    """Shared components, an edge given twice, edges without a parent or a child, and one from an unknown flow."""
    edges = [(1, "a", 2), (1, "b", 3), (2, "c", 4), (3, "c", 4), (4, "d", 5), (4, "d", 5), (5, "e", 6), (None, "n", 7), (7, "f", 6), (6, "g", None), (99, "u", 1), (8, "h", None)]
    known = list(range(1, 9))
    frame = spark.createDataFrame(edges, "parent long, identifier string, child long")
    got = flows.components(spark.createDataFrame([(k,) for k in known], "flow_id long"), frame).collect()
    wanted = [(k, [], k, 0) for k in known] + [(k, path, end, len(path)) for k in known for path, end in walk(edges, k)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))


def test_a_chain_has_one_way_per_flow(spark):
    """Not one per pair of flows."""
    edges = spark.range(1, 100).selectExpr("id - 1 AS parent", "'s' AS identifier", "id AS child")
    found = flows.ways(edges, spark.range(100).selectExpr("id AS flow_id")).collect()
    assert sorted(len(r["steps"]) for r in found) == list(range(1, 100)) and {r["root_id"] for r in found} == {0}


def test_ancestors_are_not_broadcast(spark, monkeypatch):
    """A compact file may hold more than a driver does."""
    plans = []
    monkeypatch.setattr(elements, "stage", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df.localCheckpoint())
    nodes = spark.range(40).selectExpr("id AS node", "'f' AS file", "IF(id > 0, id - 1, NULL) AS above", "IF(id > 0, array(string(id)), array()) AS path")
    assert {len(r["path"]) for r in elements.to_roots(nodes).collect()} == set(range(40))
    assert plans and not any("Broadcast" in p for p in plans)
