"""Exact searches in memory: the roots of one component are dealt to several tasks."""

import pytest
from test_graph import _betweenness, _edges, _near, _paths, _random_edges

from strataglean.operators import graph


def test_a_component_has_several_tasks(spark, rows, monkeypatch):
    monkeypatch.setattr(graph, "PART_WORK", 600.0)
    for name, value in (("MATRIX_CELLS", 1), ("BLOCK_ROWS", 4), ("SLICE_EDGES", 5)):
        monkeypatch.setattr(graph, name, value)
    pairs = _random_edges(24, 50, 2) + [(40, 41), (41, 42)]
    shares = graph._by_size(_edges(spark, pairs), None, 100)[0].select("number", "part").collect()
    assert len(shares) == len(set(shares)) > 2 and len({r["number"] for r in shares}) == 2
    got = {(r[0], r[1]): r[2] for r in graph.edge_betweenness(_edges(spark, pairs)).collect()}
    assert got == pytest.approx({e: x for e, x in _betweenness(pairs).items() if x})
    near = _near(pairs)
    counts = sorted((s, t, d, _paths(near, s)[1][t]) for s in near for t, d in _paths(near, s)[0].items())
    assert rows(graph.bfs_path_counts(_edges(spark, pairs))) == counts


def test_components_with_too_many_edges_stay_in_the_tables(spark, monkeypatch):
    monkeypatch.setattr(graph, "MATRIX_EDGES", 3)
    pairs = [("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("x", "y")]
    edges = spark.createDataFrame(pairs, "src string, dst string")
    small, large, _ = graph._by_size(edges, None, 100)
    assert small.count() == 1 and large.count() == 4
    got = {(r[0], r[1]): r[2] for r in graph.edge_betweenness(edges).collect()}
    assert got == {("a", "b"): 1, ("b", "c"): 2, ("a", "c"): 2, ("c", "d"): 3, ("x", "y"): 1}
