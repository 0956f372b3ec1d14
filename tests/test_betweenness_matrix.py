"""Exact betweenness and path counts: the same from a component's matrix as from the tables."""

import pytest

from strataglean.operators import graph

# A component of five nodes with a cycle, and one of two.
PAIRS = [(1, 2), (1, 3), (2, 4), (3, 4), (4, 5), (8, 9)]


def test_matrix_equals_tables(spark):
    edges = spark.createDataFrame([(str(a), str(b)) for a, b in PAIRS], "src string, dst string")
    found, counts = [], []
    for size in (2, 2048):  # one of the components, both
        found.append({r[:2]: r[2] for r in graph.edge_betweenness(edges, matrix_nodes=size).collect()})
        counts.append({r[:2]: r[2:] for r in graph.bfs_path_counts(edges, matrix_nodes=size).collect()})
    assert found[0] == pytest.approx(found[1]) and found[1]["4", "5"] == 4 and found[1]["8", "9"] == 1
    assert counts[0] == counts[1] and counts[1]["1", "4"] == (2, 2) and len(counts[1]) == 29


def test_chosen_roots(spark):
    edges = spark.createDataFrame(PAIRS, "src long, dst long")
    found = graph.edge_betweenness(edges, spark.createDataFrame([(5,)], "id long"))
    assert {r[:2]: r[2] for r in found.collect()} == {(4, 5): 2, (2, 4): 0.75, (3, 4): 0.75, (1, 2): 0.25, (1, 3): 0.25}


def test_a_search_ends_at_what_is_wanted(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(6)], "src long, dst long")
    links = graph._spread_links(edges, None)
    wanted = spark.createDataFrame([(0, 2)], "root long, node long")
    assert len(graph._bfs_levels(links, spark.createDataFrame([(0,)], "id long"), wanted)) == 3
