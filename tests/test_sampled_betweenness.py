import itertools
import math
import random

from strataglean.operators import graph


def edge_table(spark, edges):
    return spark.createDataFrame(sorted({(min(e), max(e)) for e in edges}), "src long, dst long")


def random_graph(seed):
    """Two dense parts with a bridge, and a component apart."""
    rng = random.Random(seed)
    edges = [e for part in (range(0, 9), range(9, 16)) for e in itertools.combinations(part, 2) if rng.random() < 0.5]
    return edges + [(0, i) for i in range(1, 9)] + [(9, i) for i in range(10, 16)] + [(3, 11), (100, 101)]


def test_estimates_are_within_the_stated_error(spark):
    edges = edge_table(spark, random_graph(1))
    exact = {(r.src, r.dst): r.betweenness for r in graph.edge_betweenness(edges).collect()}
    found = graph.sampled_betweenness(edges, eps=0.12, delta=0.1, seed=1, first=128).collect()
    estimate = {(r.src, r.dst): r.betweenness for r in found}
    n = graph.vertices(edges).count()
    assert {r.error for r in found} == {0.12 * n * (n - 1) / 2} and set(estimate) <= set(exact)
    assert max(abs(b - estimate.get(e, 0.0)) for e, b in exact.items()) <= found[0].error
    bound = graph.sample_bound(graph.vertex_diameter_bound(edges), 0.12, 0.05)
    assert 128 <= found[0].samples <= bound


def test_each_shortest_path_is_equally_likely(spark):
    # Four shortest paths lead from 0 to 9; each of their first edges carries the same share.
    ladder = edge_table(spark, [(0, m) for m in (1, 2, 3, 4)] + [(m, 9) for m in (1, 2, 3, 4)])
    pairs = spark.createDataFrame([(i, 0, 9) for i in range(800)], "sample long, root long, target long")
    links = graph._spread_links(ladder, graph._hubs(ladder))
    steps = graph._walk_back(links, pairs)
    assert steps.count() == 1600 and steps.groupBy("sample").count().filter("count <> 2").isEmpty()
    firsts = [r["count"] for r in steps.filter("src = 0").groupBy("dst").count().collect()]
    assert len(firsts) == 4 and all(150 < c < 250 for c in firsts)


def test_diameter_bound_and_sample_size(spark):
    path = edge_table(spark, [(i, i + 1) for i in range(4)])
    assert graph.vertex_diameter_bound(path) >= 5
    assert graph.sample_bound(2, 0.1, 0.1) == math.ceil(50 * (1 + math.log(10)))
    empty = spark.createDataFrame([], "src long, dst long")
    assert graph.sampled_betweenness(empty).collect() == []
