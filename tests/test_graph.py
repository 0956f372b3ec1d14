import random
from collections import Counter, defaultdict, deque
from itertools import combinations

import pytest

from strataglean.operators import graph

BRIDGE = [(1, 2), (1, 3), (2, 3), (3, 4), (4, 5), (4, 6), (5, 6)]


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "src bigint, dst bigint")


def _random_edges(n, m, seed):
    rng = random.Random(seed)
    return sorted(rng.sample(list(combinations(range(n), 2)), m))


def _near(pairs):
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    return near


def _paths(near, root):
    dist, paths, queue = {root: 0}, Counter({root: 1}), deque([root])
    while queue:
        v = queue.popleft()
        for w in near[v]:
            if w not in dist:
                dist[w] = dist[v] + 1
                queue.append(w)
            if dist[w] == dist[v] + 1:
                paths[w] += paths[v]
    return dist, paths


def _betweenness(pairs):
    """By counting, for each pair of nodes, the shortest paths that use an edge."""
    near, out = _near(pairs), Counter()
    all_paths = {v: _paths(near, v) for v in near}
    for s, t in combinations(sorted(near), 2):
        ds, ps = all_paths[s]
        dt, pt = all_paths[t]
        if t not in ds:
            continue
        for a, b in pairs:
            for u, v in ((a, b), (b, a)):
                if u in ds and v in dt and ds[u] + 1 + dt[v] == ds[t]:
                    out[a, b] += ps[u] * pt[v] / ps[t]
    return out


def _components(nodes, pairs):
    near, label = _near(pairs), {}
    for v in sorted(nodes):
        if v not in label:
            for w in _paths(near, v)[0]:
                label[w] = v
    return label


def _divide(pairs):
    nodes, m = {v for e in pairs for v in e}, len(pairs)
    degree = Counter(v for e in pairs for v in e)

    def score(label):
        inner = Counter(label[a] for a, b in pairs if label[a] == label[b])
        total = Counter()
        for v, d in degree.items():
            total[label[v]] += d
        return round(sum(inner[c] / m - (total[c] / (2 * m)) ** 2 for c in total), 7)

    left, best = list(pairs), _components(nodes, pairs)
    top = score(best)
    while left:
        b = _betweenness(left)
        left.remove(min(left, key=lambda e: (-round(b[e], 7), e)))
        label = _components(nodes, left)
        if score(label) > top:
            best, top = label, score(label)
    return best, top


def test_bridge_graph(spark, rows):
    df = _edges(spark, BRIDGE)
    want = [(1, 2, 1.0), (1, 3, 4.0), (2, 3, 4.0), (3, 4, 9.0), (4, 5, 4.0), (4, 6, 4.0), (5, 6, 1.0)]
    assert rows(graph.edge_betweenness(df)) == want
    assert tuple(graph.top_edge(graph.edge_betweenness(df)).first()) == (3, 4, 9.0)
    best = graph.divisive_communities(df).collect()
    assert {r["id"]: r["community"] for r in best} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4}
    assert best[0]["modularity"] == 0.3571429


def test_betweenness_with_hubs_and_batches(spark, monkeypatch, rows):
    monkeypatch.setattr(graph, "HUB_ROWS", 3)
    pairs = sorted(set(_random_edges(12, 14, 1)) | {(0, i) for i in range(1, 9)})
    df, want = _edges(spark, pairs), _betweenness(pairs)
    for batches in (1, 2):
        got = {(r[0], r[1]): round(r[2], 6) for r in graph.edge_betweenness(df, root_batches=batches).collect()}
        assert got == {e: round(x, 6) for e, x in want.items()}
    near = _near(pairs)
    counts = sorted((s, t, d, _paths(near, s)[1][t]) for s in near for t, d in _paths(near, s)[0].items())
    assert rows(graph.bfs_path_counts(df)) == counts


@pytest.mark.parametrize("pairs, small", [
    (_random_edges(8, 9, 7), 0), (_random_edges(8, 9, 7), 4), (_random_edges(8, 9, 7), 2000), (_random_edges(9, 14, 3), 2000),
    (_random_edges(12, 12, 5), 2000), (_random_edges(12, 12, 5), 3),
    ([(1, 2), (2, 3), (3, 4), (4, 1), (5, 6), (6, 7), (7, 8), (8, 5)], 2000),  # ties, two components
])
def test_divisive_communities_match_single_cuts(spark, pairs, small):
    best, top = _divide(pairs)
    got = graph.divisive_communities(_edges(spark, pairs), small_edges=small).collect()
    assert got[0]["modularity"] == top
    assert {r["id"]: r["community"] for r in got} == best


def test_cuts_in_one_task_equal_cuts_over_tables(spark):
    edges = _edges(spark, _random_edges(8, 9, 11))
    one, tables = (sorted((r["src"], r["dst"], r["gain"]) for r in graph.cut_sequence(edges, n).collect()) for n in (2000, 0))
    assert one == tables


def test_components(spark, rows):
    pairs = [(i, i + 1) for i in range(30)] + [(40, 41), (41, 45), (50, 60)]
    got = graph.connected_components(_edges(spark, pairs))
    assert rows(got) == sorted(_components({v for e in pairs for v in e}, pairs).items())


def test_labels_and_modularity(spark, rows):
    df = _edges(spark, BRIDGE)
    near, label = _near(BRIDGE), {v: v for e in BRIDGE for v in e}
    for _ in range(5):
        label = {v: min(Counter(label[w] for w in near[v]).items(), key=lambda t: (-t[1], t[0]))[0] for v in near}
    assert rows(graph.label_propagation(df, 5)) == sorted(label.items())
    halves = spark.createDataFrame([(i, 0 if i < 4 else 1) for i in range(1, 7)], "id bigint, community bigint")
    assert graph.modularity(df, halves).first()[0] == 0.3571429


def test_co_pair_edges(spark, rows):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1), ("y", 2), ("y", 3)], "g string, m int")
    assert rows(graph.co_pair_edges(df, "g", "m", 2, directed=True)) == [(1, 2, 2), (2, 1, 2)]


def test_divisive_communities_of_text_ids_and_of_nothing(spark):
    named = spark.createDataFrame([(f"u{a}", f"u{b}") for a, b in BRIDGE], "src string, dst string")
    got = {r["id"]: r["community"] for r in graph.divisive_communities(named).collect()}
    assert got == {"u1": "u1", "u2": "u1", "u3": "u1", "u4": "u4", "u5": "u4", "u6": "u4"}
    none = spark.createDataFrame([], "src string, dst string")
    assert graph.divisive_communities(none).count() == 0 and graph.cut_sequence(none).count() == 0


def test_betweenness_does_not_depend_on_batches(spark, rows, monkeypatch):
    edges = _edges(spark, _random_edges(9, 14, 3))
    want = rows(graph.edge_betweenness(edges, root_batches=1).selectExpr("src", "dst", "round(betweenness, 9) b"))
    monkeypatch.setattr(graph, "STATE_ROWS", 20)
    assert rows(graph.edge_betweenness(edges).selectExpr("src", "dst", "round(betweenness, 9) b")) == want
