"""Queries that no SQL checks: their results by invariants."""

import math
import os
import random
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
from strataglean.operators import recommend
from strataglean.plans import clusters, graphs

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
run = lambda spark, name: entry.queries()[name](spark, FOLDER)


@pytest.fixture
def blobs(spark, monkeypatch):
    pick = random.Random(5)
    data = [(i, [pick.gauss(30.0 * (i % 3), 1), pick.gauss(0, 1)]) for i in range(300)]
    points = spark.createDataFrame(data, "id bigint, features array<double>")
    monkeypatch.setattr(clusters, "_points", lambda *_: points)
    monkeypatch.setattr(clusters, "K", 3)
    return dict(data)


def test_kmeans_places_points_at_the_nearest_centre(spark, blobs):
    label = {r["id"]: r["cluster"] for r in run(spark, "kmeans_clusters").collect()}
    members = defaultdict(list)
    for i, c in label.items():
        members[c].append(blobs[i])
    centre = {c: [sum(x) / len(x) for x in zip(*m)] for c, m in members.items()}
    assert label.keys() == blobs.keys() and len(centre) == 3
    assert all(min(centre, key=lambda c: math.dist(centre[c], blobs[i])) == own for i, own in label.items())


def test_bfr_returns_its_sets_and_labels(spark, blobs):
    label = {r["id"]: r["cluster"] for r in run(spark, "bfr_clusters").collect()}
    last = max(run(spark, "bfr_round_counts").collect(), key=lambda r: r["round"])
    assert label.keys() == blobs.keys()
    assert sum(c >= 0 for c in label.values()) == last["n_discard"] > 200
    assert last["n_discard"] + last["n_cs_points"] + last["n_retained"] == 300
    blob = defaultdict(set)
    for i, c in label.items():
        blob[c].add(i % 3)
    assert all(len(blob[c]) == 1 for c in range(3))
    sets = run(spark, "bfr_init_sets").collect()
    assert sorted(r["cluster"] for r in sets if r["kind"] == "ds") == [0, 1, 2] and all(r["n"] >= 0 for r in sets)


def test_modularity_of_the_returned_communities(spark, monkeypatch):
    edges = [(a + s, b + s) for s in (0, 10, 20) for a in range(4) for b in range(a)] + [(0, 10), (11, 20)]
    monkeypatch.setattr(graphs, "_kept", lambda spark, *_: spark.createDataFrame(edges, "src bigint, dst bigint"))
    found = run(spark, "gn_partition").collect()
    of = {r["id"]: r["community"] for r in found}
    degree = Counter(n for e in edges for n in e)
    same = sum(of[a] == of[b] for a, b in edges) / len(edges)
    want = same - sum((sum(degree[n] for n in of if of[n] == c) / (2 * len(edges))) ** 2 for c in set(of.values()))
    assert of.keys() == degree.keys() and {r["modularity"] for r in found} == {round(want, 7)}
    assert len(set(of.values())) == 3


def test_errors_follow_from_the_predictions(spark, monkeypatch):
    monkeypatch.setattr(recommend.fit_boosted_trees, "__defaults__", (None, 5, *recommend.fit_boosted_trees.__defaults__[2:]))
    monkeypatch.setattr(entry.plans.ratings, "_FITTED", {})
    rows = run(spark, "hybrid_predictions").collect()
    truth = {(r["user_id"], r["item_id"]): r["stars"] for r in recommend.latest_ratings(
        entry.plans.ratings.roles.test_reviews(spark, FOLDER, "l_partkey")).collect()}
    errors = [abs(r["prediction"] - truth[r["user_id"], r["item_id"]]) for r in rows]
    got = run(spark, "hybrid_rmse").first()
    assert got["n"] == len(rows) == len(truth)
    assert got["rmse"] == pytest.approx(math.sqrt(sum(e * e for e in errors) / len(errors)))
    assert {r["bin"]: r["n"] for r in run(spark, "hybrid_error_bins").collect()} == {
        b: sum(b <= e < b + 1 for e in errors) for b in range(5)}
    for name in ("gbt_predictions", "gbt_two_column_predictions", "hybrid_two_column_predictions"):
        scores = [r["prediction"] for r in run(spark, name).collect()]
        assert len(set(scores)) > 1 and all(math.isfinite(s) for s in scores), name
