"""Second-order trees against brute force over raw rows."""

import math
import random

import pytest

from strataglean.operators import boosting

NAMES = ["a", "b", "c"]
L2, STEP, BASE = 1.0, 0.3, 0.5


def made(n=300, seed=3):
    pick = random.Random(seed)
    out = []
    for _ in range(n):
        a, b = float(pick.randrange(12)), pick.choice([None, float("nan"), *map(float, range(5))])
        c = pick.uniform(-1, 1)
        gone = b is None or math.isnan(b)
        out.append((a, b, c, (3.0 if gone else b) + (a > 6) * 2 + round(c, 2)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "a double, b double, c double, label double").repartition(3)


def bins_of(row, edges):
    return [0 if x is None or math.isnan(x) else 1 + sum(e <= x for e in own) for x, own in zip(row, edges)]


def cuts_of(rows, min_child=1):
    """(gain, feature, cut, missing left, left rows) of all allowed cuts of (bins, gradient) rows."""
    score = lambda part: sum(g for _, g in part) ** 2 / (len(part) + L2)
    for f in range(len(NAMES)):
        for cut in sorted({b[f] for b, _ in rows} - {0}):
            for missing_left in (False, True):
                left = [r for r in rows if (missing_left if r[0][f] == 0 else r[0][f] <= cut)]
                right = [r for r in rows if not (missing_left if r[0][f] == 0 else r[0][f] <= cut)]
                if len(left) >= min_child and len(right) >= min_child:
                    yield score(left) + score(right) - score(rows), f, cut, missing_left, left, right


def grown(rows, depth, min_child):
    """A tree as nested tuples, or its weight."""
    found = list(cuts_of(rows, min_child)) if depth else []
    best = max(found, key=lambda c: (round(c[0], 7), -c[1], -c[2], not c[3]), default=None)
    if best is None or best[0] <= 1e-9:
        return -STEP * sum(g for _, g in rows) / (len(rows) + L2)
    return best[1], best[2], best[3], grown(best[4], depth - 1, min_child), grown(best[5], depth - 1, min_child)


def reached(tree, bins):
    while isinstance(tree, tuple):
        f, cut, missing_left, left, right = tree
        tree = left if (missing_left if bins[f] == 0 else bins[f] <= cut) else right
    return tree


def test_root_gains(spark):
    rows = made()
    edges = boosting.even_edges(frame(spark, rows), NAMES, 8)
    table = boosting.binned(frame(spark, rows), "label", NAMES, edges, BASE)
    gains = boosting.split_gains(boosting.histogram(table, 3, [], boosting.Tree(2), 0), L2).filter(boosting.allowed())
    got = {(r["feature"], r["cut"], r["missing_left"]): (r["gain"], r["hl"]) for r in gains.collect()}
    want = {(f, cut, m): (gain, len(left))
            for gain, f, cut, m, left, _ in cuts_of([(bins_of(r, edges), BASE - r[3]) for r in rows])}
    assert got.keys() == want.keys()
    for key in got:
        assert got[key] == pytest.approx(want[key], abs=1e-8)


def test_model_equals_brute_force(spark):
    rows, rounds, depth, min_child = made(), 12, 3, 4  # more rounds than are kept unwritten
    data = frame(spark, rows)
    edges = boosting.quantile_edges(data, NAMES, 8)
    model = boosting.fit_trees(data, "label", NAMES, rounds, depth, STEP, L2, 1e-9, min_child, edges=edges, base=BASE)
    known = [bins_of(r, edges) for r in rows]
    score = [BASE] * len(rows)
    for _ in range(rounds):
        tree = grown([(b, s - r[3]) for b, s, r in zip(known, score, rows)], depth, min_child)
        score = [s + reached(tree, b) for s, b in zip(score, known)]
    key = lambda r: tuple(map(str, r))
    want = dict(zip(map(key, rows), score))
    got = boosting.predict_trees(model, data).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["prediction"] == pytest.approx(want[key(r[:4])], abs=1e-6)
    shares = model.importance()
    assert sum(shares.values()) == pytest.approx(1) and min(shares.values()) > 0


def test_missing_values_go_where_they_gain(spark):
    rows = [(float(i % 4), None if i % 4 == 3 else float(i % 4), 0.0, 9.0 if i % 4 in (0, 3) else 1.0) for i in range(80)]
    model = boosting.fit_trees(frame(spark, rows), "label", ["b"], 1, 1, 1.0, bins=4)
    assert model.trees[0].missing_left[0]
    found = {r["b"]: r["prediction"] for r in boosting.predict_trees(model, frame(spark, rows)).collect()}
    assert found[None] == found[0.0] > 8 and found[1.0] == found[2.0] < 2


def test_edge_cases(spark):
    empty = frame(spark, [])
    model = boosting.fit_trees(empty, "label", NAMES, 3)
    assert model.trees == [] and boosting.predict_trees(model, empty).collect() == []
    gone = [(1.0, 2.0, None, None), (None, None, None, 5.0), (float("nan"), 1.0, None, 5.0)]
    model = boosting.fit_trees(frame(spark, gone), "label", NAMES, 2, 2, 1.0)
    assert all(t.feature[0] != 2 for t in model.trees) and model.importance()["c"] == 0
    extra = frame(spark, gone).withColumnsRenamed({"label": "residual"})
    out = boosting.predict_trees(model, extra)
    assert out.columns == ["a", "b", "c", "residual", "prediction"] and out.count() == 3
    with pytest.raises(ValueError):
        boosting.predict_trees(model, out)


def test_rows_of_equal_bins_are_added_up(spark, monkeypatch):
    """The same model from one row per combination of bins as from every row."""
    rows = made(400)
    data = frame(spark, rows)
    edges = boosting.quantile_edges(data, NAMES, 6)
    table = boosting.binned(data, "label", NAMES, edges, BASE)
    added = boosting._added_up(table, edges)
    kinds = {tuple(bins_of(r, edges)) for r in rows}
    assert added.count() == len(kinds) < len(rows) and added.agg({"n": "sum"}).first()[0] == len(rows)
    models = [boosting.fit_trees(data, "label", NAMES, 11, 2, STEP, L2, 1e-9, 4, edges=edges, base=BASE)]
    monkeypatch.setattr(boosting, "MOST_CELLS", 0)
    models.append(boosting.fit_trees(data, "label", NAMES, 11, 2, STEP, L2, 1e-9, 4, edges=edges, base=BASE))
    for one, other in zip(*(m.trees for m in models), strict=True):
        assert list(one.feature) == list(other.feature) and list(one.cut) == list(other.cut)
        assert list(one.weight) == pytest.approx(list(other.weight), abs=1e-9)
