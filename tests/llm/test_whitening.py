import math

import numpy as np
import pytest

from strataglean.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, at string, c string, w string, own string, part string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) + ("clash",) * 6 for i, v in rows], SCHEMA)


def brute(rows, components=16):
    """The same by numpy over Python integers."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for i, x in kept:
        whole = [n * a - s for a, s in zip(x, sums)]
        out.append((i, sum(d * d for d in whole), (np.array(whole) / n) @ vectors / np.sqrt(values)))
    return n, out, values / np.trace(v)


def random_rows(n, width, seed=0):
    rng = np.random.default_rng(seed)
    spread = rng.normal(size=(width, width)) + np.diag(np.arange(width))
    return [(i, (rng.normal(size=width) @ spread).tolist()) for i in range(n)]


def test_equal_to_numpy_with_repeats_and_invalid_vectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 16)
    monkeypatch.setattr(whitening, "SPLIT", 3)
    rows = random_rows(150, 20)
    hot = rows[3][1]
    rows += [(1000 + i, hot) for i in range(60)] + [(7, hot), (7, hot), (None, rows[5][1])]
    rows += [(2000, None), (2001, [None] + hot[1:]), (2002, [float("nan")] + hot[1:]), (2003, [float("inf")] + hot[1:])]
    n, expected, explained = brute(rows)
    found = {}
    for r in whitening.whiten(table(spark, rows).repartition(5)).collect():
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        found.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    signs = None
    count = {}
    for vec_id, deviation, w in expected:
        count[vec_id, deviation] = count.get((vec_id, deviation), 0) + 1
        own = found[vec_id, deviation]
        first = np.array([own[c + 1][0] for c in range(16)])
        signs = np.sign(first * w) if signs is None else signs
        assert np.allclose(first, signs * w, atol=1e-9)
    assert {k: len(v[1]) for k, v in found.items()} == count
    assert all(sorted(v) == list(range(1, 17)) for v in found.values())


def test_blocks_of_columns(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 32)
    monkeypatch.setattr(whitening, "COLUMNS", 8)
    rows = random_rows(80, 20, 1)
    _, expected, _ = brute(rows, 3)
    found = {}
    for r in whitening.whiten(table(spark, rows), components=3).collect():
        found.setdefault(r.vec_id, {})[r.component] = r.whitened
    signs = np.sign([found[0][c] for c in (1, 2, 3)] * expected[0][2])
    for vec_id, _, w in expected:
        assert np.allclose([found[vec_id][c] for c in (1, 2, 3)], signs * w, atol=1e-9)


def test_empty_single_and_dependent(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).collect() == []
    assert whitening.whiten(table(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])).collect() == []
    line = whitening.whiten(table(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])).collect()
    assert {r.component for r in line} == {1} and len(line) == 5
    assert all(abs(r.explained - 1) < 1e-12 for r in line)
    assert whitening.whiten(table(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])).schema.simpleString() == \
        "struct<vec_id:bigint,component:int,n:bigint,deviation:bigint,whitened:double,explained:double,identity_error:double>"
    with pytest.raises(ValueError):
        whitening.whiten(table(spark, [(1, [0.5]), (2, [0.5, 1.0])]))
