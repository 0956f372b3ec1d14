"""Held-out accuracy, and odd inputs."""

import random

import pytest
from odd import empty_documents, odd_documents

from strataglean.llm import quality_classifier as qc

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, n, seed=1):
    pick = random.Random(seed)
    words = ["".join(pick.choice("etaoinshr") for _ in range(pick.randrange(2, 9))) for _ in range(400)]
    rows, truth = [], {}
    for i in range(n):
        text = [pick.choice(words) for _ in range(pick.randrange(20, 200))]
        bad = pick.random() < 0.2
        if bad:
            kind = pick.randrange(3)
            text = [[w.upper() + "!!" for w in text], [w + "***" for w in text], [text[0]] * len(text)][kind]
        truth[i] = not bad
        rows.append((i, " ".join(text), "en", "junk" if bad and i % 2 else f"src{i % 5}", len(text)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), truth


def test_held_out_accuracy_and_exchange(spark):
    docs, truth = corpus(spark, 600)
    labels = spark.createDataFrame([(i, int(truth[i]), 0) for i in range(0, 600, 4)], LABELS)
    model = qc.train(docs, labels)
    rows = qc.score(docs, model, "found").collect()
    others = [r for r in rows if r.doc_id % 4]
    assert sum(r.found.kept == truth[r.doc_id] for r in others) / len(others) > 0.97
    # A single round learns from the labels alone; the exchange must not cost accuracy.
    alone = qc.score(docs, qc.train(docs, labels, rounds=1), "found").collect()
    right = [sum(r.found.kept == truth[r.doc_id] for r in x if r.doc_id % 4) for x in (alone, rows)]
    assert right[1] >= right[0] - 3
    kept = qc.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.found.kept}


def test_newton_equals_a_plain_fit(spark):
    import numpy as np
    docs, truth = corpus(spark, 200, 2)
    labels = spark.createDataFrame([(i, int(truth[i]), 0) for i in range(200)], LABELS)
    table = qc.feature_table(docs, labels)
    weights = qc._fit_views(table, None)
    rows = [r for r in table.collect() if not r.held]
    for view in range(2):
        x = np.array([r[f"x{view}"] for r in rows])
        y = np.array([r.y for r in rows])
        gradient = x.T @ (y - 1 / (1 + np.exp(-x @ weights[view]))) - qc.RIDGE * weights[view]
        assert np.abs(gradient).max() < 0.05


@pytest.mark.parametrize("marks", [[], [(4, 1, 0)], [(4, 1, 0), (5, 0, 0), (6, None, 0), (None, 1, 0), (4, 0, 1)]])
def test_odd_documents(spark, marks):
    docs = odd_documents(spark)
    labels = spark.createDataFrame(marks, LABELS)
    rows = qc.score(docs, qc.train(docs, labels), "verdict").collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.verdict.score <= 1 for r in rows)
    if len(marks) < 2:
        assert all(r.verdict.kept and r.verdict.score == 0.5 for r in rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], LABELS)
    assert qc.keep_good(empty_documents(spark), none).count() == 0
