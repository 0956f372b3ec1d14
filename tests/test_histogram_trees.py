"""Trees grown in the tasks' memory: those of Spark, in a number of jobs that does not depend on the rounds."""

import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor

from strataglean.operators import histogram_trees, recommend

NAMES = ["a", "b", "c", "same"]


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(4)
    data = []
    for i in range(900):
        a, b, c = pick.gauss(0, 1), float(pick.randrange(4)), pick.choice((0.0, 0.0, pick.random()))
        data.append((i, 0, a, b, c, 7.0, a * b + 2 * c + pick.gauss(0, 0.3)))
    return spark.createDataFrame(data, "user_id int, item_id int, a double, b double, c double, same double, label double").repartition(3)


def _scores(model, rows):
    return {r["user_id"]: r["prediction"] for r in recommend.predict_boosted_trees(model, rows, NAMES).collect()}


@pytest.mark.parametrize("share", [100_000, 300])  # one task, several that exchange their sums
def test_trees_equal_those_of_spark(spark, rows, monkeypatch, share):
    monkeypatch.setattr(histogram_trees, "SHARE_ROWS", share)
    model = recommend.fit_boosted_trees(rows, "label", NAMES, rounds=8, depth=4)
    assembled = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    own = GBTRegressor(labelCol="label", featuresCol="features", maxIter=8, maxDepth=4, stepSize=0.2, seed=1).fit(assembled)
    got, want = _scores(model, rows), _scores(own, rows)
    assert got == pytest.approx(want, abs=1e-9) and len(set(got.values())) > 50
    assert np.abs(model.featureImportances.toArray() - own.featureImportances.toArray()).max() < 0.05
    assert model.treeWeights == own.treeWeights and model.getNumTrees == 8
    assert model.featureImportances.toArray()[3] == 0


def test_the_jobs_do_not_grow_with_the_rounds(spark, rows):
    """Before, each round of boosting started a job per level."""
    context, jobs = spark.sparkContext, []
    for rounds in (3, 30):
        context.setJobGroup(f"trees {rounds}", "")
        recommend.fit_boosted_trees(rows, "label", NAMES, rounds=rounds)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"trees {rounds}")))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_repeated_rows_count_each(spark):
    data = [(0.0, 1.0)] * 3 + [(0.0, 5.0)] + [(1.0, 8.0)] * 2
    rows = spark.createDataFrame([(i, 0, x, y) for i, (x, y) in enumerate(data)], "user_id int, item_id int, a double, label double")
    model = recommend.fit_boosted_trees(rows, "label", ["a"], rounds=1)
    scores = {r["user_id"]: r["prediction"] for r in recommend.predict_boosted_trees(model, rows, ["a"]).collect()}
    assert scores == {0: 2.0, 1: 2.0, 2: 2.0, 3: 2.0, 4: 8.0, 5: 8.0}


def test_no_feature_varies_and_missing_labels(spark):
    rows = spark.createDataFrame([(i, 0, 1.0, float(i)) for i in range(4)], "user_id int, item_id int, a double, label double")
    model = recommend.fit_boosted_trees(rows, "label", ["a"], rounds=2)
    assert {r["prediction"] for r in recommend.predict_boosted_trees(model, rows, ["a"]).collect()} == {1.5}
    with pytest.raises(ValueError):
        recommend.fit_boosted_trees(rows.selectExpr("user_id", "item_id", "a", "cast(null as double) label"), "label", ["a"], rounds=2)


def test_too_many_rows_for_the_tasks_go_to_sparks_rounds(spark, rows, monkeypatch):
    want = _scores(recommend.fit_boosted_trees(rows, "label", NAMES, rounds=2), rows)
    monkeypatch.setattr(histogram_trees, "TASK_ROWS", 10)
    assert _scores(recommend.fit_boosted_trees(rows, "label", NAMES, rounds=2), rows) == pytest.approx(want, abs=1e-9)


def test_cuts_follow_the_sizes():
    values, counts = np.arange(6.0), np.array([50, 1, 1, 1, 40, 7])
    assert histogram_trees.cuts_between(values, counts, 4) == [0.5, 1.5, 4.5]
    assert histogram_trees.cuts_between(values[:3], counts[:3], 4) == [0.5, 1.5]
    assert histogram_trees.cuts_between(values[:1], counts[:1], 4) == []
