"""Pair sums: equal to brute force, with bounded tasks and members that have very many pairs."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strataglean.operators.recommend import cf_predict
from strataglean.skew import pair_sums, tasks_for


def brute(rows):
    groups, found = defaultdict(list), defaultdict(lambda: [0, 0])
    for g, m, x in rows:
        if g is not None and m is not None:
            groups[g].append((m, x))
    for row in groups.values():
        for a, x in row:
            for b, y in row:
                if a < b:
                    found[a, b][0] += 1
                    found[a, b][1] += x * y
    return {k: tuple(v) for k, v in found.items()}


@pytest.mark.parametrize("task_rows", [1, 30, 10**6])
def test_equals_brute_force(spark, task_rows):
    random.seed(5)
    rows = list({(random.randrange(12), random.randrange(15)): None for _ in range(110)})
    rows = [(g, m, random.randrange(1, 6)) for g, m in rows] + [(None, 1, 2), (3, None, 4), (50, 7, 1)]
    df = spark.createDataFrame(rows, "g long, m long, x long")
    sums = {"n": F.lit(1), "xy": F.col("x") * F.col("y")}
    found = pair_sums(df, "g", "m", "x", sums, task_rows)
    assert {(r[0], r[1]): (r.n, r.xy) for r in found.collect()} == brute(rows)
    plain = pair_sums(df, "g", "m", None, {"n": F.lit(1)}, task_rows)
    assert Counter({(r[0], r[1]): r.n for r in plain.collect()}) == {k: v[0] for k, v in brute(rows).items()}


def test_tasks_grow_with_the_pairs(spark):
    rows = spark.range(40).selectExpr("id % 2 as g", "id as m")
    few, many = (pair_sums(rows, "g", "m", None, {"n": F.lit(1)}, size).rdd.getNumPartitions() for size in (10**6, 10))
    assert many >= 2 * 190 / 10 > few
    assert tasks_for(spark, 10**9) >= 500


def test_users_with_more_ratings_than_count_are_ranked(spark):
    rows = [(1, i, 1 + i % 5, i) for i in range(8)] + [(2, i, 1 + (i * i) % 5, i) for i in range(3)]
    ratings = spark.createDataFrame(rows, "user_id int, item_id int, stars int, day int")
    targets = spark.createDataFrame([(1, 2), (2, 5)], "user_id int, item_id int")
    means = {i: sum(s for _, j, s, _ in rows if j == i) / sum(j == i for _, j, _, _ in rows) for i in range(8)}

    def expected(user, item, top):
        weights = sorted(((-(5 - abs(means[item] - means[i])) / 5, i, s) for u, i, s, _ in rows if u == user))[:top]
        return sum(-w * s for w, _, s in weights) / sum(-w for w, _, _ in weights)

    for top in (1, 3, 5, 600):
        found = {(r.user_id, r.item_id): r.prediction for r in cf_predict(ratings, targets, 99, top_n=top).collect()}
        assert found == pytest.approx({(1, 2): expected(1, 2, top), (2, 5): expected(2, 5, top)})
