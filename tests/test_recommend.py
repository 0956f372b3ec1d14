import random
from collections import defaultdict
from math import sqrt

import pytest
from pyspark.sql import functions as F

from strataglean.operators import recommend


def _ratings(spark, data):
    df = spark.createDataFrame(data, "user_id int, item_id int, stars int, day string")
    return df.withColumn("day", F.col("day").cast("timestamp_ntz"))


def test_pearson_and_fallback(spark):
    data = [(u, 1, s, "2000-01-01") for u, s in zip((1, 2, 3), (5, 3, 1))]
    data += [(u, 2, s, "2000-01-01") for u, s in zip((1, 2, 3), (4, 3, 2))]
    data += [(u, 3, 4, "2000-01-01") for u in (1, 2, 3)] + [(9, 4, 4, "2000-01-01"), (8, 5, 2, "2000-01-01"), (7, 5, 3, "2000-01-01")]
    ratings = _ratings(spark, data)
    latest = recommend.latest_ratings(ratings)
    pairs = spark.createDataFrame([(1, 2), (1, 3), (4, 5)], "item_1 int, item_2 int")
    got = {(r["item_1"], r["item_2"]): round(r["weight"], 6) for r in recommend.item_weights(ratings, latest, pairs, 3).collect()}
    assert got == {(1, 2): 1.0, (1, 3): 0.0, (4, 5): 0.7}


def test_latest_rating_wins(spark, rows):
    data = [(1, 1, 2, "2000-01-01"), (1, 1, 5, "2001-01-01"), (1, 1, 4, "2001-01-01")]
    assert rows(recommend.latest_ratings(_ratings(spark, data))) == [(1, 1, 5)]


def _brute(data, targets, k, top_n, exclude_self):
    latest, users, items = {}, defaultdict(list), defaultdict(list)
    for u, i, s, day in data:
        latest[u, i] = max(latest.get((u, i), ("", 0)), (day, s))
        users[u].append(s)
        items[i].append(s)
    by_item = defaultdict(dict)
    for (u, i), (_, s) in latest.items():
        by_item[i][u] = s
    mean = lambda x: sum(x) / len(x)

    def weight(a, b):
        common = by_item[a].keys() & by_item[b].keys()
        if len(common) < k:
            return (5 - abs(mean(items[a]) - mean(items[b]))) / 5
        x, y = [by_item[a][u] for u in common], [by_item[b][u] for u in common]
        dx, dy = sqrt(sum((v - mean(x)) ** 2 for v in x)), sqrt(sum((v - mean(y)) ** 2 for v in y))
        return sum((p - mean(x)) * (q - mean(y)) for p, q in zip(x, y)) / (dx * dy) if dx * dy else 0.0

    out = {}
    for u, b in targets:
        if u not in users or b not in items:
            out[u, b] = mean(users[u]) if u in users else 3.0
            continue
        near = sorted(((-round(weight(b, i), 9), i) for (v, i) in latest if v == u and not (exclude_self and i == b)))[:top_n]
        den = sum(abs(w) for w, _ in near)
        out[u, b] = sum(-w * by_item[i][u] for w, i in near) / den if den else 3.0
    return out


@pytest.mark.parametrize("heavy,top_n,exclude_self", [(1000, 600, False), (4, 600, True), (3, 3, False)])
def test_predictions_match_brute_force(spark, monkeypatch, heavy, top_n, exclude_self):
    """A small ``heavy`` sends users through the lookup path."""
    rng = random.Random(11)
    data = [(rng.randrange(14), rng.randrange(9), rng.randint(1, 5), f"2000-01-{rng.randint(10, 28)}") for _ in range(110)]
    data += [(0, i, 1 + i % 5, "2000-02-01") for i in range(9)]
    targets = sorted({(rng.randrange(16), rng.randrange(11)) for _ in range(40)})
    monkeypatch.setattr(recommend.co_rating_moments, "__defaults__", (heavy,))
    got = recommend.cf_predict(_ratings(spark, data), spark.createDataFrame(targets, "user_id int, item_id int"),
                               3, top_n, exclude_self=exclude_self).collect()
    want = _brute(data, targets, 3, top_n, exclude_self)
    assert {(r[0], r[1]): round(r[2], 6) for r in got} == {t: round(p, 6) for t, p in want.items()}


def test_blend_matches_by_key(spark, rows):
    a = spark.createDataFrame([(1, 1, 2.0), (2, 1, 4.0)], "user_id int, item_id int, prediction double")
    b = spark.createDataFrame([(2, 1, 1.0), (1, 1, 3.0)], "user_id int, item_id int, prediction double")
    assert rows(recommend.hybrid_blend(a, b, 0.5, 0.5)) == [(1, 1, 2.5), (2, 1, 2.5)]


def test_stars_keep_their_type(spark, rows):
    data = [(1, 1, 4.0, "2000-01-01"), (1, 1, 3.5, "2001-01-01"), (1, 2, 4.5, "9999-12-31"), (1, 2, 2.0, None), (2, 1, 1.0, None)]
    df = spark.createDataFrame(data, "user_id int, item_id int, stars double, day string").withColumn(
        "day", F.col("day").cast("timestamp_ntz"))
    assert rows(recommend.latest_ratings(df)) == [(1, 1, 3.5), (1, 2, 4.5), (2, 1, 1.0)]
    exact = df.withColumn("stars", F.col("stars").cast("decimal(3,1)"))
    assert [float(r[2]) for r in rows(recommend.latest_ratings(exact))] == [3.5, 4.5, 1.0]


def test_pearson_of_half_stars(spark):
    first, second = [4.5, 3.0, 1.5, 2.0], [5.0, 2.5, 1.0, 3.5]
    data = [(u, i, s) for i, stars in ((1, first), (2, second)) for u, s in enumerate(stars)]
    latest = spark.createDataFrame(data, "user_id int, item_id int, stars double")
    pairs = spark.createDataFrame([(1, 2)], "item_1 int, item_2 int")
    mx, my = sum(first) / 4, sum(second) / 4
    want = sum((x - mx) * (y - my) for x, y in zip(first, second)) / sqrt(
        sum((x - mx) ** 2 for x in first) * sum((y - my) ** 2 for y in second))
    assert abs(recommend.item_pearson(latest, pairs).first()["pearson"] - want) < 1e-12


def test_trees_take_the_features_they_are_given(spark):
    data = [(u, i, float(u % 3), float(i % 2), float(u % 3 + i % 2)) for u in range(12) for i in range(6)]
    rows = spark.createDataFrame(data, "user_id int, item_id int, a double, b double, label double")
    model = recommend.fit_boosted_trees(rows, "label", ["a", "b"], rounds=10)
    scored = recommend.predict_boosted_trees(model, rows, ["a", "b"]).join(rows, ["user_id", "item_id"])
    assert all(abs(r["prediction"] - r["label"]) < 0.2 for r in scored.collect())
    shares = {r["feature"]: r["importance"] for r in recommend.feature_importance(model, spark, ["a", "b"]).collect()}
    assert set(shares) == {"a", "b"} and abs(sum(shares.values()) - 1) < 1e-9


def test_z_score_without_spread(spark):
    row = spark.createDataFrame([(3.0, 3.0, 0.0)], "v double, m double, s double").select(
        recommend.z_score(F.col("v"), F.col("m"), F.col("s")).alias("z")).first()
    assert row["z"] == 0.0


def test_feature_rows_are_joined_by_pair_while_narrow(spark):
    """The wide rows are not dealt by (user, item); items without ratings keep their attributes, records may repeat."""
    ratings = spark.createDataFrame([(1, 10, 4), (2, 10, 2), (1, 11, 5)], "user_id long, item_id long, stars int")
    records = spark.createDataFrame(
        [(10, '{"RestaurantsPriceRange2": "3"}', "Food"), (12, '{"RestaurantsPriceRange2": "2"}', ""), (12, None, "Food")],
        "business_id long, attributes string, categories string")
    tips = spark.createDataFrame([(1, 12, "great great"), (1, None, "great")], "user_id long, item_id long, text string")
    pairs = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (3, 13), (1, None)], "user_id long, item_id long")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = recommend.feature_matrix(pairs, ratings.select("user_id", "item_id"), ratings, records, tips)
        plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    top = next(line for line in plan if "SortMergeJoin" in line)
    assert "user_id" not in top
    got = sorted(((r["user_id"], r["item_id"], r["price_range"], r["is_food"], r["stars"], r["positive"] > 0) for r in rows), key=str)
    assert got == sorted([(1, 10, 3.0, 1.0, 3.0, False), (1, 11, -1.0, 0.0, 5.0, False), (1, 12, 2.0, 0.0, 0.0, True),
                          (1, 12, -1.0, 1.0, 0.0, True), (3, 13, -1.0, 0.0, 0.0, False), (1, None, -1.0, 0.0, 0.0, False)], key=str)
