from pyspark.sql import functions as F

from strataglean.functions import hashing, text, vectors
from strataglean.operators import recommend, relational
from strataglean.sources import files


def test_string_hash(spark):
    df = spark.createDataFrame([("ab",), ("a longer id é 0123456789",), ("",)], "id string")
    got = df.select("id", hashing.string_mod(F.col("id"), 2147483647).alias("x"),
                    *[hashing.mod_hash(F.col("id"), a, b, m, p).alias(f"h{i}")
                      for i, (a, b, p, m) in enumerate(hashing.BLOOM_HASHES)]).collect()
    assert [got[0][f"h{i}"] for i in range(3)] == [46071, 245, 4838]
    for row in got:
        number = int.from_bytes(row["id"].encode(), "big")
        assert row["x"] == number % 2147483647
        assert row["h1"] == ((137 * number + 107) % 701) % 69997


def test_trailing_zeros(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 2, 12, 64)], "v bigint")
    assert [r[0] for r in df.select(hashing.trailing_zeros(F.col("v"))).collect()] == [0, 0, 1, 2, 6]


def test_sentiment_and_shingles(spark):
    df = spark.createDataFrame([("The freshest food, not bad",), ("a b",)], "t string")
    row = recommend.sentiment_counts(df, "t").first()
    assert (row["positive"], row["negative"]) == (2, 1)
    words = df.select(text.word_list(F.col("t")).alias("w"))
    got = [r[0] for r in words.select(text.shingles(F.col("w"))).collect()]
    assert got == [["the freshest food,", "freshest food, not", "food, not bad"], []]


def test_business_features(spark):
    attributes = ('{"RestaurantsPriceRange2": "2", "OutdoorSeating": "True", "WiFi": "no", '
                  '"Ambience": "{\'romantic\': True, \'classy\': False}"}')
    df = spark.createDataFrame(
        [("a", attributes, "Food, Bars"), ("b", None, None)], "business_id string, attributes string, categories string")
    a, b = recommend.business_features(df).orderBy("business_id").collect()
    assert (a["price_range"], a["outdoor_seating"], a["alcohol"], a["wifi"]) == (2, 1, 0, 0)
    assert (a["is_restaurant"], a["is_food"], a["romantic"], a["classy"]) == (0, 1, 1, 0)
    assert b["price_range"] == -1 and sum(b[c] for c in b.asDict() if c not in ("business_id", "price_range")) == 0


def test_mahalanobis_and_vectors(spark):
    df = spark.createDataFrame([([3.0, 2.0], (2, [2.0, 4.0], [4.0, 16.0]))],
                               "x array<double>, s struct<n:bigint,sum:array<double>,sumsq:array<double>>")
    assert df.select(vectors.mahalanobis(F.col("x"), F.col("s"))).first()[0] == 2.0
    lines = spark.createDataFrame([("7, 1,0.5,-2",), ("8,0,oops,1",)], "value string")
    assert [tuple(r) for r in files.parse_vectors(lines).collect()] == [(7, 1, [0.5, -2.0]), (8, 0, [None, 1.0])]


def test_transactions(spark, rows):
    raw = spark.createDataFrame([("11/20/2000", "0123 ", "00456")], "date string, customer string, product string")
    assert rows(files.transaction_baskets(raw)) == [("11/20/00-0123", "456")]


def test_error_bins_and_rmse(spark, rows):
    df = spark.createDataFrame([(0.0, e) for e in (0.0, 0.99, 1.0, 4.99, 5.0)], "t double, g double")
    assert rows(relational.error_histogram(df, "t", "g")) == [(0, 2), (1, 1), (2, 0), (3, 0), (4, 1)]
    assert round(relational.rmse(df, "t", "g").first()["rmse"], 6) == round(((0.99**2 + 1 + 4.99**2 + 25) / 5) ** 0.5, 6)


def test_zscore_and_metrics(spark):
    import json
    reviews = spark.createDataFrame([(1, 7, 5, "2018-01-01"), (1, 8, 4, "2018-02-01"), (2, 7, 3, "2019-01-01")],
                                    "user_id int, item_id int, stars int, day string")
    reviews = reviews.withColumn("day", F.col("day").cast("timestamp_ntz"))
    line = relational.metrics_json(relational.overview_metrics(reviews, 2018),
                                   {"top10_user": relational.top_k(reviews, "user_id")}).first()[0]
    got = json.loads(line)
    assert (got["n_review"], got["n_review_year"], got["n_user"], got["n_business"]) == (3, 2, 2, 2)
    assert got["top10_user"] == [["1", "2"], ["2", "1"]]
