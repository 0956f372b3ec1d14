"""Item-based collaborative filtering, feature rows, boosted trees and blending."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window

from strataglean.functions.text import (
    AMBIENCE, NEGATIVE_WORDS, POSITIVE_WORDS, WIFI_ON, comma_member, lexicon_count, literal_flag,
)
from strataglean.operators import histogram_trees
from strataglean.session import cut_lineage, shared_root
from strataglean.skew import hot_groups, pair_sums, spread_join, tasks_for

# Users with more rated items than this do not emit their item pairs.
HEAVY_USER_ITEMS = 1000

# The names of the 19 features in their order.
FEATURES = [
    "average_stars", "stars", "interaction", "review_count", "price_range", "outdoor_seating",
    "alcohol", "wifi", "is_restaurant", "is_food", *AMBIENCE, "user_review_count",
    "positive", "negative",
]


def latest_ratings(ratings: DataFrame) -> DataFrame:
    """One rating per (user, item): the latest day, then the highest stars, of their own type.

    A row without a day counts as oldest, without stars as lowest. The maximum is
    taken in the tasks before the shuffle.
    """
    best = ratings.groupBy("user_id", "item_id").agg(F.max(F.struct("day", "stars")).alias("_best"))
    return best.select("user_id", "item_id", F.col("_best.stars").alias("stars"))


def averages(ratings: DataFrame, key: str) -> DataFrame:
    """``key, avg_stars, n`` over all rating rows."""
    return ratings.groupBy(key).agg(
        (F.sum("stars") / F.count(F.lit(1))).alias("avg_stars"), F.count(F.lit(1)).alias("n")
    )


def item_pairs_for(latest: DataFrame, targets: DataFrame) -> DataFrame:
    """Distinct ``item_1 <= item_2``: a target's item with each item its user has rated."""
    rated = latest.select("user_id", F.col("item_id").alias("other"))
    warm, tasks = _warm_targets(latest, targets)
    return (
        spread_join(warm, rated, ["user_id"], "other")
        .select(
            F.least("item_id", "other").alias("item_1"),
            F.greatest("item_id", "other").alias("item_2"),
        )
        .repartition(tasks, "item_1", "item_2").distinct()
    )


def _warm_targets(latest: DataFrame, targets: DataFrame) -> tuple[DataFrame, int]:
    """(``user_id, item_id, rated``: targets whose user and item have ratings, the tasks for their users' ratings)."""
    rated = latest.groupBy("user_id").agg(F.count(F.lit(1)).alias("rated"))
    known = latest.select("item_id").distinct()
    warm = cut_lineage(
        targets.select("user_id", "item_id").join(known, "item_id", "left_semi").join(rated, "user_id"))
    return warm, tasks_for(latest.sparkSession, warm.agg(F.sum("rated")).first()[0] or 0)


# Stars that are no whole numbers are counted in hundredths; Pearson does not mind the scale.
STAR_PARTS = 100


def _whole(latest: DataFrame) -> DataFrame:
    """``latest`` with stars as whole numbers, so that sums are exact in any order."""
    if isinstance(latest.schema["stars"].dataType, IntegralType):
        return latest.withColumn("stars", F.col("stars").cast("bigint"))
    parts = F.col("stars") * STAR_PARTS
    return latest.withColumn("stars", F.when(F.abs(parts - F.round(parts)) < 1e-6, F.round(parts).cast("bigint"))
                             .when(parts.isNotNull(), F.raise_error(F.lit("stars have more than two decimals")).cast("bigint")))


def _moments(x: Column, y: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
        F.sum(x * x).alias("sxx"), F.sum(y * y).alias("syy"), F.sum(x * y).alias("sxy"),
    ]


def co_rating_moments(
    latest: DataFrame, pairs: DataFrame, heavy_items: int = HEAVY_USER_ITEMS
) -> DataFrame:
    """Integer moments over the users who rated both items of each given pair.

    Only items of wanted pairs take part. Users with few of them emit their item pairs.
    The few heavy users would emit quadratically many; for them the wanted pairs are
    looked up instead.
    """
    key = ["item_1", "item_2"]
    asked = pairs.select(F.explode(F.array("item_1", "item_2")).alias("item_id")).distinct()
    latest = _whole(latest.join(asked, "item_id", "left_semi"))
    heavy = hot_groups(latest, "user_id", heavy_items).select("user_id")
    any_heavy = not heavy.isEmpty()
    light = latest.join(heavy, "user_id", "left_anti") if any_heavy else latest
    x, y = F.col("x"), F.col("y")
    moments = (
        pair_sums(light, "user_id", "item_id", "stars",
                  {"n": F.lit(1), "sx": x, "sy": y, "sxx": x * x, "syy": y * y, "sxy": x * y})
        .withColumnsRenamed({"member_1": "item_1", "member_2": "item_2"})
        .join(pairs.filter("item_1 < item_2"), key, "left_semi")
    )
    if any_heavy:
        rows = latest.join(heavy, "user_id", "left_semi")
        first = rows.select("user_id", F.col("item_id").alias("item_1"), F.col("stars").alias("x"))
        second = rows.select("user_id", F.col("item_id").alias("item_2"), F.col("stars").alias("y"))
        found = (
            pairs.filter("item_1 < item_2").join(first, "item_1").join(second, ["user_id", "item_2"])
            .groupBy(*key).agg(*_moments(F.col("x"), F.col("y")))
        )
        sums = ["n", "sx", "sy", "sxx", "syy", "sxy"]
        moments = moments.unionByName(found).groupBy(*key).agg(*[F.sum(c).alias(c) for c in sums])
    # An item paired with itself is co-rated by all its users.
    own = (
        latest.join(pairs.filter("item_1 = item_2").select(F.col("item_1").alias("item_id")),
                    "item_id", "left_semi")
        .groupBy(F.col("item_id").alias("item_1"))
        .agg(*_moments(F.col("stars"), F.col("stars")))
        .withColumn("item_2", F.col("item_1"))
    )
    return moments.unionByName(own)


def pearson_column() -> Column:
    """Pearson from integer moments; 0 where one side does not vary."""
    def big(name: str) -> Column:  # products of sums leave 64 bits long before 38 digits
        return F.col(name).cast("decimal(19,0)")

    cov = big("n") * big("sxy") - big("sx") * big("sy")
    vx = big("n") * big("sxx") - big("sx") * big("sx")
    vy = big("n") * big("syy") - big("sy") * big("sy")
    return F.when((vx == 0) | (vy == 0), F.lit(0.0)).otherwise(
        cov.cast("double") / (F.sqrt(vx.cast("double")) * F.sqrt(vy.cast("double")))
    )


def z_score(value: Column, mean: Column, deviation: Column) -> Column:
    """Distance from the mean in standard deviations; 0 where nothing varies."""
    return F.coalesce((value - mean) / F.nullif(deviation, F.lit(0.0)), F.lit(0.0))


def item_pearson(latest: DataFrame, pairs: DataFrame) -> DataFrame:
    """``item_1, item_2, n, pearson`` for the given pairs with at least one co-rating user."""
    return co_rating_moments(latest, pairs).select("item_1", "item_2", "n", pearson_column().alias("pearson"))


def item_weights(
    ratings: DataFrame, latest: DataFrame, pairs: DataFrame, k: int, scale: float = 5.0
) -> DataFrame:
    """``item_1, item_2, n, weight``: Pearson, or closeness of means below ``k`` co-raters."""
    pearson = item_pearson(latest, pairs)
    means = averages(ratings, "item_id").select("item_id", "avg_stars")
    left = means.select(F.col("item_id").alias("item_1"), F.col("avg_stars").alias("avg_1"))
    right = means.select(F.col("item_id").alias("item_2"), F.col("avg_stars").alias("avg_2"))
    n = F.coalesce("n", F.lit(0))
    tasks = tasks_for(pairs.sparkSession, pairs.count())
    return (
        pairs.repartition(tasks, "item_1", "item_2").join(pearson, ["item_1", "item_2"], "left")
        .join(left, "item_1").join(right, "item_2")
        .select(
            "item_1", "item_2", n.cast("bigint").alias("n"),
            F.when(n >= k, F.col("pearson"))
            .otherwise((F.lit(scale) - F.abs(F.col("avg_1") - F.col("avg_2"))) / scale)
            .alias("weight"),
        )
    )


def cold_start(ratings: DataFrame, targets: DataFrame, default: float = 3.0) -> DataFrame:
    """Predictions for targets whose user or item was never rated: user mean, else ``default``."""
    users = averages(ratings, "user_id").select("user_id", "avg_stars")
    items = ratings.select("item_id").distinct().withColumn("known", F.lit(True))
    return (
        targets.join(users, "user_id", "left").join(items, "item_id", "left")
        .filter(F.col("avg_stars").isNull() | F.col("known").isNull())
        .select("user_id", "item_id", F.coalesce("avg_stars", F.lit(default)).alias("prediction"))
    )


def cf_predict(
    ratings: DataFrame,
    targets: DataFrame,
    k: int,
    top_n: int = 600,
    default: float = 3.0,
    exclude_self: bool = False,
) -> DataFrame:
    """``user_id, item_id, prediction`` for distinct targets.

    Weighted mean of the user's ratings over the ``top_n`` items of highest
    weight (ties by item); ``default`` where the weights sum to 0.
    """
    latest = cut_lineage(latest_ratings(ratings))
    weights = item_weights(ratings, latest, cut_lineage(item_pairs_for(latest, targets)), k)
    rated = latest.withColumnRenamed("item_id", "other")
    warm, tasks = _warm_targets(latest, targets)
    # Only users with more ratings than count need them ranked.
    ranked = not warm.filter(F.col("rated") > top_n).isEmpty()
    if ranked:
        weights = cut_lineage(weights)

    def weighted(some: DataFrame) -> DataFrame:
        rows = spread_join(some.drop("rated"), rated, ["user_id"], "other")
        if exclude_self:
            rows = rows.filter(F.col("item_id") != F.col("other"))
        return (
            rows.withColumn("item_1", F.least("item_id", "other"))
            .withColumn("item_2", F.greatest("item_id", "other"))
            .repartition(tasks, "item_1", "item_2")
            .join(weights.select("item_1", "item_2", "weight"), ["item_1", "item_2"])
        )

    counted = weighted(warm.filter(F.col("rated") <= top_n)).select("user_id", "item_id", "weight", "stars")
    if ranked:
        by_weight = Window.partitionBy("user_id", "item_id").orderBy(F.desc("weight"), F.asc("other"))
        counted = counted.unionByName(
            weighted(warm.filter(F.col("rated") > top_n)).withColumn("rank", F.row_number().over(by_weight))
            .filter(F.col("rank") <= top_n).select("user_id", "item_id", "weight", "stars"))
    scored = (
        counted.groupBy("user_id", "item_id")
        .agg(F.sum(F.col("weight") * F.col("stars")).alias("num"),
             F.sum(F.abs("weight")).alias("den"))
        .select("user_id", "item_id",
                F.when(F.col("den") != 0, F.col("num") / F.col("den")).alias("prediction"))
    )
    cold = cold_start(ratings, targets, default)
    warm_targets = targets.join(cold, ["user_id", "item_id"], "left_anti")
    return (
        warm_targets.join(scored, ["user_id", "item_id"], "left")
        .select("user_id", "item_id", F.coalesce("prediction", F.lit(default)).alias("prediction"))
        .unionByName(cold)
    )


def rating_features(
    pairs: DataFrame, users: DataFrame, items: DataFrame, default: float = 0.0
) -> DataFrame:
    """``pairs`` with the user's and the item's mean; unseen ids get ``default``.

    Plain left joins: Catalyst broadcasts a lookup table only below its own size limit.
    """
    return (
        pairs.join(users, "user_id", "left").join(items, "item_id", "left")
        .withColumn("average_stars", F.coalesce("average_stars", F.lit(default)))
        .withColumn("stars", F.coalesce("stars", F.lit(default)))
    )


def user_table(ratings: DataFrame) -> DataFrame:
    return averages(ratings, "user_id").select(
        "user_id", F.col("avg_stars").alias("average_stars"), F.col("n").alias("user_review_count")
    )


def item_table(ratings: DataFrame) -> DataFrame:
    return averages(ratings, "item_id").select(
        "item_id", F.col("avg_stars").alias("stars"), F.col("n").alias("review_count")
    )


def business_features(records: DataFrame) -> DataFrame:
    """``business_id`` and 12 numbers from the attribute object and the category list."""
    schema = ("RestaurantsPriceRange2 string, OutdoorSeating string, Alcohol string, "
              "WiFi string, Ambience string")
    parsed = records.withColumn("a", F.from_json("attributes", schema))

    def flag(test: Column) -> Column:
        return F.coalesce(test.cast("int"), F.lit(0))

    return parsed.select(
        "business_id",
        F.coalesce(F.col("a.RestaurantsPriceRange2").try_cast("int"), F.lit(-1)).alias("price_range"),
        flag(F.col("a.OutdoorSeating") == "True").alias("outdoor_seating"),
        flag(F.col("a.Alcohol") != "none").alias("alcohol"),
        flag(F.col("a.WiFi").isin(WIFI_ON)).alias("wifi"),
        comma_member(F.col("categories"), "Restaurants").alias("is_restaurant"),
        comma_member(F.col("categories"), "Food").alias("is_food"),
        *[literal_flag(F.col("a.Ambience"), key).alias(key) for key in AMBIENCE],
    )


def sentiment_counts(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("positive", lexicon_count(F.col(text), POSITIVE_WORDS)).withColumn(
        "negative", lexicon_count(F.col(text), NEGATIVE_WORDS)
    )


def interaction_stats(train_pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """One row ``mean, sd`` of user mean times item mean over the training rows."""
    product = F.col("average_stars") * F.col("stars")
    rows = train_pairs.select("user_id", "item_id")
    return rating_features(rows, users, items).agg(
        F.avg(product).alias("mean"), F.stddev_pop(product).alias("sd")
    )


def feature_matrix(
    pairs: DataFrame, train_pairs: DataFrame, ratings: DataFrame, records: DataFrame, tips: DataFrame
) -> DataFrame:
    """The 19 features of each (user, item) row."""
    users, items = user_table(ratings), item_table(ratings)
    stats = interaction_stats(train_pairs, users, items)
    attributes = business_features(records).withColumnRenamed("business_id", "item_id")
    spoken = (
        sentiment_counts(tips, "text").groupBy("user_id", "item_id")
        .agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))
    )
    zero = ["review_count", "user_review_count", "positive", "negative", "outdoor_seating",
            "alcohol", "wifi", "is_restaurant", "is_food", *AMBIENCE]
    # The narrow rows are joined by (user, item) first, where they often lie by it already; wide rows are dealt no more.
    joined = (
        rating_features(pairs.join(spoken, ["user_id", "item_id"], "left"), users, items.join(attributes, "item_id", "full"))
        .crossJoin(F.broadcast(stats))  # one row
        .withColumn("interaction",
                    z_score(F.col("average_stars") * F.col("stars"), F.col("mean"), F.col("sd")))
        .fillna(0, zero).fillna(-1, ["price_range"])
    )
    return joined.select(*pairs.columns, *[F.col(c).cast("double").alias(c) for c in FEATURES])


def fit_boosted_trees(
    train: DataFrame, label: str, features: list[str] | None = None, rounds: int = 500, depth: int = 5,
    step: float = 0.2, seed: int = 1
) -> GBTRegressionModel:
    """Boosted regression trees over the feature columns, all 19 unless others are named.

    They are grown by :mod:`histogram_trees` from rows in the tasks' memory; what doesn't fit there, by Spark's own rounds.
    """
    shared_root(train.sparkSession)
    params = {"maxIter": rounds, "maxDepth": depth, "stepSize": step, "seed": seed, "labelCol": label}
    model = histogram_trees.fit(train, label, features or FEATURES, rounds, depth, step, params)
    if model is not None:
        return model
    assembled = VectorAssembler(inputCols=features or FEATURES, outputCol="features").transform(train)
    return GBTRegressor(
        labelCol=label, featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=step,
        seed=seed, checkpointInterval=10,
    ).fit(assembled.select("features", F.col(label).cast("double").alias(label)))


def predict_boosted_trees(
    model: GBTRegressionModel, rows: DataFrame, features: list[str] | None = None
) -> DataFrame:
    assembled = VectorAssembler(inputCols=features or FEATURES, outputCol="features").transform(rows)
    return model.transform(assembled).select("user_id", "item_id", "prediction")


def feature_importance(
    model: GBTRegressionModel, spark: SparkSession, features: list[str] | None = None
) -> DataFrame:
    """``feature, importance``; the model holds one number per feature."""
    weights = [(name, float(w)) for name, w in zip(features or FEATURES, model.featureImportances.toArray())]
    return spark.createDataFrame(weights, "feature string, importance double")


def hybrid_blend(first: DataFrame, second: DataFrame, w_first: float, w_second: float) -> DataFrame:
    """Weighted sum of two predictions, matched by (user, item)."""
    other = second.select("user_id", "item_id", F.col("prediction").alias("_p"))
    return first.join(other, ["user_id", "item_id"]).select(
        "user_id", "item_id",
        (F.col("prediction") * w_first + F.col("_p") * w_second).alias("prediction"),
    )
