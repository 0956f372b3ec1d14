"""Role views: the given tables read as reviews, businesses, baskets, graphs and streams.

Table names appear only here and in ``plans``; operators take any DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataglean.functions.text import shingles, word_list
from strataglean.skew import spread_scan

# Ratings before this day train the recommenders, later ones are predicted.
SPLIT_DAY = "2001-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str, item: str = "l_suppkey") -> DataFrame:
    """``user_id, item_id, stars (1..5), day``."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", item, "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col(item).alias("item_id"),
        (F.lit(1) + F.col("l_quantity").cast("int") % 5).cast("int").alias("stars"),
        F.col("o_orderdate").alias("day"),
    )


def train_reviews(spark: SparkSession, sf_dir: str, item: str = "l_suppkey") -> DataFrame:
    return reviews(spark, sf_dir, item).filter(F.col("day") < F.lit(SPLIT_DAY).cast("timestamp_ntz"))


def test_reviews(spark: SparkSession, sf_dir: str, item: str = "l_suppkey") -> DataFrame:
    return reviews(spark, sf_dir, item).filter(F.col("day") >= F.lit(SPLIT_DAY).cast("timestamp_ntz"))


def businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item_id, city``."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("item_id"), F.col("n_name").alias("city")
    )


def tips(spark: SparkSession, sf_dir: str, item: str = "l_partkey") -> DataFrame:
    """``user_id, item_id, text``: a document is a tip on the lowest item of its order."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    first = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min(item).alias("item_id"))
    )
    return (
        documents.join(orders, documents.doc_id == orders.o_orderkey)
        .join(first, F.col("doc_id") == F.col("l_orderkey"))
        .select(F.col("o_custkey").alias("user_id"), "item_id", "text")
    )


def business_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``business_id, attributes (JSON string), categories`` in the shape of a business file."""
    size = F.col("p_size")

    def flag(step: int) -> str:
        return F.when(size % step == 0, F.lit("True")).otherwise(F.lit("False"))

    ambience = F.concat(
        F.lit("{'romantic': "), flag(2), F.lit(", 'classy': "), flag(3),
        F.lit(", 'trendy': "), flag(5), F.lit("}"),
    )
    attributes = F.concat(
        F.lit('{"RestaurantsPriceRange2": "'), (size % 4 + 1).cast("string"),
        F.lit('", "OutdoorSeating": "'), flag(7),
        F.lit('", "Alcohol": "'), F.when(size % 3 == 0, F.lit("none")).otherwise(F.col("p_type")),
        F.lit('", "WiFi": "'), F.when(size % 4 == 0, F.lit("yes")).otherwise(F.lit("no")),
        F.lit('", "Ambience": "'), ambience, F.lit('"}'),
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("business_id"),
        F.when(size % 10 != 0, attributes).alias("attributes"),
        F.concat_ws(
            ", ", F.col("p_brand"),
            F.when(size % 2 == 0, F.lit("Restaurants")), F.when(size % 5 == 0, F.lit("Food")),
        ).alias("categories"),
    )


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ``basket, item``: brands bought together in an order."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .select(F.col("l_orderkey").alias("basket"), F.col("p_brand").alias("item"))
        .distinct()
    )


def supplier_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ``item_id, user_id``: parts, and the suppliers that share them."""
    return (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("user_id"))
        .distinct()
    )


def document_shingles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ``item, member``: documents and their three-word shingles."""
    texts = spread_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = texts.select(F.col("doc_id").alias("item"), word_list(F.col("text")).alias("words"))
    return words.select("item", F.explode(shingles(F.col("words"))).alias("member"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, label, features``."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), "label", F.col("embedding").cast("array<double>").alias("features")
    )


def id_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, o_custkey``: customers in the order their orders arrive."""
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
