"""JSON-lines, CSV, text and vector files in; CSV, JSON and text files out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataglean.functions.hashing import md5_int
from strataglean.skew import dense_number


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON object per line; only the fields of ``schema`` are parsed."""
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header line, typed by position of ``schema``."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)


def read_text(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Text lines in ``value``, spread over at least ``partitions`` partitions."""
    lines = spark.read.text(path)
    return lines if partitions is None else lines.repartition(partitions)


def parse_vectors(lines: DataFrame, column: str = "value") -> DataFrame:
    """``id,label,f1,..,fd`` lines -> id, label, features; a bad or absent number becomes NULL."""
    fields = F.transform(F.split(column, ","), lambda f: F.trim(f))
    numbers = F.transform(
        F.slice("f", F.lit(3), F.greatest(F.size("f") - 2, F.lit(0))), lambda f: f.try_cast("double"))
    return lines.select(fields.alias("f")).select(
        F.get("f", F.lit(0)).try_cast("bigint").alias("id"),
        F.get("f", F.lit(1)).try_cast("int").alias("label"),
        numbers.alias("features"),
    )


def transaction_baskets(raw: DataFrame) -> DataFrame:
    """Distinct ``basket, item`` from text columns date (M/d/yyyy), customer and product.

    A basket is a customer's day with a two-digit year; a product id loses its
    leading zeros. Rows without a valid date, customer or product are left out.
    """
    day = F.date_format(F.try_to_date("date", "M/d/yyyy"), "M/d/yy")
    found = raw.select(
        F.concat(day, F.lit("-"), F.trim("customer")).alias("basket"),
        F.trim("product").try_cast("bigint").cast("string").alias("item"),
    )
    return found.dropna().distinct()


def stream_elements(df: DataFrame, order: list[str], element: str, batch_size: int) -> DataFrame:
    """``seq, batch_id, id``: a table read as a stream of batches of ``batch_size`` ids."""
    numbered = dense_number(
        df.select(*order, F.col(element).cast("string").alias("id")), order, "seq"
    )
    return numbered.select(
        F.col("seq").cast("bigint").alias("seq"),
        F.floor((F.col("seq") - 1) / batch_size).cast("bigint").alias("batch_id"),
        "id",
    )


def split_sample(df: DataFrame, key: str, percent: int, salt: str = "sample") -> DataFrame:
    """Add ``sampled``: a repeatable choice of about ``percent`` of the keys; the rest is false."""
    return df.withColumn("sampled", md5_int(F.col(key), F.lit(salt)) % 100 < percent)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string")).write.mode("overwrite").text(path)
