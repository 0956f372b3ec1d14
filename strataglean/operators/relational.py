"""Exploratory aggregates, lookups and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataglean.functions.hashing import md5_int


def overview_metrics(reviews: DataFrame, year: int) -> DataFrame:
    """One row: rows, rows of a year, distinct users and items, mean stars."""
    return reviews.agg(
        F.count(F.lit(1)).alias("n_review"),
        F.count_if(F.year("day") == year).alias("n_review_year"),
        F.countDistinct("user_id").alias("n_user"),
        F.countDistinct("item_id").alias("n_business"),
        (F.sum("stars") / F.count(F.lit(1))).alias("avg_stars"),
    )


def count_containing(df: DataFrame, column: Column, text: str) -> DataFrame:
    """One row ``n``: rows whose text form contains ``text``."""
    return df.filter(column.cast("string").contains(text)).agg(F.count(F.lit(1)).alias("n"))


def count_by_key(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def top_k(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent keys, ties by key."""
    return count_by_key(df, key).orderBy(F.desc("n"), F.asc("key")).limit(k)


def group_mean_by_lookup(
    facts: DataFrame, lookup: DataFrame, on: str, group: str, value: str
) -> DataFrame:
    """Mean of ``value`` per looked-up ``group``, highest first.

    The facts are summed per key before the join, so a hot key reaches it as one row.
    """
    per_key = facts.groupBy(on).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    return (
        per_key.join(lookup, on)
        .groupBy(group)
        .agg((F.sum("_s") / F.sum("_n")).alias("mean"))
        .orderBy(F.desc("mean"), F.asc(group))
    )


def partition_profile(df: DataFrame, key: str | None = None, partitions: int | None = None) -> DataFrame:
    """``n_partition, partition, n_items``: how rows are spread, empty partitions included.

    By default that of ``df`` as it is; with ``partitions``, of its counted keys, placed by
    their hash modulo 100. Keys are counted first, so a hot key moves as one row.
    """
    if partitions is None:
        placed, partitions = df, df.rdd.getNumPartitions()
    else:
        placed = count_by_key(df, key).repartitionById(
            partitions, (md5_int(F.col("key")) % 100 % partitions).cast("int"))
    found = (
        placed.select(F.spark_partition_id().alias("partition"))
        .groupBy("partition").agg(F.count(F.lit(1)).alias("n"))
    )
    every = df.sparkSession.range(partitions).withColumnRenamed("id", "partition")
    return every.join(found, "partition", "left").select(
        F.lit(partitions).cast("bigint").alias("n_partition"), "partition",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_items"))


def having_min_size(pairs: DataFrame, group: str, member: str, more_than: int) -> DataFrame:
    """``group, n`` of groups with more than ``more_than`` distinct members."""
    return (
        pairs.groupBy(group)
        .agg(F.countDistinct(member).alias("n"))
        .filter(F.col("n") > more_than)
    )


def metrics_json(metrics: DataFrame, tops: dict[str, DataFrame]) -> DataFrame:
    """One JSON object per row from a one-row metrics table and short top-k lists."""
    out = metrics
    for name, top in tops.items():
        listed = top.agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "key"))),
                lambda t: F.array(t["key"].cast("string"), (-t["o"]).cast("string")),
            ).alias(name)
        )
        out = out.crossJoin(F.broadcast(listed))  # one row each
    return out.select(F.to_json(F.struct(*out.columns)).alias("json"))


def format_lines(groups: DataFrame, members: str) -> DataFrame:
    """Add ``line``: the members quoted and joined as ``'a', 'b'``."""
    quoted = F.transform(members, lambda m: F.concat(F.lit("'"), m.cast("string"), F.lit("'")))
    return groups.withColumn("line", F.array_join(quoted, ", "))


def rmse(scored: DataFrame, truth: str, guess: str) -> DataFrame:
    """One row ``n, rmse``."""
    error = F.col(truth) - F.col(guess)
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(error * error)).alias("rmse")
    )


def error_histogram(scored: DataFrame, truth: str, guess: str, bins: int = 5) -> DataFrame:
    """``bin, n``: absolute errors in [0,1), [1,2), ..; empty bins count 0, the rest has no bin."""
    size = F.abs(F.col(truth) - F.col(guess))
    counted = scored.agg(
        *[F.count_if((size >= b) & (size < b + 1)).alias(f"b{b}") for b in range(bins)]
    )
    return counted.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(b).cast("bigint").alias("bin"), F.col(f"b{b}").alias("n"))
                for b in range(bins)
            ])
        ).alias("row")
    ).select("row.bin", "row.n")
