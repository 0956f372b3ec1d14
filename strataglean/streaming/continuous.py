"""Sketches as continuous queries.

Every micro-batch writes its own partial state (registers or slots) or all state so far
(bits, whose number is bounded) and its report into folders named after the epoch. A
replayed epoch overwrites the same folders, and partial states and reports merge by min,
max or sum when they are read, so results do not change when a query is restarted, an
executor is lost, or a batch comes in several epochs. Rows carry their sequence number, as
offsets of a log do; epochs arrive in that order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataglean.operators import sketches

STREAM = "seq bigint, batch_id bigint, id string"


def _run(
    source: DataFrame, name: str, path: str, each: Callable[[DataFrame, int, str], None]
) -> None:
    """Process all available input, then stop; ``path`` holds progress and state."""
    query = (
        source.writeStream.queryName(name)
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .foreachBatch(lambda df, epoch: each(df, epoch, path))
        .start()
    )
    query.awaitTermination()


def open_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Files that appear in ``folder`` as a stream of (seq, batch_id, id)."""
    return spark.readStream.schema(STREAM).parquet(folder)


def _put(df: DataFrame, path: str, what: str, epoch: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{what}/epoch={epoch}")


def _before(spark: SparkSession, path: str, what: str, schema: str, epoch: int) -> DataFrame:
    """All state up to the epoch before this one; a replay does not see its own output."""
    if epoch == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{what}/epoch={epoch - 1}")


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """The Bloom filter's report, one row per batch however many epochs it came in."""
    counts = spark.read.parquet(f"{path}/report").groupBy("batch_id").agg(
        F.sum("n_new").alias("n_new"), F.sum("fp").alias("fp"))
    return sketches.fp_rates(counts)


def bloom_epoch(hashes: list[sketches.BloomHash]) -> Callable[[DataFrame, int, str], None]:
    bits = max(m for *_, m in hashes)

    def each(df: DataFrame, epoch: int, path: str) -> None:
        spark = df.sparkSession
        df.persist()
        before = _before(spark, path, "bits", "bit bigint, first bigint", epoch)
        seen = _before(spark, path, "seen", "id string, since bigint", epoch)
        own = sketches.bloom_first_bits(df, hashes)
        # Only bits that no earlier epoch has set are news.
        _put(own.join(before.select("bit"), "bit", "left_anti"), path, "fresh", epoch)
        fresh = spark.read.parquet(f"{path}/fresh/epoch={epoch}")
        _put(before.unionByName(fresh), path, "bits", epoch)
        new = sketches.bloom_new_ids(df, fresh, bits).select("id", F.col("batch_id").alias("since"))
        _put(seen.unionByName(new), path, "seen", epoch)
        _put(sketches.bloom_counts(df, fresh, bits, seen), path, "report", epoch)
        df.unpersist()

    return each


def run_bloom(source: DataFrame, path: str, hashes: list[sketches.BloomHash]) -> None:
    """Bloom filter over a stream of batches."""
    _run(source, "bloom", path, bloom_epoch(hashes))


def run_fm(source: DataFrame, path: str, params: list[tuple[int, int]]) -> None:
    """Registers and distinct ids per batch; partial states of a batch may come in several epochs."""
    def each(df: DataFrame, epoch: int, path: str) -> None:
        df.persist()
        _put(sketches.fm_registers(df, params, ["batch_id"]), path, "registers", epoch)
        _put(df.select("batch_id", "id").distinct(), path, "ids", epoch)
        df.unpersist()

    _run(source, "fm", path, each)


def read_fm(spark: SparkSession, path: str, n_params: int, groups: int = 4) -> DataFrame:
    """``batch_id, exact, estimate`` from the merged state."""
    names = [f"r{i}" for i in range(n_params)]
    registers = spark.read.parquet(f"{path}/registers").groupBy("batch_id").agg(
        *[F.max(n).alias(n) for n in names])
    exact = spark.read.parquet(f"{path}/ids").groupBy("batch_id").agg(F.countDistinct("id").alias("exact"))
    return exact.join(registers, "batch_id").select(
        "batch_id", "exact", sketches.fm_combine([F.col(n) for n in names], groups).alias("estimate"))


def run_reservoir(source: DataFrame, path: str, size: int, salt: str) -> None:
    """Accepted elements and batch ends; the reservoir is the latest element of each slot."""
    def each(df: DataFrame, epoch: int, path: str) -> None:
        df.persist()
        _put(sketches.reservoir_accepted(df, size, salt), path, "accepted", epoch)
        _put(df.groupBy("batch_id").agg(F.max("seq").alias("seqnum")), path, "batches", epoch)
        df.unpersist()

    _run(source, "reservoir", path, each)


def read_reservoir(spark: SparkSession, path: str, slots: list[int]) -> DataFrame:
    batches = spark.read.parquet(f"{path}/batches").groupBy("batch_id").agg(F.max("seqnum").alias("seqnum"))
    return sketches.reservoir_snapshots(batches, spark.read.parquet(f"{path}/accepted"), slots)


def run_fm_by_window(
    events: DataFrame, path: str, params: list[tuple[int, int]], width: str = "1 hour",
    delay: str = "2 hours",
) -> None:
    """Event-time form: each epoch writes the windows it changed; rows later than ``delay`` are left out."""
    windows = sketches.fm_by_window(events.withWatermark("ts", delay), params, width)
    query = (
        windows.writeStream.outputMode("update").option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .foreachBatch(lambda df, epoch: _put(df, path, "windows", epoch))
        .start()
    )
    query.awaitTermination()


def read_fm_by_window(spark: SparkSession, path: str) -> DataFrame:
    """The latest state of every window."""
    return (
        spark.read.parquet(f"{path}/windows").groupBy("window_start")
        .agg(F.max_by(F.struct("n", "estimate"), "epoch").alias("last"))
        .select("window_start", "last.n", "last.estimate")
    )
