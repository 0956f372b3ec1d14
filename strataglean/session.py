"""Session set-up, lineage cuts and shared scratch folders."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "strataglean") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(max(8, cores)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="strataglean-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, named by ``spark.checkpoint.dir``.

    Where that is unset, a local session takes a folder of its own below the warehouse. On a cluster
    the warehouse may be a folder of the driver's machine, so there it is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        root = f"{warehouse}/strataglean-{context.applicationId}"
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    Later steps neither recompute nor lose it with an executor, the planner knows
    its size and chooses broadcast or shuffle joins from facts, and plans of long
    loops do not grow.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
