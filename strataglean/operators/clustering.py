"""K-means, and clustering of a large table by cluster summaries in one pass per chunk.

A summary is a row (cluster, n, sum, sumsq). Points near a summary of the
discard set (DS) or the compressed set (CS) are folded into it; the rest is
retained (RS) until enough points are left to form new summaries. There are at
most k summaries in DS; those in CS may grow with the number of chunks, so summaries
travel to the points in blocks of a bounded size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataglean.functions.hashing import md5_int
from strataglean.functions.vectors import mean_of, scaled_distance, variance_of
from strataglean.operators.graph import connected_components
from strataglean.session import cut_lineage, scratch_path
from strataglean.skew import pairs_within
from strataglean.sources.files import split_sample

STATS = "cluster bigint, n bigint, sum array<double>, sumsq array<double>"
# Ids of compressed clusters: round * ROUND_IDS + label.
ROUND_IDS = 1_000_000
# Coordinates of summaries that travel with a task at a time.
PACKED_NUMBERS = 1_000_000


def kmeans_labels(points: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """``points`` with a ``cluster`` from k-means."""
    rows = points.withColumn("_v", array_to_vector("features"))
    model = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(rows)
    return model.transform(rows).drop("_v").withColumn("cluster", F.col("cluster").cast("bigint"))


def cluster_stats(labelled: DataFrame) -> DataFrame:
    """``cluster, n, sum, sumsq`` of labelled points; vectors are summed inside the tasks first."""
    summary = Summarizer.metrics("count", "sum", "normL2").summary(F.col("_v"))
    return (
        labelled.withColumn("_v", array_to_vector("features"))
        .groupBy("cluster").agg(summary.alias("s"))
        .select(
            F.col("cluster").cast("bigint").alias("cluster"),
            F.col("s.count").cast("bigint").alias("n"),
            vector_to_array("s.sum").alias("sum"),
            F.transform(vector_to_array("s.normL2"), lambda q: q * q).alias("sumsq"),
        )
    )


def add_stats(first: DataFrame, second: DataFrame) -> DataFrame:
    """Summaries of equal cluster added up."""
    return sum_stats(first.unionByName(second), "cluster")


def sum_stats(stats: DataFrame, key: str) -> DataFrame:
    """N, SUM and SUMSQ added per ``key``."""
    return (
        stats.select(F.col(key).alias("cluster"), "n", F.posexplode(F.arrays_zip("sum", "sumsq")).alias("d", "v"))
        .groupBy("cluster", "d").agg(
            F.sum("n").alias("n"), F.sum("v.sum").alias("s"), F.sum("v.sumsq").alias("q"))
        .groupBy("cluster").agg(
            F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("d", "s", "q"))).alias("a"))
        .select("cluster", "n", F.col("a.s").alias("sum"), F.col("a.q").alias("sumsq"))
    )


def _packed(stats: DataFrame, name: str) -> DataFrame:
    """Summaries as one row that travels with every task; callers bound their number."""
    entry = F.struct(
        "cluster", mean_of(F.struct("n", "sum")).alias("mean"),
        variance_of(F.struct("n", "sum", "sumsq")).alias("variance"),
    )
    return F.broadcast(stats.agg(F.collect_list(entry).alias(name)))


def _nearest(packed: str):
    return F.array_min(F.transform(packed, lambda s: F.struct(
        scaled_distance(F.col("features"), s["mean"], s["variance"]).alias("distance"),
        s["cluster"].alias("cluster"),
    )))


def _with_nearest(rows: DataFrame, stats: DataFrame, name: str) -> DataFrame:
    """``rows`` with the nearest summary as ``name``.

    Up to PACKED_NUMBERS numbers travel at once; more summaries come block by block, and
    between the blocks the rows are written, so that no more than one block is in memory.
    """
    size = stats.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("sum")).alias("dims")).first()
    blocks = max(1, -(-size["n"] * (size["dims"] or 1) // PACKED_NUMBERS))
    block = F.pmod(F.xxhash64("cluster"), F.lit(blocks))
    for b in range(blocks):
        part = stats if blocks == 1 else stats.filter(block == b)
        rows = rows.crossJoin(_packed(part, "_all")).withColumn("_near", _nearest("_all")).drop("_all")  # one row
        rows = rows.withColumn(name, F.least(name, "_near") if b else F.col("_near")).drop("_near")
        if blocks > 1:
            rows = cut_lineage(rows)
    return rows


def bfr_assign(
    points: DataFrame, ds: DataFrame, cs: DataFrame | None = None, factor: float = 2.0
) -> DataFrame:
    """``points`` with ``kind, cluster, distance``: the nearest DS summary within
    factor * sqrt(d), else the nearest CS summary within it, else RS."""
    limit = F.lit(factor) * F.sqrt(F.size("features").cast("double"))
    rows = _with_nearest(points, ds, "_d")
    if cs is None:
        rows = rows.withColumn("_c", F.lit(None).cast("struct<distance:double,cluster:bigint>"))
    else:
        rows = _with_nearest(rows, cs, "_c")
    in_ds, in_cs = F.col("_d.distance") < limit, F.col("_c.distance") < limit
    return (
        rows.withColumn("kind", F.when(in_ds, "ds").when(in_cs, "cs").otherwise("rs"))
        .withColumn("cluster", F.when(in_ds, F.col("_d.cluster")).when(in_cs, F.col("_c.cluster"))
                    .otherwise(F.lit(-1).cast("bigint")))
        .withColumn("distance", F.when(in_cs & ~in_ds, F.col("_c.distance")).otherwise(F.col("_d.distance")))
        .drop("_d", "_c")
    )


def merge_map(cs: DataFrame, factor: float = 2.0) -> DataFrame:
    """``cluster, target``: compressed clusters whose centroids lie within
    factor * sqrt(d) under their pooled variance, directly or through others."""
    rows = cs.select(F.lit(0).alias("all"), "cluster", F.struct("n", "sum", "sumsq").alias("s"))
    pooled = F.zip_with(
        variance_of(F.col("a.s")), variance_of(F.col("b.s")),
        lambda u, v: (F.col("a.s.n") * u + F.col("b.s.n") * v) / (F.col("a.s.n") + F.col("b.s.n")),
    )
    distance = scaled_distance(mean_of(F.col("a.s")), mean_of(F.col("b.s")), pooled)
    near = (
        pairs_within(rows, ["all"], "cluster", ("s",))
        .filter(distance < F.lit(factor) * F.sqrt(F.size("a.s.sum").cast("double")))
        .select(F.col("a.cluster").alias("src"), F.col("b.cluster").alias("dst"))
    )
    near = cut_lineage(near)
    if near.isEmpty():
        return cs.select("cluster", F.col("cluster").alias("target"))
    groups = connected_components(near).select(F.col("id").alias("cluster"), "component")
    return cs.select("cluster").join(groups, "cluster", "left").select(
        "cluster", F.coalesce("component", "cluster").alias("target")
    )


def bfr_merge(cs: DataFrame, factor: float = 2.0) -> DataFrame:
    """Compressed summaries after merging near ones; a merged one keeps its smallest id."""
    return sum_stats(cs.join(merge_map(cs, factor), "cluster"), "target")


def fold_into_ds(ds: DataFrame, cs: DataFrame, factor: float = 2.0) -> DataFrame:
    """``cluster, target``: compressed clusters whose centroid lies within the limit of a DS summary."""
    centroids = cs.select("cluster", mean_of(F.struct("n", "sum")).alias("features"))
    placed = bfr_assign(centroids.withColumnRenamed("cluster", "own"), ds, None, factor)
    return placed.filter("kind = 'ds'").select(F.col("own").alias("cluster"), F.col("cluster").alias("target"))


def _split_singletons(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points in clusters of at least two, and points alone in theirs."""
    alone = (
        labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select("cluster")
    )
    return (labelled.join(alone, "cluster", "left_anti"), labelled.join(alone, "cluster", "left_semi"))


class BfrState:
    """DS and CS summaries, retained points, and where each placed point went."""

    def __init__(self, k: int, seed: int, factor: float):
        self.k, self.seed, self.factor = k, seed, factor
        self.ds = self.cs = self.rs = None
        self.placed: list[DataFrame] = []
        self.merges: list[DataFrame] = []
        self.rounds: list[DataFrame] = []

    def start(self, sample: DataFrame) -> None:
        """5k clusters on the sample; lone points are retained, the others form k DS clusters."""
        labelled = cut_lineage(kmeans_labels(sample, self.k * 5, self.seed))
        together, alone = _split_singletons(labelled)
        discard = cut_lineage(kmeans_labels(together.drop("cluster"), self.k, self.seed))
        self.ds = cut_lineage(cluster_stats(discard))
        self.placed.append(discard.select("id", F.lit("ds").alias("kind"), "cluster"))
        self.rs = cut_lineage(alone.select("id", "features"))
        self.compress(1)

    def compress(self, round_no: int) -> None:
        """More than 5k retained points: those that cluster become CS, lone ones stay."""
        if self.rs.count() <= self.k * 5:
            return
        labelled = cut_lineage(kmeans_labels(self.rs, self.k * 5, self.seed))
        together, alone = _split_singletons(labelled)
        fresh = together.withColumn("cluster", F.col("cluster") + F.lit(round_no * ROUND_IDS))
        self.rs = cut_lineage(alone.select("id", "features"))
        if fresh.isEmpty():
            return
        self.placed.append(cut_lineage(fresh.select("id", F.lit("cs").alias("kind"), "cluster")))
        stats = cluster_stats(fresh)
        self.cs = cut_lineage(stats if self.cs is None else self.cs.unionByName(stats))

    def take(self, chunk: DataFrame, round_no: int) -> None:
        """Assign a chunk by the summaries as they stand, then bring them up to date."""
        assigned = cut_lineage(
            bfr_assign(chunk, self.ds, self.cs, self.factor).select("id", "features", "kind", "cluster")
        )
        self.placed.append(assigned.filter("kind <> 'rs'").select("id", "kind", "cluster"))
        self.ds = cut_lineage(add_stats(self.ds, cluster_stats(assigned.filter("kind = 'ds'"))))
        if self.cs is not None:
            self.cs = cut_lineage(add_stats(self.cs, cluster_stats(assigned.filter("kind = 'cs'"))))
        self.rs = cut_lineage(
            self.rs.unionByName(assigned.filter("kind = 'rs'").select("id", "features"))
        )
        self.compress(round_no)
        if self.cs is not None:
            mapping = cut_lineage(merge_map(self.cs, self.factor))
            self.merges.append(mapping)
            self.cs = cut_lineage(sum_stats(self.cs.join(mapping, "cluster"), "target"))

    def finish(self) -> DataFrame | None:
        """Compressed clusters near a DS cluster join it; returns their map."""
        if self.cs is None:
            return None
        mapping = cut_lineage(fold_into_ds(self.ds, self.cs, self.factor))
        joining = self.cs.join(mapping, "cluster")
        self.ds = cut_lineage(add_stats(self.ds, sum_stats(joining, "target")))
        self.cs = cut_lineage(self.cs.join(mapping, "cluster", "left_anti"))
        return mapping

    def report(self, round_no: int) -> None:
        """One row: points in DS, CS clusters, points in CS, points in RS."""
        def total(stats: DataFrame | None, what) -> DataFrame:
            rows = self.ds.filter(F.lit(False)) if stats is None else stats
            return rows.agg(what)

        row = (
            total(self.ds, F.coalesce(F.sum("n"), F.lit(0)).alias("n_discard"))
            .crossJoin(total(self.cs, F.struct(
                F.count(F.lit(1)).alias("c"), F.coalesce(F.sum("n"), F.lit(0)).alias("p")).alias("cs")))
            .crossJoin(self.rs.agg(F.count(F.lit(1)).alias("n_retained")))
        )
        self.rounds.append(cut_lineage(row.select(
            F.lit(round_no).alias("round"), "n_discard", F.col("cs.c").alias("n_cs"),
            F.col("cs.p").alias("n_cs_points"), "n_retained")))

    def labels(self, into_ds: DataFrame | None) -> DataFrame:
        """``id, cluster``: the DS cluster of each point, -1 for CS and RS."""
        rows = reduce(DataFrame.unionByName, self.placed)
        in_cs = rows.filter("kind = 'cs'").select("id", "cluster")
        for mapping in self.merges:
            in_cs = in_cs.join(mapping, "cluster", "left").select(
                "id", F.coalesce("target", "cluster").alias("cluster"))
        if into_ds is not None:
            in_cs = in_cs.join(into_ds, "cluster", "left").select(
                "id", F.coalesce("target", F.lit(-1)).cast("bigint").alias("cluster"))
        else:
            in_cs = in_cs.select("id", F.lit(-1).cast("bigint").alias("cluster"))
        return (
            rows.filter("kind = 'ds'").select("id", "cluster").unionByName(in_cs)
            .unionByName(self.rs.select("id", F.lit(-1).cast("bigint").alias("cluster")))
        )


def bfr_init(points: DataFrame, k: int, seed: int = 42, percent: int = 20) -> DataFrame:
    """The first round: ``kind, cluster, n`` of every summary, and the retained points as one row."""
    state = BfrState(k, seed, 2.0)
    state.start(split_sample(points, "id", percent).filter("sampled").select("id", "features"))
    parts = [state.ds.select(F.lit("ds").alias("kind"), "cluster", "n")]
    if state.cs is not None:
        parts.append(state.cs.select(F.lit("cs").alias("kind"), "cluster", "n"))
    parts.append(state.rs.agg(
        F.lit("rs").alias("kind"), F.lit(-1).cast("bigint").alias("cluster"), F.count(F.lit(1)).alias("n")))
    return reduce(DataFrame.unionByName, parts)


def bfr(
    points: DataFrame, k: int, chunks: int = 4, seed: int = 42, factor: float = 2.0, percent: int = 20
) -> tuple[DataFrame, DataFrame]:
    """(rounds, labels): ``round, n_discard, n_cs, n_cs_points, n_retained`` and ``id, cluster``."""
    drawn = split_sample(points.select("id", "features"), "id", percent)
    # A chunk's points lie in a folder of their own, so a round reads no others.
    part = F.when(F.col("sampled"), -1).otherwise(md5_int(F.col("id"), F.lit("chunk")) % chunks).cast("int")
    path = scratch_path(points.sparkSession, "chunks")
    drawn.withColumn("chunk", part).drop("sampled").write.partitionBy("chunk").parquet(path)
    marked = points.sparkSession.read.schema(drawn.withColumn("chunk", part).drop("sampled").schema).parquet(path)
    state = BfrState(k, seed, factor)
    state.start(marked.filter("chunk = -1").select("id", "features"))
    state.report(1)
    into_ds = None
    for c in range(chunks):
        state.take(marked.filter(F.col("chunk") == c).select("id", "features"), c + 2)
        if c == chunks - 1:
            into_ds = state.finish()
        state.report(c + 2)
    return reduce(DataFrame.unionByName, state.rounds), state.labels(into_ds)
