"""Embeddings as points: k-means and clustering by summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataglean.functions.vectors import mahalanobis as mahalanobis_column
from strataglean.operators import clustering
from strataglean.session import cut_lineage
from strataglean.sources import roles

K = 10
# Limits in units of sqrt(d): chosen so that points and summaries fall on both sides.
ASSIGN_FACTOR, MERGE_FACTOR = 1.0, 0.3


def _points(spark, sf):
    return roles.vectors(spark, sf)


def _by_label(points):
    return clustering.cluster_stats(points.withColumn("cluster", F.col("label").cast("bigint")))


def _by_dimension(stats):
    return stats.select("cluster", "n", F.posexplode(F.arrays_zip("sum", "sumsq")).alias("dim", "v")).select(
        "cluster", "n", F.col("dim").cast("bigint").alias("dim"),
        F.round("v.sum", 5).alias("sum"), F.round("v.sumsq", 5).alias("sumsq"))


def cluster_stats(spark, sf):
    return _by_dimension(_by_label(_points(spark, sf)))


def mahalanobis(spark, sf):
    """Distance of every point to the summary of its own label."""
    points = _points(spark, sf)
    stats = _by_label(points).select(F.col("cluster").cast("int").alias("label"), F.struct("n", "sum", "sumsq").alias("s"))
    return points.join(stats, "label").select(
        "id", F.round(mahalanobis_column(F.col("features"), F.col("s")), 5).alias("distance"))


def bfr_assign(spark, sf):
    """Labels 0-4 as discard summaries, 5-9 as compressed ones."""
    points = _points(spark, sf)
    stats = cut_lineage(_by_label(points))
    placed = clustering.bfr_assign(
        points, stats.filter("cluster < 5"), stats.filter("cluster >= 5"), ASSIGN_FACTOR)
    return placed.select("id", "kind", "cluster", F.round("distance", 5).alias("distance"))


def _halves(spark, sf):
    """Each label as three summaries."""
    points = _points(spark, sf)
    return clustering.cluster_stats(
        points.withColumn("cluster", F.col("label").cast("bigint") * 3 + F.col("id") % 3))


def bfr_merge(spark, sf):
    return _by_dimension(clustering.bfr_merge(cut_lineage(_halves(spark, sf)), MERGE_FACTOR))


def kmeans_clusters(spark, sf):
    """Every point's cluster; no SQL says where the iterations end."""
    return clustering.kmeans_labels(_points(spark, sf), K).select("id", "cluster")


def kmeans_labels(spark, sf):
    """Whether every point has one of K labels."""
    labels = kmeans_clusters(spark, sf)
    return labels.select("id", F.col("cluster").between(0, K - 1).alias("placed"))


def bfr_init_sets(spark, sf):
    """Every summary of the first round with its number of points, and the retained points as one row."""
    return clustering.bfr_init(_points(spark, sf), K)


def bfr_init(spark, sf):
    """The first round places every sampled point: in K discard summaries, in others, or as retained."""
    parts = bfr_init_sets(spark, sf)
    return parts.agg(F.sum("n").cast("bigint").alias("n_points"), F.count_if(F.col("kind") == "ds").alias("n_discard_sets"))


def bfr_round_counts(spark, sf):
    """What each round holds in discard, compressed and retained sets."""
    return clustering.bfr(_points(spark, sf), K)[0]


def bfr_rounds(spark, sf):
    """Each round accounts for all points read so far."""
    rounds = bfr_round_counts(spark, sf)
    return rounds.select(F.col("round").cast("bigint").alias("round"),
                         (F.col("n_discard") + F.col("n_cs_points") + F.col("n_retained")).alias("n_points"))


def bfr_clusters(spark, sf):
    """Every point's cluster, -1 outside of all."""
    return clustering.bfr(_points(spark, sf), K)[1]


def bfr_labels(spark, sf):
    labels = bfr_clusters(spark, sf)
    return labels.select("id", F.col("cluster").between(-1, K - 1).alias("placed"))


QUERIES = {
    "cluster_stats": cluster_stats, "mahalanobis": mahalanobis, "bfr_assign": bfr_assign,
    "bfr_merge": bfr_merge, "kmeans_labels": kmeans_labels, "bfr_init": bfr_init,
    "bfr_rounds": bfr_rounds, "bfr_labels": bfr_labels,
    # Without SQL: what the facts above are about.
    "kmeans_clusters": kmeans_clusters, "bfr_init_sets": bfr_init_sets,
    "bfr_round_counts": bfr_round_counts, "bfr_clusters": bfr_clusters,
}


def _stats(cluster):
    return f"""x as (select vec_id id, label, {cluster} cluster, unnest(embedding)::double v,
      generate_subscripts(embedding, 1) d from embeddings),
    s as (select cluster, d, count(*) n, sum(v) s, sum(v * v) q from x group by 1, 2),
    f as (select cluster, d, n, s / n m, greatest(q / n - (s / n) * (s / n), 1e-12) var from s)"""


# The sampled points, and the chunk of each other one.
_DRAWN = """p as (select ('0x' || substr(md5(vec_id || '|sample'), 1, 8))::bigint % 100 < 20 drawn,
    ('0x' || substr(md5(vec_id || '|chunk'), 1, 8))::bigint % 4 chunk from embeddings)"""

_DIST = f"""{_stats("label::bigint")},
  g as (select id, f.cluster, sqrt(sum((v - m) * (v - m) / var)) dist from x join f on f.d = x.d group by 1, 2),
  lim as (select {ASSIGN_FACTOR} * sqrt(max(d)) z from x),
  a as (select id, arg_min(cluster, dist) filter (where cluster < 5) dc, min(dist) filter (where cluster < 5) dd,
    arg_min(cluster, dist) filter (where cluster >= 5) cc, min(dist) filter (where cluster >= 5) cd from g group by 1)"""

ORACLES = {
    "cluster_stats": f"""with {_stats("label::bigint")} select cluster, n, (d - 1)::bigint dim,
        round(s, 5) sum, round(q, 5) sumsq from s""",
    "mahalanobis": f"""with {_stats("label::bigint")} select id, round(sqrt(sum((v - m) * (v - m) / var)), 5) distance
        from x join f using (cluster, d) group by 1""",
    "bfr_assign": f"""with {_DIST} select id, case when dd < z then 'ds' when cd < z then 'cs' else 'rs' end kind,
        case when dd < z then dc when cd < z then cc else -1 end cluster,
        round(case when dd >= z and cd < z then cd else dd end, 5) distance from a, lim""",
    "bfr_merge": f"""with recursive {_stats("label::bigint * 3 + vec_id % 3")},
        p as (select a.cluster x, b.cluster y, sqrt(sum((a.m - b.m) * (a.m - b.m)
            / ((a.n * a.var + b.n * b.var) / (a.n + b.n)))) dist, max(a.d) dims
          from f a join f b on a.d = b.d and a.cluster < b.cluster group by 1, 2),
        l as (select x, y from p where dist < {MERGE_FACTOR} * sqrt(dims) union all select y, x from p where dist < {MERGE_FACTOR} * sqrt(dims)),
        r(c, o) as (select distinct cluster, cluster from s union select r.c, l.y from r join l on r.o = l.x),
        t as (select c, min(o) target from r group by 1),
        z as (select target cluster, d, sum(n)::bigint n, sum(s) s, sum(q) q from s join t on t.c = s.cluster group by 1, 2)
        select cluster, n, (d - 1)::bigint dim, round(s, 5) sum, round(q, 5) sumsq from z""",
    "kmeans_labels": "select vec_id id, true placed from embeddings",
    "bfr_labels": "select vec_id id, true placed from embeddings",
    "bfr_init": f"with {_DRAWN} select count(*) n_points, {K}::bigint n_discard_sets from p where drawn",
    "bfr_rounds": f"""with {_DRAWN}, r(k) as (select unnest(range(1, 6)))
        select k::bigint round, (select count(*) from p where drawn or chunk < k - 1) n_points from r""",
}
