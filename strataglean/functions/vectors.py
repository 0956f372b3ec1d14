"""Expressions over ARRAY<DOUBLE> vectors and cluster summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Variances below this count as this, so that flat dimensions divide by no zero.
MIN_VARIANCE = 1e-12


def mean_of(stats: Column) -> Column:
    return F.transform(stats["sum"], lambda s: s / stats["n"])


def variance_of(stats: Column) -> Column:
    """Population variance per dimension from (n, sum, sumsq)."""
    return F.zip_with(
        stats["sum"], stats["sumsq"],
        lambda s, q: F.greatest(q / stats["n"] - (s / stats["n"]) * (s / stats["n"]),
                                F.lit(MIN_VARIANCE)),
    )


def scaled_distance(x: Column, mean: Column, variance: Column) -> Column:
    """sqrt(sum((x - mean)^2 / variance)) over the dimensions."""
    squares = F.zip_with(
        F.zip_with(x, mean, lambda u, m: (u - m) * (u - m)), variance, lambda d, v: d / v
    )
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v))


def mahalanobis(x: Column, stats: Column) -> Column:
    """Diagonal Mahalanobis distance of a vector to a cluster summary."""
    return scaled_distance(x, mean_of(stats), variance_of(stats))
