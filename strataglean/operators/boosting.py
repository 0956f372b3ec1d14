"""Regression trees boosted by sums of gradients and curvatures in histograms.

The loss is half the squared error: a row's gradient is its prediction less its label, its
curvature 1. Every feature is cut into bins once; bin 0 holds missing values (null or NaN). A tree grows level by
level: the tasks add up gradients per (node, feature, bin), one group-by adds the tasks' sums, and
windows over these few rows give the gain of every cut, with the missing values on either side.
Rows never move: a task finds a row's node by walking the tree grown so far, and its prediction
by the trees since the table was last written. Rows of equal bins have the same prediction in every round: where
the bins allow few combinations, such rows are added up once, to the sum of their gradients and their number.

With sums G and H on each side and the L2 term ``l2``, a cut gains
``GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)``. Each side has ``min_child`` rows at least; a node whose best
gain is not above ``gamma`` is a leaf of weight ``-G / (H + l2)``, times ``step``. Equal gains: the first
feature, the lowest cut, and missing values to the right.

Rows without a label are not fitted; without any row the model is its base score. Extra columns are ignored by
the fit and kept by the prediction.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from strataglean.session import cut_lineage

# Bins have one byte; trees kept in the tasks before predictions are written again.
MOST_BINS, WRITE_EVERY = 254, 10
# Combinations of bins up to which rows of equal bins are added up before the first tree.
MOST_CELLS = 1_000_000


@dataclass
class Tree:
    """Nodes in heap order: the children of i are 2i + 1 (left) and 2i + 2. A leaf's feature is -1."""

    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    missing_left: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)
    weight: np.ndarray = field(init=False)

    def __post_init__(self):
        size = 2 ** (self.depth + 1) - 1
        self.feature, self.cut = np.full(size, -1), np.zeros(size, np.int64)
        self.missing_left, self.gain, self.weight = np.zeros(size, bool), np.zeros(size), np.zeros(size)

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row of ``bins`` (rows x features) ends in."""
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(self.depth):
            feature = self.feature[node]
            value = bins[rows, np.maximum(feature, 0)]
            right = np.where(value == 0, ~self.missing_left[node], value > self.cut[node])
            node = np.where(feature < 0, node, 2 * node + 1 + right)
        return node


@dataclass
class BoostedTrees:
    """A fitted model: edges of the features' bins, and trees whose weights hold the step."""

    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree]

    def importance(self) -> dict[str, float]:
        """Each feature's share of the mean gains of its cuts; all 0 without a cut."""
        mean = []
        for i in range(len(self.features)):
            gains = [g for t in self.trees for g in t.gain[t.feature == i]]
            mean.append(float(sum(gains) / len(gains)) if gains else 0.0)
        return {name: m / (sum(mean) or 1.0) for name, m in zip(self.features, mean)}


def _number(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def quantile_edges(rows: DataFrame, features: Sequence[str], bins: int, accuracy: int = 10_000) -> list[list[float]]:
    """Edges between ``bins`` parts of each feature with about as many rows each."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = rows.agg(*[F.percentile_approx(_number(f), shares, accuracy).alias(str(i)) for i, f in enumerate(features)])
    return [sorted(set(values or [])) for values in found.first()]


def even_edges(rows: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Edges between ``bins`` parts of equal width of each feature's range."""
    found = rows.agg(*[F.struct(F.min(_number(f)), F.max(_number(f))).alias(str(i)) for i, f in enumerate(features)])
    return [[] if low is None else [low + (high - low) * i / bins for i in range(1, bins)] for low, high in found.first()]


def _matrix(batch: pa.RecordBatch, edges: list[list[float]]) -> np.ndarray:
    """The bins of a batch whose first columns are the features: 1 + edges not above the value."""
    out = np.zeros((batch.num_rows, len(edges)), np.uint8)
    for i, own in enumerate(edges):
        values = batch.column(i).to_numpy(zero_copy_only=False).astype(float)
        out[:, i] = np.where(np.isnan(values), 0, 1 + np.searchsorted(np.array(own), values, "right"))
    return out


def binned(rows: DataFrame, label: str, features: Sequence[str], edges: list[list[float]], base: float) -> DataFrame:
    """``bins binary, residual double``: a byte per feature, and base less label."""
    if max(map(len, edges), default=0) > MOST_BINS:
        raise ValueError(f"more than {MOST_BINS} edges")
    target = _number(label)
    source = rows.filter(target.isNotNull()).select(
        *[_number(f).alias(str(i)) for i, f in enumerate(features)], (F.lit(float(base)) - target).alias("residual"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [row.tobytes() for row in _matrix(batch, edges)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary()), batch.column(len(edges))], ["bins", "residual"])

    return source.mapInArrow(run, "bins binary, residual double")


def _added_up(table: DataFrame, edges: list[list[float]]) -> DataFrame:
    """``table`` with one row per combination of bins and the number ``n`` of its rows, if there are few combinations."""
    if math.prod(len(own) + 2 for own in edges) > MOST_CELLS:
        return table
    return table.groupBy("bins").agg(F.sum("residual").alias("residual"), F.count(F.lit(1)).alias("n"))


def _unpacked(batch: pa.RecordBatch, width: int, trees: list[Tree]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, gradient sums and numbers of rows; a table without ``n`` has one row each."""
    bins = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(batch.num_rows, width)
    residual = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
    n = batch.column(2).to_numpy(zero_copy_only=False).astype(float) if batch.num_columns > 2 else np.ones(batch.num_rows)
    for tree in trees:
        residual = residual + n * tree.weight[tree.nodes(bins)]
    return bins, residual, n


def histogram(table: DataFrame, width: int, trees: list[Tree], tree: Tree, level: int) -> DataFrame:
    """``node, feature, bin, g, h`` of the level's nodes; rows carry the ``trees`` not yet written."""
    first, size = 2**level - 1, MOST_BINS + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, h = np.zeros((2, (first + 1) * width * size))
        for batch in batches:
            bins, residual, n = _unpacked(batch, width, trees)
            node = tree.nodes(bins) - first
            bins, residual, n, node = bins[node >= 0], residual[node >= 0], n[node >= 0], node[node >= 0]
            place = ((node[:, None] * width + np.arange(width)) * size + bins).ravel()
            g += np.bincount(place, np.repeat(residual, width), len(g))
            h += np.bincount(place, np.repeat(n, width), len(h))
        at = np.flatnonzero(h)
        columns = (first + at // (width * size), at // size % width, at % size, g[at], h[at])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "feature", "bin", "g", "h"])

    parts = table.mapInArrow(run, "node long, feature long, bin long, g double, h double")
    # Dealt by (node, feature), which the windows over the sums need as well: one shuffle for both.
    return parts.repartition("node", "feature").groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def split_gains(sums: DataFrame, l2: float = 1.0) -> DataFrame:
    """The gain of each cut of a histogram.

    ``node, feature, cut, missing_left, gain`` with the sums ``g, h`` of the node and ``gl, hl`` of its left side, which
    holds the bins up to ``cut``.
    """
    own = Window.partitionBy("node", "feature")
    upto = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    there, missing = F.col("bin") > 0, F.col("bin") == 0

    def added(column: str, where: Column, window) -> Column:
        return F.sum(F.when(where, F.col(column)).otherwise(0.0)).over(window)

    sides = sums.select(
        "node", "feature", F.col("bin").alias("cut"),
        *[added(c, F.lit(True), own).alias(f"{c}_all") for c in "gh"],
        *[added(c, there, upto).alias(f"{c}_left") for c in "gh"],
        *[added(c, missing, own).alias(f"{c}_missing") for c in "gh"])
    sides = sides.withColumn("missing_left", F.explode(F.array(F.lit(False), F.lit(True))))
    more = F.col("missing_left").cast("int")
    sides = sides.select(
        "node", "feature", "cut", "missing_left", F.col("g_all").alias("g"), F.col("h_all").alias("h"),
        *[(F.col(f"{c}_left") + more * F.col(f"{c}_missing")).alias(f"{c}l") for c in "gh"])
    score = lambda g, h: g * g / (h + F.lit(float(l2)))
    gain = (score(F.col("gl"), F.col("hl")) + score(F.col("g") - F.col("gl"), F.col("h") - F.col("hl"))
            - score(F.col("g"), F.col("h")))
    return sides.withColumn("gain", gain)


def allowed(min_child: float = 1.0) -> Column:
    """Whether a cut of :func:`split_gains` leaves enough on both sides."""
    return (F.col("cut") > 0) & (F.col("hl") >= min_child) & (F.col("h") - F.col("hl") >= min_child)


def best_splits(gains: DataFrame, min_child: float = 1.0) -> DataFrame:
    """One row per node: its sums ``g, h`` and its ``best`` cut, null if none is allowed."""
    order = F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("cut")).alias("c"),
                     (~F.col("missing_left")).alias("right"), "gl", "hl")
    of_first = F.col("feature") == 0
    return gains.groupBy("node").agg(
        F.max(F.when(of_first, F.col("g"))).alias("g"), F.max(F.when(of_first, F.col("h"))).alias("h"),
        F.max(F.when(allowed(min_child), order)).alias("best"))


def _grow(table: DataFrame, width: int, trees: list[Tree], depth: int, step: float, l2: float, gamma: float,
          min_child: float) -> Tree:
    """One tree: a job per level, which brings home a row per node."""
    tree = Tree(depth)
    for level in range(depth):
        nodes = best_splits(split_gains(histogram(table, width, trees, tree, level), l2), min_child).collect()
        cuts = [n for n in nodes if n["best"] and n["best"]["gain"] > gamma]
        if level == 0:
            tree.weight[0] = -step * nodes[0]["g"] / (nodes[0]["h"] + l2) if nodes else 0.0
        for n in cuts:
            i, best = n["node"], n["best"]
            tree.feature[i], tree.cut[i], tree.missing_left[i] = -best["f"], -best["c"], not best["right"]
            tree.gain[i] = best["gain"]
            tree.weight[2 * i + 1] = -step * best["gl"] / (best["hl"] + l2)
            tree.weight[2 * i + 2] = -step * (n["g"] - best["gl"]) / (n["h"] - best["hl"] + l2)
        if not cuts:
            break
    return tree


def fit_trees(
    rows: DataFrame, label: str, features: Sequence[str], rounds: int = 100, depth: int = 3, step: float = 0.1, l2: float = 1.0,
    gamma: float = 0.0, min_child: float = 1.0, bins: int = 64, base: float = 0.5, edges: list[list[float]] | None = None
) -> BoostedTrees:
    """Boosted trees on ``bins`` quantile bins, or on the ``edges`` given."""
    edges = quantile_edges(rows, features, bins) if edges is None else edges
    table, width = cut_lineage(_added_up(binned(rows, label, features, edges, base), edges)), len(features)
    trees: list[Tree] = []
    kept: list[Tree] = []
    for _ in range(rounds):
        tree = _grow(table, width, kept, depth, step, l2, gamma, min_child)
        if tree.feature[0] < 0 and tree.weight[0] == 0:
            break
        trees.append(tree)
        kept = kept + [tree]
        if len(kept) == WRITE_EVERY:
            table, kept = cut_lineage(_moved(table, width, kept)), []
    return BoostedTrees(list(features), edges, float(base), trees)


def _moved(table: DataFrame, width: int, trees: list[Tree]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            residual = _unpacked(batch, width, trees)[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(residual), *batch.columns[2:]], batch.schema.names)

    return table.mapInArrow(run, table.schema)


def predict_trees(model: BoostedTrees, rows: DataFrame, name: str = "prediction") -> DataFrame:
    """``rows`` with the model's prediction as the column ``name``, which they don't have yet."""
    if name in rows.columns:
        raise ValueError(f"there is a column {name} already")
    width = len(model.features)
    source = rows.select(*[_number(f).alias(f"feature {i}") for i, f in enumerate(model.features)], *rows.columns)
    schema = StructType([*rows.schema.fields]).add(name, DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, found = _matrix(batch, model.edges), np.full(batch.num_rows, model.base)
            for tree in model.trees:
                found += tree.weight[tree.nodes(bins)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[width:], pa.array(found)], [*batch.schema.names[width:], name])

    return source.mapInArrow(run, schema)
