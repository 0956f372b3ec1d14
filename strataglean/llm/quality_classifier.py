"""Quality classifier by co-training on two views of a document.

View one is the text's content (ratios of symbols, capitals, repeats, lengths), view two the
page's metadata (language, source, length column). Each view has a logistic model,
fitted by Newton steps whose sums are taken in the tasks over all labelled rows. Rows whose
hashed id falls in a fold of its own are kept out to calibrate each view (Platt). In every
further round a view also learns from the unlabelled rows of which the other view is confident
after calibration, with less weight. In the end both calibrated log-odds are added, the
prior counted once, and every document is scored; it is kept from 0.5 on.

All labelled and unlabelled rows take part; only sums of a fixed size reach the
driver. A document's label is the mean of its quality labels, good from 0.5 on; null labels and
null ids teach nothing. Null texts, languages, sources and lengths are features of their own.
Repeated rows teach and are scored each by itself. Without a label of both kinds nothing can
be learnt: all documents are kept with score 0.5. An empty table gives an empty result.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from strataglean.llm import common
from strataglean.session import cut_lineage

ROUNDS, STEPS, RIDGE = 3, 8, 1.0
# Certainty from which a pseudo-label is exchanged, and its weight; every n-th label calibrates.
CERTAIN, PSEUDO_WEIGHT, HELD_OUT, KEEP_FROM = 0.98, 0.2, 5, 0.5
# Hash classes of languages and sources, words of a stretch in which distinct words are counted.
LANG_CLASSES, SOURCE_CLASSES, STRETCH = 8, 16, 200

LETTERS_UP, DIGITS, STOPS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?'\"()"
SYMBOLS, ASCII = b"#*$%&|<>{}[]\\^~_=+@", bytes(range(128))


def text_features(text: str | None) -> list[float]:
    """Sixteen numbers of a text's content, all of the order of one."""
    raw = (text or "").encode()
    words, n = raw.split(), max(len(raw), 1)
    m = max(len(words), 1)

    def share(chars: bytes) -> float:
        return (len(raw) - len(raw.translate(None, chars))) / n

    distinct = sum(len(set(words[i : i + STRETCH])) for i in range(0, len(words), STRETCH))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ratios = [
        share(SYMBOLS), share(LETTERS_UP), share(DIGITS), share(STOPS), raw.count(b"!") / m, raw.count(b"|") / m,
        len(raw.translate(None, ASCII)) / n, sum(map(operator.eq, words, words[1:])) / m,
        1 - distinct / m, 1 - len(set(lines)) / max(len(lines), 1), raw.count(b"http") / m,
        sum(len(w) > 24 for w in words) / m,
    ]
    return [1.0, *[float(np.log1p(50 * r)) for r in ratios], np.log1p(len(words)) / 10,
            min(n / m, 50) / 10, float(not words)]


def meta_features(lang: str | None, source: str | None, n_chars: float | None) -> list[float]:
    """Hash classes of language and source, and the length column."""
    known = n_chars is not None and not np.isnan(n_chars) and n_chars >= 0
    found = [0.0] * (LANG_CLASSES + SOURCE_CLASSES)
    found[crc32(lang.encode()) % (LANG_CLASSES - 1) if lang is not None else LANG_CLASSES - 1] = 1.0
    found[LANG_CLASSES + (crc32(source.encode()) % (SOURCE_CLASSES - 1) if source is not None
                          else SOURCE_CLASSES - 1)] = 1.0
    size = float(np.log1p(n_chars)) / 10 if known else 0.0
    return [1.0, size, size * size, float(not known), *found]


VIEWS = (len(text_features("")), len(meta_features(None, None, None)))


@dataclass
class Model:
    """Weights, slope and offset of the two views, and the prior log-odds."""

    weights: list[np.ndarray] = field(default_factory=lambda: [np.zeros(n) for n in VIEWS])
    platt: list[np.ndarray] = field(default_factory=lambda: [np.array([1.0, 0.0]) for _ in VIEWS])
    prior: float = 0.0
    fitted: bool = False

    def logits(self, view: int, x: np.ndarray) -> np.ndarray:
        slope, offset = self.platt[view]
        return np.clip(slope * (x @ self.weights[view]) + offset, -30, 30)

    def score(self, views: list[np.ndarray]) -> np.ndarray:
        both = self.logits(0, views[0]) + self.logits(1, views[1]) - self.prior
        return _sigmoid(both) if self.fitted else np.full(len(views[0]), 0.5)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _matrices(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(-1, n).astype(np.float64)
            for i, n in enumerate(VIEWS)]


def _inputs() -> list:
    return [F.col("text").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string"),
            F.col("n_chars").cast("double")]


def _views(texts: pd.Series, langs: pd.Series, sources: pd.Series, sizes: pd.Series) -> tuple[list, list]:
    return list(map(text_features, texts)), [meta_features(*x) for x in zip(langs, sources, sizes)]


BOTH = StructType([StructField(f"x{i}", ArrayType(DoubleType())) for i in range(len(VIEWS))])


@F.pandas_udf(BOTH)
def _features(texts: pd.Series, langs: pd.Series, sources: pd.Series, sizes: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(dict(zip(("x0", "x1"), _views(texts, langs, sources, sizes))))


def feature_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``x0, x1, y, held``: both views, the label (null: none), and whether it calibrates."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _features(*_inputs()).alias("x")).select(
        "doc_id", "x.x0", "x.x1")
    marks = (labels.filter("quality is not null and doc_id is not null")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg((F.avg("quality") >= 0.5).cast("double").alias("y")))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    return cut_lineage(rows.join(marks, "doc_id", "left").select("x0", "x1", "y", held.alias("held")))


def _newton_sums(table: DataFrame, parts, widths: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per fit: gradient and curvature, summed over all rows.

    ``parts`` gives for a batch, per fit, the rows' inputs, targets, weights and current logits.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((n + 1, n)) for n in widths]
        for batch in batches:
            for k, (x, y, w, z) in enumerate(parts(batch)):
                p = _sigmoid(z)
                sums[k][0] += x.T @ (w * (y - p))
                sums[k][1:] += (x * (w * p * (1 - p))[:, None]).T @ x
        flat = np.concatenate([s.ravel() for s in sums])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["i", "v"])

    rows = table.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(sum((n + 1) * n for n in widths))
    for i, v in rows:  # as many as there are numbers in the sums
        flat[i] = v
    found, at = [], 0
    for n in widths:
        both = flat[at : at + (n + 1) * n].reshape(n + 1, n)
        found.append((both[0], both[1:]))
        at += (n + 1) * n
    return found


def _labels(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    y = batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
    return y, batch.column(3).to_numpy(zero_copy_only=False).astype(bool)


def _fit_views(table: DataFrame, teacher: Model | None) -> list[np.ndarray]:
    """Weights of both views; each learns from labels, and from what the other view of ``teacher`` is sure of."""
    weights = [np.zeros(n) for n in VIEWS]
    for _ in range(STEPS):
        now = [w.copy() for w in weights]

        def parts(batch: pa.RecordBatch) -> list:
            xs = _matrices(batch)
            y, held = _labels(batch)
            labelled = ~np.isnan(y)
            found = []
            for view, x in enumerate(xs):
                target, weight = np.nan_to_num(y), (labelled & ~held).astype(float)
                if teacher is not None:
                    p = _sigmoid(teacher.logits(1 - view, xs[1 - view]))
                    sure = ~labelled & (np.maximum(p, 1 - p) >= CERTAIN)
                    target = np.where(sure, p >= 0.5, target)
                    weight = np.where(sure, PSEUDO_WEIGHT, weight)
                found.append((x, target, weight, x @ now[view]))
            return found

        moved = 0.0
        for k, (gradient, curvature) in enumerate(_newton_sums(table, parts, list(VIEWS))):
            ridge = RIDGE * np.eye(VIEWS[k])
            step = np.linalg.solve(curvature + ridge, gradient - RIDGE * now[k])
            weights[k] = np.round(now[k] + step, 9)  # the order of a sum leaves no trace
            moved = max(moved, float(np.abs(step).max()))
        if moved < 1e-4:
            break
    return weights


def _calibrate(table: DataFrame, model: Model, good: int, bad: int) -> list[np.ndarray]:
    """Slope and offset of each view on the rows held out, with Platt's softened targets."""
    platt = [np.array([1.0, 0.0]) for _ in VIEWS]
    high, low = (good + 1) / (good + 2), 1 / (bad + 2)
    for _ in range(STEPS):
        now = [p.copy() for p in platt]

        def parts(batch: pa.RecordBatch) -> list:
            y, held = _labels(batch)
            weight = (~np.isnan(y) & held).astype(float)
            target = np.where(np.nan_to_num(y) > 0.5, high, low)
            found = []
            for view, x in enumerate(_matrices(batch)):
                pair = np.column_stack([x @ model.weights[view], np.ones(len(x))])
                found.append((pair, target, weight, pair @ now[view]))
            return found

        moved = 0.0
        for k, (gradient, curvature) in enumerate(_newton_sums(table, parts, [2, 2])):
            start = np.array([1.0, 0.0])
            step = np.linalg.solve(curvature + 0.1 * np.eye(2), gradient - 0.1 * (now[k] - start))
            platt[k] = np.round(now[k] + np.clip(step, -2, 2), 9)
            moved = max(moved, float(np.abs(step).max()))
        if moved < 1e-3:
            break
    return platt


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> Model:
    """The two calibrated views after ``rounds`` of exchanging pseudo-labels."""
    table = feature_table(docs, labels)
    counts = {(y, held): n for y, held, n in
              table.filter("y is not null").groupBy("y", "held").count().collect()}
    good, bad = (counts.get((y, False), 0) for y in (1.0, 0.0))
    if not good or not bad:
        return Model()
    model = None
    for _ in range(rounds):
        fitted = Model(weights=_fit_views(table, model), prior=float(np.log(good / bad)), fitted=True)
        own_good, own_bad = (counts.get((y, True), 0) for y in (1.0, 0.0))
        if own_good and own_bad:
            fitted.platt = _calibrate(table, fitted, own_good, own_bad)
        model = fitted
    return model


def score(docs: DataFrame, model: Model, out: str) -> DataFrame:
    """``docs`` with a struct column ``out``: text_score, meta_score, score, kept."""
    # One function from texts to scores: a second one would be a second Python worker for each task.
    @F.pandas_udf("text_score double, meta_score double, score double")
    def scored(texts: pd.Series, langs: pd.Series, sources: pd.Series, sizes: pd.Series) -> pd.DataFrame:
        views = [np.array(x, float).reshape(-1, n) for x, n in zip(_views(texts, langs, sources, sizes), VIEWS)]
        return pd.DataFrame({
            "text_score": _sigmoid(model.logits(0, views[0])), "meta_score": _sigmoid(model.logits(1, views[1])),
            "score": model.score(views)})

    found = docs.withColumn(out, scored(*_inputs()))
    return found.withColumn(out, F.col(out).withField("kept", F.col(f"{out}.score") >= KEEP_FROM))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps."""
    out = common.fresh("quality_found", docs.columns)
    return score(docs, train(docs, labels), out).filter(F.col(f"{out}.kept")).drop(out)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the calibrated scores of both views, their combination, and whether it is kept."""
    docs = common.documents(spark, sf_dir)
    found = score(docs, train(docs, common.table(spark, sf_dir, "labels")), "found")
    return found.select("doc_id", *[F.round(f"found.{c}", 6).alias(c) for c in ("text_score", "meta_score", "score")],
                        "found.kept")
