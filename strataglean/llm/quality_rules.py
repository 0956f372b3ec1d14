"""Quality rules: base rules, and hashed n-grams of a trusted target against the raw corpus.

Words are maximal runs without ASCII white space. The base rules count characters in
words, symbols, repeated lines and words in repeated five-word windows.

The method: words and pairs of words, A-Z lower-cased, are hashed to BUCKETS classes. Two
multinomials over the classes are estimated: from all documents (raw corpus), and from all documents that
``labels`` calls good and not toxic (trusted target). The target is smoothed towards the raw corpus: an
n-gram of a trusted document counts WEIGHT times in addition to its one place in the raw counts. So a
target that is a small part of the corpus gives ratios near 0. A document's score is the mean over its
n-grams of log p(target) - log p(raw); a document that passes the base rules is kept if its score is at
least THRESHOLD. The ratios depend on relative frequencies alone: the same corpus several times over gets the same
verdicts. The counts are summed in the tasks, so that one
vector of BUCKETS numbers per task is shuffled and one reaches the driver.

A null text has no words. A document without n-grams has score 0. Rows are told apart by
nothing, since each is judged by itself; repeated labels of an id count once and an id
is trusted if any of its labels says so. Null ids are never trusted. Empty tables give
empty results; without trusted documents all scores are 0.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataglean.llm import common
from strataglean.skew import broadcast_checked

BUCKETS, WEIGHT, THRESHOLD = 10_000, 10, -0.08
# The factor that joins two words' hashes, the window, the base rules' bounds.
PAIR, WINDOW = 1_000_003, 5
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20
SYMBOLS = re.compile(r"[#*$%&|<>]")
# Hashed words a worker remembers.
REMEMBERED = 150_000


def word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.md5(word).digest()[:4], "big")


def coded(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The words as numbers, and the distinct words in the order of their numbers."""
    known: dict[bytes, int] = defaultdict(count().__next__)
    codes = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    return codes, list(known)


def ngram_buckets(words: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """Classes of the words and of the pairs of words of one text."""
    hashes = common.per_worker("word hashes", dict)
    if len(hashes) > REMEMBERED:
        hashes.clear()
    codes, distinct = coded([w.lower() for w in words])
    found = np.empty(len(distinct), np.int64)
    for i, word in enumerate(distinct):
        h = hashes.get(word)
        if h is None:
            h = hashes[word] = word_hash(word)
        found[i] = h
    h = found[codes] if len(codes) else codes
    return np.concatenate([h % buckets, (h[:-1] * PAIR + h[1:]) % buckets])


def repeated_words(codes: np.ndarray) -> int:
    """Words in windows of five that occur twice or more, the first occurrence included."""
    n = len(codes) - WINDOW + 1
    if n < 2:
        return 0

    def ranked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]

    two = ranked(codes[:-1], codes[1:])
    four = ranked(two[:-2], two[2:])
    _, place, times = np.unique(four[:n] * (int(codes.max()) + 1) + codes[WINDOW - 1 :],
                                return_inverse=True, return_counts=True)
    ends = np.zeros(len(codes) + 1, np.int64)
    often = np.flatnonzero(times[place] > 1)
    np.add.at(ends, often, 1)
    np.add.at(ends, often + WINDOW, -1)
    return int((np.cumsum(ends) > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            n += line in seen
            seen.add(line)
    return n


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    blank = sum(map(text.count, " \t\n\v\f\r"))
    return (len(words), len(text) - blank, len(SYMBOLS.findall(text)), repeated_lines(text),
            repeated_words(coded(words)[0]))


def trusted_ids(labels: DataFrame) -> DataFrame:
    return (labels.filter("quality = 1 and toxic = 0 and doc_id is not null")
            .select(F.col("doc_id").cast("long").alias("trusted_id")).distinct())


def multinomials(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log of target over raw probability for each class; 0 for a class without n-grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for text, trusted in zip(*(c.to_pylist() for c in batch.columns)):
                n = np.bincount(ngram_buckets((text or b"").split(), buckets), minlength=buckets)
                sums[0] += n
                if trusted:
                    sums[1] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(buckets, dtype=np.int32)), pa.array(sums[0]), pa.array(sums[1])],
            ["bucket", "raw", "target"])

    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).join(
        broadcast_checked(trusted_ids(labels)), F.col("doc_id") == F.col("trusted_id"), "left")
    rows = (
        marked.select("text", F.col("trusted_id").isNotNull().alias("trusted"))
        .mapInArrow(run, "bucket int, raw long, target long")
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    )  # one row per class
    counts = np.zeros((buckets, 2))
    for bucket, raw, target in rows:
        counts[bucket] = raw, raw + WEIGHT * target
    used = counts[:, 0] > 0
    share = counts[used] / counts.sum(0)  # quotients of whole numbers: repeating the corpus changes no bit
    weights = np.zeros(buckets)
    weights[used] = np.log(share[:, 1]) - np.log(share[:, 0])
    return weights


RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "score double")


def score(docs: DataFrame, weights: np.ndarray, out: str) -> DataFrame:
    """``docs`` with a struct column ``out`` of the base counts and the score of each text."""
    @F.pandas_udf(RESULT)
    def judged(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words = (text or "").encode().split()
            found = ngram_buckets(words, len(weights))
            rows.append((*base_counts(text or "", words), float(weights[found].mean()) if len(found) else 0.0))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in RESULT.split(", ")])

    return docs.withColumn(out, judged(F.col("text").cast("string")))


def apply_rules(docs: DataFrame, labels: DataFrame, out: str, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with a struct column ``out``: base counts, score, base_failed, kept."""
    scored = score(docs, multinomials(docs, labels), out)
    c = F.col(out)
    failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEATED_PERCENT * c["n_words"])
    return scored.withColumn(out, c.withField("base_failed", failed)).withColumn(
        out, F.col(out).withField("kept", ~F.col(f"{out}.base_failed") & (F.col(f"{out}.score") >= threshold)))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its base counts, whether it failed them, and the verdict."""
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    found = apply_rules(docs, common.table(spark, sf_dir, "labels"), "found")
    return found.select("doc_id", "found.n_words", "found.word_chars", "found.n_symbols", "found.n_dup_lines",
                        "found.n_repeat_words", "found.base_failed", "found.kept")


ORACLE = rf"""with d as (select row_number() over () r, doc_id, coalesce(text, '') t from documents),
  w as (select r, doc_id, t, {common.WORDS_SQL.format("t")} ws from d),
  p as (select r, unnest(ws) word, unnest(range(len(ws))) i from w),
  five as (select r, i, word || ' ' || lead(word, 1) over o || ' ' || lead(word, 2) over o || ' '
      || lead(word, 3) over o || ' ' || lead(word, 4) over o g from p window o as (partition by r order by i)),
  twice as (select r, i, count(*) over (partition by r, g) > 1 again from five where g is not null),
  rep as (select r, count(distinct i + k) n from twice, (select unnest(range({WINDOW})) k) where again group by r),
  li as (select r, unnest(string_split(t, chr(10))) line from d),
  dup as (select r, sum(n - 1)::bigint n from (select r, line, count(*) n from li
      where len({common.WORDS_SQL.format("line")}) > 0 group by 1, 2) group by 1),
  h as (select r, i, ('0x' || substr(md5(word), 1, 8))::bigint h from (
      select r, i, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') word from p) q),
  g as (select r, h % {BUCKETS} b from h union all
    select r, (h * {PAIR} + lead(h) over (partition by r order by i)) % {BUCKETS} b from h
    qualify lead(h) over (partition by r order by i) is not null),
  good as (select distinct doc_id from labels where quality = 1 and toxic = 0),
  c as (select b, count(*) n_raw, count(good.doc_id) n_good from g join d using (r) left join good using (doc_id) group by b),
  tot as (select sum(n_raw)::double raw, sum(n_raw + {WEIGHT} * n_good)::double good from c),
  wt as (select b, ln((n_raw + {WEIGHT} * n_good) / tot.good) - ln(n_raw / tot.raw) x from c, tot),
  s as (select r, avg(x) score from g join wt using (b) group by r)
select doc_id, len(ws)::bigint n_words, len(array_to_string(ws, ''))::bigint word_chars,
  (len(t) - len(translate(t, '#*$%&|<>', '')))::bigint n_symbols, coalesce(dup.n, 0) n_dup_lines,
  coalesce(rep.n, 0)::bigint n_repeat_words,
  len(ws) < {MIN_WORDS} or 100 * coalesce(rep.n, 0) > {MAX_REPEATED_PERCENT} * len(ws) base_failed,
  not (len(ws) < {MIN_WORDS} or 100 * coalesce(rep.n, 0) > {MAX_REPEATED_PERCENT} * len(ws))
    and coalesce(score, 0) >= {THRESHOLD}::double kept
from w left join rep using (r) left join dup using (r) left join s using (r)"""
