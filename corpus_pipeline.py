"""From raw documents to tokens: five stages, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. Between stages the rows are written as Parquet in the shared
folder and read again, so that a lost executor costs at most one stage's tasks.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataglean.llm import bpe, common, decontaminate, line_dedup, quality_classifier, simhash
from strataglean.session import cut_lineage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier keeps."""
    return quality_classifier.keep_good(docs, common.table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that occur earlier; n_chars follows the text."""
    kept = line_dedup.remove_repeated_lines(docs, **line_dedup.WHOLE)
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontaminate.remove_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, and digests of the ids and of what they decode to."""
    return bpe.digests(docs, bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY)))


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_lines),
    ("SimHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE encoding and decoding", encoded),
]

# A trained classifier, 64-bit fingerprints and BPE merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, from documents."""
    docs = common.documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
