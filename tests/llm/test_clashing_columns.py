"""Stages of the pipeline on documents whose extra columns have the names of helper columns."""

from pyspark.sql import functions as F

from odd import odd_documents
from strataglean.llm import decontaminate, simhash

NAMES = ["_best_id", "best_fp", "_several", "several", "best_id", "bad_id", "_bad_print", "own_print", "bad_print"]


def clashing(spark, more=()):
    docs = odd_documents(spark, more)
    return docs.select("*", *[F.lit("clash").alias(n) for n in NAMES])


def test_keep_one(spark):
    docs = clashing(spark)
    kept = simhash.keep_one(docs)
    plain = simhash.keep_one(odd_documents(spark))
    assert kept.columns == docs.columns and kept.count() == plain.count()
    assert all(kept.filter(F.col(n) == "clash").count() == kept.count() for n in NAMES[:1])


def test_remove_contaminated(spark):
    item = " ".join(f"word{i}" for i in range(30))
    docs = clashing(spark, [f"before {item} after"])
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = decontaminate.remove_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
