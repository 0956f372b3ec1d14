"""Registered queries against their SQL, and the pipeline against its stages."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))
import check_queries

import __spark_entry__ as entry
import corpus_pipeline
from strataglean.llm import common, decontaminate, plans, quality_classifier, simhash

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")}
    assert "pipeline" in names and set(plans.ORACLES) <= set(plans.QUERIES)


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_query_equals_sql(spark, name):
    problem, _ = check_queries.compare(spark, check_queries.database(FOLDER), FOLDER, name)
    assert problem == ""


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLES)))
def test_query_runs_over_its_whole_table(spark, name):
    n = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    rows = entry.queries()[name](spark, FOLDER).collect()
    if name == "op11_embedding_whitening":  # a row per vector without null and non-finite entries, and component
        valid = spark.read.parquet(f"{FOLDER}/embeddings.parquet").filter(
            "embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
        n = 16 * valid.count()
    assert len(rows) == n if name != "op3_benchmark_decontamination" else len(rows) > 0


def test_every_stage_works_on_what_its_predecessor_kept(spark):
    docs = common.documents(spark, FOLDER)
    columns, labels = docs.columns, common.table(spark, FOLDER, "labels")
    model = quality_classifier.train(docs, labels)
    good = docs.join(quality_classifier.score(docs, model, "q").filter("q.kept").select("doc_id"), "doc_id").select(*columns)
    lines = corpus_pipeline.without_repeated_lines(spark, good, FOLDER)
    prints = simhash.fingerprints(lines)
    heads = prints.join(simhash.components(prints), "fp").select("component_id").distinct()
    one = lines.join(heads.withColumnRenamed("component_id", "doc_id"), "doc_id").select(*columns)
    bad = decontaminate.contaminated(one, common.table(spark, FOLDER, "benchmark")).select("doc_id").distinct()
    clean = one.join(bad, "doc_id", "left_anti").select(*columns)
    want = sorted(map(tuple, corpus_pipeline.encoded(spark, clean, FOLDER).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == want
    assert 0 < len(want) < docs.count()


def test_stages_keep_the_columns(spark):
    docs = common.documents(spark, FOLDER)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
