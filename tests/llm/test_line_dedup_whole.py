"""Short lines under the limits of the query, against brute force with limits of its own."""

import random

import pytest
from odd import odd_documents
from test_line_dedup import corpus, distance, edited

import corpus_pipeline
from strataglean.llm import line_dedup as dedup


def edits_allowed(n):
    return 2 if n >= 40 else 1 if n >= 3 else 0


def brute(rows):
    """(doc_id, line number) of lines with an equal or near line at an earlier place."""
    lines = [((doc_id, i), line.strip(" \t\v\f\r")) for doc_id, text in rows for i, line in enumerate((text or "").split("\n"))]
    lines = [(place, line) for place, line in lines if line]
    return {place for place, line in lines if any(
        other < place and abs(len(line) - len(second)) <= 2
        and distance(line, second) <= edits_allowed(min(len(line), len(second)))
        for other, second in lines)}


def short_corpus(seed):
    pick = random.Random(seed)
    base = ["Les.", "And ornd.", "Of, edti oner.", "x", "ab", "été", "x" * 38, "y" * 39, "z" * 40, "w" * 41]
    rows = [(100 + i, "\n".join(edited(pick, pick.choice(base), pick.randrange(3)) for _ in range(5))) for i in range(20)]
    return corpus(seed) + rows


@pytest.mark.parametrize("seed, hot", [(1, 64), (2, 2), (3, 1)])
def test_short_lines_equal_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(dedup, "HOT_KEY", hot)
    rows = short_corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.line_no) for r in dedup.repeated_lines(docs, **dedup.WHOLE).collect()}
    assert got == brute(rows)
    assert {len(t.split("\n")[n].strip()) for i, t in rows if i >= 100 for j, n in got if j == i} & set(range(1, 20))


def test_query_and_stage_see_short_lines(spark, monkeypatch):
    rows = [(1, "Les.\nOf, edti oner.\n\n"), (2, "Les.\nOf edti oner.\n\nab"), (3, "x\nab\nac")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_chars long")
    monkeypatch.setattr(dedup.common, "documents", lambda *_: docs)
    got = {r.doc_id: (r.n_removed, r.n_near, r.removed_lines) for r in dedup.op6_line_dedup(spark, "").collect()}
    assert got == {1: (0, 0, ""), 2: (2, 1, "0,1"), 3: (1, 0, "1")}
    kept = corpus_pipeline.without_repeated_lines(spark, docs, "").collect()
    assert {r.doc_id: (r.text, r.n_chars) for r in kept} == {
        1: (rows[0][1], len(rows[0][1])), 2: ("\nab", 3), 3: ("x\nac", 4)}


def test_odd_documents_lose_their_short_repeats(spark):
    texts = {r.text for r in dedup.remove_repeated_lines(odd_documents(spark).filter("doc_id = 6"), **dedup.WHOLE).collect()}
    assert texts == {"a\n"}
