"""The query with longer n-grams, and the packets that carry them."""

import numpy as np
from test_lm import brute

import __spark_entry__ as entry
from strataglean.llm import blocks, lm


def test_query_scores_trigrams(spark, monkeypatch):
    texts = ["a b c d", "x a b c", "b c e a b d", "a b c a b c", "", None, "z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(lm.common, "documents", lambda *_: docs)
    got = entry.queries()["op10_lm_scoring_long"](spark, "").orderBy("doc_id").collect()
    want = brute([t or "" for t in texts], 3, lm.ALPHA)
    assert [(r.n_words, round(r.log_score, 3), r.n_backoff, r.n_unseen) for r in got] == [
        (n, round(v, 3), b, u) for n, v, b, u in want]
    assert want != brute([t or "" for t in texts], 2, lm.ALPHA)


def test_sorted_hashes_come_back_and_are_smaller():
    hashes = np.unique(np.random.default_rng(1).integers(0, 2**64, 100_000, np.uint64))[5000:50_000]
    counts = np.ones(len(hashes), np.uint32)
    for n in (0, 1, len(hashes)):
        back = lm.unpack_sorted(lm.pack_sorted(hashes[:n], counts[:n]), np.uint32)
        assert (back[0] == hashes[:n]).all() and (back[1] == counts[:n]).all()
    assert len(lm.pack_sorted(hashes, counts)) < len(blocks.pack(hashes, counts))
