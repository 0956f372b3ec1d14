"""Scores against counting by hand."""

import math
import random
from collections import Counter

import pytest
from odd import empty_documents, odd_documents

from strataglean.llm import blocks, lm


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words_of(text):
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(texts, order, alpha):
    docs = [words_of(lower(t)) for t in texts]

    def counts(ws):
        return Counter(tuple(ws[i:i + k]) for k in range(1, order + 1) for i in range(len(ws) - k + 1))

    total = Counter()
    for ws in docs:
        total.update(counts(ws))
    n = sum(map(len, docs))
    rows = []
    for ws in docs:
        rest, others, score, back, unseen = total - counts(ws), max(n - len(ws), 1), 0.0, 0, 0
        for i in range(len(ws)):
            longest = min(order, i + 1)
            for k in range(longest, -1, -1):
                gram = tuple(ws[i - k + 1:i + 1])
                if k == 0:
                    score += math.log(1 / others)
                elif rest[gram] > 0:
                    score += math.log(rest[gram] / (rest[gram[:-1]] if k > 1 else others))
                else:
                    score += math.log(alpha)
                    continue
                back += k < longest
                unseen += k == 0
                break
        rows.append((len(ws), round(score, 6), back, unseen))
    return rows


@pytest.mark.parametrize("order, block", [(1, 1), (2, 200), (2, 1 << 24), (3, 100), (4, 1 << 24)])
def test_scores_equal_brute_force(spark, monkeypatch, order, block):
    monkeypatch.setattr(blocks.gather, "__defaults__", (block,))
    monkeypatch.setattr(lm, "BUCKET_BYTES", 1000)
    pick = random.Random(order)
    more = [" ".join(pick.choice("a B c D e f g h".split()) for _ in range(pick.randrange(30))) for _ in range(30)]
    docs = odd_documents(spark, more).repartition(3)
    rows = docs.collect()
    got = sorted(((r.doc_id, r.n_words, round(r.log_score, 6), r.n_backoff, r.n_unseen)
                  for r in lm.score(docs, order).collect()), key=repr)
    want = sorted(((r.doc_id, *b) for r, b in zip(rows, brute([r.text for r in rows], order, lm.ALPHA))), key=repr)
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert all(abs(g[2] - w[2]) <= 1e-5 * max(1, abs(w[2])) for g, w in zip(got, want))


def test_empty_table(spark):
    assert lm.score(empty_documents(spark)).collect() == []
