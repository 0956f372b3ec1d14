"""Base counts, corpus statistics and verdicts against brute force."""

import math
import random
from collections import Counter

from odd import empty_documents, odd_documents

from strataglean.llm import quality_rules as rules

LABELS = "doc_id long, quality int, toxic int"


def words_of(text):
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute_counts(text):
    words = words_of(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if words_of(line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked)


TEXTS = ["a b c d e a b c d e f", "one two three four five six seven eight nine ten eleven", "x\nx\n \n \nx", "a a a a a a",
         "#*$ %&| <> ok", "A b C d E f G h I j K l", "good words come here and more of them follow on " * 2]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def test_verdicts(spark):
    docs = odd_documents(spark, TEXTS)
    rows = docs.collect()
    labels = spark.createDataFrame(
        [(10, 1, 0), (11, 1, 0), (11, 0, 0), (12, 0, 0), (13, 1, 1), (None, 1, 0), (4, None, 0), (16, 1, 0)], LABELS)
    good = {10, 11, 16}

    def grams(text):
        h = [rules.word_hash(lower(w).encode()) for w in words_of(text)]
        return [x % rules.BUCKETS for x in h] + [(a * rules.PAIR + b) % rules.BUCKETS for a, b in zip(h, h[1:])]

    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(grams(r.text or ""))
        if r.doc_id in good:
            target.update(grams(r.text or ""))

    smoothed = Counter({b: n + rules.WEIGHT * target[b] for b, n in raw.items()})

    def logp(counts, b):
        return math.log(counts[b] / sum(counts.values()))

    got = rules.apply_rules(docs, labels, "verdict").collect()
    assert len(got) == len(rows)
    for r in got:
        v, text = r.verdict, r.text or ""
        assert (v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words) == brute_counts(text)
        g = grams(text)
        want = sum(logp(smoothed, b) - logp(raw, b) for b in g) / len(g) if g else 0
        assert abs(v.score - want) < 1e-9
        failed = v.n_words < 10 or 100 * v.n_repeat_words > 20 * v.n_words
        assert v.base_failed == failed and v.kept == (not failed and want >= rules.THRESHOLD)


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert rules.apply_rules(empty_documents(spark), none, "v").count() == 0
    assert rules.apply_rules(odd_documents(spark), none, "v").count() == odd_documents(spark).count()


def test_a_repeated_corpus_gets_the_same_verdicts(spark):
    """Thirty times the same documents and labels, under ids of their own."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words[: 40 + 26 * (i % 11)], k=rng.randint(5, 40))) for i in range(90)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(0, 90, 2)]

    def verdicts(times):
        docs = spark.createDataFrame([(k * 1000 + i, t) for k in range(times) for i, t in enumerate(texts)], "doc_id long, text string")
        known = spark.createDataFrame([(k * 1000 + i, q, x) for k in range(times) for i, q, x in labels], LABELS)
        found = rules.apply_rules(docs, known, "v").selectExpr("doc_id % 1000 id", "v.score", "v.kept").distinct().collect()
        assert len(found) == len(texts)
        return {r.id: (r.score, r.kept) for r in found}

    once = verdicts(1)
    assert once == verdicts(30) and len({kept for _, kept in once.values()}) == 2
