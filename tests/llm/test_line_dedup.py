"""Removed lines against brute force over all pairs of lines."""

import random

import pytest
from odd import empty_documents, odd_documents
from pyspark.sql import functions as F

from strataglean.llm import line_dedup as dedup


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def brute(rows):
    """(doc_id, line number) of lines with an equal or near line at an earlier place."""
    lines = []
    for doc_id, text in rows:
        for i, line in enumerate((text or "").split("\n") if text is not None else []):
            line = line.strip(dedup.BLANK)
            if len(line) >= dedup.MIN_CHARS:
                lines.append(((doc_id, i), line))
    gone = set()
    for place, line in lines:
        for other, second in lines:
            if other < place and (line == second or (
                    min(len(line), len(second)) >= dedup.NEAR_CHARS and abs(len(line) - len(second)) <= dedup.DISTANCE
                    and distance(line, second) <= dedup.DISTANCE)):
                gone.add(place)
                break
    return gone


def edited(pick, line, n):
    line = list(line)
    for _ in range(n):
        at = pick.randrange(len(line) + 1)
        kind = pick.randrange(3)
        if kind == 0:
            line.insert(at, pick.choice("abé "))
        elif line:
            at = min(at, len(line) - 1)
            line[at:at + 1] = [] if kind == 1 else [pick.choice("xyzü ")]
    return "".join(line)


def corpus(seed):
    pick = random.Random(seed)
    base = [" ".join(pick.choice(["alpha", "beta", "gamma", "délta", "eps"]) + str(pick.randrange(9))
                     for _ in range(pick.randrange(3, 14))) for _ in range(12)]
    rows = []
    for doc_id in range(30):
        lines = [edited(pick, pick.choice(base), pick.randrange(4)) for _ in range(pick.randrange(4))]
        rows.append((doc_id, "\n".join([*lines, "short line", "", "  " + pick.choice(base) + "\t"])))
    return rows


@pytest.mark.parametrize("seed, hot", [(1, 64), (2, 64), (3, 2), (4, 2), (5, 1)])
def test_removed_lines_equal_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(dedup, "HOT_KEY", hot)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.line_no) for r in dedup.repeated_lines(docs).collect()}
    assert got == brute(rows) and got


def test_texts_without_the_lines(spark):
    rows = corpus(7)
    gone = brute(rows)
    docs = spark.createDataFrame([(*r, "a", "b") for r in rows], "doc_id long, text string, gone string, print string")
    kept = dedup.remove_repeated_lines(docs)
    assert kept.columns == docs.columns
    want = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in rows}
    assert {r.doc_id: r.text for r in kept.collect()} == want


def test_odd_documents(spark):
    line = "this very line stands in several places of it"
    docs = odd_documents(spark, [line, f"{line}\n{line}", f"begin\n  {line} \nend"])
    before = {(r.doc_id, r.text) for r in docs.collect()}
    kept = dedup.remove_repeated_lines(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert (10, line) in rows and (11, "") in rows and (12, "begin\nend") in rows
    assert {r for r in before if r[0] not in (11, 12)} == {r for r in rows if r[0] not in (11, 12)}


def test_null_ids_are_last_and_equal_rows_alike(spark):
    line = "a line that is long enough to be compared with others"
    docs = spark.createDataFrame([(None, line), (3, line), (3, line), (5, line)], "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in dedup.remove_repeated_lines(docs).collect()]
    assert sorted(got, key=repr) == sorted([(None, ""), (3, line), (3, line), (5, "")], key=repr)


def test_segments_cover_the_line(spark):
    for n in (40, 41, 42, 100):
        cuts = [dedup.segment(F.lit(n), F.lit(i), 3) for i in range(3)]
        row = spark.range(1).select(*[F.struct(a.alias("a"), w.alias("w")) for a, w in cuts]).first()
        at = 1
        for start, width in row:
            assert start == at
            at += width
        assert at == n + 1


def test_empty_table(spark):
    assert dedup.remove_repeated_lines(empty_documents(spark)).count() == 0
