"""Trees, audits and round trips against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from strataglean.llm import warc

PAGES = "page_id long, url string, html string, record string, file string"


def pages(spark, n=300):
    rows = [(i, f"http://host{i % 3}/{i}", f"<p>page {i} é</p>" * (i % 7 + 1), "clash", "clash") for i in range(n)]
    rows += [rows[1]] * 200 + [(None, None, None, None, None), (7, None, "", "x", "y"), (8, "u\r\n\r\nv", "a\r\n\r\nb", "", "")]
    return spark.createDataFrame(rows, PAGES)


def test_records_round_trip(spark):
    made = warc.as_records(spark.createDataFrame(
        [(1, "http://a/b", "<p>é</p>\r\n\r\nmore\r\n", "c", "d"), (2, None, None, None, None)], PAGES))
    parts = sorted(map(tuple, warc.parse(made.select("record")).select("url", "payload", "intact").collect()))
    assert parts == [("", "", True), ("http://a/b", "<p>é</p>\r\n\r\nmore\r\n", True)]
    split = warc.as_records(spark.createDataFrame([(8, "u\r\n\r\nv", "body", "", "")], PAGES))
    assert warc.parse(split.select("record")).select("url", "payload").first() == ("u%0D%0A%0D%0Av", "body")
    text = made.filter("page_id = 1").first().record
    assert text.startswith("WARC/1.0\r\nWARC-Type: resource\r\n") and "Content-Length: 19\r\n\r\n" in text
    broken = made.selectExpr("replace(record, 'more', 'less') record")
    assert sorted(r.intact for r in warc.parse(broken).collect()) == [False, True]


def test_layout_has_no_gaps(spark):
    rows = warc.layout(pages(spark), 8000).collect()
    assert len(rows) == 303 and {r.n_copies for r in rows} == {1, 201}
    by_file = {}
    for r in rows:
        by_file.setdefault(r.file, []).append(r)
    assert len(by_file) > 5
    for own in by_file.values():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at
            at += r.n_bytes


@pytest.mark.parametrize("file_bytes, range_bytes, fan_out", [(8000, 500, 2), (8000, 100_000, 16), (1 << 30, 300, 3)])
def test_audit_finds_what_was_damaged(spark, file_bytes, range_bytes, fan_out):
    laid_out = warc.layout(pages(spark), file_bytes).select("page_id", "file", "start", "n_bytes", "sha256")
    rows = [tuple(r) for r in laid_out.collect()]
    pick = random.Random(1)
    bad, want = [], set()
    for page, file, start, n, digest in rows:
        case = pick.randrange(40)
        if case == 0:
            want.add((page, file, start, "missing"))
            continue
        if case == 1:
            want.add((page, file, start, "corrupt"))
            digest = "x"
        bad.append((page, file, start, n, digest))
    bad += [(999, 0, 10**7, 5, "new"), (998, 77, 0, 5, "new file")]
    want |= {(999, 0, 10**7, "extra"), (998, 77, 0, "extra")}
    replica = spark.createDataFrame(bad, laid_out.schema)
    got = warc.audit(laid_out, replica, range_bytes, fan_out)
    assert {(r.page_id, r.file, r.start, r.status) for r in got.collect()} == want
    # Only ranges that hold damage are looked into.
    ranges = {(r.file, r.node) for r in warc.differing_ranges(laid_out, replica, range_bytes, fan_out).collect()}
    assert ranges == {(file, start // range_bytes) for _, file, start, _ in want}
    assert warc.audit(laid_out, laid_out, range_bytes, fan_out).count() == 0


def test_empty_archives(spark):
    none = warc.layout(spark.createDataFrame([], PAGES))
    assert warc.audit(none, none).count() == 0
    some = warc.layout(pages(spark, 3))
    assert {r.status for r in warc.audit(some, none).collect()} == {"missing"}
    assert warc.audit(none, some).count() == some.count()
    assert warc.replica(warc.damaged_copy(spark.createDataFrame([], PAGES)), none).count() == 0


def test_known_damage_is_found(spark):
    table = pages(spark)
    first = warc.layout(table, 8000)
    rows = warc.audit(first, warc.replica(warc.damaged_copy(table), first), 500, 2).collect()
    assert {(r.page_id, r.status) for r in rows} == {
        (i, s) for k, s in ((0, "corrupt"), (1, "missing"), (2, "corrupt"), (3, "extra")) for i in range(k, 300, 97)}
    ends = {r.file: r.end for r in first.groupBy("file").agg(F.max(F.expr("start + n_bytes")).alias("end")).collect()}
    for r in rows:
        assert (r.start >= ends[r.file]) == (r.status == "extra")
    # The copies of page 1 are lost as one record.
    assert sum(r.page_id == 1 for r in rows) == 1


@pytest.mark.parametrize("page", [50, 131, None])
def test_damage_at_any_page_is_found(spark, page):
    table = pages(spark).filter("coalesce(page_id, 99) % 97 > 3 or page_id is null")
    first = warc.layout(table, 8000)
    stored = warc.damaged_copy(table)
    assert warc.audit(first, warc.replica(stored, first), 500, 2).count() == 0
    hit = F.col("page_id").eqNullSafe(F.lit(page))
    changed = stored.withColumn("record", F.when(hit, F.overlay("record", F.lit("#"), F.length("record") - 5))
                                .otherwise(F.col("record")))
    got = warc.audit(first, warc.replica(changed, first), 500, 2).collect()
    assert [(r.page_id, r.status) for r in got] == [(page, "corrupt")] and got[0].n_bytes == got[0].n_bytes_found
    lost = warc.audit(first, warc.replica(stored.filter(~hit), first), 500, 2).collect()
    assert [(r.page_id, r.status) for r in lost] == [(page, "missing")]
