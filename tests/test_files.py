"""Readers on lines that are not as they should be, and reports on layouts."""

from strataglean.operators import relational
from strataglean.sources import files


def test_vectors_of_odd_lines(spark):
    lines = ["9007199254740993, 2, 0.5, x, 1e3", "", "7", "a,b,c", "1,2"]
    got = [tuple(r) for r in files.parse_vectors(spark.createDataFrame([(x,) for x in lines], "value string")).collect()]
    assert got == [(9007199254740993, 2, [0.5, None, 1000.0]), (None, None, []), (7, None, []), (None, None, [None]), (1, 2, [])]


def test_transactions_of_odd_rows(spark, rows):
    data = [("11/20/2000", "0123 ", "00456"), ("11/20/2000", "0123 ", "456"), ("13/45/2000", "1", "2"), (None, "1", "2"),
            ("1/2/2001", "7", "abc"), ("1/2/2001", None, "3"), ("1/2/2001", "7", " 08 ")]
    raw = spark.createDataFrame(data, "date string, customer string, product string")
    assert rows(files.transaction_baskets(raw)) == [("1/2/01-7", "8"), ("11/20/00-0123", "456")]


def test_partition_profile_lists_empty_partitions(spark):
    df = spark.createDataFrame([(i % 3,) for i in range(50)], "k int").repartition(5)
    own = relational.partition_profile(df).collect()
    assert len(own) == 5 and sum(r["n_items"] for r in own) == 50 and {r["n_partition"] for r in own} == {5}
    placed = relational.partition_profile(df, "k", 8).collect()
    assert len(placed) == 8 and sum(r["n_items"] for r in placed) == 3 and min(r["n_items"] for r in placed) == 0
