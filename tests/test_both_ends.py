"""Random shortest paths are searched from both ends, so that a search stays near its pair."""

from strataglean.operators import graph


def test_a_search_stays_between_its_ends(spark, rows):
    """Before, the search from the root held all nodes as near as the target."""
    pairs = [(0, 1), (1, 2)] + [(0, i) for i in range(10, 30)] + [(i, 100 * i + k) for i in range(10, 30) for k in range(5)]
    links = graph._spread_links(spark.createDataFrame(pairs, "src long, dst long"), None)
    wanted = spark.createDataFrame([(7, 0, 2), (8, 2, 1000), (9, 0, 1)], "sample long, root long, target long")
    levels, met = graph._both_ends(links, wanted)
    assert {r["sample"]: r["ahead"] + r["behind"] for r in met.collect()} == {7: 2, 8: 4, 9: 1}
    assert levels.filter("sample = 7").count() < 30  # of 123 nodes, 23 and more of them at distance 2 of the root at most
    assert rows(graph._walk_back(links, wanted), "sample", "src", "dst") == [
        (7, 0, 1), (7, 1, 2), (8, 0, 1), (8, 0, 10), (8, 1, 2), (8, 10, 1000), (9, 0, 1)]
