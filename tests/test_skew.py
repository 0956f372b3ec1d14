import random
from collections import defaultdict
from itertools import combinations

from pyspark.sql import functions as F

from strataglean import skew


def _hot_pairs(seed=1):
    """Groups 0 (a third of all rows and more) .. 20 with members."""
    rng = random.Random(seed)
    rows = {(0, m) for m in range(40)} | {(1, m) for m in range(0, 40, 2)}
    rows |= {(rng.randrange(2, 20), rng.randrange(40)) for _ in range(90)}
    return sorted(rows)


def _shared(rows):
    groups, counts = defaultdict(set), defaultdict(int)
    for g, m in rows:
        groups[g].add(m)
    for members in groups.values():
        for pair in combinations(sorted(members), 2):
            counts[pair] += 1
    return counts


def test_pairs_of_split_groups_are_complete(spark, rows):
    data = _hot_pairs()
    df = spark.createDataFrame(data, "g int, m int")
    want = sorted((g, a, b) for g in {g for g, _ in data}
                  for a, b in combinations(sorted(m for h, m in data if h == g), 2))
    got = skew.pairs_within(df, ["g"], "m", rows_per_part=7)
    assert rows(got, "g", "a.m", "b.m") == want


def test_co_occurrence_with_hot_groups(spark, rows):
    data = _hot_pairs()
    df = spark.createDataFrame(data, "g int, m int")
    counts = _shared(data)
    for at_least in (1, 2, 3):
        want = sorted((a, b, n) for (a, b), n in counts.items() if n >= at_least)
        assert rows(skew.co_occurrence(df, "g", "m", at_least, group_rows=10)) == want


def test_spread_join(spark, rows):
    data = _hot_pairs()
    right = spark.createDataFrame(data, "g int, m int")
    left = spark.createDataFrame([(0, "x"), (0, "y"), (5, "z"), (99, "w")], "g int, t string")
    want = sorted((g, t, m) for g, t in [(0, "x"), (0, "y"), (5, "z")] for h, m in data if h == g)
    assert rows(skew.spread_join(left, right, ["g"], "m", rows_per_part=6), "g", "t", "m") == want


def test_numbering_and_running_sum(spark, rows):
    ids = [f"k{i:03d}" for i in range(200)]
    df = spark.createDataFrame([(i,) for i in random.Random(3).sample(ids, 200)], "id string").repartition(5)
    assert rows(skew.dense_number(df, ["id"], "n", start=0)) == [(k, i) for i, k in enumerate(ids)]
    sums = skew.running_sum(df.withColumn("v", F.lit(2)), ["id"], "v", "s")
    assert rows(sums, "id", "s") == [(k, 2 * (i + 1)) for i, k in enumerate(ids)]


def test_large_groups_come_in_pieces(spark):
    df = spark.createDataFrame(_hot_pairs(), "g int, m int")
    out = skew.pieces(df, ["g"], "m", "ms", piece_rows=12).filter("g < 2").collect()
    assert len(out) > 2 and sorted(m for r in out if r["g"] == 0 for m in r["ms"]) == list(range(40))


def test_pieces_follow_one_rule_at_all_sizes(spark):
    data = _hot_pairs()
    df = spark.createDataFrame(data, "g int, m int").repartition(4)
    groups = {}
    for g, m in data:
        groups.setdefault(g, []).append(m)
    for piece_rows in (1, 7, 1000):
        out = skew.pieces(df, ["g"], "m", "ms", piece_rows=piece_rows).collect()
        for g, members in groups.items():
            own = sorted((r["piece"], r["ms"], r["n"]) for r in out if r["g"] == g)
            assert [m for _, ms, _ in own for m in ms] == sorted(members)
            assert {n for _, _, n in own} == {len(members)}
            assert [p for p, _, _ in own] == list(range(len(own))) and all(len(ms) == piece_rows for _, ms, _ in own[:-1])


def test_hot_groups_keep_whole_sizes(spark, rows):
    data = [(g, i) for g, n in enumerate([9, 8, 8, 7, 2]) for i in range(n)]
    df = spark.createDataFrame(data, "g int, m int")
    assert rows(skew.hot_groups(df, "g", 3), "g") == [(0,), (1,), (2,), (3,)]
    assert rows(skew.hot_groups(df, "g", 3, 3), "g") == [(0,), (1,), (2,)]
    assert rows(skew.hot_groups(df, "g", 3, 2), "g") == [(0,)]  # two groups of one size stay together
    assert rows(skew.hot_groups(df, "g", 3, 0), "g") == []
