import random
from itertools import combinations

import pytest

from strataglean.operators import itemsets


def _frame(spark, baskets):
    return spark.createDataFrame([(i, x) for i, b in enumerate(baskets) for x in set(b)], "basket int, item string")


def _frequent(baskets, support):
    out, sets = {}, [set(b) for b in baskets]
    items = sorted(set().union(*sets))
    for k in range(1, len(items) + 1):
        found = {c: n for c in combinations(items, k) if (n := sum(set(c) <= b for b in sets)) >= support}
        if not found:
            break
        out.update(found)
    return sorted((len(c), ",".join(c), n) for c, n in out.items())


def _got(df):
    return sorted((r["k"], ",".join(r["itemset"]), r["support"]) for r in df.collect())


SMALL = ["abc", "abd", "ab", "bcd", "acd"]


def test_known_answer(spark):
    df = _frame(spark, SMALL)
    want = [(1, "a", 4), (1, "b", 4), (1, "c", 3), (1, "d", 3), (2, "a,b", 3), (2, "a,c", 2), (2, "a,d", 2),
            (2, "b,c", 2), (2, "b,d", 2), (2, "c,d", 2)]
    assert _got(itemsets.apriori(df, 2)) == want
    report = itemsets.candidate_report(df, 2).collect()
    assert sum(r["k"] == 3 for r in report) == 4 and not any(r["is_frequent"] for r in report if r["k"] == 3)
    assert itemsets.max_basket_size(df).first()[0] == 3
    assert {r["basket"] for r in itemsets.min_size_baskets(df, 2).collect()} == {0, 1, 3, 4}


@pytest.mark.parametrize("heavy", [500, 4])
def test_apriori_and_son_match_brute_force(spark, monkeypatch, heavy):
    """With heavy = 4 some baskets are counted by lookup instead of growth."""
    monkeypatch.setattr(itemsets, "HEAVY_BASKET_ITEMS", heavy)
    rng = random.Random(5)
    baskets = ["".join(rng.sample("abcdefg", rng.randint(1, 4))) for _ in range(30)] + ["abcdefg", "abcdef"]
    df, want = _frame(spark, baskets), _frequent(baskets, 6)
    assert _got(itemsets.apriori(df, 6)) == want
    assert _got(itemsets.son(df, 6, 3)) == want
    pairs = sorted((",".join(r["itemset"]), r["support"]) for r in itemsets.frequent_pairs(df, 6).collect())
    assert pairs == [(s, n) for k, s, n in want if k == 2]


def test_more_heavy_baskets_than_support(spark, monkeypatch):
    monkeypatch.setattr(itemsets, "HEAVY_BASKET_ITEMS", 2)
    baskets = ["abcd", "abce", "abde", "acde", "bc"]
    assert _got(itemsets.apriori(_frame(spark, baskets), 2)) == _frequent(baskets, 2)


def test_same_sets_as_fpgrowth(spark):
    from pyspark.ml.fpm import FPGrowth
    baskets = ["abc", "abd", "ab", "bcd", "acd", "abcd"]
    rows = spark.createDataFrame([(list(b),) for b in baskets], "items array<string>")
    model = FPGrowth(itemsCol="items", minSupport=0.5).fit(rows)
    want = sorted((len(r["items"]), ",".join(sorted(r["items"])), r["freq"]) for r in model.freqItemsets.collect())
    assert _got(itemsets.apriori(_frame(spark, baskets), 3)) == want


def test_repeated_rows_count_once(spark):
    rows = [(0, "a"), (0, "a"), (0, "b"), (0, "b"), (1, "a"), (1, "c")]
    df = spark.createDataFrame(rows, "basket int, item string")
    want = _frequent(["ab", "ac"], 2)
    assert _got(itemsets.apriori(df, 2)) == _got(itemsets.son(df, 2, 2)) == want
    assert itemsets.frequent_pairs(df, 2).count() == 0
    assert itemsets.min_size_baskets(df, 2).count() == 0


def test_more_heavy_baskets_than_support(spark, monkeypatch):
    monkeypatch.setattr(itemsets, "HEAVY_BASKET_ITEMS", 3)
    rng = random.Random(6)
    baskets = [rng.sample("abcdefghij", rng.randrange(1, 8)) for _ in range(30)]
    for support in (2, 4, 9):
        want = _frequent(baskets, support)
        assert _got(itemsets.apriori(_frame(spark, baskets), support)) == want
        assert _got(itemsets.son(_frame(spark, baskets), support, 3)) == want


def test_chunks_are_as_small_as_asked(spark, monkeypatch):
    monkeypatch.setattr(itemsets, "CHUNK_ROWS", 7)
    assert _got(itemsets.son(_frame(spark, SMALL), 2, 1)) == _frequent(SMALL, 2)


def test_subsets_with_unknown_and_single_items(spark):
    wanted = spark.createDataFrame([(["a"],), (["a", "b"],), (["a", "b", "c"],), (["a", "z"],)], "itemset array<string>")
    got = {",".join(r["itemset"]): r["support"] for r in itemsets.subset_support(wanted, _frame(spark, SMALL)).collect()}
    assert got == {"a": 4, "a,b": 3, "a,b,c": 1}


def test_son_ends_at_a_small_share(spark, rows):
    """One basket of twenty items has a million subsets; none of them is in a second basket."""
    wide = [(0, f"i{n:02d}") for n in range(20)]
    others = [(b, f"i{n:02d}") for b in range(1, 24) for n in ((b % 20), (b + 1) % 20)]
    baskets = spark.createDataFrame(wide + others, "basket int, item string")
    found = itemsets.son(baskets, 2, chunks=8)
    assert rows(found.selectExpr("k", "array_join(itemset, ',') i", "support")) == rows(
        itemsets.apriori(baskets, 2).selectExpr("k", "array_join(itemset, ',') i", "support"))


def test_son_mines_chunks_whatever_the_floor(spark, rows):
    baskets = spark.createDataFrame(
        [(b, f"i{n}") for b in range(60) for n in range(6) if (b * 7 + n * 3) % 5 < 3], "basket int, item string")
    plain = rows(itemsets.apriori(baskets, 12).selectExpr("k", "array_join(itemset, ',') i", "support"))
    for floor in (1, 3, 100):
        found = itemsets.son(baskets, 12, chunks=3, floor=floor)
        assert rows(found.selectExpr("k", "array_join(itemset, ',') i", "support")) == plain



def test_small_baskets_grow_without_a_shuffle(spark):
    """Lists of a basket's items grow in place; rows without a basket are no basket together."""
    rows = spark.createDataFrame([*[(b, i) for b in (1, 2) for i in "abcd"], (3, "a"), (None, "a"), (None, "b")], "basket int, item string")
    first = itemsets._first_level(rows, True)
    grown = itemsets._grow(itemsets._grow(first, True), True)
    assert "Exchange" not in grown._jdf.queryExecution().executedPlan().toString()
    got = {tuple(r["itemset"]): r["support"] for r in itemsets._counted(grown, True).collect()}
    assert got == {t: 2 for t in combinations("abcd", 3)}
    assert {tuple(r["itemset"]): r["support"] for r in itemsets._counted(first, True).collect()} == {
        ("a",): 4, ("b",): 3, ("c",): 2, ("d",): 2}
    pairs = {tuple(r["itemset"]): r["support"] for r in itemsets.apriori(rows, 2, 2).filter("k = 2").collect()}
    assert pairs == {t: 2 for t in combinations("abcd", 2)}


def test_subset_support_joins_no_pairs_of_sets_and_items(spark, monkeypatch):
    wanted = [("a",), ("a", "b"), ("a", "b", "c"), ("a", "z"), ("c", "d")]
    rows = [*[(b, i) for b in range(6) for i in "abcd"[: 1 + b % 4]], (None, "a"), (None, "b"), *[(9, f"x{i}") for i in range(8)], (9, "a")]
    baskets = spark.createDataFrame(rows, "basket int, item string")
    sets = spark.createDataFrame([(list(w),) for w in wanted], "itemset array<string>")
    truth = {w: sum(set(w) <= {i for b, i in rows if b == k} for k in {b for b, _ in rows} - {None}) for w in wanted}
    truth = {w: n for w, n in truth.items() if n} | {("a",): truth["a",] + 1}
    for heavy in (500, 5):
        monkeypatch.setattr(itemsets, "HEAVY_BASKET_ITEMS", heavy)
        for most in (100, 1):
            monkeypatch.setattr(itemsets, "TASK_SETS", most)
            found = itemsets.subset_support(sets, baskets)
            assert {tuple(r["itemset"]): r["support"] for r in found.collect()} == truth
