"""Frequent itemsets: level-wise and two-pass partitioned, over distinct (basket, item) rows.

Support counts baskets, so a row that repeats would count twice: the operators that begin
from baskets drop repeated rows themselves.

A k-itemset that occurs in a basket is a row (basket, prefix, last): the sorted
first k-1 items and the largest one. Two rows of a basket that share their
prefix grow into one row of the next level, so each itemset arises once. In small baskets the rows
of a prefix are one list, (basket, prefix, lasts).
"""

from __future__ import annotations

import math
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataglean.session import cut_lineage
from strataglean.skew import co_occurrence, fits, hot_groups, pairs_within

# Larger baskets are counted by looking candidates up, not by growing their subsets.
HEAVY_BASKET_ITEMS = 500
# Rows of a chunk that one task holds in memory.
CHUNK_ROWS = 200_000
# Least share of the support, in baskets, at which a chunk is mined by itself.
LOCAL_FLOOR = 8
# Itemsets of which every task gets a copy.
TASK_SETS = 100_000


def _itemset():
    return F.concat("prefix", F.array("last")).alias("itemset")


def basket_pairs(rows: DataFrame, user: str, item: str, case: int = 1) -> DataFrame:
    """Distinct ``basket, item``: items per user (case 1) or users per item (case 2)."""
    basket, member = (user, item) if case == 1 else (item, user)
    return rows.select(F.col(basket).alias("basket"), F.col(member).alias("item")).distinct()


def min_size_baskets(baskets: DataFrame, more_than: int) -> DataFrame:
    """Rows of the baskets with more than ``more_than`` distinct items."""
    baskets = baskets.select("basket", "item").distinct()
    sizes = baskets.groupBy("basket").agg(F.count(F.lit(1)).alias("n"))
    return baskets.join(sizes.filter(F.col("n") > more_than).select("basket"), "basket", "left_semi")


def max_basket_size(baskets: DataFrame) -> DataFrame:
    sizes = baskets.groupBy("basket").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n").alias("max_size"))


def item_counts(baskets: DataFrame, support: int = 1) -> DataFrame:
    """``item, support`` of items in at least ``support`` baskets; rows have to be distinct."""
    return (
        baskets.groupBy("item").agg(F.count(F.lit(1)).alias("support"))
        .filter(F.col("support") >= support)
    )


def frequent_pairs(baskets: DataFrame, support: int) -> DataFrame:
    """``itemset, support`` of pairs in at least ``support`` baskets."""
    baskets = baskets.select("basket", "item").distinct()
    pruned = baskets.join(item_counts(baskets, support).select("item"), "item", "left_semi")
    return co_occurrence(pruned, "basket", "item", support, HEAVY_BASKET_ITEMS).select(
        F.array("member_1", "member_2").alias("itemset"), F.col("shared").alias("support")
    )


def subset_support(itemsets: DataFrame, baskets: DataFrame) -> DataFrame:
    """``itemset, support``: baskets that contain every item of the given sets.

    A set begins with the baskets of its rarest item; only for them the others are looked up: in the
    basket itself where the sets are few enough for every task, so that baskets are all that is shuffled, else
    and in baskets of more than HEAVY_BASKET_ITEMS items by a join. ``baskets`` are distinct (basket, item) rows.
    """
    items = itemsets.select("itemset").distinct().select("itemset", F.explode("itemset").alias("item"))
    counted = items.join(item_counts(baskets), "item").groupBy("itemset").agg(
        F.min_by("item", F.struct("support", "item")).alias("rare"), F.count(F.lit(1)).alias("known"))
    begun = counted.filter(F.col("known") == F.size("itemset")).select(
        "itemset", F.col("rare").alias("item"), F.array_remove("itemset", F.col("rare")).alias("others"))
    begun = cut_lineage(begun)
    if not fits(begun, TASK_SETS):
        return _looked_up(begun, baskets).groupBy("itemset").agg(F.count(F.lit(1)).alias("support"))
    heavy = hot_groups(baskets, "basket", HEAVY_BASKET_ITEMS).select("basket")
    light, apart = baskets.filter("basket is not null"), baskets.filter("basket is null")
    if not heavy.isEmpty():
        light = light.join(heavy, "basket", "left_anti")
        apart = apart.unionByName(baskets.join(heavy, "basket", "left_semi"))
    whole = light.groupBy("basket").agg(F.collect_list("item").alias("items"))
    met = whole.select("items", F.explode("items").alias("item")).join(F.broadcast(begun), "item")
    found = met.filter(F.size(F.array_except("others", "items")) == 0).select("itemset")
    found = found.unionByName(_looked_up(begun, apart).select("itemset"))
    return found.groupBy("itemset").agg(F.count(F.lit(1)).alias("support"))


def _looked_up(begun: DataFrame, baskets: DataFrame) -> DataFrame:
    """``itemset, basket``: the baskets that hold a set's first ``item`` and its ``others``."""
    met = begun.join(baskets, "item")
    single = met.filter(F.size("others") == 0).select("itemset", "basket")
    several = (
        met.select("itemset", "basket", F.size("others").alias("left"), F.explode("others").alias("item"))
        .join(baskets, ["basket", "item"])
        .groupBy("itemset", "basket", "left").agg(F.count(F.lit(1)).alias("hits"))
        .filter(F.col("hits") == F.col("left")).select("itemset", "basket")
    )
    return single.unionByName(several)


def pair_candidates(items: DataFrame) -> DataFrame:
    """``itemset``: all two-item sets of a list of (frequent) items.

    The list has at most rows / support items, however large the baskets table.
    """
    listed = items.select(F.lit(0).alias("all"), "item")
    return pairs_within(listed, ["all"], "item").select(F.array("a.item", "b.item").alias("itemset"))


def join_candidates(frequent: DataFrame) -> DataFrame:
    """``itemset``: unions of two frequent (k-1)-sets that have size k, for k >= 3."""
    dropped = frequent.select("itemset", F.explode("itemset").alias("item")).select(
        F.array_remove("itemset", F.col("item")).alias("rest"), "item"
    )
    return (
        pairs_within(dropped, ["rest"], "item")
        .select(F.array_sort(F.concat("rest", F.array("a.item", "b.item"))).alias("itemset"))
        .distinct()
    )


def _single(lists: DataFrame) -> DataFrame:
    return lists.select("basket", "prefix", F.explode("lasts").alias("last"))


def _grow(rows: DataFrame, small: bool) -> DataFrame:
    """Occurrences one item longer, made inside each (basket, prefix).

    In small baskets they are lists, and a list of occurrences grows by itself, without a shuffle; else rows.
    """
    if small:
        return rows.filter(F.size("lasts") > 1).select("basket", "prefix", "lasts", F.posexplode("lasts").alias("at", "a")).select(
            "basket", F.concat("prefix", F.array("a")).alias("prefix"),
            F.slice("lasts", F.col("at") + 2, F.size("lasts")).alias("lasts")).filter(F.size("lasts") > 0)
    return pairs_within(rows, ["basket", "prefix"], "last").select(
        "basket", F.concat("prefix", F.array("a.last")).alias("prefix"), F.col("b.last").alias("last"))


def _keep(rows: DataFrame, itemsets: DataFrame, small: bool) -> DataFrame:
    """The occurrences of the given itemsets."""
    wanted = itemsets.select(
        F.slice("itemset", F.lit(1), F.size("itemset") - 1).alias("prefix"), F.element_at("itemset", -1).alias("last"))
    if not small:
        return rows.join(wanted, ["prefix", "last"], "left_semi").select("basket", "prefix", "last")
    allowed = wanted.groupBy("prefix").agg(F.collect_set("last").alias("allowed"))
    return rows.join(allowed, "prefix").select(
        "basket", "prefix", F.array_intersect("lasts", "allowed").alias("lasts")).filter(F.size("lasts") > 0)


def _counted(rows: DataFrame, small: bool) -> DataFrame:
    """``itemset, support`` of the occurrences."""
    each = _single(rows) if small else rows
    return each.groupBy("prefix", "last").agg(F.count(F.lit(1)).alias("support")).select(_itemset(), "support")


def _split_heavy(
    baskets: DataFrame, support: int
) -> tuple[DataFrame, DataFrame | None, int, bool]:
    """Rows of ordinary baskets, rows of the heavy ones, how many heavy ones, and
    whether all ordinary baskets are known to be small.

    At most half of ``support`` baskets are set apart: a frequent set then occurs in half as
    many ordinary baskets, so that these still prune. If there are more large baskets than
    that, the rest stays and its pairs are made by many tasks.
    """
    heavy = hot_groups(baskets, "basket", HEAVY_BASKET_ITEMS, support // 2).select("basket")
    n = heavy.count()
    small = n == hot_groups(baskets, "basket", HEAVY_BASKET_ITEMS).count()
    if n == 0:
        return baskets, None, 0, small
    return (baskets.join(heavy, "basket", "left_anti"),
            cut_lineage(baskets.join(heavy, "basket", "left_semi")), n, small)


def _with_heavy(counted: DataFrame, heavy: DataFrame | None) -> DataFrame:
    """Add the support found in heavy baskets to that of ordinary ones."""
    if heavy is None:
        return counted
    found = subset_support(counted, heavy).withColumnRenamed("support", "extra")
    return counted.join(found, "itemset", "left").select(
        "itemset", (F.col("support") + F.coalesce("extra", F.lit(0))).alias("support")
    )


def _first_level(rows: DataFrame, small: bool) -> DataFrame:
    last, nothing = F.col("item").cast("string"), F.expr("cast(array() as array<string>)").alias("prefix")
    if not small:
        return rows.select("basket", nothing, last.alias("last"))
    # Rows without a basket are none together: each is a list of its own, which never grows.
    lists = rows.groupBy("basket", F.when(F.col("basket").isNull(), last).alias("own")).agg(
        F.array_sort(F.collect_list(last)).alias("lasts"))
    return cut_lineage(lists.select("basket", nothing, "lasts"))


def _text_items(baskets: DataFrame) -> DataFrame:
    return baskets.select("basket", F.col("item").cast("string").alias("item")).distinct()


def apriori(baskets: DataFrame, support: int, max_k: int | None = None) -> DataFrame:
    """``k, itemset, support``: all itemsets in at least ``support`` baskets.

    Level by level until one is empty or ``max_k`` is reached; the driver sees
    one row count per level.
    """
    baskets = _text_items(baskets)
    pruned = cut_lineage(
        baskets.join(item_counts(baskets, support).select("item"), "item", "left_semi")
    )
    ones = item_counts(pruned).select(F.array("item").alias("itemset"), "support")
    levels = [ones.select(F.lit(1).alias("k"), "itemset", "support")]
    light, heavy, n_heavy, small = _split_heavy(pruned, support)
    rows, k = _first_level(light, small), 2
    while max_k is None or k <= max_k:
        grown = _grow(rows, small)
        counted = _counted(grown, small).filter(F.col("support") >= max(support - n_heavy, 1))
        if heavy is not None:
            counted = _with_heavy(cut_lineage(counted), heavy)
        frequent = cut_lineage(counted.filter(F.col("support") >= support))
        if frequent.isEmpty():
            break
        levels.append(frequent.select(F.lit(k).alias("k"), "itemset", "support"))
        rows = _keep(grown, frequent, small)
        # Deeper levels would otherwise repeat the growth of all levels before them.
        if max_k is None or k < max_k:
            rows = cut_lineage(rows)
        k += 1
    return reduce(DataFrame.unionByName, levels)


def candidate_report(baskets: DataFrame, support: int, max_k: int | None = None) -> DataFrame:
    """``k, itemset, is_frequent``: every level's candidates, marked if frequent.

    Level 1 lists all items, level 2 all pairs of frequent items, level k >= 3
    the unions of two frequent sets of the level before. A level without
    frequent sets still lists its candidates, and is the last.
    """
    baskets = _text_items(baskets)
    frequent = cut_lineage(apriori(baskets, support, max_k))
    top = frequent.agg(F.max("k")).first()[0] or 0
    levels = [item_counts(baskets).select(F.lit(1).alias("k"), F.array("item").alias("itemset"))]
    last = top + 1 if max_k is None else min(top + 1, max_k)
    for k in range(2, last + 1):
        before = frequent.filter(F.col("k") == k - 1)
        made = (
            pair_candidates(before.select(F.col("itemset")[0].alias("item")))
            if k == 2 else join_candidates(before)
        )
        levels.append(made.select(F.lit(k).alias("k"), "itemset"))
    marked = frequent.select("k", "itemset", F.lit(True).alias("_f"))
    return (
        reduce(DataFrame.unionByName, levels)
        .join(marked, ["k", "itemset"], "left")
        .select("k", "itemset", F.coalesce("_f", F.lit(False)).alias("is_frequent"))
    )


def local_itemsets(baskets: pd.Series, items: pd.Series, support: int, max_k: int | None = None) -> list[tuple]:
    """Sorted itemsets in at least ``support`` of a chunk's baskets.

    An itemset's baskets are the bits of one integer; longer sets come from two sets that
    differ in their last item only.
    """
    number = {b: i for i, b in enumerate(dict.fromkeys(baskets))}
    where: dict[tuple, int] = {}
    for basket, item in zip(baskets, items):
        where[item,] = where.get((item,), 0) | 1 << number[basket]
    level = sorted((s, bits) for s, bits in where.items() if bits.bit_count() >= support)
    found = [s for s, _ in level]
    while level and (max_k is None or len(level[0][0]) < max_k):
        longer = []
        for i, (s, bits) in enumerate(level):
            for other, more in level[i + 1:]:
                if other[:-1] != s[:-1]:
                    break
                if (bits & more).bit_count() >= support:
                    longer.append(((*s, other[-1]), bits & more))
        level = longer
        found += [s for s, _ in level]
    return found


def son(
    baskets: DataFrame, support: int, chunks: int = 8, max_k: int | None = None, floor: int = LOCAL_FLOOR
) -> DataFrame:
    """``k, itemset, support``: the same result by two passes over chunks of baskets.

    Pass 1 finds the sets frequent inside any chunk at proportional support, each chunk
    in one task's memory; a globally frequent set is frequent in at least one chunk. A chunk
    has at most about CHUNK_ROWS rows, so there may be more of them than asked for. Pass 2
    counts these candidates over all baskets. Heavy baskets take part in pass 2 only, and
    pass 1 asks for correspondingly less.

    At a small share nearly every subset of a basket would be frequent in its chunk, and mining
    would list them all. Where a chunk's share is below ``floor`` baskets no chunk is mined: pass 2
    then counts on each level the whole negative border of the level before, that is every set that
    occurs and whose subsets are frequent, and goes on only where one of them is (:func:`apriori`).
    """
    baskets = _text_items(baskets)
    pruned = cut_lineage(
        baskets.join(item_counts(baskets, support).select("item"), "item", "left_semi")
    )
    light, heavy, n_heavy, small = _split_heavy(pruned, support)
    need = max(support - n_heavy, 1)
    rows, total = light.count(), light.select("basket").distinct().count()
    n_chunks = max(chunks, -(-rows // CHUNK_ROWS))
    parted = light.withColumn("chunk", F.pmod(F.xxhash64("basket"), F.lit(n_chunks)).cast("int"))

    least = parted.groupBy("chunk").agg(F.countDistinct("basket").alias("n")).agg(F.min("n")).first()[0] or 0
    if need * least / max(total, 1) <= floor - 1:
        return apriori(baskets, support, max_k)

    def local(frame: pd.DataFrame) -> pd.DataFrame:
        share = need * frame["basket"].nunique() / max(total, 1)
        found = local_itemsets(frame["basket"], frame["item"], max(math.ceil(share - 1e-9), 1), max_k)
        return pd.DataFrame({"k": [len(x) for x in found], "itemset": [list(x) for x in found]})

    found = cut_lineage(
        parted.groupBy("chunk").applyInPandas(local, "k int, itemset array<string>").distinct())
    deepest = found.agg(F.max("k")).first()[0] or 0
    candidates = [found.filter(F.col("k") == k).select("itemset") for k in range(1, deepest + 1)]

    everywhere, levels = _first_level(light, small), []
    for k, wanted in enumerate(candidates, start=1):
        if k > 1:
            everywhere = _grow(everywhere, small)
        everywhere = cut_lineage(_keep(everywhere, wanted, small))
        counted = _with_heavy(_counted(everywhere, small), heavy)
        levels.append(
            counted.filter(F.col("support") >= support).select(F.lit(k).alias("k"), "itemset", "support")
        )
    if not levels:
        return item_counts(pruned, support).select(
            F.lit(1).alias("k"), F.array("item").alias("itemset"), "support"
        )
    return reduce(DataFrame.unionByName, levels)
