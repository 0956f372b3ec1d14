"""Baskets of brands per order: frequent itemsets and their parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataglean.operators import itemsets as sets_
from strataglean.plans.explore import basket_preprocess
from strataglean.session import cut_lineage
from strataglean.skew import pieces
from strataglean.sources import roles

# Supports as shares of the number of baskets: (numerator, denominator).
PAIR_SUPPORT = (20, 1000)
DEEP_SUPPORT = (27, 10000)


def _baskets(spark, sf):
    """Kept, because the support is a share of their number and levels read them again."""
    return cut_lineage(roles.baskets(spark, sf))


def _support(baskets, share):
    return max(baskets.select("basket").distinct().count() * share[0] // share[1], 1)


def _text(df, *keep):
    return df.select(*[F.col(c).cast("bigint").alias(c) for c in keep if c in ("k", "support")],
                     F.array_join("itemset", ",").alias("itemset"),
                     *[c for c in keep if c not in ("k", "support")])


def collect_baskets(spark, sf):
    """Items per user (case 1) and users per item (case 2)."""
    reviews = roles.reviews(spark, sf)
    both = [
        pieces(sets_.basket_pairs(reviews, "user_id", "item_id", case), ["basket"], "item", "items")
        .select(F.lit(case).cast("bigint").alias("case"), "basket", "piece", "n", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"))
        for case in (1, 2)
    ]
    return both[0].unionByName(both[1])


def max_basket_size(spark, sf):
    return sets_.max_basket_size(_baskets(spark, sf))


def min_size_baskets(spark, sf):
    return sets_.min_size_baskets(_baskets(spark, sf), 6)


def item_counts(spark, sf):
    baskets = _baskets(spark, sf)
    return sets_.item_counts(baskets, _support(baskets, PAIR_SUPPORT))


def pair_candidates(spark, sf):
    baskets = _baskets(spark, sf)
    return _text(sets_.pair_candidates(sets_.item_counts(baskets, _support(baskets, PAIR_SUPPORT))))


def itemsets_k2(spark, sf):
    baskets = _baskets(spark, sf)
    return _text(sets_.frequent_pairs(baskets, _support(baskets, PAIR_SUPPORT)), "support")


def subset_support(spark, sf):
    baskets = _baskets(spark, sf)
    wanted = sets_.pair_candidates(sets_.item_counts(baskets, _support(baskets, PAIR_SUPPORT)))
    return _text(sets_.subset_support(wanted, baskets), "support")


def itemsets_k3(spark, sf):
    baskets = _baskets(spark, sf)
    return _text(sets_.apriori(baskets, _support(baskets, DEEP_SUPPORT), 3).filter("k = 3"), "support")


def apriori_all(spark, sf):
    baskets = _baskets(spark, sf)
    return _text(sets_.apriori(baskets, _support(baskets, DEEP_SUPPORT)), "k", "support")


def son_two_pass(spark, sf):
    baskets = _baskets(spark, sf)
    return _text(sets_.son(baskets, _support(baskets, DEEP_SUPPORT), 4), "k", "support")


def itemset_candidates(spark, sf):
    baskets = _baskets(spark, sf)
    return _text(sets_.candidate_report(baskets, _support(baskets, PAIR_SUPPORT)), "k", "is_frequent")


def transaction_itemsets(spark, sf):
    """Raw transactions to baskets, those with more than two items, and their frequent itemsets."""
    baskets = cut_lineage(sets_.min_size_baskets(basket_preprocess(spark, sf), 2))
    return _text(sets_.apriori(baskets, 2), "k", "support")


QUERIES = {
    "transaction_itemsets": transaction_itemsets,
    "collect_baskets": collect_baskets, "max_basket_size": max_basket_size,
    "min_size_baskets": min_size_baskets, "item_counts": item_counts,
    "pair_candidates": pair_candidates, "itemsets_k2": itemsets_k2,
    "subset_support": subset_support, "itemsets_k3": itemsets_k3, "apriori_all": apriori_all,
    "son_two_pass": son_two_pass, "itemset_candidates": itemset_candidates,
}

_BASE = """b as (select distinct l_orderkey basket, p_brand item from lineitem join part on l_partkey = p_partkey)"""


def _bar(share):
    return f"{_BASE}, bar as (select greatest(count(distinct basket) * {share[0]} // {share[1]}, 1) s from b)"


def _level(k):
    """Itemsets of size k with their support, by a k-fold self-join."""
    joins = " ".join(
        f"join b b{i} on b{i}.basket = b0.basket and b{i}.item > b{i - 1}.item" for i in range(1, k))
    items = ", ".join(f"b{i}.item" for i in range(k))
    return f"""select {k}::bigint k, concat_ws(',', {items}) itemset, count(*) support
        from b b0 {joins} group by {items} having count(*) >= (select s from bar)"""


def _raw_level(k):
    joins = " ".join(
        f"join b b{i} on b{i}.basket = b0.basket and b{i}.item > b{i - 1}.item" for i in range(1, k))
    items = ", ".join(f"b{i}.item" for i in range(k))
    return f"""select {k}::bigint k, concat_ws(',', {items}) itemset, count(*) support
        from b b0 {joins} group by {items} having count(*) >= 2"""


_RAW_SETS = """raw as (select distinct strftime(o_orderdate, '%-m/%-d/%y') || '-' || o_custkey basket,
    l_partkey::varchar item from lineitem join orders on l_orderkey = o_orderkey),
  b as (select * from raw where basket in (select basket from raw group by 1 having count(*) > 2))
  """ + " union all ".join(_raw_level(k) for k in range(1, 5))

_ALL = f"with {_bar(DEEP_SUPPORT)} " + " union all ".join(_level(k) for k in range(1, 7))

ORACLES = {
    "collect_baskets": """with r as (select distinct o_custkey u, l_suppkey i from lineitem join orders on l_orderkey = o_orderkey),
        b as (select 1::bigint kind, u basket, i member from r union all select 2::bigint, i, u from r),
        p as (select *, (row_number() over (partition by kind, basket order by member) - 1) // 100000 piece,
          count(*) over (partition by kind, basket) n from b)
        select kind as "case", basket, piece::bigint piece, max(n) n, string_agg(member::varchar, ',' order by member) items
        from p group by kind, basket, piece""",
    # Every basket here is one customer's day: pairs and more that two such baskets share, and all single items.
    "transaction_itemsets": f"""with {_RAW_SETS}""",
    "max_basket_size": f"with {_BASE} select max(n) max_size from (select count(*) n from b group by basket)",
    "min_size_baskets": f"""with {_BASE} select basket, item from b
        where basket in (select basket from b group by 1 having count(*) > 6)""",
    "item_counts": f"""with {_bar(PAIR_SUPPORT)} select item, count(*) support from b group by 1
        having count(*) >= (select s from bar)""",
    "pair_candidates": f"""with {_bar(PAIR_SUPPORT)}, f as (select item from b group by 1 having count(*) >= (select s from bar))
        select x.item || ',' || y.item itemset from f x join f y on x.item < y.item""",
    "itemsets_k2": f"with {_bar(PAIR_SUPPORT)} select support, itemset from ({_level(2)})",
    "subset_support": f"""with {_bar(PAIR_SUPPORT)}, f as (select item from b group by 1 having count(*) >= (select s from bar))
        select x.item || ',' || y.item itemset, count(*) support from b x join b y on x.basket = y.basket and x.item < y.item
        where x.item in (from f) and y.item in (from f) group by 1""",
    "itemsets_k3": f"with {_bar(DEEP_SUPPORT)} select support, itemset from ({_level(3)})",
    "apriori_all": _ALL,
    "son_two_pass": _ALL,
    "itemset_candidates": f"""with {_bar(PAIR_SUPPORT)},
        f1 as ({_level(1)}), f2 as ({_level(2)}), f3 as ({_level(3)}),
        c2 as (select x.itemset || ',' || y.itemset itemset from f1 x join f1 y on x.itemset < y.itemset),
        p as (select split_part(itemset, ',', 1) a, split_part(itemset, ',', 2) b from f2),
        u as (select x.a, x.b, y.a c, y.b d from p x join p y on (x.a = y.a or x.a = y.b or x.b = y.a or x.b = y.b)
              and not (x.a = y.a and x.b = y.b)),
        c3 as (select distinct array_to_string(list_sort(list_distinct([a, b, c, d])), ',') itemset from u),
        l1 as (select distinct item itemset from b)
        select 1::bigint k, itemset, itemset in (select itemset from f1) is_frequent from l1
        union all select 2::bigint, itemset, itemset in (select itemset from f2) from c2
        union all select 3::bigint, itemset, itemset in (select itemset from f3) from c3""",
}
