"""Tiles and coverage against a plain greedy search over all common passages."""

import random

import pytest
from odd import empty_documents, odd_documents

from strataglean.llm import decontaminate as dec


def brute_tiles(mine, theirs, length=5):
    """Longest common passage of free tokens, marked again and again; ties by place."""
    used_a, used_b, found = set(), set(), []
    while True:
        best = None
        for x in range(len(mine)):
            for y in range(len(theirs)):
                n = 0
                while (x + n < len(mine) and y + n < len(theirs) and mine[x + n] == theirs[y + n]
                       and x + n not in used_a and y + n not in used_b):
                    n += 1
                if n >= length and (best is None or n > best[2]):
                    best = (x, y, n)
        if best is None:
            return found
        x, y, n = best
        found.append(best)
        used_a.update(range(x, x + n))
        used_b.update(range(y, y + n))


def places(mine, theirs, length=5):
    return [(x, y) for x in range(len(mine) - length + 1) for y in range(len(theirs) - length + 1)
            if mine[x:x + length] == theirs[y:y + length]]


def test_tiles_equal_the_greedy_search():
    pick = random.Random(4)
    for letters in ("ab", "abc", "abcdefgh"):
        for _ in range(60):
            theirs = [pick.choice(letters) for _ in range(pick.randrange(5, 30))]
            mine = [pick.choice(letters) for _ in range(pick.randrange(0, 20))]
            for _ in range(2):
                a = pick.randrange(len(theirs))
                mine[len(mine) // 2:len(mine) // 2] = theirs[a:a + pick.randrange(4, 12)]
            assert dec.tiles(places(mine, theirs)) == brute_tiles(mine, theirs)


ITEM = " ".join(f"token{i}" for i in range(40))
REORDERED = " ".join(f"token{i}" for i in [*range(20, 40), *range(20)])
HALF = " ".join(f"token{i}" for i in range(20))


@pytest.mark.parametrize("bits", [1 << 24, 64])
def test_contaminated_documents(spark, bits):
    more = [f"before {ITEM} after", f"x {REORDERED} y", f"only {HALF} here", ITEM.upper().replace(" ", ", "),
            " ".join(f"token{i}" if i % 13 else "changed" for i in range(40)), " ".join(f"token{i}" for i in range(0, 40, 2)),
            f"{ITEM} {ITEM}"]
    docs = odd_documents(spark, more)
    items = spark.createDataFrame([(1, ITEM), (2, "too short"), (3, None), (4, ""), (5, "word " * 12), (1, ITEM)],
                                  "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in dec.matches(docs, items, bits).collect()}
    covered = {k: r.n_covered for k, r in found.items()}
    first = 10  # number of odd documents before these
    assert covered[first, 1] == covered[first + 1, 1] == covered[first + 3, 1] == covered[first + 6, 1] == 40
    assert found[first + 1, 1].n_tiles == 2 and covered[first + 2, 1] == 20
    assert covered[first + 4, 1] == 36 and (first + 5, 1) not in covered
    assert covered[7, 5] == 12 and len(covered) == 7
    want = {first, first + 1, first + 3, first + 4, first + 6, 7}
    assert {r.doc_id for r in dec.contaminated(docs, items).collect()} == want
    clean = dec.remove_contaminated(docs, items)
    assert clean.columns == docs.columns
    # The other row with id 7 is another text and stays.
    assert sorted((repr(r.doc_id) for r in clean.collect())) == sorted(
        repr(r.doc_id) for r in docs.collect() if r.doc_id not in want or r.text == "other text")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dec.matches(empty_documents(spark), none).count() == 0
    docs = odd_documents(spark)
    assert dec.remove_contaminated(docs, none).count() == docs.count()
