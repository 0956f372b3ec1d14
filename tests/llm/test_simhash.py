"""Fingerprints and components against brute force."""

import random

import pytest
import xxhash

from strataglean.llm import simhash


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(prints):
            for j, y in enumerate(prints):
                if bin(x ^ y).count("1") <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


TEXTS = ["", None, "   \n\t ", "one", "One TWO", "a b c d e f", "A b C d e f", "É été ÉTÉ x y",
         "a b c d e", "the same words again and again " * 400, "word " * 5000]


def test_fingerprint_of_odd_texts():
    for text in TEXTS:
        assert simhash.fingerprint(None if text is None else text.encode()) == brute_print(text)


def test_pieces_of_a_long_text_add_up(monkeypatch):
    text = " ".join(str(i % 97) for i in range(1000))
    monkeypatch.setattr(simhash, "PIECE", 64)
    assert simhash.fingerprint(text.encode()) == brute_print(text)


def near_texts(n, seed):
    pick = random.Random(seed)
    base = [pick.choice("abcdefghij") + str(pick.randrange(50)) for _ in range(150)]
    texts = list(TEXTS)
    for _ in range(n):
        copy = list(base)
        for _ in range(pick.randrange(3)):
            copy[pick.randrange(len(copy))] = "changed" + str(pick.randrange(9))
        texts.append(" ".join(copy))
    return texts + [" ".join(pick.choice("xyz") + str(pick.randrange(99)) for _ in range(30)) for _ in range(20)]


@pytest.mark.parametrize("hot", [512, 3])
def test_components_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_VALUE", hot)
    monkeypatch.setattr(simhash, "BLOCK", 4 if hot == 3 else 2048)
    texts = near_texts(40, 5)
    docs = spark.createDataFrame(
        [(i, t, "x", "fp clash") for i, t in enumerate(texts)], "doc_id long, text string, fp string, component string")
    prints = simhash.fingerprints(docs)
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in
           prints.join(simhash.components(prints), "fp").collect()}
    want = [brute_print(t) for t in texts]
    assert [got[i][0] for i in range(len(texts))] == want
    assert [got[i][1] for i in range(len(texts))] == brute_components(want)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_components(want)))


def test_links_of_every_distance(spark):
    pick = random.Random(3)
    prints = {pick.getrandbits(64) for _ in range(30)}
    for x in list(prints):
        for k in (1, 2, 3, 4):
            prints.add(x ^ sum(1 << b for b in pick.sample(range(64), k)))
    rows = [(x - 2**64 if x >> 63 else x,) for x in prints]
    found = {tuple(r) for r in simhash.links(spark.createDataFrame(rows, "fp long")).collect()}
    want = {(a[0], b[0]) for a in rows for b in rows
            if a < b and bin((a[0] ^ b[0]) % 2**64).count("1") <= 3}
    assert found == want


def test_thresholds_obey_the_pigeonhole_rule(spark):
    rows = [(random.Random(i).getrandbits(63),) for i in range(500)]
    n, ones = simhash.bit_statistics(spark.createDataFrame(rows, "fp long"))
    assert n == 500
    for m in (2, 3, 4):
        groups = simhash.group_bits(n, ones, m)
        assert sorted(b for g in groups for b in g) == list(range(64))
        _, chosen = simhash.allocate(n, ones, groups, 3)
        assert sum(t + 1 for t in chosen) == 4


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.components(simhash.fingerprints(empty)).count() == 0
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (4, "q w e"), (4, "q w e")],
                                 "doc_id long, text string")
    assert sorted((r.doc_id is None, r.text) for r in simhash.keep_one(docs).collect()) == [
        (False, "q w e"), (True, "a b c")]
