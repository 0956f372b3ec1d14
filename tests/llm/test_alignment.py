import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from odd import empty_documents, odd_documents
from strataglean.llm import alignment

PATHS = [public_tokenizers.path(p) for p in (alignment.BYTE_LEVEL, alignment.PIECES)]


@pytest.fixture(scope="module")
def encoders():
    return alignment.Encoders(*PATHS)


def brute(texts):
    """Rows in the order of the texts, by the libraries and plain loops."""
    a_lib = Tokenizer.from_file(PATHS[0])
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, more = {}, 256
    for byte in range(256):
        letters[chr(byte) if byte in plain else chr(more)] = byte
        more += byte not in plain
    counts, found = Counter(), []
    for text in texts:
        if not text:
            found.append(None)
            continue
        a = a_lib.encode(" " + text, add_special_tokens=False).ids
        b = b_lib.encode(text)
        bytes_a = [bytes(letters[c] for c in a_lib.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i)
                   else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(bytes_a) == (" " + text).encode() == b"".join(bytes_b):
            found.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        shared, groups, at_a, at_b = sorted(set(ends_a) & set(ends_b)), [], 0, 0
        for end in shared:
            to_a, to_b = ends_a.index(end, at_a) + 1, ends_b.index(end, at_b) + 1
            groups.append((a[at_a:to_a], b[at_b:to_b]))
            at_a, at_b = to_a, to_b
        linked, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            linked.append((a[i], b[j]))
            step_a, step_b = ends_a[i] <= ends_b[j], ends_b[j] <= ends_a[i]
            i, j = i + step_a, j + step_b
        counts.update(linked)
        found.append((a, b, groups, linked))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    rows = []
    for one in found:
        if one is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, linked = one
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append((len(a), len(b), len(groups), len(linked), sum(counts[p] == most[p[1]] for p in linked),
                     sum(counts[p] for p in linked), hashlib.sha256(text.encode()).hexdigest()))
    return rows


TEXTS = ["The cat sat.", "naïve café 漢字 😀🤷", "<|endoftext|> and <s> </s> <unk>", "  two  spaces \n\n tabs\t\there ",
         "a\u0000b � ▁ x", "x" * 3000, "word " * 3000, "漢字仮名" * 500, "ＡＢＣ ﬁ é", " ", "\n", "it's I'll we've",
         "12345 67890 3.14159", "　   ", "ÅÄÖ åäö ŁŃ"]


def some_texts():
    rng = random.Random(5)
    words = ["alpha", "beta", "naïve", "Über", "x1", "漢", "!!", "don't", "...", "\n", "  ", "token", "izer", "streets"]
    return TEXTS + [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)] + ["alpha beta"] * 5 + ["", None]


@pytest.mark.parametrize("block_bytes", [500, 1 << 20])
def test_equal_to_brute_force(spark, block_bytes):
    texts = some_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r[0]: tuple(r[1:]) for r in alignment.align(docs, *PATHS, block_bytes=block_bytes).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts)


def test_words_that_are_forgotten(monkeypatch, encoders):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    texts = some_texts()
    a, n_a, b, n_b = alignment.encoded(encoders, texts)
    expected = brute(texts)
    assert list(zip(n_a.tolist(), n_b.tolist())) == [r[:2] for r in expected]
    assert len(a) == n_a.sum() and len(b) == n_b.sum()


def test_cuts_of_any_ends(monkeypatch):
    rng = np.random.default_rng(3)
    for trial in range(300):
        monkeypatch.setattr(alignment, "STEPS", int(rng.integers(1, 5)))
        size = int(rng.integers(1, 200))
        share = rng.choice([0.02, 0.2, 0.7])
        ends = [np.union1d(np.flatnonzero(rng.random(size) < share) + 1, [size]) for _ in range(2)]
        first = np.intersect1d(*ends)
        some = np.union1d(first[rng.random(len(first)) < 0.1], [size])  # documents' ends
        cuts = alignment.shared_cuts(ends[0], ends[1], np.searchsorted(ends[0], some))
        assert ends[0][cuts].tolist() == first.tolist()
        at_a, at_b = alignment.links(*ends)
        expected = sorted({(int(np.searchsorted(ends[0], x)), int(np.searchsorted(ends[1], x))) for x in range(1, size + 1)})
        assert list(zip(at_a.tolist(), at_b.tolist())) == expected


def test_odd_documents_and_empty_table(spark):
    docs = odd_documents(spark, ["more text"])
    rows = docs.select("doc_id", "text").collect()
    expected = sorted(((r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows]))), key=str)
    assert sorted((tuple(r) for r in alignment.align(docs, *PATHS).collect()), key=str) == expected
    assert alignment.align(empty_documents(spark), *PATHS).collect() == []
