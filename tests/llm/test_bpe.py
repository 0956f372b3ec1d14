"""Encoding against the library that the vocabulary is made for, and exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import empty_documents, odd_documents

from strataglean.llm import blocks, bpe, letters

RANKS = bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
SPLIT = letters.splitter(public_tokenizers.PATTERN, letters.exchanges("tiktoken"))


def plain(text):
    return [i for w in SPLIT(text) for i in bpe.merge(w.encode(), RANKS)]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_is_encoded_as_the_library_does(text):
    assert plain(text) == LIBRARY.encode_ordinary(text)


def test_characters_that_tables_class_differently():
    odd = [chr(c) for c in letters.exchanges("tiktoken")]
    for i in range(0, len(odd), 500):
        text = "".join(f"{c}é{c} 1{c}.{c}" for c in odd[i:i + 500])
        assert plain(text) == LIBRARY.encode_ordinary(text)


def test_long_words_merge_alike():
    pick = random.Random(1)
    for n in (95, 96, 97, 500):
        for letters in ("a", "ab", "the and", "éß漢", "=-"):
            word = "".join(pick.choice(letters) for _ in range(n)).replace(" ", "t")
            assert bpe._merge_long(word.encode(), RANKS) == LIBRARY.encode_ordinary(word) == plain(word)


def test_packets_hold_what_was_packed():
    words = [b"", b"a", "é".encode() * 300, b"\x00\xff"]
    assert blocks.unpack_tokens(blocks.pack_tokens(words)) == words
    assert blocks.unpack_tokens(blocks.pack_tokens([])) == []


@pytest.mark.parametrize("block_bytes", [1, 64, 1 << 24])
def test_documents_survive_the_shuffle(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(blocks, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(blocks, "TABLE_BYTES", 50_000)
    monkeypatch.setattr(blocks.build, "__defaults__", (block_bytes,))
    docs = odd_documents(spark, ["the same words the same words", "it's 12345 o'clock"])
    got = sorted(map(tuple, bpe.digests(docs, RANKS).collect()), key=repr)

    def digest(data):
        return hashlib.sha256(data).hexdigest()

    want = []
    for row in docs.collect():
        ids = LIBRARY.encode_ordinary(row.text or "")
        want.append((row.doc_id, len(ids), digest(",".join(map(str, ids)).encode()), digest((row.text or "").encode())))
    assert got == sorted(want, key=repr)


def test_decoding_a_table_of_ids_is_a_round_trip(spark):
    docs = odd_documents(spark)
    got = sorted((repr(r.doc_id), r.bytes) for r in bpe.decode(bpe.encode(docs, RANKS), RANKS).collect())
    assert got == sorted((repr(r.doc_id), (r.text or "").encode()) for r in docs.collect())


def test_empty_table(spark):
    assert bpe.digests(empty_documents(spark), RANKS).collect() == []


def test_null_ids_decode_to_null(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, LIBRARY.encode_ordinary("round trip"))], "n int, ids array<int>")
    got = {r.n: r.bytes for r in bpe.decode(rows, RANKS).collect()}
    assert got == {1: None, 2: b"", 3: b"round trip"}
