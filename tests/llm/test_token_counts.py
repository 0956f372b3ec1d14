"""Counts against the library that the vocabulary is made for."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import empty_documents, odd_documents
from tokenizers import Tokenizer

from strataglean.llm import letters, token_counts

PATH = public_tokenizers.path(token_counts.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)
EXCHANGE = letters.exchanges("tokenizers")
COUNTER = token_counts.TokenCounter(PATH, EXCHANGE)


def library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert COUNTER.count(text) == library(text)


def test_words_of_a_few_letters_and_special_tokens():
    pick = random.Random(2)
    letters = "abcde ABÉß'Σσ́123.,/w>\n"
    for i in range(2000):
        text = "".join(pick.choice(letters) for _ in range(pick.randrange(40)))
        text += "<|endoftext|>" * (i % 3) + text[:3]
        assert COUNTER.count(text) == library(text)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 5)
    monkeypatch.setattr(token_counts, "MAX_WORDS", 2)
    text = "several words that the transducer has to read again and again, several words"
    assert token_counts.TokenCounter(PATH, EXCHANGE).count(text) == library(text)


def test_state_maps_compose_in_any_order():
    pick = random.Random(3)
    for _ in range(300):
        text = "".join(pick.choice("ab é́ \nS<|endoftext|>") for _ in range(60))
        cuts = sorted(pick.sample(range(61), 4))
        maps = [token_counts.state_map(COUNTER, text[a:b]) for a, b in zip([0, *cuts], [*cuts, 60])]
        left = maps[0]
        for m in maps[1:]:
            left = token_counts.compose(COUNTER, left, m)
        right = maps[-1]
        for m in reversed(maps[:-1]):
            right = token_counts.compose(COUNTER, m, right)
        assert token_counts.total(COUNTER, left) == token_counts.total(COUNTER, right) == library(text)


@pytest.mark.parametrize("chunk, fan_in", [(7, 2), (1000, 3), (1 << 15, 64)])
def test_documents(spark, chunk, fan_in):
    docs = odd_documents(spark, ["one two <|endoftext|> three " * 30] if chunk == 7 else ["The quick fox. " * 5000])
    docs = docs.filter("length(text) < 3000 or text is null") if chunk == 7 else docs
    got = sorted(map(tuple, token_counts.count_tokens(docs, PATH, chunk, fan_in).collect()), key=repr)
    want = [(r.doc_id, len((r.text or "").encode()), library(r.text or "")) for r in docs.collect()]
    assert got == sorted(want, key=repr)


def test_empty_table(spark):
    assert token_counts.count_tokens(empty_documents(spark), PATH).collect() == []
