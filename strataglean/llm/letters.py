"""Splitting texts as a library does whose Unicode tables are of another version.

The patterns of tokenizers speak of letters and numbers. The regular expressions used
here may know other characters as such than the library that a vocabulary is made for.
The library is asked once, on the driver, about every character; texts that hold one of the
characters on which the two differ are split with these exchanged for others of the right kind.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import regex
import tiktoken
from tokenizers import Regex, pre_tokenizers

# A letter, a number and a symbol that all tables agree upon.
LETTER, NUMBER, OTHER = "é", "٣", "¤"
PIECE = 10_000


def _characters() -> list[str]:
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    return ["".join(every[i : i + PIECE]) for i in range(0, len(every), PIECE)]


def _matched_by_regex(kind: str) -> set[str]:
    return {c for piece in _characters() for c in regex.findall(rf"\p{{{kind}}}", piece)}


def _matched_by_tiktoken(kind: str) -> set[str]:
    library = tiktoken.Encoding("probe", pat_str=rf"\p{{{kind}}}", special_tokens={},
                                mergeable_ranks={bytes([b]): b for b in range(256)})
    return {c for piece in _characters() for c in bytes(library.encode_ordinary(piece)).decode()}


def _matched_by_tokenizers(kind: str) -> set[str]:
    library = pre_tokenizers.Split(Regex(rf"\p{{{kind}}}"), "removed", invert=True)
    return {c for piece in _characters() for word, _ in library.pre_tokenize_str(piece) for c in word}


@cache
def exchanges(library: str) -> dict[int, str]:
    """Characters that ``tiktoken`` or ``tokenizers`` class otherwise than this module's patterns."""
    ask = {"tiktoken": _matched_by_tiktoken, "tokenizers": _matched_by_tokenizers}[library]
    letters, numbers = ask("L"), ask("N")
    own_letters, own_numbers = _matched_by_regex("L"), _matched_by_regex("N")
    differ = (letters ^ own_letters) | (numbers ^ own_numbers)
    return {ord(c): LETTER if c in letters else NUMBER if c in numbers else OTHER for c in differ}


def splitter(pattern: str, exchange: dict[int, str]) -> Callable[[str], list[str]]:
    """A function from texts to the matches of ``pattern``."""
    compiled = regex.compile(pattern)
    odd = frozenset(map(chr, exchange))
    plain = all(c > 0xFF for c in exchange)

    def split(text: str) -> list[str]:
        if plain:
            try:
                text.encode("latin-1")
                return compiled.findall(text)
            except UnicodeEncodeError:
                pass
        if odd.isdisjoint(text):
            return compiled.findall(text)
        return [text[m.start() : m.end()] for m in compiled.finditer(text.translate(exchange))]

    return split
