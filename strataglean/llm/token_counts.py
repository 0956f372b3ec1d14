"""Token counts with a tokenizer compiled to a finite-state transducer.

The tokenizer cuts a normalised text into words and merges each word's characters by
ranked pairs; the last character of a word is another symbol than the same character
inside. The sequence of tokens of a word's prefix ends in one certain token, and that
token and the one before it are all that decides which token the next symbol makes. So
a deterministic transducer reads the word symbol by symbol. Its state holds the
last tokens of the latest prefixes, as far back as a token can reach; every
transition is annotated with the change of the number of tokens. States and transitions
are compiled when first needed and forgotten when there are too many.

A long text is cut into chunks, which are rows of their own. A chunk's state map is: the
text before its first white space, the count of what lies between, the text after its
last white space (or the whole text, if it has no white space). No word reaches over white
space, so two neighbours compose into one such map; composition is associative, and
the chunks of a text are combined by a parallel scan, some neighbours at a time.

Special tokens inside a text count as one token each and cut it. Null and empty texts have
no tokens. Repeated rows are told apart by a number of their own; null ids are kept. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strataglean.llm import common
from strataglean.llm.bpe import merge_parts
from strataglean.llm.letters import exchanges, splitter

VOCABULARY = "word_bpe_49k.json"
# Code points of a chunk, neighbours that one step of the scan combines, tokens of a full context.
CHUNK, FAN_IN, LIMIT = 32_768, 64, 2048
# States and words a task remembers.
MAX_STATES, MAX_WORDS = 200_000, 300_000


class Tokenizer:
    """What the vocabulary file says: words, symbols and ranked merges."""

    def __init__(self, path: str, exchange: dict[int, str]):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.merges = {(a, b): rank for rank, (a, b) in enumerate(model["merges"])}
        self.end = model["end_of_word_suffix"] or ""
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.words = splitter(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"], exchange)
        self.letter = _byte_letters()

    def rank(self, left: str, right: str) -> int | None:
        return self.merges.get((left, right))


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte; bytes without one get those from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Transducer:
    """Number of tokens of a word, by transitions that are compiled on first use.

    A state is the text of the symbols that a token not yet complete may contain, and, for
    each prefix after which such a token may begin, how far back it ends, its last
    token, and its number of tokens relative to the newest prefix.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.tokens = _reachable(tokenizer)
        self.begun = {symbols[:k] for symbols in self.tokens.values() for k in range(1, len(symbols))}
        self.forget()

    def forget(self) -> None:
        start = ((), ((0, "", 0),))  # the empty prefix has no last token
        self.number: dict[tuple, int] = {start: 0}
        self.states: list[tuple] = [start]
        self.next: list[dict[str, tuple[int, int]]] = [{}]
        self.pairs: dict[tuple[str, str], bool] = {}

    def stays(self, left: str, right: str) -> bool:
        """Whether the two tokens are the tokens of their concatenation."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self.pairs[left, right] = merge_parts(
                self.tokens[left] + self.tokens[right], self.tokenizer.rank) == [left, right]
        return known

    def _compile(self, state: int, symbol: str) -> tuple[int, int]:
        behind, prefixes = self.states[state]
        symbols = (*behind, symbol)
        for back, before, relative in prefixes:
            last = symbols[len(symbols) - back - 1 :]
            token = "".join(last)
            if self.tokens.get(token) == last and (before == "" or self.stays(before, token)):
                change = relative + 1
                break
        else:
            raise ValueError(f"no token ends with {symbol!r}")
        open_ends = [(back + 1, t, n - change) for back, t, n in prefixes
                     if symbols[len(symbols) - back - 1 :] in self.begun]
        longest = max((back for back, _, _ in open_ends), default=0)
        moved = (symbols[len(symbols) - longest :], (*open_ends, (0, token, 0)))
        number = self.number.get(moved)
        if number is None:
            number = self.number[moved] = len(self.states)
            self.states.append(moved)
            self.next.append({})
        return number, change

    def count(self, word: str) -> int:
        """Tokens of one word, its last character as a word's end."""
        letters = [self.tokenizer.letter[b] for b in word.encode()]
        letters[-1] += self.tokenizer.end
        if len(self.states) > MAX_STATES:
            self.forget()
        state = total = 0
        for letter in letters:
            step = self.next[state].get(letter)
            if step is None:
                step = self.next[state][letter] = self._compile(state, letter)
            state, change = step
            total += change
        return total


def _reachable(tokenizer: Tokenizer) -> dict[str, tuple[str, ...]]:
    """Tokens that a text of their own can have, with their symbols."""
    made: dict[str, tuple[str, ...]] = {}
    for letter in tokenizer.letter:
        made[letter] = (letter,)
        made[letter + tokenizer.end] = (letter + tokenizer.end,)
    for a, b in tokenizer.merges:
        if a in made and b in made and a + b not in made:
            symbols = made[a] + made[b]
            if merge_parts(symbols, tokenizer.rank) == [a + b]:
                made[a + b] = symbols
    return made


class TokenCounter:
    """Counts whole stretches of text that begin and end at a word's border."""

    def __init__(self, path: str, exchange: dict[int, str]):
        self.tokenizer = Tokenizer(path, exchange)
        self.transducer = Transducer(self.tokenizer)
        self.known: dict[str, int] = {}
        self.cut = regex.compile("|".join(map(regex.escape, self.tokenizer.special)) or r"(?!)")

    def words(self, text: str) -> int:
        # Letters are lower-cased one by one: a sigma does not look at its neighbours.
        plain = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
        known, total = self.known, 0
        if len(known) > MAX_WORDS:
            known.clear()
        for word, times in Counter(self.tokenizer.words(plain)).items():
            n = known.get(word)
            if n is None:
                n = known[word] = self.transducer.count(word)
            total += n * times
        return total

    def count(self, text: str) -> int:
        parts = self.cut.split(text)
        return len(parts) - 1 + sum(self.words(p) for p in parts if p)


# White space that is a border in every tokenizer of this kind; special tokens have none inside.
SPACE = regex.compile(r"[ \t\n\r\f\v]")


def state_map(counter: TokenCounter, text: str) -> tuple[str, int | None, str]:
    """Text before the first border, count between, text after the last; no border: (text, None, '')."""
    first = SPACE.search(text)
    if first is None:
        return text, None, ""
    last = max(text.rfind(c) for c in " \t\n\r\f\v")
    return text[: first.start()], counter.count(text[first.start() : last + 1]), text[last + 1 :]


def compose(counter: TokenCounter, left: tuple, right: tuple) -> tuple:
    """The map of two neighbours."""
    if left[1] is None and right[1] is None:
        return left[0] + right[0], None, ""
    if left[1] is None:
        return left[0] + right[0], right[1], right[2]
    if right[1] is None:
        return left[0], left[1], left[2] + right[0]
    return left[0], left[1] + counter.count(left[2] + right[0]) + right[1], right[2]


def total(counter: TokenCounter, mapped: tuple) -> int:
    head, between, tail = mapped
    return counter.count(head) + (between or 0) + (counter.count(tail) if tail else 0)


MAPS = StructType([StructField("head", StringType()), StructField("between", LongType()),
                   StructField("tail", StringType())])


def count_tokens(docs: DataFrame, path: str, chunk: int = CHUNK, fan_in: int = FAN_IN) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for every row of ``docs`` (doc_id, text)."""
    exchange = exchanges("tokenizers")

    def counter() -> TokenCounter:
        return common.per_worker(f"tokens of {path}", lambda: TokenCounter(path, exchange))

    @F.pandas_udf(LongType())
    def short(texts: pd.Series) -> pd.Series:
        count = counter().count
        return pd.Series([count(t) for t in texts], dtype="int64")

    @F.pandas_udf(MAPS)
    def mapped(texts: pd.Series) -> pd.DataFrame:
        own = counter()
        return pd.DataFrame([state_map(own, t) for t in texts], columns=MAPS.names).astype(
            {"between": "Int64"})

    @F.pandas_udf(LongType())
    def closed(head: pd.Series, between: pd.Series, tail: pd.Series) -> pd.Series:
        own = counter()
        return pd.Series([total(own, (h, None if pd.isna(b) else int(b), t))
                          for h, b, t in zip(head, between, tail)], dtype="int64")

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter()
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                whole = None
                for m in row.pop("maps"):
                    this = (m["head"], m["between"], m["tail"])
                    whole = this if whole is None else compose(own, whole, this)
                rows.append(row | dict(zip(MAPS.names, whole)))
            yield pa.RecordBatch.from_pylist(rows, pa.schema(
                [("row", pa.int64()), ("part", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                 ("head", pa.string()), ("between", pa.int64()), ("tail", pa.string())]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    few = rows.filter(F.length("text") <= chunk).select("doc_id", "n_bytes", short("text").alias("n_tokens"))
    # Long texts: their chunks are dealt out, so that one text is not one task's work.
    long = rows.filter(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id())
    most = long.agg(F.max(F.length("text"))).first()[0]
    if most is None:
        return few

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text = row.pop("text")
                for part, start in enumerate(range(0, len(text), chunk)):
                    yield pa.RecordBatch.from_pylist(
                        [row | {"part": part, "piece": text[start : start + chunk]}], pa.schema(
                            [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("row", pa.int64()),
                             ("part", pa.int64()), ("piece", pa.string())]))

    chunks = long.select("doc_id", "n_bytes", "row", "text").mapInArrow(
        cut, "doc_id long, n_bytes long, row long, part long, piece string")
    state = (
        chunks.repartition("row", "part")
        .select("row", "part", "doc_id", "n_bytes", mapped("piece").alias("m"))
        .select("row", "part", "doc_id", "n_bytes", "m.*"))
    parts = -(-most // chunk)
    while parts > 1:
        grouped = state.groupBy("row", F.floor(F.col("part") / fan_in).alias("part")).agg(
            F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"),
            F.array_sort(F.collect_list(F.struct("part", "head", "between", "tail"))).alias("maps"))
        state = grouped.select("row", "part", "doc_id", "n_bytes", "maps").mapInArrow(
            combine, "row long, part long, doc_id long, n_bytes long, head string, between long, tail string")
        parts = -(-parts // fan_in)
    many = state.select("doc_id", "n_bytes", closed("head", "between", "tail").alias("n_tokens"))
    return few.unionByName(many)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its bytes and tokens, and whether it is longer than a full context."""
    counted = count_tokens(common.documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
