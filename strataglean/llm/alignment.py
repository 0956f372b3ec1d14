"""Alignment of two tokenizers by divide and conquer at shared cuts.

Each text is encoded twice, by a byte-level tokenizer (A) with a space before the text and by a
piece tokenizer (B), which adds that space by itself. Byte offsets at which a token of A and a token of B
both end cut the two sequences into groups. An interval of tokens is divided at such an offset near its
middle: the middle is located by bisection among the ends of A, the ends around it are
looked up by bisection among those of B, going outwards; both halves are treated alike. An interval without
a shared end inside is a group. All intervals of a block of documents are divided in the same vector
steps, the documents being the first intervals.

Every two tokens whose bytes overlap are a link. How often two ids are linked in the whole corpus is
counted in Spark: a block sends each distinct pair of ids once with its count, so that the most
frequent pair has no more rows than there are blocks; the sums come back to the blocks likewise.

Both tokenizers begin a token at a space between two other characters, whatever comes before. Texts are split
there, and a worker encodes each distinct word once while it remembers it.

Texts that are null or empty, or whose tokens' bytes are not those of the text after a space, have
no tokens: zeros and no groups. Null and repeated ids and extra columns are no matter: the
result has one row per input row. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strataglean.llm import blocks, common
from strataglean.llm.token_counts import _byte_letters
from strataglean.session import cut_lineage

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Bytes of text in a block, steps outwards before all ends are looked up.
BLOCK_BYTES, STEPS = 2 << 20, 8
# Words that a worker remembers, and the length of the longest among them.
REMEMBERED, LONG = 300_000, 100
SPACE = "▁"

BLOCK = ("block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
         "n_links array<long>, digests array<string>, codes binary, pairs array<long>, counts array<long>")
COUNTED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Vocabulary:
    """The bytes of each id of one tokenizer, and its ids as text."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.sizes = np.array([len(t) for t in tokens], np.int64)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Encoders:
    """Both tokenizers with their vocabularies."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        byte = {letter: bytes([n]) for n, letter in enumerate(_byte_letters())}
        named = {i: t for t, i in self.a.get_vocab().items()}
        self.own_a = Vocabulary([
            b"".join(byte.get(c, c.encode()) for c in named.get(i, "")) for i in range(max(named) + 1)])
        listed = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.own_b = Vocabulary([
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(listed)])
        # A space between two other characters ends a token in both, unless a piece goes on after one.
        splits = not any(SPACE in p.lstrip(SPACE) for p in listed)
        self.cut = regex.compile(r"(?<=\S) (?=\S)") if splits else None
        table = np.array([f"{sign}{i}" for sign in ",|;" for i in range(max(len(named), len(listed)) + 1)], object)
        self.shown = table.reshape(3, -1)

        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def words(self, text: str) -> list[str]:
        """Parts of a text, each to be encoded with a space before it."""
        return self.cut.split(text) if self.cut else [text]

    def encode(self, words: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of both, as 32-bit integers, for each of some distinct words; null where the tokens do not spell the word."""
        new = [w for w in words if w not in self.known]
        both = zip(self.a.encode_batch_fast([" " + w for w in new], add_special_tokens=False), self.b.encode(new, num_threads=1))
        for word, (a, b) in zip(new, both):
            spelled, ids = b" " + word.encode(), a.ids  # a list that is made anew each time it is asked for
            right = self.own_a.joined(ids) == spelled == self.own_b.joined(b)
            self.known[word] = (array("I", ids).tobytes(), array("I", b).tobytes()) if right else None
        found = [self.known[w] for w in words]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for word in new:
            if len(word) > LONG:
                self.known.pop(word, None)
        return found


def _gathered(lists: list[bytes], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of 32-bit integers that the codes name, one after the other, and their sizes."""
    sizes = np.array([len(x) // 4 for x in lists], np.int64)
    flat = np.frombuffer(b"".join(lists), np.uint32).astype(np.int64)
    starts, n = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
    upto = np.cumsum(n)
    return flat[np.arange(int(n.sum())) + np.repeat(starts - upto + n, n)], n


def encoded(encoders: Encoders, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of A and of B of all texts, and how many of either each text has."""
    number: dict[str, int] = defaultdict(count().__next__)
    each = []
    for text in texts:
        words = encoders.words(text) if text else []
        each.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    found = encoders.encode(list(number))
    n_words = np.array([len(c) for c in each], np.int64)
    codes = np.concatenate([*each, np.zeros(0, np.int64)])
    text_of = np.repeat(np.arange(len(texts)), n_words)
    wrong = np.array([ids is None for ids in found], bool)
    spoilt = np.zeros(len(texts), bool)
    spoilt[text_of[wrong[codes]]] = True
    stays = ~spoilt[text_of]
    codes, text_of = codes[stays], text_of[stays]
    result = []
    for side in (0, 1):
        ids, sizes = _gathered([x[side] if x else b"" for x in found], codes)
        result += [ids, np.bincount(text_of, sizes, len(texts)).astype(np.int64)]
    return tuple(result)


def _found(sorted_ends: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of ``wanted`` bisection finds in ``sorted_ends``."""
    at = np.searchsorted(sorted_ends, wanted)
    return (at < len(sorted_ends)) & (sorted_ends[np.minimum(at, len(sorted_ends) - 1)] == wanted)


def _cut_of(ends_a: np.ndarray, ends_b: np.ndarray, low: int, high: int, middle: int) -> int:
    """The shared end next to the middle among a's ends low..high-1, -1 if there is none."""
    shared = np.flatnonzero(_found(ends_b, ends_a[low:high])) + low
    return int(shared[np.abs(shared - middle).argmin()]) if len(shared) else -1


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    """Indices of a's tokens that end a group, in order.

    ``lasts`` are the indices of the last tokens of the first intervals, whose ends both share.
    """
    low = np.concatenate([[0], lasts[:-1] + 1]).astype(np.int64)
    high = lasts.astype(np.int64)  # an interval's own last token is no cut inside it
    groups = [high]
    while len(low):
        some = low < high
        low, high = low[some], high[some]
        if not len(low):
            break
        start = np.where(low > 0, ends_a[np.maximum(low - 1, 0)], 0)
        middle = np.clip(np.searchsorted(ends_a, (start + ends_a[high]) // 2), low, high - 1)
        cut = np.full(len(low), -1, np.int64)
        open_ = np.arange(len(low))
        for step in range(STEPS):
            for way in (step, -step) if step else (0,):
                at = middle[open_] + way
                inside = (at >= low[open_]) & (at < high[open_])
                shared = inside.copy()
                shared[inside] = _found(ends_b, ends_a[at[inside]])
                cut[open_[shared]] = at[shared]
                open_ = open_[~shared]
            # Where all ends are looked up, the interval is a group.
            open_ = open_[(middle[open_] + step + 1 < high[open_]) | (middle[open_] - step - 1 >= low[open_])]
            if not len(open_):
                break
        for i in open_.tolist():
            cut[i] = _cut_of(ends_a, ends_b, int(low[i]), int(high[i]), int(middle[i]))
        divided = cut >= 0
        low, high, cut = low[divided], high[divided], cut[divided]
        groups.append(cut)
        # In the order of the texts, in which bisection is fastest.
        low, high = np.column_stack([low, cut + 1]).ravel(), np.column_stack([cut, high]).ravel()
    return np.sort(np.concatenate(groups))


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token indices of both for every overlap, in order.

    Between two neighbouring ends of either lies one token of each.
    """
    ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")  # two sorted runs are merged
    ends = ends[np.append(ends[1:] != ends[:-1], True)]
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


def show(shown: np.ndarray, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> str:
    """``a1,a2|b1;a3|b2,b3``; the groups of the tokens rise from one token to the next."""
    if not len(a):
        return ""
    # A group's tokens of a come first, then those of b.
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    first_a = np.concatenate([[True], group_a[1:] != group_a[:-1]])
    first_b = np.concatenate([[True], group_b[1:] != group_b[:-1]])
    sign = np.concatenate([np.where(first_a, 2, 0), np.where(first_b, 1, 0)])
    return "".join(shown[sign[order], np.concatenate([a, b])[order]].tolist())[1:]


def _numbered(lasts: np.ndarray, size: int) -> np.ndarray:
    """The number of each token's group, by the groups' last tokens."""
    begins = np.zeros(size, np.int64)
    begins[lasts[:-1] + 1] = 1
    return np.cumsum(begins)


def _block(encoders: Encoders, number: int, rows: list[tuple[int | None, str | None]]) -> pa.RecordBatch:
    """Groups and links of a block's documents."""
    a, n_a, b, n_b = encoded(encoders, [text for _, text in rows])
    # Offsets go on from one document to the next, so each document's last ends are shared.
    ends_a, ends_b = np.cumsum(encoders.own_a.sizes[a]), np.cumsum(encoders.own_b.sizes[b])
    upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
    if len(a):
        cuts = shared_cuts(ends_a, ends_b, upto_a[n_a > 0] - 1)
        at_a, at_b = links(ends_a, ends_b)
    else:
        cuts = at_a = at_b = np.zeros(0, np.int64)
    group_a = _numbered(cuts, len(a))
    group_b = _numbered(np.searchsorted(ends_b, ends_a[cuts]), len(b))
    found = []
    for size_a, size_b, to_a, to_b in zip(n_a.tolist(), n_b.tolist(), upto_a.tolist(), upto_b.tolist()):
        own_a, own_b = slice(to_a - size_a, to_a), slice(to_b - size_b, to_b)
        text = show(encoders.shown, a[own_a], b[own_b], group_a[own_a], group_b[own_b])
        found.append(hashlib.sha256(text.encode()).hexdigest() if size_a else "")
    pairs, codes, counts = np.unique(
        a[at_a] * len(encoders.own_b.tokens) + b[at_b], return_inverse=True, return_counts=True)

    def per_document(indices: np.ndarray) -> list[int]:
        """How many of the indices of a's tokens lie in each document."""
        return np.diff(np.searchsorted(indices, np.concatenate([[0], upto_a]))).tolist()

    lists = {"n_a": n_a.tolist(), "n_b": n_b.tolist(), "n_groups": per_document(cuts), "n_links": per_document(at_a),
             "pairs": pairs, "counts": counts, "doc_ids": [doc_id for doc_id, _ in rows]}
    return pa.RecordBatch.from_pydict(
        {"block": pa.array([number], pa.int64())}
        | {name: pa.array([lists[name]], pa.list_(pa.int64())) for name in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")}
        | {"digests": pa.array([found], pa.list_(pa.string())), "codes": pa.array([blocks.pack(codes.astype(np.uint32))], pa.binary())}
        | {name: pa.array([lists[name]], pa.list_(pa.int64())) for name in ("pairs", "counts")})


def aligned_blocks(docs: DataFrame, make: Callable[[], Encoders], total: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of ``docs`` (doc_id, text), ``total`` bytes in all: see BLOCK."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders, number, rows, size = make(), TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for row in blocks.pairs(batch):
                rows.append(row)
                size += len(row[1] or "")
                if size >= block_bytes:
                    yield _block(encoders, number, rows)
                    number, rows, size = number + 1, [], 0
        if rows:
            yield _block(encoders, number, rows)

    made = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, BLOCK)
    return blocks.store(made, total)


def pair_counts(stored: DataFrame, n_b: int) -> DataFrame:
    """``pair, total, best``: links of each pair of ids, and whether no id of A has more with this id of B."""
    each = stored.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    totals = cut_lineage(each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("total")))
    own = F.pmod("pair", F.lit(n_b)).alias("id_b")
    most = totals.groupBy(own).agg(F.max("total").alias("most"))
    return totals.select("pair", "total", own).join(most, "id_b").select(
        "pair", "total", (F.col("total") == F.col("most")).alias("best"))


def _scored(own: pa.Table, answered: pa.Table) -> pa.Table:
    """One row per document of a block, from its links' counts."""
    row = own.to_pylist()[0]
    order = np.argsort(answered.column("at").to_numpy())
    totals = answered.column("total").to_numpy()[order]
    best = answered.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    (codes,) = blocks.unpack(row["codes"], np.uint32)
    upto = np.concatenate([[0], np.cumsum(row["n_links"])]).astype(np.int64)

    def sums(values: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(values[codes])])[upto])

    none = np.zeros(0, np.int64)
    return pa.table({
        "doc_id": pa.array(row["doc_ids"], pa.int64()),
        **{c: pa.array(row[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")},
        "n_best": sums(best if len(best) else none), "count_sum": sums(totals if len(totals) else none),
        "groups_sha256": pa.array(row["digests"], pa.string())})


def align(docs: DataFrame, byte_level: str, pieces: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), see COUNTED; the paths are those of the two vocabularies."""
    def encoders() -> Encoders:
        return common.per_worker(f"alignment of {byte_level}, {pieces}", lambda: Encoders(byte_level, pieces))

    stored = aligned_blocks(docs, encoders, blocks.text_bytes(docs), block_bytes)
    n_b = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
    asked = stored.select("block", F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(pair_counts(stored, n_b), "pair").select(
        F.col("block").alias("asked"), "at", "total", "best")
    own = stored.select("block", "doc_ids", "n_a", "n_b", "n_groups", "n_links", "digests", "codes")
    return own.groupBy("block").cogroup(answers.groupBy("asked")).applyInArrow(_scored, COUNTED)


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups, links and corpus-wide link counts of every document."""
    return align(common.documents(spark, sf_dir), public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES))
