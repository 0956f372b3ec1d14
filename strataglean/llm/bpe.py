"""Byte-level BPE encoding and decoding by a shuffle of distinct words.

Texts are split into pre-tokens; a document is the sequence of its pre-tokens with
their positions. Every distinct pre-token of a block goes once to the task of its
bucket, where equal words of all blocks meet and each is merged once; the ids join
back to the block and are put together by position. Decoding joins ids to the table
of token bytes, which is as large as the vocabulary and no larger.

Null and empty texts have no tokens and decode to the empty string; texts may be of any
length; null and repeated ids and extra columns are no matter, since documents are
told apart by their place in a block. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable
from typing import Any

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from strataglean.llm import blocks, common
from strataglean.llm.letters import exchanges, splitter

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Merged words a task remembers within a bucket; the length from which a heap finds the next merge.
REMEMBERED, LONG = 100_000, 96


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file, which is far smaller than a task's input."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_parts(parts: list, rank: Callable[[Any, Any], int | None]) -> list:
    """Merge neighbours while any pair has a rank: the lowest first, the leftmost of equals."""
    parts = list(parts)
    ranks = [rank(a, b) for a, b in zip(parts, parts[1:])]
    while True:
        best, at = None, 0
        for i, r in enumerate(ranks):
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            return parts
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del ranks[at]
        if at < len(ranks):
            ranks[at] = rank(parts[at], parts[at + 1])
        if at:
            ranks[at - 1] = rank(parts[at - 1], parts[at])


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token."""
    if word in ranks:
        return [ranks[word]]
    if len(word) >= LONG:
        return _merge_long(word, ranks)
    parts = merge_parts([word[i : i + 1] for i in range(len(word))], lambda a, b: ranks.get(a + b))
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for a long word: pairs wait in a heap, parts are linked by their ends."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n))
    heap: list[tuple[int, int, int]] = []

    def offer(start: int) -> None:
        middle = end[start]
        if middle < n and (rank := ranks.get(word[start : end[middle]])) is not None:
            heapq.heappush(heap, (rank, start, end[middle]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, start, stop = heapq.heappop(heap)
        middle = end[start]
        if middle < 0 or middle >= n or end[middle] != stop:
            continue  # one of the two parts has merged since
        end[start], end[middle] = stop, -1
        if stop < n:
            before[stop] = start
        offer(start)
        if before[start] >= 0:
            offer(before[start])
    ids, at = [], 0
    while at < n:
        ids.append(ranks[word[at : end[at]]])
        at = end[at]
    return ids


def token_table(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each id, as many as the vocabulary has."""
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def join_bytes(ids: list[int], table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN,
           decoded: bool = False) -> DataFrame:
    """``doc_id, ids`` for every row of ``docs`` (doc_id, text).

    With ``decoded`` also ``bytes``, what the ids decode to, by the same Python worker that puts
    them together; :func:`decode` is for ids that lie in a table.
    """
    split = splitter(pattern, exchanges("tiktoken"))
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # bounded by the vocabulary file
    known: dict[bytes, list[int]] = {}

    def reply(words: list[bytes]) -> bytes:
        table, found = shared.value, []
        for word in words:
            ids = known.get(word)
            if ids is None:
                ids = known[word] = merge(word, table)
            found.append(ids)
        if len(known) > REMEMBERED:
            known.clear()
        return blocks.pack(np.array([len(x) for x in found], np.uint32),
                           np.fromiter((i for x in found for i in x), np.uint32))

    def finish(block: dict, packets: list[bytes]) -> pa.Table:
        (codes,), (place,) = (blocks.unpack(block[c], np.uint32) for c in ("codes", "extra"))
        answers = [blocks.unpack(p, np.uint32, np.uint32) for p in packets]
        sizes = np.concatenate([a for a, _ in answers] or [place])
        flat = np.concatenate([b for _, b in answers] or [place]).astype(np.int32)
        # Answers come by bucket and, within one, by code.
        by_bucket = np.argsort(place, kind="stable")
        starts, n_ids = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
        starts[by_bucket], n_ids[by_bucket] = np.cumsum(sizes, dtype=np.int64) - sizes, sizes
        found, at = [], 0
        table = token_table(shared.value) if decoded else []
        for first in range(0, len(block["doc_ids"]), 64):  # ids are more than the words they come from
            lengths = np.array(block["lengths"][first : first + 64], np.int64)
            words = codes[at : at + int(lengths.sum())]
            at += len(words)
            n = n_ids[words]
            upto = np.concatenate([[0], np.cumsum(n)])
            ids = flat[np.arange(upto[-1]) + np.repeat(starts[words] - upto[:-1], n)]
            offsets = upto[np.concatenate([[0], np.cumsum(lengths)])].astype(np.int32)
            columns = {"doc_id": pa.array(block["doc_ids"][first : first + 64], pa.int64()),
                       "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))}
            if decoded:
                columns["bytes"] = pa.array(
                    [join_bytes(ids[a:b].tolist(), table) for a, b in zip(offsets, offsets[1:])], pa.binary())
            found.append(pa.RecordBatch.from_pydict(columns))
        return pa.Table.from_batches(found)

    made = blocks.build(docs, split, str.encode, blocks.text_bytes(docs))
    answers = blocks.answer(made, reply, known.clear)
    return blocks.reassemble(
        made, answers, finish, "doc_id long, ids array<int>" + (", bytes binary" if decoded else ""))


def decoder(ranks: dict[bytes, int]) -> Callable[[Column], Column]:
    """A column function from arrays of ids to the bytes they stand for; null for null."""
    table = token_table(ranks)

    @F.pandas_udf(BinaryType())
    def decode(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: None if x is None else join_bytes(x.tolist(), table))

    return decode


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "bytes") -> DataFrame:
    """``encoded`` with the bytes of its id arrays as column ``out``."""
    return encoded.withColumn(out, decoder(ranks)(F.col(ids)))


def digests(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    both = encode(docs, ranks, decoded=True)

    def digest(column: Column) -> Column:
        return F.sha2(column, 256)

    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        digest(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")).alias("ids_sha256"),
        digest(F.col("bytes")).alias("decoded_sha256"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    return digests(common.documents(spark, sf_dir), read_ranks(public_tokenizers.path(VOCABULARY)))
