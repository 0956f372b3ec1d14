"""Texts as blocks with their own dictionaries.

A task gathers documents into blocks of a few megabytes. Within a block every token is
a code of the block's dictionary, so what has to meet the rest of the corpus is one
row per (block, distinct token), however often the token occurs: the most frequent
token has no more rows than there are blocks. These rows travel in packets, one per
(block, bucket of tokens), and their answers come back in the same order.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataglean.session import scratch_path

# Bytes of text in a block, bytes of text for each bucket, most buckets.
BLOCK_BYTES, BUCKET_BYTES, MAX_BUCKETS = 6 << 20, 8 << 20, 20_000
# Bytes of text whose blocks lie in one bucket of the table, and most of its buckets.
TABLE_BYTES, MAX_TABLE_BUCKETS = 32 << 20, 50_000

BLOCK = "block long, doc_ids array<long>, lengths array<long>, codes binary, extra binary"
PACKET = "block long, bucket long, packet binary"
TABLE = f"{BLOCK}, bucket long, packet binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string; integers byte plane by byte plane, which compresses best."""
    parts = []
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
        parts.append(len(a).to_bytes(8, "little") + a.itemsize.to_bytes(1, "little") + planes.tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpack(packet: bytes, *types: type) -> list[np.ndarray]:
    """The arrays of :func:`pack`."""
    data, at, found = zstandard.ZstdDecompressor().decompress(packet), 0, []
    for kind in types:
        n, width = int.from_bytes(data[at : at + 8], "little"), data[at + 8]
        at += 9
        planes = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        found.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * width
    return found


def pack_tokens(tokens: list[bytes]) -> bytes:
    return pack(np.array([len(t) for t in tokens], np.uint32), np.frombuffer(b"".join(tokens), np.uint8))


def unpack_tokens(packet: bytes) -> list[bytes]:
    lengths, data = unpack(packet, np.uint32, np.uint8)
    ends, whole = np.cumsum(lengths, dtype=np.int64).tolist(), data.tobytes()
    return [whole[a:b] for a, b in zip([0, *ends], ends)]


def text_bytes(docs: DataFrame) -> int:
    return int(docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0)


def portions(total: int, size: int, most: int) -> int:
    """How many portions of ``size`` bytes ``total`` makes: one at least, ``most`` at most."""
    return min(most, -(-total // size) or 1)


def pairs(batch: pa.RecordBatch, rows: int = 128) -> Iterator[tuple]:
    """Rows of a batch, some at a time: texts as Python objects are larger than in a batch."""
    for start in range(0, batch.num_rows, rows):
        yield from zip(*(c.to_pylist() for c in batch.slice(start, rows).columns))


def gather(batches: Iterator[pa.RecordBatch], split: Callable[[str], list],
           block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, list, list, np.ndarray, list]]:
    """Blocks of (doc_id, text) rows: number, ids, numbers of tokens, codes, distinct tokens.

    Frequent tokens have small codes; the tokens come in the order of their codes. A block's
    number is the same whenever its task runs again.
    """
    task = TaskContext.get().partitionId() << 32

    def block() -> tuple[int, list, list, np.ndarray, list]:
        flat = np.concatenate(codes)
        often = np.bincount(flat, minlength=len(known)) if len(flat) else np.zeros(0, np.int64)
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        tokens = list(known)
        return task + next(numbers), ids, lengths, rank[flat], [tokens[i] for i in order]

    numbers = count()
    ids, lengths, codes, size = [], [], [], 0
    known: dict = defaultdict(count().__next__)
    for batch in batches:
        for doc_id, text in pairs(batch):
            tokens = split(text or "")
            ids.append(doc_id)
            lengths.append(len(tokens))
            codes.append(np.fromiter(map(known.__getitem__, tokens), np.uint32, len(tokens)))
            size += len(text or "")
            if size >= block_bytes:
                yield block()
                ids, lengths, codes, size = [], [], [], 0
                known = defaultdict(count().__next__)
    if ids:
        yield block()


def batch_of(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    return pa.RecordBatch.from_pylist(rows, pa.schema([(name, kinds[kind]) for name, kind in fields]))


def store(made: DataFrame, total: int) -> DataFrame:
    """Write rows of one or more kinds to the shared folder, dealt by block, and read them again.

    So no part is computed twice, and what is joined to the blocks later is dealt alike and
    the blocks stay where they are.
    """
    spark = made.sparkSession
    path = scratch_path(spark, "blocks")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    (made.write.bucketBy(portions(total, TABLE_BYTES, MAX_TABLE_BUCKETS), "block").option("path", path)
     .option("compression", "none").format("parquet").saveAsTable(name))
    table = spark.table(name)
    return table


def build(docs: DataFrame, split: Callable[[str], list], token_bytes: Callable[[object], bytes],
          total: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of ``docs`` (doc_id, text), ``total`` bytes in all: see TABLE.

    One row per block has its documents' ids, their numbers of tokens, all codes, and for each
    code its bucket. One row per (block, bucket) has the bucket's distinct tokens in the
    order of their codes.
    """
    buckets = portions(total, BUCKET_BYTES, MAX_BUCKETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, lengths, codes, known in gather(batches, split, block_bytes):
            tokens = [token_bytes(t) for t in known]
            place = np.fromiter((crc32(t) % buckets for t in tokens), np.uint32, len(tokens))
            yield batch_of([{"block": block, "doc_ids": ids, "lengths": lengths, "codes": pack(codes),
                             "extra": pack(place)}], TABLE)
            by_bucket = np.argsort(place, kind="stable")
            cuts = np.flatnonzero(np.diff(place[by_bucket])) + 1
            rows = [{"block": block, "bucket": int(place[part[0]]), "packet": pack_tokens([tokens[i] for i in part])}
                    for part in np.split(by_bucket, cuts) if len(part)]
            if rows:
                yield batch_of(rows, TABLE)

    made = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, TABLE)
    return store(made, total)


def answer(blocks: DataFrame, reply: Callable[[list[bytes]], bytes], forget: Callable[[], None]) -> DataFrame:
    """Packets of tokens through ``reply``, dealt by bucket, so that equal tokens meet.

    ``forget`` is called whenever another bucket begins.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for start in range(0, batch.num_rows, 16):
                part = batch.slice(start, 16)
                rows = []
                for block, bucket, packet in zip(*(c.to_pylist() for c in part.columns)):
                    if bucket != last:
                        forget()
                        last = bucket
                    rows.append({"block": block, "bucket": bucket, "packet": reply(unpack_tokens(packet))})
                yield batch_of(rows, PACKET)

    asked = blocks.filter("packet is not null").select("block", "bucket", "packet")
    return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, PACKET)


def reassemble(blocks: DataFrame, answers: DataFrame, finish: Callable[[dict, list[bytes]], pa.Table],
               schema: str) -> DataFrame:
    """``finish`` for every block's row and its answers by bucket."""
    def run(own: pa.Table, answered: pa.Table) -> pa.Table:
        parts = sorted(zip(answered.column("bucket").to_pylist(), answered.column("packet").to_pylist()))
        return finish(own.to_pylist()[0], [packet for _, packet in parts])

    own = blocks.filter("codes is not null").select("block", "doc_ids", "lengths", "codes", "extra")
    return own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
