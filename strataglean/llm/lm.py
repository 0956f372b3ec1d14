"""Stupid-backoff language-model scores from n-gram counts of the corpus.

Words are the maximal runs without ASCII white space, A-Z lower-cased. Every document
is scored by the n-grams, up to ORDER words, of all other documents: its own occurrences are taken
off each count. A word's score is c(n-gram) / c(context) for the longest n-gram that still
occurs, times ALPHA for each word of context given up; the first words of a text have less
context. A word that occurs nowhere else scores ALPHA once more over the number of words.

1. Tasks gather documents into blocks; a block lists each of its distinct n-grams once, with
   its count there, as a 64-bit hash. So the most frequent n-gram has one entry per block.
2. The entries are dealt into buckets, which are ranges of hashes, so that only the small
   differences of sorted hashes travel. There the count table of the bucket is summed
   and joined to the entries again. Totals go back to their blocks.
3. Each block joins the totals to its exploded n-grams and sums the scores per document.

Null and empty texts have no words and score 0. Repeated rows and ids are told apart by their
place in a block and count as documents of their own. Null ids are kept. An empty table gives
an empty result. N-grams whose hashes collide (2^-64 a pair) would share a count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataglean.llm import blocks, common
from strataglean.llm.blocks import BLOCK, PACKET, batch_of, gather, pack, portions, unpack

ORDER, ALPHA = 2, 0.4
# Words of the longest n-grams of the query that goes beyond pairs.
LONG_ORDER = 3
# Bytes of text for each bucket of uni- and bigrams (fewer with longer ones), and most buckets.
BUCKET_BYTES, MAX_BUCKETS = 8 << 20, 1 << 22
# Fixed value: the base that joins the hashes of words, modulo 2^64.
BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[bytes]:
    return text.encode().lower().split()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of BLOCK; the extra column has the hashes of the words by code."""
    for block, ids, lengths, codes, tokens in gather(batches, words):
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
        yield batch_of([{"block": block, "doc_ids": ids, "lengths": lengths, "codes": pack(codes),
                         "extra": pack(hashes)}], BLOCK)


def _grams(codes: np.ndarray, hashes: np.ndarray, lengths: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n-gram that ends at each word, and whether it lies in one document."""
    each = hashes[codes] if len(codes) else np.zeros(0, np.uint64)
    place = np.arange(len(each)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    gram = np.full(len(each), np.uint64(order))
    for back in range(order - 1, -1, -1):
        shifted = np.zeros(len(each), np.uint64)
        shifted[back:] = each[: len(each) - back]
        gram = (gram * BASE) ^ shifted
        gram ^= gram >> np.uint64(29)
    return gram * BASE, place >= order - 1


def block_grams(codes: np.ndarray, hashes: np.ndarray, lengths: np.ndarray, order: int):
    """Per length of n-gram: for each word the number of its n-gram (or -1); and all n-grams.

    The distinct n-grams of a block are numbered by hash; buckets are ranges of hashes, so bucket
    by bucket they are what the packets hold.
    """
    whole, inside = zip(*(_grams(codes, hashes, lengths, k) for k in range(1, order + 1)))
    distinct, inverse, counts = np.unique(
        np.concatenate([g[i] for g, i in zip(whole, inside)]), return_inverse=True, return_counts=True)
    numbers, at = [], 0
    for i in inside:
        own = np.full(len(i), -1, np.int64)
        own[i] = inverse[at : at + int(i.sum())]
        at += int(i.sum())
        numbers.append(own)
    return numbers, distinct, counts


def pack_sorted(hashes: np.ndarray, *more: np.ndarray) -> bytes:
    """:func:`pack` with the differences of sorted hashes, whose upper bytes are mostly zero."""
    return pack(np.diff(hashes, prepend=hashes[:1]), hashes[:1], *more)


def unpack_sorted(packet: bytes, *types: type) -> list[np.ndarray]:
    steps, first, *more = unpack(packet, np.uint64, np.uint64, *types)
    return [np.cumsum(steps, dtype=np.uint64) + first, *more]


def _read_block(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    (codes,), (hashes,) = unpack(row["codes"], np.uint32), unpack(row["extra"], np.uint64)
    return codes, hashes, np.array(row["lengths"], np.int64)


def _packets(order: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, distinct, counts = block_grams(*_read_block(row), order)
                bucket = (distinct >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                starts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
                found = [(int(bucket[a]), pack_sorted(distinct[a:b], counts[a:b].astype(np.uint32)))
                         for a, b in zip(starts, starts[1:]) if b > a]
                for first in range(0, len(found), 256):
                    part = found[first : first + 256]
                    yield batch_of([{"block": row["block"], "bucket": b, "packet": p} for b, p in part], PACKET)

    return run


def _totals(bucket: pa.Table) -> pa.Table:
    """The bucket's count table, joined to the entries of each block."""
    packets = [unpack_sorted(p, np.uint32) for p in bucket.column("packet").to_pylist()]
    everything = np.concatenate([h for h, _ in packets])
    distinct, place = np.unique(everything, return_inverse=True)
    totals = np.zeros(len(distinct), np.uint64)
    np.add.at(totals, place, np.concatenate([n for _, n in packets]).astype(np.uint64))
    answers, at = [], 0
    for hashes, _ in packets:
        answers.append(pack(totals[place[at : at + len(hashes)]]))
        at += len(hashes)
    return pa.table({"block": bucket.column("block"), "bucket": bucket.column("bucket"),
                     "packet": pa.array(answers, pa.binary())})


def document_score(numbers: list[np.ndarray], totals: np.ndarray, n_corpus: int, alpha: float) -> tuple:
    """Words, sum of log scores, words scored below their longest n-gram, words seen nowhere else."""
    n = len(numbers[0])
    if not n:
        return 0, 0.0, 0, 0
    rest = []  # counts without the document's own, per length
    for own in numbers:
        left = np.zeros(n, np.int64)
        inside = own >= 0
        grams, place, times = np.unique(own[inside], return_inverse=True, return_counts=True)
        left[inside] = (totals[grams].astype(np.int64) - times)[place] if len(grams) else 0
        rest.append(left)
    others = max(n_corpus - n, 1)
    possible = np.minimum(np.arange(n) + 1, len(numbers))  # the longest n-gram that a word can end
    score, used = np.full(n, 1 / others), np.zeros(n, np.int64)
    for k, left in enumerate(rest, 1):
        # The context of an n-gram is the one that ends a word earlier, one word shorter.
        below = np.concatenate([[1], rest[k - 2][:-1]]) if k > 1 else np.full(n, others)
        seen = left > 0
        score[seen], used[seen] = left[seen] / below[seen], k
    logs = np.log(score) + (possible - used) * np.log(alpha)
    return n, float(logs.sum()), int((used < possible).sum()), int((used == 0).sum())


RESULT = "doc_id long, n_words long, log_score double, n_backoff long, n_unseen long"


def score(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA) -> DataFrame:
    """``doc_id, n_words, log_score, n_backoff, n_unseen`` for every row of ``docs`` (doc_id, text)."""
    total = blocks.text_bytes(docs)
    buckets = portions(total * max(order, 2) // 2, BUCKET_BYTES, MAX_BUCKETS)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_blocks, BLOCK)
    table = blocks.store(rows, total)
    n_corpus = int(table.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0)
    packets = table.mapInArrow(_packets(order, buckets), PACKET)
    answers = packets.groupBy("bucket").applyInArrow(_totals, PACKET)

    def finish(block: dict, found: list[bytes]) -> pa.Table:
        numbers, _, _ = block_grams(*_read_block(block), order)
        totals = np.concatenate([unpack(p, np.uint64)[0] for p in found] or [np.zeros(0, np.uint64)])
        scores, at = [], 0
        for n in block["lengths"]:
            scores.append(document_score([x[at : at + n] for x in numbers], totals, n_corpus, alpha))
            at += n
        return pa.table({"doc_id": pa.array(block["doc_ids"], pa.int64())} | dict(
            zip(["n_words", "log_score", "n_backoff", "n_unseen"], map(pa.array, zip(*scores)))))

    return blocks.reassemble(table, answers, finish, RESULT)


def _rounded(found: DataFrame) -> DataFrame:
    mean = F.col("log_score") / F.greatest(F.col("n_words"), F.lit(1))
    return found.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"),
                        F.round(mean, 6).alias("mean_log_score"), "n_backoff", "n_unseen")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its words, log score, mean log score, and how often it backed off."""
    return _rounded(score(common.documents(spark, sf_dir)))


def op10_lm_scoring_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with n-grams of up to LONG_ORDER words; the SQL of op10_lm_scoring ends at pairs."""
    return _rounded(score(common.documents(spark, sf_dir), LONG_ORDER))


ORACLE = rf"""with d as (select row_number() over () r, doc_id,
    {common.WORDS_SQL.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ws
    from documents),
  p as (select r, unnest(ws) w, unnest(range(len(ws))) i from d),
  q as (select r, i, w, lag(w) over (partition by r order by i) c from p),
  tot as (select count(*) n from p),
  u as (select w, count(*) n from p group by 1), ud as (select r, w, count(*) n from p group by 1, 2),
  b as (select c, w, count(*) n from q where c is not null group by 1, 2),
  bd as (select r, c, w, count(*) n from q where c is not null group by 1, 2, 3),
  x as (select q.r, q.c, greatest(tot.n - len(d.ws), 1) others, u.n - ud.n uni,
      coalesce(uc.n - udc.n, 0) ctx, coalesce(b.n - bd.n, 0) bi
    from q join d using (r) cross join tot join u using (w) join ud on ud.r = q.r and ud.w = q.w
    left join b on b.c = q.c and b.w = q.w left join bd on bd.r = q.r and bd.c = q.c and bd.w = q.w
    left join u uc on uc.w = q.c left join ud udc on udc.r = q.r and udc.w = q.c),
  s as (select r, case when bi > 0 then ln(bi / ctx)
      when uni > 0 then ln(uni / others) + if(c is null, 0, ln({ALPHA}))
      else ln(1 / others) + if(c is null, 1, 2) * ln({ALPHA}) end v,
    (bi = 0 and not (c is null and uni > 0))::bigint back, (bi = 0 and uni = 0)::bigint unseen from x),
  t as (select r, sum(v) v, sum(back)::bigint back, sum(unseen)::bigint unseen from s group by r)
select doc_id, len(ws)::bigint n_words, round(coalesce(v, 0), 4) log_score,
  round(coalesce(v, 0) / greatest(len(ws), 1), 6) mean_log_score,
  coalesce(back, 0)::bigint n_backoff, coalesce(unseen, 0)::bigint n_unseen from d left join t using (r)"""
