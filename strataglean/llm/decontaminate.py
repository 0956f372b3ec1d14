"""Benchmark decontamination by greedy string tiling.

Tokens are the maximal runs of letters and digits of the lower-cased text (ASCII punctuation
and white space separate). A document is contaminated by a benchmark item if tiles, common
passages of at least five tokens that overlap in neither text, cover at least COVERAGE of
the item's tokens; their order does not matter, so a reordered passage is found too.

1. Karp-Rabin: every run of five tokens has a rolling hash. The benchmark's hashes set the bits
   of a filter whose size is a parameter; a document's runs that hit it are seeds. Few do.
2. Seeds join the benchmark's runs by their tokens, not their hash, which gives pairs of
   places (document, item) that begin a match.
3. Places on one diagonal in a row make maximal matches. Per (document, item) the longest
   match whose tokens are all free is marked as a tile, again and again; a match that is partly
   taken goes on with what is left of it, down to five tokens.

Items shorter than five tokens need no seed of their own length and can't be found; an item's or
document's null text has no tokens. Null ids are kept. Rows that repeat an id are told apart by
their text; equal rows give one result. Empty tables give an empty result. Places gathered
for one (document, item) are no more than the places of that one document's text.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataglean.llm import common
from strataglean.session import cut_lineage

MATCH, COVERAGE = 5, 0.8
# Bits of the filter of the benchmark's hashes (2 MB), hashed tokens a task remembers.
FILTER_BITS, REMEMBERED = 1 << 24, 150_000
# Fixed value: the base of the rolling hash, modulo 2^64.
BASE = np.uint64(0x9E3779B97F4A7C15)
SEPARATORS = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def tokens(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(SEPARATORS).split()


def rolling_hashes(words: list[bytes], length: int = MATCH) -> np.ndarray:
    """Karp-Rabin hash of every run of ``length`` tokens."""
    n = len(words) - length + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    known = common.per_worker("token hashes", dict)
    if len(known) > REMEMBERED:
        known.clear()
    missing = set(words).difference(known)
    known.update(zip(missing, map(xxhash.xxh64_intdigest, missing)))
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    total = np.zeros(n, np.uint64)
    for i in range(length):
        total = total * BASE + each[i : i + n]
    return total


def _bits(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(17)) % np.uint64(bits)


RUNS = "id long, print long, n_tokens int, place int, run string"


def _printed(table: DataFrame, key: str) -> DataFrame:
    """``id, print, text``; the print tells rows with one id apart."""
    return table.select(F.col(key).cast("long").alias("id"), F.xxhash64(common.whole_text()).alias("print"),
                        common.whole_text().alias("text"))


def _runs(bits: np.ndarray | None):
    """Tasks that list runs of a table (id, print, text): all, or those that hit the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, own, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = tokens(text)
                hashes = rolling_hashes(words)
                if bits is None:
                    places = np.arange(len(hashes))
                else:
                    places = np.flatnonzero(bits[_bits(hashes, len(bits))])
                if not len(places):
                    continue
                n = len(places)
                yield pa.RecordBatch.from_arrays([
                    pa.array([number] * n, pa.int64()), pa.array([own] * n, pa.int64()),
                    pa.array([len(words)] * n, pa.int32()), pa.array(places, pa.int32()),
                    pa.array([b" ".join(words[p : p + MATCH]).decode() for p in places], pa.string()),
                ], ["id", "print", "n_tokens", "place", "run"])

    return run


def _filter_of(items: DataFrame, bits: int) -> np.ndarray:
    """The benchmark's hashes as a filter of fixed size; tasks send the numbers of its bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [_bits(rolling_hashes(tokens(t)), bits) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.unique(np.concatenate(marks or [np.zeros(0, np.uint64)])).astype(np.int64))], ["bit"])

    found = np.zeros(bits, bool)
    numbers = items.select("text").mapInArrow(run, "bit long").distinct()
    for start in numbers.groupBy(F.shiftright("bit", 14)).agg(F.collect_list("bit").alias("bits")).toLocalIterator():
        found[start["bits"]] = True  # at most as many numbers as the filter has bits
    return np.packbits(found)


def tiles(places: list[tuple[int, int]], length: int = MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiles (document place, item place, tokens) from the places where ``length`` tokens match."""
    runs, heap = {}, []
    for x, y in sorted(places, key=lambda p: (p[0] - p[1], p[0])):
        last = runs.get(x - y)
        if last and last[0] + last[1] == x:
            last[1] += 1
        else:
            if last:
                heap.append((-(last[1] + length - 1), last[0], last[0] - (x - y)))
            runs[x - y] = [x, 1]
    heap += [(-(n + length - 1), x, x - diagonal) for diagonal, (x, n) in runs.items()]
    heapq.heapify(heap)
    mine, theirs, found = set(), set(), []
    while heap:
        n, x, y = heapq.heappop(heap)
        free = [x + i not in mine and y + i not in theirs for i in range(-n)]
        if all(free):
            found.append((x, y, -n))
            mine.update(range(x, x - n))
            theirs.update(range(y, y - n))
            continue
        start = 0
        for i in range(-n + 1):
            if i == -n or not free[i]:
                if i - start >= length:
                    heapq.heappush(heap, (start - i, x + start, y + start))
                start = i + 1
    return found


def _tile_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            found = tiles([(p["place"], p["item_place"]) for p in row.pop("places")])
            covered = sum(n for _, _, n in found)
            rows.append(row | {"n_tiles": len(found), "longest_tile": max(n for _, _, n in found),
                               "n_covered": covered})
        yield pa.RecordBatch.from_pylist(rows, pa.schema(
            [("doc_id", pa.int64()), ("print", pa.int64()), ("item_id", pa.int64()), ("n_item_tokens", pa.int32()),
             ("n_tiles", pa.int32()), ("longest_tile", pa.int32()), ("n_covered", pa.int32())]))


def matches(docs: DataFrame, items: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``doc_id, print, item_id, n_item_tokens, n_tiles, longest_tile, n_covered`` of all that share a tile."""
    numbered = _printed(items, "item_id")
    theirs = cut_lineage(numbered.mapInArrow(_runs(None), RUNS).distinct().select(
        F.col("id").alias("item_id"), F.col("print").alias("item_print"), F.col("n_tokens").alias("n_item_tokens"),
        F.col("place").alias("item_place"), "run"))
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(numbered, bits))

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _runs(np.unpackbits(shared.value, count=bits).astype(bool))(batches)

    mine = cut_lineage(_printed(docs, "doc_id").mapInArrow(seeds, RUNS))
    pairs = mine.join(theirs, "run").groupBy(
        F.col("id").alias("doc_id"), "print", "item_id", "item_print", "n_item_tokens")
    gathered = pairs.agg(F.collect_set(F.struct("place", "item_place")).alias("places"))
    return gathered.select("doc_id", "print", "item_id", "n_item_tokens", "places").mapInArrow(
        _tile_batches, "doc_id long, print long, item_id long, n_item_tokens int, n_tiles int, "
        "longest_tile int, n_covered int")


def contaminated(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The matches that cover at least ``coverage`` of their item."""
    return matches(docs, items).filter(F.col("n_covered") >= coverage * F.col("n_item_tokens"))


def remove_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents."""
    own, bad_id, bad_print = (common.fresh(c, docs.columns) for c in ("own_print", "bad_id", "bad_print"))
    found = contaminated(docs, items).select(F.col("doc_id").alias(bad_id), F.col("print").alias(bad_print)).distinct()
    return docs.withColumn(own, F.xxhash64(common.whole_text())).join(
        found, F.col("doc_id").cast("long").eqNullSafe(F.col(bad_id)) & (F.col(own) == F.col(bad_print)),
        "left_anti").drop(own)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents with their items, tiles and coverage."""
    found = contaminated(common.documents(spark, sf_dir), common.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item_tokens", "n_tiles", "longest_tile", "n_covered",
                        F.round(F.col("n_covered") / F.col("n_item_tokens"), 6).alias("coverage"))
