"""SimHash near-duplicates by the generalised pigeonhole principle.

A document's words are the maximal runs without ASCII white space after A-Z are
lower-cased; its features are all three-word shingles, repeats included (with fewer
words the whole sequence, without words none). Bit b of the 64-bit fingerprint is set
if it is set in more than half of the features' XXH64. Two fingerprints are linked
if they differ in at most three bits.

Links are found among distinct fingerprints:

1. Frequencies and correlations of the 64 bits are summed over all fingerprints.
2. Strongly correlated bits are grouped into m partitions, for m = 2, 3, 4.
3. If a pair differs in at most T bits and thresholds t_i have sum(t_i + 1) = T + 1,
   some partition differs in at most t_i bits. Dynamic programming chooses the t_i
   that make index rows, probes and expected candidates cheapest; -1 skips a partition.
4. Every fingerprint is indexed by its value in each partition used, and probes all
   values within t_i bits. Candidates are verified in the join.

A value that very many fingerprints share is cut into blocks; a pair of blocks is
compared by one task, which returns a spanning forest of its links and not all pairs.

Null and empty texts have fingerprint zero and are linked like any other. Repeated
rows and null ids are kept: the result has one row per input row, and a component's
id is its smallest non-null doc_id. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from strataglean.llm import common
from strataglean.operators.graph import connected_components
from strataglean.session import cut_lineage
from strataglean.skew import broadcast_checked

SEED, SHINGLE, BITS, MAX_DISTANCE = 42, 3, 64, 3
# Shingles hashed at a time, so that a very long text needs little memory.
PIECE = 1 << 16
# Fingerprints with one value of a partition before they are cut into blocks, and a block's size.
HOT_VALUE, BLOCK = 512, 2048
# Cost of a candidate pair in units of a row that is shuffled.
PAIR_COST = 0.05
# Rows of 16 bytes up to which the ids of the documents that stay are broadcast.
BROADCAST_IDS = 1_000_000


def fingerprint(text: bytes | None) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    ones, total = np.zeros(BITS, np.int64), len(words) - SHINGLE + 1
    for start in range(0, total, PIECE):
        part = words[start : start + PIECE + SHINGLE - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(SHINGLE))))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def with_fingerprint(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of its text as column ``name``."""
    return docs.withColumn(name, _fingerprints(F.col("text").cast("string").cast("binary")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp``, one row per document."""
    return with_fingerprint(docs.select(F.col("doc_id").cast("long"), "text"), "fp").select("doc_id", "fp")


def _bit_sums(batches):
    ones = np.zeros((BITS, BITS))
    rows = 0
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for start in range(0, len(prints), PIECE):
            part = np.ascontiguousarray(prints[start : start + PIECE]).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(part, axis=1, bitorder="little").astype(np.float64)
            ones += bits.T @ bits
            rows += len(bits)
    i, j = np.divmod(np.arange(BITS * BITS), BITS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(i, -1), pa.int32()), pa.array(np.append(j, -1), pa.int32()),
         pa.array(np.append(ones.ravel(), rows).astype(np.int64))], ["i", "j", "n"])


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often each two bits are set together (64 x 64)."""
    sums = (
        distinct.select("fp").mapInArrow(_bit_sums, "i int, j int, n long")
        .groupBy("i", "j").agg(F.sum("n").alias("n")).collect()  # 4,097 rows at most
    )
    ones, rows = np.zeros((BITS, BITS)), 0
    for i, j, n in sums:
        if i < 0:
            rows = n
        else:
            ones[i, j] = n
    return rows, ones


def group_bits(rows: int, ones: np.ndarray, m: int) -> list[list[int]]:
    """Split the bits into ``m`` partitions of nearly equal width, correlated bits together."""
    p = np.diag(ones) / max(rows, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tied = np.abs(ones / max(rows, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(tied, 0)
    left, groups = list(range(BITS)), []
    for k in range(m):
        width = (BITS - sum(map(len, groups))) // (m - k)
        group = [max(left, key=lambda b: (tied[b, left].sum(), -b))]
        while len(group) < width:
            group.append(max((b for b in left if b not in group),
                             key=lambda b: (tied[b, group].sum(), -b)))
        groups.append(sorted(group))
        left = [b for b in left if b not in group]
    return groups


def _within(differ: np.ndarray, most: int) -> float:
    """Chance that two fingerprints differ in at most ``most`` of these bits."""
    chance = np.zeros(most + 1)
    chance[0] = 1.0
    for d in differ:
        chance[1:] = chance[1:] * (1 - d) + chance[:-1] * d
        chance[0] *= 1 - d
    return float(chance.sum())


def allocate(rows: int, ones: np.ndarray, groups: list[list[int]], distance: int) -> tuple[float, list[int]]:
    """Cheapest thresholds with sum(t + 1) = distance + 1, and their estimated cost."""
    p = np.diag(ones) / max(rows, 1)
    differ = 2 * p * (1 - p)

    def cost(group: list[int], t: int) -> float:
        if t < 0:
            return 0.0
        probes = sum(len(list(combinations(group, k))) for k in range(t + 1))
        if probes > 4096:
            return float("inf")
        pairs = rows * (rows - 1) / 2 * _within(differ[group], t)
        return rows * (probes + 1) + PAIR_COST * pairs

    costs = [[cost(g, t) for t in range(-1, distance + 1)] for g in groups]

    @lru_cache(maxsize=None)
    def best(k: int, left: int) -> tuple[float, tuple[int, ...]]:
        if k == len(groups):
            return (0.0, ()) if left == 0 else (float("inf"), ())
        options = []
        for spent in range(left + 1):
            rest, chosen = best(k + 1, left - spent)
            options.append((costs[k][spent] + rest, (spent - 1, *chosen)))
        return min(options)

    total, chosen = best(0, distance + 1)
    return total, list(chosen)


def plan_probes(rows: int, ones: np.ndarray, distance: int = MAX_DISTANCE) -> list[tuple[list[int], int]]:
    """The partitions to use, with their thresholds."""
    plans = []
    for m in (2, 3, 4):
        groups = group_bits(rows, ones, m)
        total, chosen = allocate(rows, ones, groups, distance)
        plans.append((total, m, [(g, t) for g, t in zip(groups, chosen) if t >= 0]))
    return min(plans)[2]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _probe_rows(distinct: DataFrame, plan: list[tuple[list[int], int]]) -> tuple[DataFrame, DataFrame]:
    """Index rows and probes: ``part, value, fp``."""
    def keyed(part: int, bits: list[int], flips: list[int]) -> DataFrame:
        mask = F.lit(_signed(sum(1 << b for b in bits))).cast("long")
        base = distinct.select(
            "fp", F.explode(F.array(*[F.lit(_signed(x)).cast("long") for x in flips])).alias("flip"))
        return base.select(F.lit(part).alias("part"),
                           F.col("fp").bitwiseXOR(F.col("flip")).bitwiseAND(mask).alias("value"), "fp")

    index, probes = [], []
    for part, (bits, t) in enumerate(plan):
        flips = [sum(1 << b for b in c) for k in range(t + 1) for c in combinations(bits, k)]
        index.append(keyed(part, bits, [0]))
        probes.append(keyed(part, bits, flips))
    return reduce(DataFrame.unionByName, index), reduce(DataFrame.unionByName, probes)


def _forest(frame: pd.DataFrame, distance: int) -> pd.DataFrame:
    """Links that connect what the links between two blocks connect, at most one per fingerprint."""
    prints = np.unique(frame["fp"].to_numpy(np.int64))
    indexed = np.isin(prints, frame.loc[frame["indexed"], "fp"].to_numpy(np.int64))
    probed = np.isin(prints, frame.loc[~frame["indexed"], "fp"].to_numpy(np.int64))
    plain = prints.view(np.uint64)  # bits of a negative number are not those of its absolute value
    near = np.bitwise_count(plain[indexed][:, None] ^ plain[probed][None, :]) <= distance
    rows, columns = prints[indexed], prints[probed]
    open_rows, links = np.ones(len(rows), bool), []
    while open_rows.any():
        start = int(np.argmax(open_rows))
        group, edge = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
        edge[start] = True
        reached = np.zeros(len(columns), bool)
        while edge.any():
            group |= edge
            reached |= near[edge].any(0)
            edge = near[:, reached].any(1) & ~group
        open_rows &= ~group
        members = np.unique(np.concatenate([rows[group], columns[reached]]))
        links.append((np.full(len(members) - 1, members[0]), members[1:]))
    return pd.DataFrame({"src": np.concatenate([a for a, _ in links]) if links else np.array([], np.int64),
                         "dst": np.concatenate([b for _, b in links]) if links else np.array([], np.int64)})


def _hot_links(index: DataFrame, probes: DataFrame, hot: DataFrame, distance: int) -> DataFrame:
    """Links of values that many fingerprints share, block by block."""
    keys = ["part", "value"]
    sizes = cut_lineage(
        hot.join(probes.join(hot.select(*keys), keys, "left_semi").groupBy(*keys)
                 .agg(F.count(F.lit(1)).alias("n_probes")), keys)
        .select(*keys, F.ceil(F.col("n") / BLOCK).cast("int").alias("index_blocks"),
                F.ceil(F.col("n_probes") / BLOCK).cast("int").alias("probe_blocks")))
    own = F.xxhash64("fp")
    left = index.join(sizes, keys).select(
        *keys, "fp", F.lit(True).alias("indexed"),
        F.pmod(own, "index_blocks").cast("int").alias("x"),
        F.explode(F.expr("sequence(0, probe_blocks - 1)")).alias("y"))
    right = probes.join(sizes, keys).select(
        *keys, "fp", F.lit(False).alias("indexed"),
        F.explode(F.expr("sequence(0, index_blocks - 1)")).alias("x"),
        F.pmod(own, "probe_blocks").cast("int").alias("y"))
    return left.unionByName(right).groupBy(*keys, "x", "y").applyInPandas(
        lambda frame: _forest(frame, distance), "src long, dst long")


def links(distinct: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """``src < dst``: pairs that connect all fingerprints within ``distance`` bits of each other.

    ``distinct`` has one row per fingerprint ``fp``. All links of ordinary values are
    listed; those of a hot value are replaced by a spanning forest.
    """
    rows, ones = bit_statistics(distinct)
    plan = plan_probes(rows, ones, distance)
    index, probes = _probe_rows(distinct, plan)
    keys = ["part", "value"]
    hot = cut_lineage(
        index.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_VALUE))
    some_hot = not hot.isEmpty()
    if some_hot:
        light_index, light_probes = (x.join(hot, keys, "left_anti") for x in (index, probes))
    else:
        light_index, light_probes = index, probes
    near = F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= distance
    found = (
        light_index.withColumnRenamed("fp", "src")
        .join(light_probes.withColumnRenamed("fp", "dst").withColumnsRenamed(
            {"part": "p2", "value": "v2"}),
            (F.col("part") == F.col("p2")) & (F.col("value") == F.col("v2"))
            & (F.col("src") < F.col("dst")) & near)
        .select("src", "dst")
    )
    if some_hot:
        found = found.unionByName(_hot_links(index, probes, hot, distance))
    return found.distinct()


def components(prints: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """``fp, component, component_id`` per distinct fingerprint of ``doc_id, fp`` rows.

    ``component`` is the least fingerprint and ``component_id`` the smallest doc_id
    that links reach.
    """
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    linked = connected_components(links(distinct, distance))
    labels = cut_lineage(
        distinct.join(linked.withColumnRenamed("id", "fp"), "fp", "left")
        .withColumn("component", F.coalesce("component", "fp")))
    least = labels.groupBy("component").agg(F.min("first").alias("component_id"))
    return labels.join(least, "component").select("fp", "component", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    prints = cut_lineage(fingerprints(common.documents(spark, sf_dir)))
    found = prints.join(components(prints), "fp")
    return found.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Documents without near copies: of each component one row stays.

    It is the one with the smallest doc_id, null last, then the least fingerprint;
    of rows equal in both any one.
    """
    best_id, best_fp, twice = (common.fresh(c, docs.columns) for c in ("best_id", "best_fp", "several"))
    prints = cut_lineage(fingerprints(docs))
    best = cut_lineage(
        prints.join(components(prints, distance), "fp").groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp")).alias("best"))
        .select(F.col("best.doc_id").alias(best_id), F.col("best.fp").alias(best_fp))
    )
    # Where an id names one row, the id decides; the texts need not be moved or read by their words again.
    several = cut_lineage(
        prints.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select(F.col("doc_id").alias(twice)))
    own_id = F.col("doc_id").cast("long")
    chosen = broadcast_checked(best, BROADCAST_IDS)
    some = not several.isEmpty()
    single = docs.join(several, own_id.eqNullSafe(F.col(twice)), "left_anti") if some else docs
    kept = single.join(chosen, own_id.eqNullSafe(F.col(best_id)), "left_semi")
    if some:
        fp = common.fresh("fp", docs.columns)
        marked = with_fingerprint(docs.join(several, own_id.eqNullSafe(F.col(twice)), "left_semi"), fp)
        rest = marked.join(
            chosen, own_id.eqNullSafe(F.col(best_id)) & (F.col(fp) == F.col(best_fp)), "left_semi")
        kept = kept.unionByName(rest.dropDuplicates(["doc_id", fp]).drop(fp))
    return kept
