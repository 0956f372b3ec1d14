"""Sketches over a numbered stream (seq, batch_id, id): Bloom filter, distinct count, reservoir.

The state of each sketch merges by min or max, so it needs no serial pass: a
batch job and a streaming job reach the same state in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataglean.functions.hashing import (
    BLOOM_HASHES, FM_MODULUS, linear_hash, md5_int, mod_hash, string_mod, trailing_zeros,
)

# Reservoir size and the slots that are reported.
RESERVOIR_SIZE = 100
REPORT_SLOTS = [0, 20, 40, 60, 80]

BloomHash = tuple[int, int, int | None, int]

# A table with one row per bit may be broadcast up to this many bits.
BROADCAST_BITS = 1_000_000


def stream_batches(stream: DataFrame) -> DataFrame:
    """One row per batch: size, first and last sequence number and id."""
    return stream.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"),
        F.min_by("id", "seq").alias("first_id"), F.max_by("id", "seq").alias("last_id"),
    )


def bloom_first_bits(stream: DataFrame, hashes: list[BloomHash] = BLOOM_HASHES) -> DataFrame:
    """``bit, first``: the first element that sets each bit. At most one row per bit."""
    return (
        stream.select("seq", F.explode(F.array(
            *[mod_hash(F.col("id"), a, b, m, p) for a, b, p, m in hashes])).alias("bit"))
        .groupBy("bit").agg(F.min("seq").alias("first"))
    )


def bloom_report(
    stream: DataFrame, first_bits: DataFrame, bits: int, seen_before: DataFrame | None = None
) -> DataFrame:
    """``batch_id, n_new, fp, fpr_reference, fpr`` of the batches in ``stream``.

    An element is new iff it is the first to set some bit, so the new elements
    and their ids are no more than the bits. An element that is not new counts
    as a false positive unless its id was new in an earlier batch.
    ``seen_before`` (``id, since``) holds the ids that were new in earlier calls.
    """
    return fp_rates(bloom_counts(stream, first_bits, bits, seen_before))


def fp_rates(counts: DataFrame) -> DataFrame:
    """``batch_id, n_new, fp, fpr_reference, fpr`` from ``batch_id, n_new, fp``."""
    return counts.select(
        "batch_id", "n_new", "fp",
        F.when(F.col("n_new") > 0, F.col("fp") / F.col("n_new")).otherwise(0.0).alias("fpr_reference"),
        F.when(F.col("fp") + F.col("n_new") > 0, F.col("fp") / (F.col("fp") + F.col("n_new")))
        .otherwise(0.0).alias("fpr"),
    )


def bloom_counts(
    stream: DataFrame, first_bits: DataFrame, bits: int, seen_before: DataFrame | None = None
) -> DataFrame:
    """``batch_id, n_new, fp``; counts of one batch from several calls add up."""
    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if bits <= BROADCAST_BITS else df

    new = bloom_new_ids(stream, first_bits, bits)
    since = new.select("id", F.col("batch_id").alias("since"))
    if seen_before is not None:
        since = since.unionByName(seen_before.select("id", "since"))
    since = since.groupBy("id").agg(F.min("since").alias("since"))
    heads = first_bits.select(F.col("first").alias("seq")).distinct().withColumn("new", F.lit(1))
    marked = stream.join(small(heads), "seq", "left").join(small(since), "id", "left")
    is_new = F.col("new").isNotNull()
    false_positive = ~is_new & (F.col("since").isNull() | (F.col("since") >= F.col("batch_id")))
    return marked.groupBy("batch_id").agg(
        F.count_if(is_new).alias("n_new"), F.count_if(false_positive).alias("fp"))


def bloom_new_ids(stream: DataFrame, first_bits: DataFrame, bits: int) -> DataFrame:
    """Rows of ``stream`` that the filter had not seen; at most one per bit."""
    heads = first_bits.select(F.col("first").alias("seq")).distinct()
    return stream.join(F.broadcast(heads) if bits <= BROADCAST_BITS else heads, "seq", "left_semi")


def bloom_batches(
    stream: DataFrame, hashes: list[BloomHash] = BLOOM_HASHES, truth: str = "batch"
) -> DataFrame:
    """Per batch: new ids, false positives and their rates, with the filter kept across batches.

    ``truth='batch'`` calls an element seen if its id was new in an earlier
    batch; ``truth='element'`` if its id came earlier at all.
    """
    bits = max(m for *_, m in hashes)
    first_bits = bloom_first_bits(stream, hashes)
    if truth == "batch":
        return bloom_report(stream, first_bits, bits)
    heads = first_bits.select(F.col("first").alias("seq")).distinct().withColumn("new", F.lit(1))
    once = stream.groupBy("id").agg(F.min("seq").alias("seq")).withColumn("unseen", F.lit(1))
    marked = stream.join(heads, "seq", "left").join(once, ["id", "seq"], "left")
    is_new, unseen = F.col("new").isNotNull(), F.col("unseen").isNotNull()
    return fp_rates(marked.groupBy("batch_id").agg(
        F.count_if(is_new).alias("n_new"), F.count_if(~is_new & unseen).alias("fp")))


def fm_register_columns(x: Column, params: list[tuple[int, int]], modulus: int = FM_MODULUS) -> list[Column]:
    """Aggregates ``r0, r1, ..``: the most trailing zeros of the number ``x`` under each hash."""
    return [
        F.max(trailing_zeros(linear_hash(x, a, b, modulus))).alias(f"r{i}")
        for i, (a, b) in enumerate(params)
    ]


def fm_registers(stream: DataFrame, params: list[tuple[int, int]], keys: list[str]) -> DataFrame:
    """``keys, r0, r1, ..``: each id is folded to an integer once."""
    hashed = stream.select(*keys, string_mod(F.col("id"), FM_MODULUS).alias("x"))
    return hashed.groupBy(*keys).agg(*fm_register_columns(F.col("x"), params))


def fm_combine(registers: list[Column], groups: int = 4) -> Column:
    """2^mean per group of registers, median over the groups, truncated."""
    size = len(registers) // groups
    powers = []
    for g in range(groups):
        total = sum(registers[g * size + 1:(g + 1) * size], registers[g * size])
        powers.append(F.pow(F.lit(2.0), total / size))
    ordered = F.array_sort(F.array(*powers))
    if groups % 2:
        return F.floor(ordered[groups // 2]).cast("bigint")
    return F.floor((ordered[groups // 2 - 1] + ordered[groups // 2]) / 2).cast("bigint")


def fm_batches(
    stream: DataFrame, params: list[tuple[int, int]], groups: int = 4,
    keys: tuple[str, ...] = ("batch_id",),
) -> DataFrame:
    """``keys, exact, estimate``: distinct ids per batch, counted and estimated."""
    names = [f"r{i}" for i in range(len(params))]
    exact = stream.groupBy(*keys).agg(F.countDistinct("id").alias("exact"))
    return exact.join(fm_registers(stream, params, list(keys)), list(keys)).select(
        *keys, "exact", fm_combine([F.col(n) for n in names], groups).alias("estimate")
    )


def reservoir_accepted(stream: DataFrame, size: int = RESERVOIR_SIZE, salt: str = "r") -> DataFrame:
    """``seq, batch_id, id, slot`` of accepted elements.

    The first ``size`` fill the slots; a later element n enters with chance
    size / n at a random slot. The choice depends only on (seq, salt). About
    size * (1 + ln(n / size)) elements are accepted in all.
    """
    u = md5_int(F.col("seq"), F.lit(salt), F.lit("u"))
    entered = stream.select("seq", "batch_id", "id").filter(
        (F.col("seq") <= size) | (u < F.lit(float(size << 32)) / F.col("seq"))
    )
    slot = md5_int(F.col("seq"), F.lit(salt), F.lit("s")) % size
    return entered.withColumn(
        "slot", F.when(F.col("seq") <= size, F.col("seq") - 1).otherwise(slot)
    )


def reservoir_state(accepted: DataFrame) -> DataFrame:
    """``slot, seq, id``: the latest accepted element of each slot."""
    return accepted.groupBy("slot").agg(F.max("seq").alias("seq"), F.max_by("id", "seq").alias("id"))


def reservoir_snapshots(
    batches: DataFrame, accepted: DataFrame, slots: list[int] = REPORT_SLOTS
) -> DataFrame:
    """``seqnum, id_0, ..`` after each batch; ``batches`` holds ``batch_id, seqnum``.

    The history of the reported slots is logarithmic in the stream length, so it
    travels as one row of short arrays; each batch picks its latest entries.
    """
    last = accepted.filter(F.col("slot").isin(slots)).groupBy("slot", "batch_id").agg(
        F.max("seq").alias("seq"), F.max_by("id", "seq").alias("id")
    )
    entry = F.struct("batch_id", "id")
    history = last.agg(*[
        F.sort_array(F.collect_list(F.when(F.col("slot") == s, entry))).alias(f"h_{s}") for s in slots
    ])

    def at(name: str) -> Column:
        return F.get(
            F.reverse(F.filter(name, lambda e: e["batch_id"] <= F.col("batch_id"))), F.lit(0)
        )["id"]

    return batches.crossJoin(F.broadcast(history)).select(
        "seqnum", *[at(f"h_{s}").alias(f"id_{s}") for s in slots]
    )


def reservoir_batches(
    stream: DataFrame, size: int = RESERVOIR_SIZE, slots: list[int] = REPORT_SLOTS, salt: str = "r"
) -> DataFrame:
    batches = stream.groupBy("batch_id").agg(F.max("seq").alias("seqnum"))
    return reservoir_snapshots(batches, reservoir_accepted(stream, size, salt), slots)


def fm_by_window(
    events: DataFrame, params: list[tuple[int, int]], width: str = "1 hour", groups: int = 4
) -> DataFrame:
    """``window_start, n, estimate`` per event-time window, for a table or a stream.

    On a stream, ``events`` carries a watermark: later rows are left out.
    """
    names = [f"r{i}" for i in range(len(params))]
    return (
        events.select("ts", string_mod(F.col("id"), FM_MODULUS).alias("x"))  # folded once per row
        .groupBy(F.window("ts", width))
        .agg(F.count(F.lit(1)).alias("n"), *fm_register_columns(F.col("x"), params))
        .select(F.col("window.start").alias("window_start"), "n",
                fm_combine([F.col(n) for n in names], groups).alias("estimate"))
    )
