import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from strataglean.functions.hashing import linear_params
from strataglean.operators import sketches
from strataglean.session import scratch_path
from strataglean.sources import files
from strataglean.plans import streams
from strataglean.streaming import continuous

HASHES = [(131, 103, None, 97), (137, 107, 61, 97), (149, 109, None, 97)]
PARAMS = linear_params(8, 3, 100)
BATCH = 12


def _ids(seed=4, n=120):
    rng = random.Random(seed)
    return [str(rng.randrange(70)) for _ in range(n)]


@pytest.fixture(scope="module")
def stream(spark):
    df = spark.createDataFrame([(10 * i, int(x)) for i, x in enumerate(_ids())], "pos bigint, who int")
    return files.stream_elements(df.repartition(3), ["pos"], "who", BATCH).cache()


def _number(text):
    return int.from_bytes(text.encode(), "big")


def _bloom(ids):
    """The filter as one pass with mutable bits."""
    bits, seen, out = set(), set(), []
    for start in range(0, len(ids), BATCH):
        new, fp = set(), 0
        for x in ids[start:start + BATCH]:
            hit = {((a * _number(x) + b) % (p or m)) % m for a, b, p, m in HASHES}
            if hit - bits:
                new.add(x)
            elif x not in seen:
                fp += 1
            bits |= hit
        seen |= new
        out.append((start // BATCH, len(new), fp))
    return out


def _zeros(v):
    return (v & -v).bit_length() - 1 if v else 0


def _fm(ids):
    regs = [max(_zeros((a * _number(x) + b) % 69997) for x in ids) for a, b in PARAMS]
    return int(median(2 ** (sum(regs[g * 2:g * 2 + 2]) / 2) for g in range(4)))


def _reservoir(stream, size, slots):
    """Snapshots by one pass over the accepted elements."""
    slot_of = {r["seq"]: r["slot"] for r in sketches.reservoir_accepted(stream, size, "t").collect()}
    held, out = {}, []
    for i, x in enumerate(_ids(), start=1):
        if i in slot_of:
            held[slot_of[i]] = x
        if i % BATCH == 0:
            out.append((i, *[held.get(s) for s in slots]))
    return out, slot_of


def test_batches(stream, rows):
    ids = _ids()
    assert rows(sketches.stream_batches(stream))[1] == (1, 12, 13, 24, ids[12], ids[23])


def test_bloom_equals_one_pass(stream, rows):
    assert rows(sketches.bloom_batches(stream, HASHES), "batch_id", "n_new", "fp") == _bloom(_ids())


def test_bloom_known_answer(spark, rows):
    df = spark.createDataFrame([(1, 0, "x"), (2, 0, "x"), (3, 1, "x")], "seq bigint, batch_id bigint, id string")
    got = rows(sketches.bloom_batches(df, HASHES), "batch_id", "n_new", "fp", "fpr_reference")
    assert got == [(0, 1, 1, 1.0), (1, 0, 0, 0.0)]
    assert rows(sketches.bloom_batches(df, HASHES, "element"), "batch_id", "n_new", "fp") == [(0, 1, 0), (1, 0, 0)]


def test_fm_equals_one_pass(stream, rows):
    ids = _ids()
    want = [(b, len(set(part)), _fm(part)) for b in range(10) for part in [ids[b * BATCH:(b + 1) * BATCH]]]
    assert rows(sketches.fm_batches(stream, PARAMS)) == want


def test_fm_combine(spark):
    cols = [F.lit(x) for x in (1.0, 2.0, 3.0, 0.5)]
    assert spark.range(1).select(sketches.fm_combine(cols, 4)).first()[0] == 3


def test_reservoir_equals_one_pass(stream, rows):
    want, slot_of = _reservoir(stream, 10, [0, 3, 9])
    assert rows(sketches.reservoir_batches(stream, 10, [0, 3, 9], "t")) == want
    assert all(slot_of[i] == i - 1 for i in range(1, 11)) and len(slot_of) < 80


def test_missing_slots_are_null(stream):
    first = sketches.reservoir_batches(stream, 20, [0, 15], "t").orderBy("seqnum").first()
    assert first["id_0"] == _ids()[0] and first["id_15"] is None


def test_continuous_queries_equal_batch_and_survive_replay(spark, stream, rows):
    state = streams.replay_in_drops(stream, 2, lambda src, path: continuous.run_bloom(src, path, HASHES))
    got = rows(continuous.read_reports(spark, state), "batch_id", "n_new", "fp")
    assert got == _bloom(_ids())
    # The last epoch runs again, as after a failure between output and commit.
    late = stream.filter("batch_id >= 5")
    continuous.bloom_epoch(HASHES)(late, 1, state)
    assert rows(continuous.read_reports(spark, state), "batch_id", "n_new", "fp") == got

    state = streams.replay_in_drops(stream, 2, lambda src, path: continuous.run_fm(src, path, PARAMS))
    assert rows(continuous.read_fm(spark, state, len(PARAMS))) == rows(sketches.fm_batches(stream, PARAMS))

    state = streams.replay_in_drops(
        stream, 2, lambda src, path: continuous.run_reservoir(src, path, 10, "t"))
    assert rows(continuous.read_reservoir(spark, state, [0, 3, 9])) == _reservoir(stream, 10, [0, 3, 9])[0]


def test_late_events_are_left_out(spark, rows):
    folder, path = scratch_path(spark, "in"), scratch_path(spark, "state")

    def drop(*stamps):
        df = spark.createDataFrame([(t, "7") for t in stamps], "ts string, id string")
        df.select(F.col("ts").cast("timestamp").alias("ts"), "id").coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema("ts timestamp, id string").parquet(folder)
        continuous.run_fm_by_window(source, path, PARAMS, "1 hour", "2 hours")

    drop("2024-01-01 00:10:00", "2024-01-01 00:20:00", "2024-01-01 09:00:00")
    drop("2024-01-01 00:30:00", "2024-01-01 09:30:00")
    got = [(str(w), n) for w, n, _ in rows(continuous.read_fm_by_window(spark, path))]
    assert got == [("2024-01-01 00:00:00", 2), ("2024-01-01 09:00:00", 2)]


def test_a_batch_over_two_epochs_is_one_report(spark, stream, rows):
    state = scratch_path(spark, "split")
    each = continuous.bloom_epoch(HASHES)
    each(stream.filter("seq <= 18"), 0, state)  # ends inside batch 1
    each(stream.filter("seq > 18 and seq <= 55"), 1, state)
    each(stream.filter("seq > 55"), 2, state)
    assert rows(continuous.read_reports(spark, state), "batch_id", "n_new", "fp") == _bloom(_ids())
