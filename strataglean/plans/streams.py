"""Customers of successive orders as a stream of ids; events by event time."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataglean.functions.hashing import FM_MODULUS, linear_params
from strataglean.operators import sketches
from strataglean.session import scratch_path
from strataglean.sources import files, roles
from strataglean.streaming import continuous

BATCH = 300
SALT = "reservoir"
DROPS = 4
# A small filter, so that false positives occur: (a, b, first modulus, bits).
HASHES = [(131, 103, None, 4999), (137, 107, 701, 4999), (149, 109, None, 4999)]
# 32 hashes with factors in 1..100, four groups.
FM_PARAMS = linear_params(32, 7, 100)


def replay_in_drops(
    stream, drops, run
):
    """Feed a numbered table to a continuous query in ``drops`` deliveries; returns its state folder.

    After each delivery the query runs until it has read everything and stops,
    so every next run resumes from its saved progress. Deliveries end at batch ends.
    """
    spark = stream.sparkSession
    folder, path = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-state")
    last = stream.agg(F.max("batch_id")).first()[0] or 0
    step = last // drops + 1
    for drop in range(drops):
        part = stream.filter((F.col("batch_id") >= drop * step) & (F.col("batch_id") < (drop + 1) * step))
        part.select("seq", "batch_id", "id").write.mode("append").parquet(folder)
        run(continuous.open_stream(spark, folder), path)
    return path


def _stream(spark, sf):
    return files.stream_elements(roles.id_stream(spark, sf), ["o_orderkey"], "o_custkey", BATCH)


def _rounded(report):
    return report.withColumn("fpr_reference", F.round("fpr_reference", 6)).withColumn("fpr", F.round("fpr", 6))


def stream_batches(spark, sf):
    return sketches.stream_batches(_stream(spark, sf))


def bloom_fpr(spark, sf):
    return _rounded(sketches.bloom_batches(_stream(spark, sf), HASHES))


def bloom_fpr_element(spark, sf):
    return _rounded(sketches.bloom_batches(_stream(spark, sf), HASHES, truth="element"))


def fm_estimate(spark, sf):
    return sketches.fm_batches(_stream(spark, sf), FM_PARAMS)


def reservoir_snapshots(spark, sf):
    return sketches.reservoir_batches(_stream(spark, sf), salt=SALT)


def stream_bloom(spark, sf):
    path = replay_in_drops(
        _stream(spark, sf), DROPS, lambda source, state: continuous.run_bloom(source, state, HASHES))
    return _rounded(continuous.read_reports(spark, path))


def stream_fm(spark, sf):
    path = replay_in_drops(
        _stream(spark, sf), DROPS, lambda source, state: continuous.run_fm(source, state, FM_PARAMS))
    return continuous.read_fm(spark, path, len(FM_PARAMS))


def stream_reservoir(spark, sf):
    path = replay_in_drops(
        _stream(spark, sf), DROPS,
        lambda source, state: continuous.run_reservoir(source, state, sketches.RESERVOIR_SIZE, SALT))
    return continuous.read_reservoir(spark, path, sketches.REPORT_SLOTS)


def _events(spark, sf):
    return roles.table(spark, sf, "events").select("ts", F.col("user_id").cast("string").alias("id"))


def fm_by_window(spark, sf):
    return sketches.fm_by_window(_events(spark, sf), FM_PARAMS)


def stream_fm_by_window(spark, sf):
    """The events as files that a continuous query reads in event-time order."""
    folder, path = scratch_path(spark, "events-in"), scratch_path(spark, "events-state")
    events = _events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartitionByRange(4, "ts").write.parquet(folder)
    source = spark.readStream.schema("ts timestamp, id string").parquet(folder)
    continuous.run_fm_by_window(source, path, FM_PARAMS)
    return continuous.read_fm_by_window(spark, path).withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz"))


QUERIES = {
    "stream_batches": stream_batches, "bloom_fpr": bloom_fpr, "bloom_fpr_element": bloom_fpr_element,
    "fm_estimate": fm_estimate, "reservoir_snapshots": reservoir_snapshots,
    "stream_bloom": stream_bloom, "stream_fm": stream_fm, "stream_reservoir": stream_reservoir,
    "fm_by_window": fm_by_window, "stream_fm_by_window": stream_fm_by_window,
}

_ELEMENTS = f"""el as (select seq, (seq - 1) // {BATCH} batch_id, id from (
    select row_number() over (order by o_orderkey) seq, o_custkey::varchar id from orders)),
  el2 as (select *, list_reduce(list_transform(range(1, length(id) + 1), lambda i: ascii(substr(id, i, 1))::hugeint),
    lambda x, y: x * 256 + y) num from el)"""


def _bits():
    return ", ".join(
        f"({a} * num + {b}) % {m}" if p is None else f"(({a} * num + {b}) % {p}) % {m}" for a, b, p, m in HASHES)


_BLOOM = f"""{_ELEMENTS}, bits as (select seq, batch_id, id, unnest([{_bits()}]) bit from el2),
  firsts as (select bit, min(seq) f from bits group by 1),
  el3 as (select el.*, el.seq in (select f from firsts) is_new from el)"""

_RATES = """select batch_id, n_new, fp, case when n_new > 0 then round(fp / n_new, 6) else 0.0::double end fpr_reference,
  case when fp + n_new > 0 then round(fp / (fp + n_new), 6) else 0.0::double end fpr from r"""

_BLOOM_SQL = f"""with {_BLOOM}, born as (select id, min(batch_id) since from el3 where is_new group by 1),
  r as (select batch_id, count(*) filter (where is_new) n_new,
    count(*) filter (where not is_new and (since is null or since >= batch_id)) fp
    from el3 left join born using (id) group by 1) {_RATES}"""


def _registers(modulus):
    values = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(FM_PARAMS))
    zeros = "case when h = 0 then 0 else length(bin(h)) - length(rtrim(bin(h), '0')) end"
    return values, zeros, modulus


def _fm(source, key):
    values, zeros, m = _registers(FM_MODULUS)
    return f"""p(i, a, b) as (values {values}),
      h as (select {key}, i, (a * num + b) % {m} h from {source}, p),
      reg as (select {key}, i, max({zeros}) r from h group by 1, 2),
      grp as (select {key}, i // 8 g, pow(2.0::double, sum(r) / 8) e from reg group by 1, 2),
      est as (select {key}, floor(median(e))::bigint estimate from grp group by 1)"""


_FM_SQL = f"""with {_ELEMENTS}, {_fm("el2", "batch_id")}
  select batch_id, exact, estimate from (select batch_id, count(distinct id) exact from el group by 1) join est using (batch_id)"""

_RESERVOIR_SQL = f"""with {_ELEMENTS},
  acc as (select seq, batch_id, id, case when seq <= 100 then seq - 1 else
      ('0x' || substr(md5(seq || '|{SALT}|s'), 1, 8))::bigint % 100 end slot from el
    where seq <= 100 or ('0x' || substr(md5(seq || '|{SALT}|u'), 1, 8))::bigint < 429496729600.0::double / seq),
  b as (select batch_id, max(seq) seqnum from el group by 1)
  select seqnum, {", ".join(f"arg_max(acc.id, seq) filter (where slot = {s}) id_{s}" for s in sketches.REPORT_SLOTS)}
  from b join acc on acc.seq <= seqnum group by 1"""

_WINDOW_SQL = f"""with ev as (select date_trunc('hour', ts) window_start, user_id::varchar id from events),
  ev2 as (select *, list_reduce(list_transform(range(1, length(id) + 1), lambda i: ascii(substr(id, i, 1))::hugeint),
    lambda x, y: x * 256 + y) num from ev), {_fm("ev2", "window_start")}
  select window_start, n, estimate from (select window_start, count(*) n from ev group by 1) join est using (window_start)"""

ORACLES = {
    "stream_batches": f"""with {_ELEMENTS} select batch_id, count(*) n, min(seq) first_seq, max(seq) last_seq,
        arg_min(id, seq) first_id, arg_max(id, seq) last_id from el group by 1""",
    "bloom_fpr": _BLOOM_SQL,
    "bloom_fpr_element": f"""with {_BLOOM}, r as (select batch_id, count(*) filter (where is_new) n_new,
        count(*) filter (where not is_new and seq in (select min(seq) from el group by id)) fp from el3 group by 1) {_RATES}""",
    "stream_bloom": _BLOOM_SQL,
    "fm_estimate": _FM_SQL,
    "stream_fm": _FM_SQL,
    "reservoir_snapshots": _RESERVOIR_SQL,
    "stream_reservoir": _RESERVOIR_SQL,
    "fm_by_window": _WINDOW_SQL,
    "stream_fm_by_window": _WINDOW_SQL,
}
