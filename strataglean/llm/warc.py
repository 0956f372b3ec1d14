"""WARC records and a Merkle audit of their fixity. DataFrame functions only.

``records`` turns pages into WARC/1.0 resource records and lays them out in files of about FILE_BYTES:
a record's file follows from a hash of its id, its offset from the order of ids in the file.
``parse`` takes records apart again.

A replica is a table of records at offsets of files; its hashes are made from its own records
(``hashed``), whichever side it is. ``audit`` compares two replicas:

1. Records are hashed; a range of RANGE_BYTES of offsets is hashed from the offsets, sizes
   and hashes of the records that begin in it, in order.
2. FAN_OUT neighbouring ranges make the next node, up to one node per file; FAN_OUT neighbouring
   files make the next one, up to the root. A node's hash covers its children's numbers and hashes.
3. From the roots down, only children of nodes that differ are compared. Records are compared only
   in ranges that differ.

A record is ``corrupt`` if its hash differs at the same offset, ``missing`` or ``extra`` if only
the first or only the second replica has one there. Equal pages are one record, with their number in
the result of ``records``. Line ends in a url are escaped. Null ids, urls and texts are empty strings in a record, null ids null in
the result. Without pages there are no records, and equal replicas give an empty result. No
step gathers more than one range, FAN_OUT nodes, or, by the window over sizes, one file's layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataglean.llm import common
from strataglean.session import cut_lineage

FILE_BYTES, RANGE_BYTES, FAN_OUT = 16 << 20, 1 << 18, 16
# The fields of a record that no column decides.
VERSION, KIND, DATE, CONTENT = "WARC/1.0", "resource", "1970-01-01T00:00:00Z", "text/html; charset=utf-8"
END = "\r\n"
# What names a record in every replica.
ADDRESS = ["page_id", "url", "record_id"]


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _one_line(value: Column) -> Column:
    """A header's value must not end its line."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def as_records(pages: DataFrame) -> DataFrame:
    """``pages`` with ``record_id`` and ``record``, the text of the WARC record of (page_id, url, html)."""
    digest = F.sha2(_text("html"), 256)
    name = F.md5(F.concat_ws("|", _text("page_id"), _text("url"), digest))
    uuid = F.concat_ws("-", *[F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    head = F.concat_ws(
        END, F.lit(VERSION), F.lit(f"WARC-Type: {KIND}"), F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), uuid, F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), _one_line(_text("url"))), F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Block-Digest: sha256:"), digest), F.lit(f"Content-Type: {CONTENT}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(_text("html"))), F.lit(""), F.lit(""))
    return pages.withColumn("record_id", uuid).withColumn(
        "record", F.concat(head, _text("html"), F.lit(END + END)))


def parse(found: DataFrame) -> DataFrame:
    """``record_id, url, digest, payload`` of a column ``record``; ``intact`` if the digest is the payload's."""
    record = F.col("record")

    def value(name: str) -> Column:
        return F.regexp_extract(record, rf"\r\n{name}: ([^\r]*)\r\n", 1)

    body = F.substring(record, F.locate(END + END, record) + 4, F.length(record))
    payload = F.substring(body, F.lit(1), F.length(body) - 4)
    parts = found.select(
        F.regexp_extract(value("WARC-Record-ID"), "uuid:([^>]*)", 1).alias("record_id"),
        value("WARC-Target-URI").alias("url"),
        F.regexp_extract(value("WARC-Block-Digest"), "sha256:(.*)", 1).alias("digest"), payload.alias("payload"))
    return parts.withColumn("intact", F.sha2("payload", 256) == F.col("digest"))


def hashed(records: DataFrame) -> DataFrame:
    """``records`` with ``n_bytes, sha256`` of each record's bytes in place of ``record``."""
    return records.withColumn("n_bytes", F.octet_length("record").cast("long")).withColumn(
        "sha256", F.sha2("record", 256)).drop("record")


def _addressed(pages: DataFrame) -> DataFrame:
    """``page_id, url, record_id, record``."""
    return as_records(pages).select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "record_id", "record")


def layout(pages: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``page_id, url, record_id, n_copies, file, start, n_bytes, sha256``: where each record lies.

    The order in a file is that of (page_id with null first, record_id).
    """
    # Equal records are merged before any shuffle, however many there are.
    distinct = cut_lineage(hashed(_addressed(pages)).groupBy(*ADDRESS, "n_bytes", "sha256").agg(
        F.count(F.lit(1)).alias("n_copies")))
    files = max(1, -(-int(distinct.agg(F.sum("n_bytes")).first()[0] or 0) // file_bytes))
    number = F.conv(F.substring(F.col("record_id"), 1, 8), 16, 10).cast("long") % files
    before = Window.partitionBy("file").orderBy("page_id", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    return distinct.withColumn("file", number).withColumn(
        "start", F.coalesce(F.sum("n_bytes").over(before), F.lit(0)))


def _parent(children: DataFrame, keys: list[Column], child: Column) -> DataFrame:
    """Nodes ``file, node, hash`` over the sorted numbers and hashes of their children."""
    return children.groupBy(*keys).agg(F.sha2(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(child.alias("n"), F.col("hash")))),
        lambda x: F.concat_ws(":", x["n"].cast("string"), x["hash"])), ","), 256).alias("hash"))


def ranges(replica: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``file, node, hash`` of the ranges of offsets of ``replica`` (file, start, n_bytes, sha256)."""
    hashed = replica.select("file", F.floor(F.col("start") / range_bytes).cast("long").alias("node"), "start",
                            F.concat_ws(":", F.col("n_bytes").cast("string"), "sha256").alias("hash"))
    return _parent(hashed, ["file", "node"], F.col("start"))


def tree(leaves: DataFrame, widest: int, files: int, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Levels from the ranges to the root, each ``file, node, up_file, up_node, hash``.

    Files have at most ``widest`` ranges; ``files`` is above every file's number.
    """
    levels, level = [], leaves
    while True:
        # Within a file neighbouring nodes meet; when each file is one node, neighbouring files do.
        if widest > 1:
            up = [F.col("file"), F.floor(F.col("node") / fan_out).cast("long")]
            widest = -(-widest // fan_out)
        else:
            up = [F.floor(F.col("file") / fan_out).cast("long"), F.lit(0).cast("long")]
            files = 0 if files == 1 else -(-files // fan_out)
        level = cut_lineage(level.withColumn("up_file", up[0]).withColumn("up_node", up[1]))
        levels.append(level)
        if files == 0:
            return levels
        level = _parent(level, [F.col("up_file").alias("file"), F.col("up_node").alias("node")],
                        F.concat_ws("/", F.lpad(F.col("file").cast("string"), 12, "0"), F.lpad(F.col("node").cast("string"), 12, "0")))


def differing_ranges(first: DataFrame, second: DataFrame, range_bytes: int = RANGE_BYTES,
                     fan_out: int = FAN_OUT) -> DataFrame | None:
    """``file, node`` of the ranges that differ, found from the roots down; None if the roots are equal."""
    leaves = [cut_lineage(ranges(r, range_bytes)) for r in (first, second)]
    bound = leaves[0].unionByName(leaves[1]).agg(F.max("node"), F.max("file")).first()
    if bound[0] is None:
        return None
    trees = [tree(x, bound[0] + 1, bound[1] + 1, fan_out) for x in leaves]
    suspects = None
    for mine, theirs in zip(*(reversed(t) for t in trees)):
        if suspects is not None:
            parents = suspects.select(F.col("file").alias("up_file"), F.col("node").alias("up_node"))
            mine, theirs = (x.join(parents, ["up_file", "up_node"], "left_semi") for x in (mine, theirs))
        suspects = cut_lineage(
            mine.select("file", "node", F.col("hash").alias("a"))
            .join(theirs.select("file", "node", F.col("hash").alias("b")), ["file", "node"], "full")
            .filter(~F.col("a").eqNullSafe(F.col("b"))).select("file", "node"))
        if suspects.isEmpty():
            return None
    return suspects


def audit(first: DataFrame, second: DataFrame, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT) -> DataFrame:
    """Where two replicas (page_id, file, start, n_bytes, sha256) differ, with a status."""
    suspects = differing_ranges(first, second, range_bytes, fan_out)

    def within(replica: DataFrame, mark: str) -> DataFrame:
        node = F.floor(F.col("start") / range_bytes).cast("long")
        near = replica.withColumn("node", node)
        near = near.limit(0) if suspects is None else near.join(suspects, ["file", "node"], "left_semi")
        return near.select("file", "start", *[F.col(c).alias(f"{c}_{mark}") for c in ("page_id", "n_bytes", "sha256")])

    both = within(first, "a").join(within(second, "b"), ["file", "start"], "full")
    status = F.when(F.col("sha256_b").isNull(), "missing").when(F.col("sha256_a").isNull(), "extra").otherwise("corrupt")
    return both.filter(~F.col("sha256_a").eqNullSafe(F.col("sha256_b"))).select(
        F.coalesce("page_id_a", "page_id_b").alias("page_id"), "file", "start",
        F.col("n_bytes_a").alias("n_bytes"), F.col("sha256_a").alias("sha256"),
        F.col("n_bytes_b").alias("n_bytes_found"), F.col("sha256_b").alias("sha256_found"), status.alias("status"))


# Of the query's replica: every 97th page has another first character, the next is lost, the
# next is cut in half, and the next has a second record after the end of its file.
EVERY = 97


def damaged_copy(pages: DataFrame) -> DataFrame:
    """``page_id, url, record_id, appended, record``: a second archive of ``pages``, damaged in a known way.

    ``record_id`` is that of the record in the first archive, ``record`` what the copy holds in its place, or
    after the end of its file if ``appended``.
    """
    case = F.pmod(F.col("page_id").cast("long"), F.lit(EVERY))
    html = _text("html")
    found = as_records(pages.select("page_id", "url", "html")).select(
        "page_id", "url", F.col("record_id").alias("first_id"), case.alias("case"),
        F.when(case == 0, F.concat(F.lit("X"), F.substring(html, 2, 1 << 30)))
        .when(case == 2, F.substring(html, F.lit(1), F.floor(F.length(html) / 2).cast("int"))).otherwise(html).alias("html"),
    ).filter(~F.coalesce(F.col("case") == 1, F.lit(False)))
    twice = F.when(F.col("case") == 3, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return as_records(found).select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("first_id").alias("record_id"), F.explode(twice).alias("appended"), "record")


def replica(stored: DataFrame, laid_out: DataFrame) -> DataFrame:
    """``page_id, file, start, n_bytes, sha256`` of every record that a copy of ``laid_out`` holds.

    ``stored`` has the columns of :func:`damaged_copy`. All hashes and sizes are those of its records; only the
    places come from the layout. Equal records at a place count once, others there are all listed.
    """
    # Merged before any shuffle, so no text travels.
    held = hashed(stored).select(*ADDRESS, "appended", "n_bytes", "sha256").distinct()
    files = laid_out.groupBy("file").agg(F.max(F.col("start") + F.col("n_bytes")).alias("end"))
    placed = common.null_safe(held, laid_out.select(*ADDRESS, "file", "start"), ADDRESS)
    after = Window.partitionBy("file").orderBy("page_id", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    extra = placed.filter("appended").join(files, "file").withColumn(
        "start", F.col("end") + F.coalesce(F.sum("n_bytes").over(after), F.lit(0)))
    columns = ["page_id", "file", "start", "n_bytes", "sha256"]
    return placed.filter("not appended").select(*columns).unionByName(extra.select(*columns))


def op9_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records in which a damaged replica of the pages' archive differs from the archive."""
    pages = common.table(spark, sf_dir, "pages")
    first = cut_lineage(layout(pages))
    stored = cut_lineage(damaged_copy(pages))
    return audit(first, cut_lineage(replica(stored, first)))


def _record_sql(html: str) -> str:
    return f"""('{VERSION}' || e || 'WARC-Type: {KIND}' || e || 'WARC-Record-ID: <urn:uuid:' || id || '>' || e
      || 'WARC-Target-URI: ' || replace(replace(u, chr(13), '%0D'), chr(10), '%0A') || e || 'WARC-Date: {DATE}' || e || 'WARC-Block-Digest: sha256:' || sha256({html}) || e
      || 'Content-Type: {CONTENT}' || e || 'Content-Length: ' || strlen({html}) || e || e || {html} || e || e)"""


def _uuid_sql(html: str) -> str:
    name = f"md5(coalesce(page_id::varchar, '') || '|' || u || '|' || sha256({html}))"
    return " || '-' || ".join(f"substr({name}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


ORACLE = f"""with p as (select distinct page_id, url, coalesce(url, '') u, coalesce(html, '') h, chr(13) || chr(10) e from pages),
  i as (select *, {_uuid_sql("h")} id from p),
  x as (select *, case when page_id % {EVERY} = 0 then 'X' || substr(h, 2)
      when page_id % {EVERY} = 2 then substr(h, 1, len(h) // 2) else h end h2 from i),
  r as (select page_id, id, strlen({_record_sql("h")}) n, sha256({_record_sql("h")}) s,
      {_record_sql("h2").replace("urn:uuid:' || id", "urn:uuid:' || id2")} bad
    from (select *, {_uuid_sql("h2")} id2 from x) y),
  f as (select *, ('0x' || substr(id, 1, 8))::bigint % (select greatest(1, ceil(sum(n) / {FILE_BYTES}))::bigint from r) file from r),
  l as (select *, coalesce(sum(n) over (partition by file order by page_id nulls first, id rows between unbounded preceding and 1 preceding), 0)::bigint pos,
      sum(n) over (partition by file)::bigint file_end from f),
  t as (select *, page_id % {EVERY} k from l)
select page_id, file, pos "start", n::bigint n_bytes, s sha256,
    case when k <> 1 then strlen(bad)::bigint end n_bytes_found, case when k <> 1 then sha256(bad) end sha256_found,
    case when k = 1 then 'missing' else 'corrupt' end status
  from t where k = 1 or (k in (0, 2) and sha256(bad) <> s)
union all select page_id, file, (file_end + coalesce(sum(n) over (partition by file order by page_id, id
    rows between unbounded preceding and 1 preceding), 0))::bigint, null, null, n::bigint, s, 'extra' from t where k = 3"""
