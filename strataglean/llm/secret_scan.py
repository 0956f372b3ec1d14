"""Secret scans with corpus-wide ownership frequency. DataFrame functions only.

Base patterns (assignments, access keys, hex strings) give spans in code points, leftmost
and non-overlapping per kind; matches that are too short are dropped afterwards, so they
still use up the text they cover. A fourth pattern finds bare tokens of letters and digits.

Each candidate's value is hashed and counted over the whole corpus by distinct
repositories (source and language) and owners (source). A value that several owners hold, or one
owner in EXAMPLE_REPOS or more repositories, is a widely copied example; another looks live. Live-looking bare
tokens that overlap no base span are added as kind ``owned``; base spans always stay.

A null text is empty and has no spans. A null source or language counts as one owner or
repository of its own. Repeated rows give equal results; their values count once per
repository. An empty table gives an empty result. Only documents that match a pattern are
taken apart; a document's spans are gathered, and they are no longer than its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataglean.llm import common
from strataglean.session import cut_lineage

# Kinds in their order, pattern, group that holds the value, least length of value.
# A run that is too short ends where a longer one cannot begin, so the bounds of all but the
# first pattern may stand in the pattern itself.
KEYWORD = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = [
    ("assign", KEYWORD, 2, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("owned", r"[A-Za-z0-9+/_=-]{24,}", 0, 24),
]
# Owners, and repositories, from which a value is an example and no longer a live-looking credential.
EXAMPLE_OWNERS, EXAMPLE_REPOS = 2, 3


def _matches(kind: str, pattern: str, group: int) -> Column:
    """All matches of a text that has some: place, length of the text before, of the match, value."""
    text = F.col("whole")
    between = F.transform(F.split(text, pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    zipped = F.arrays_zip(between.alias("a"), found.alias("b"), values.alias("c"))
    rows = F.transform(zipped, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("place"), x["a"].alias("gap"),
        F.length(x["b"]).alias("width"), x["c"].alias("value")))
    # One more text between than there are matches: the last entry has no match.
    return F.when(text.rlike(pattern), F.filter(rows, lambda x: x["width"].isNotNull()))


def scan(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, print, repo, owner, found`` with the matches of all patterns."""
    one = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("whole"),
        F.col("source").cast("string").alias("owner"), F.col("lang").cast("string").alias("lang"))
    none = F.array().cast("array<struct<kind:string,place:int,gap:int,width:int,value:string>>")
    found = [F.coalesce(_matches(kind, pattern, group), none) for kind, pattern, group, _ in PATTERNS]
    return one.select(
        "doc_id", F.xxhash64("whole").alias("print"), F.struct("owner", "lang").alias("repo"), "owner",
        F.concat(*found).alias("found"))


def spans(scanned: DataFrame) -> DataFrame:
    """``doc_id, print, repo, owner, kind, rank, start, stop, value``: long enough matches, once per document."""
    rows = (
        scanned.filter(F.size("found") > 0)
        .select("doc_id", "print", "repo", "owner", F.explode("found").alias("m"))
        .select("doc_id", "print", "repo", "owner", "m.*")
        .dropDuplicates(["doc_id", "print", "kind", "place"])
    )
    before = Window.partitionBy("doc_id", "print", "kind").orderBy("place")
    rank = F.lit(len(PATTERNS))
    least = F.lit(0)
    for i, (kind, _, _, length) in enumerate(PATTERNS):
        rank = F.when(F.col("kind") == kind, i).otherwise(rank)
        least = F.when(F.col("kind") == kind, length).otherwise(least)
    placed = rows.withColumn("stop", F.sum(F.col("gap") + F.col("width")).over(before))
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    return (
        placed.filter((F.length("value") >= least) & ((F.col("kind") != "owned") | mixed))
        .select("doc_id", "print", "repo", "owner", "kind", rank.cast("int").alias("rank"),
                (F.col("stop") - F.col("width")).alias("start"), "stop", "value")
    )


def ownership(found: DataFrame) -> DataFrame:
    """``value_hash, n_repos, n_owners`` over the corpus; repeats are merged before every shuffle."""
    per_repo = found.select(F.sha2("value", 256).alias("value_hash"), "owner", "repo").distinct()
    per_owner = per_repo.groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return per_owner.groupBy("value_hash").agg(
        F.sum("n").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def find_secrets(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS,
                 example_repos: int = EXAMPLE_REPOS) -> tuple[DataFrame, DataFrame]:
    """The scanned documents, and their spans with ``n_repos, n_owners, live``.

    Bare tokens stay only if they are live and overlap no base span.
    """
    scanned = cut_lineage(scan(docs))
    found = cut_lineage(spans(scanned))
    counted = found.withColumn("value_hash", F.sha2("value", 256)).join(ownership(found), "value_hash")
    # A base span that reaches over a bare token starts before its end and stops after its start.
    per_doc = Window.partitionBy("doc_id", "print")
    base = F.col("kind") != "owned"
    upto = per_doc.orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onwards = per_doc.orderBy("start", "rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    free = (F.coalesce(F.max(F.when(base, F.col("stop"))).over(upto), F.lit(0)) <= F.col("start")) & (
        F.coalesce(F.min(F.when(base, F.col("start"))).over(onwards), F.col("stop")) >= F.col("stop"))
    live = (F.col("n_owners") < example_owners) & (F.col("n_repos") < example_repos)
    marked = counted.withColumn("live", live).withColumn("free", free)
    return scanned, marked.filter(base | (F.col("live") & F.col("free"))).drop("free")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its spans, how many of each kind, how many look live, and how widely its values are held."""
    scanned, found = find_secrets(common.documents(spark, sf_dir))
    base = F.col("kind") != "owned"
    entry = F.struct("start", "rank", F.concat_ws(":", "kind", "start", "stop").alias("name"))

    def listed(when: Column) -> Column:
        return F.array_join(F.transform(
            F.array_sort(F.collect_list(F.when(when, entry))), lambda x: x["name"]), ",")

    def number(when: Column) -> Column:
        return F.count(F.when(when, 1))

    per_doc = found.groupBy("doc_id", "print").agg(
        number(F.col("kind") == "assign").alias("n_assign"), number(F.col("kind") == "access").alias("n_access"),
        number(F.col("kind") == "hex").alias("n_hex"), listed(base).alias("base"),
        listed(F.lit(True)).alias("spans"), number(base & F.col("live")).alias("n_live"),
        number(base & ~F.col("live")).alias("n_example"), number(~base).alias("n_owned"),
        F.max("n_repos").alias("max_repos"), F.max("n_owners").alias("max_owners"))
    joined = common.null_safe(scanned.select("doc_id", "print"), per_doc, ["doc_id", "print"], "left")
    counts = ["n_assign", "n_access", "n_hex", "n_live", "n_example", "n_owned", "max_repos", "max_owners"]
    return joined.select(
        "doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts[:3]],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts[3:]])


def _matches_sql(rank: int) -> str:
    kind, pattern, group, _ = PATTERNS[rank]
    pattern = pattern.replace("(?i)password|passwd|secret|token|api_?key", "(?i:password|passwd|secret|token|api_?key)").replace("'", "''")
    return f"""select r, doc_id, source, lang, {rank} rk, '{kind}' kind, unnest(range(1, len(f) + 1)) i,
      unnest(list_transform(range(1, len(f) + 1), lambda i: len(b[i]))) gap, unnest(list_transform(f, lambda x: len(x))) width,
      unnest(v) v from (select r, doc_id, source, lang, string_split_regex(t, '{pattern}') b,
        regexp_extract_all(t, '{pattern}', 0) f, regexp_extract_all(t, '{pattern}', {group}) v from d) q"""


_LONG_ENOUGH = " or ".join(
    f"(rk = {i} and len(v) >= {least}" + (" and regexp_matches(v, '[0-9]') and regexp_matches(v, '[A-Za-z]'))" if kind == "owned" else ")")
    for i, (kind, _, _, least) in enumerate(PATTERNS))

ORACLE = f"""with d as (select row_number() over () r, doc_id, coalesce(text, '') t, source, lang from documents),
  m as ({" union all ".join(_matches_sql(i) for i in range(len(PATTERNS)))}),
  e as (select *, sum(gap + width) over (partition by r, rk order by i) fin from m),
  s as (select *, fin - width ini, kind || ':' || (fin - width)::bigint || ':' || fin::bigint as name from e where {_LONG_ENOUGH}),
  o as (select v, count(distinct row(source)) owners, count(distinct row(source, lang)) repos from s group by 1),
  l as (select s.*, owners, repos, owners < {EXAMPLE_OWNERS} and repos < {EXAMPLE_REPOS} live from s join o using (v)),
  k as (select * from l where rk < 3 or (live and not exists (
    select 1 from l x where x.r = l.r and x.rk < 3 and x.ini < l.fin and x.fin > l.ini))),
  g as (select r, count(*) filter (where rk = 0) n_assign, count(*) filter (where rk = 1) n_access,
    count(*) filter (where rk = 2) n_hex, string_agg(name, ',' order by ini, rk) filter (where rk < 3) base,
    string_agg(name, ',' order by ini, rk) spans, count(*) filter (where rk < 3 and live) n_live,
    count(*) filter (where rk < 3 and not live) n_example, count(*) filter (where rk = 3) n_owned,
    max(repos) max_repos, max(owners) max_owners from k group by r)
select doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex,
  sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans, coalesce(n_live, 0) n_live,
  coalesce(n_example, 0) n_example, coalesce(n_owned, 0) n_owned,
  coalesce(max_repos, 0) max_repos, coalesce(max_owners, 0) max_owners from d left join g using (r)"""
