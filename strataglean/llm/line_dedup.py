r"""Near-duplicate lines by a segment-partition edit join. DataFrame functions only.

Lines are the \n-separated parts of the texts, without white space at their ends. A line
of at least ``min_chars`` characters goes if an equal line stands earlier, by (doc_id, line
number), or one within the edits that ``allowed`` has for the shorter of the two: rows of
(characters from which on, edits). Blank lines always stay.

The query and the pipeline take WHOLE: every line that is not blank is compared for equality;
one edit is allowed from DISTANCE + 1 characters on, DISTANCE edits from NEAR_CHARS on.
Callers that give no limits get MIN_CHARS, and DISTANCE edits from NEAR_CHARS on.

1. Equal lines are merged into one row with its first place, known by two hashes.
2. For d allowed edits each distinct line is cut into d + 1 segments. A line within d edits contains
   one of them unchanged, near the same place. Its keys are the hashes of its own segments and of
   the substrings that may equal a segment of a line up to d shorter; a key holds the row of
   ``allowed`` and the segment's number and width. Two near lines share a key.
3. Keys of a single line are dropped, and lines that share one are paired. Parity bits of the lines'
   words decide first: an edit changes at most three of them.
4. What is left is verified by edit distance within a band of the allowed edits (levenshtein with a
   threshold; word-parallel columns can't be written with DataFrame functions).

A key shared by many lines would make all pairs of them. Its lines are compared with the
earliest of them first; two lines that have each found an earlier near one are not compared
again. The others are verified inside the join, so that only near pairs leave it; groups that
are still large are cut into parts, and each pair of parts is a task's work.

Null texts have no lines and stay null; null ids come last; lines of rows that repeat an id stand
in equal places, so none of them counts as earlier than the other; an empty table gives
an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataglean.llm import common
from strataglean.session import cut_lineage
from strataglean.skew import broadcast_checked, pairs_within

MIN_CHARS, NEAR_CHARS, DISTANCE = 20, 40, 2
NEAR = ((NEAR_CHARS, DISTANCE),)
WHOLE = {"min_chars": 1, "allowed": ((DISTANCE + 1, 1), (NEAR_CHARS, DISTANCE))}
# Lines with one key from which they are compared with the earliest of them first.
HOT_KEY = 32
# Rows of 16 bytes up to which the keys of several lines are broadcast.
BROADCAST_KEYS = 1_000_000
# Removed lines up to which their numbers are broadcast, about 16 bytes each with their documents.
BROADCAST_LINES = 1_000_000
# White space at the ends of a line.
BLANK = " \t\v\f\r"


def lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, print, line_no, line``: every line to compare; ``print`` hashes the text."""
    text = F.col("text").cast("string")
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("print"),
                    F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line"))
        .withColumn("line", F.btrim("line", F.lit(BLANK)))
        .filter(F.length("line") >= min_chars)
    )


def line_keys() -> list[Column]:
    """128 bits that name a line."""
    return [F.xxhash64("line").alias("k1"), F.xxhash64(F.lit("second"), "line").alias("k2")]


def place() -> Column:
    """Where a line stands; least is earliest, null ids are last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "line_no")


def segment(length: Column, i: Column, parts: int) -> tuple[Column, Column]:
    """Start (from 1) and width of segment ``i`` of a line of this length, the longer ones last."""
    short = F.floor(length / parts).cast("int")
    n_short = parts - (length - short * parts)
    return short * i + F.greatest(F.lit(0), i - n_short) + 1, short + (n_short <= i).cast("int")


def key_places(lengths: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``length, i, at, width`` of every substring that a line of a length may share with a near one.

    With i segments before it and distance - i after it, a segment cannot have moved
    by more than the edits to its left, nor, seen from the end, by those to its right.
    """
    cases = []
    for less in range(distance + 1):
        for i in range(distance + 1):
            lowest, highest = max(-i, less - (distance - i)), min(i, less + (distance - i))
            cases += [(less, i, move) for move in range(lowest, highest + 1)]
    listed = F.array(*[F.struct(F.lit(a).alias("less"), F.lit(b).alias("i"), F.lit(c).alias("move")) for a, b, c in cases])
    rows = lengths.select("length", F.explode(listed).alias("c")).select("length", "c.*")
    start, width = segment(F.col("length") - F.col("less"), F.col("i"), distance + 1)
    placed = rows.select("length", "i", (start + F.col("move")).alias("at"), width.alias("width")).distinct()
    return placed.filter((F.col("at") >= 1) & (F.col("width") >= 1) & (F.col("at") + F.col("width") - 1 <= F.col("length")))


def word_parity() -> Column:
    """64 bits: for each hash class of words whether it occurs an odd number of times."""
    return F.aggregate(
        F.split("line", " "), F.lit(0).cast("long"),
        lambda seen, word: seen.bitwiseXOR(F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.xxhash64(word).bitwiseAND(F.lit(63)).cast("int"))))


def distinct_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``k1, k2, line, length, first, n``: every line once, its first place, and how often it occurs."""
    return lines(docs, min_chars).select(*line_keys(), "line", place().alias("at")).groupBy("k1", "k2").agg(
        F.first("line").alias("line"), F.min("at").alias("first"), F.count(F.lit(1)).alias("n")
    ).withColumn("length", F.length("line"))


def allowed_places(lengths: DataFrame, allowed: tuple = NEAR) -> DataFrame:
    """``length, edits, i, at, width``: the places for each row of ``allowed`` that concerns a length.

    A row holds for pairs whose shorter line is below the next row's characters; the longer may
    reach beyond them by the edits.
    """
    rows = sorted(allowed)
    parts = []
    for (least, edits), (above, _) in zip(rows, [*rows[1:], (None, 0)]):
        own = lengths.filter(F.col("length") >= least)
        own = own if above is None else own.filter(F.col("length") < above + edits)
        parts.append(key_places(own, edits).withColumn("edits", F.lit(edits)))
    return reduce(DataFrame.unionByName, parts)


def close_enough(a: str, b: str, allowed: tuple = NEAR) -> Column:
    """Whether two lines are within the edits allowed for the shorter one."""
    shorter, found = F.least(F.length(a), F.length(b)), F.lit(False)
    for least, edits in sorted(allowed):
        found = F.when(shorter >= least, F.levenshtein(a, b, edits) >= 0).otherwise(found)
    return found


def line_index(distinct: DataFrame, allowed: tuple = NEAR) -> DataFrame:
    """``key, k1``: distinct keys of the lines that may have near ones."""
    near = distinct.filter(F.col("length") >= min(allowed)[0])
    # Where to cut depends on the length alone.
    places = cut_lineage(allowed_places(near.select("length").distinct(), allowed))
    placed = near.select("k1", "length", "line").join(broadcast_checked(places, BROADCAST_KEYS), "length")
    # Bytes need no counting of characters; where each character is a byte, both cuts are the same.
    at, width = F.col("at"), F.col("width")
    key = F.when(F.octet_length("line") == F.col("length"),
                 F.xxhash64("edits", "i", "width", F.substring(F.col("line").cast("binary"), at, width))).otherwise(
        F.xxhash64("edits", "i", "width", F.substring("line", at, width)))
    return placed.select(key.alias("key"), "k1")


def shared_keys(distinct: DataFrame, allowed: tuple = NEAR) -> DataFrame:
    """``key, n, k1, parity`` of the keys that more than one line has."""
    index = line_index(distinct, allowed)
    counted = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = cut_lineage(index.join(broadcast_checked(cut_lineage(counted), BROADCAST_KEYS), "key"))
    wanted = cut_lineage(rows.select("k1").distinct())
    bits = distinct.join(broadcast_checked(wanted, BROADCAST_KEYS), "k1", "left_semi").select(
        "k1", word_parity().alias("parity"), "first")
    return rows.distinct().join(bits, "k1")


def _few_bits(a: Column, b: Column, edits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= 3 * edits


def _verified(pairs: DataFrame, distinct: DataFrame, allowed: tuple) -> DataFrame:
    """``k1, k2`` of the later line of each pair (a, b) of k1 that is within the allowed edits."""
    pairs = cut_lineage(pairs.distinct())
    wanted = cut_lineage(pairs.select(F.col("a").alias("k1")).unionByName(pairs.select(F.col("b").alias("k1"))).distinct())
    long = distinct.filter(F.col("length") >= min(allowed)[0])
    texts = cut_lineage(long.join(broadcast_checked(wanted, BROADCAST_KEYS), "k1", "left_semi").select(
        "k1", F.struct("first", "k1", "k2", "line").alias("own")))
    both = (
        pairs.join(texts.withColumnsRenamed({"k1": "a", "own": "x"}), "a")
        .join(texts.withColumnsRenamed({"k1": "b", "own": "y"}), "b")
        .filter((F.col("x.first") != F.col("y.first"))
                & close_enough("x.line", "y.line", allowed))
    )
    later = F.when(F.col("x.first") > F.col("y.first"), F.col("x")).otherwise(F.col("y"))
    return both.select(later.alias("later")).select("later.k1", "later.k2").distinct()


def near_lines(distinct: DataFrame, allowed: tuple = NEAR) -> DataFrame:
    """``k1, k2`` of the distinct lines that have a near line at an earlier place."""
    rows, most = cut_lineage(shared_keys(distinct, allowed)), max(edits for _, edits in allowed)
    hot, done = rows.filter(F.col("n") >= HOT_KEY), None
    some_hot = not hot.isEmpty()
    if some_hot:
        top = hot.groupBy("key").agg(F.min(F.struct("first", "k1", "parity")).alias("top"))
        to_top = hot.join(top, "key").filter(
            (F.col("k1") != F.col("top.k1")) & _few_bits(F.col("parity"), F.col("top.parity"), most))
        done = cut_lineage(_verified(to_top.select(F.col("k1").alias("a"), F.col("top.k1").alias("b")), distinct, allowed))
        found = done.select("k1").distinct().withColumn("done", F.lit(True))
        rows = cut_lineage(rows.join(found, "k1", "left").withColumn("done", F.coalesce("done", F.lit(False))))
    else:
        rows = rows.withColumn("done", F.lit(False))
    possible = _few_bits(F.col("a.parity"), F.col("b.parity"), most) & ~(F.col("a.done") & F.col("b.done"))
    names = [F.col("a.k1").alias("a"), F.col("b.k1").alias("b")]
    pairs = pairs_within(rows.filter(F.col("n") < HOT_KEY), ["key"], "k1", ("parity", "done")).filter(possible).select(*names)
    if some_hot:
        # Where pairs would be very many, only near ones leave the join: the lines themselves take part.
        hot = rows.filter(F.col("n") >= HOT_KEY)
        wanted = cut_lineage(hot.select("k1").distinct())
        texts = distinct.join(broadcast_checked(wanted, BROADCAST_KEYS), "k1", "left_semi").select("k1", "line")
        close = close_enough("a.line", "b.line", allowed)
        pairs = pairs.unionByName(
            pairs_within(cut_lineage(hot.join(texts, "k1")), ["key"], "k1", ("parity", "done", "line"))
            .filter(possible & close).select(*names))
    found = _verified(pairs, distinct, allowed)
    return found if done is None else found.unionByName(done).distinct()


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, allowed: tuple = NEAR) -> DataFrame:
    """``doc_id, print, line_no, near`` of the lines that go; ``near`` if only a near one is earlier."""
    distinct = cut_lineage(distinct_lines(docs, min_chars))
    near = cut_lineage(near_lines(distinct, allowed).withColumn("near", F.lit(True)))
    concerned = cut_lineage(
        distinct.select("k1", "k2", "first", "n").join(near, ["k1", "k2"], "left")
        .filter((F.col("n") > 1) | F.col("near")).drop("n"))
    places = lines(docs, min_chars).select(*line_keys(), place().alias("at"), "print")
    return (
        places.join(concerned, ["k1", "k2"])
        .filter((F.col("at") > F.col("first")) | F.col("near"))
        .select("at.doc_id", "print", "at.line_no", (F.col("at") == F.col("first")).alias("near"))
        .distinct()
    )


def _per_document(docs: DataFrame, **limits) -> DataFrame:
    return repeated_lines(docs, **limits).groupBy("doc_id", "print").agg(
        F.array_sort(F.collect_list("line_no")).alias("removed"),
        F.count(F.when(F.col("near"), 1)).alias("n_near"))


def remove_repeated_lines(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` without the lines that go by ``limits``, see :func:`repeated_lines`; all rows and columns stay."""
    columns = docs.columns
    own_print, other, gone = (common.fresh(c, columns) for c in ("print", "gone_id", "gone"))
    found = cut_lineage(_per_document(docs, **limits).select(
        F.col("doc_id").alias(other), F.col("print").alias(f"{gone}_print"), F.col("removed").alias(gone)))
    if (found.agg(F.sum(F.size(gone))).first()[0] or 0) <= BROADCAST_LINES:  # else texts are shuffled to them
        found = F.broadcast(found)
    text = F.col("text").cast("string")
    joined = docs.withColumn(own_print, F.xxhash64(text)).join(
        found, F.col("doc_id").cast("long").eqNullSafe(F.col(other)) & (F.col(own_print) == F.col(f"{gone}_print")), "left")
    kept = F.array_join(
        F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains(F.col(gone), i)), "\n")
    return joined.withColumn("text", F.when(F.col(gone).isNull(), text).otherwise(kept)).select(*columns)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of lines, of removed and of near-duplicate lines, and which are removed."""
    docs = common.documents(spark, sf_dir)
    text = F.col("text").cast("string")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("print"),
                      F.coalesce(F.size(F.split(text, "\n", -1)), F.lit(0)).cast("long").alias("n_lines"))
    joined = common.null_safe(own, _per_document(docs, **WHOLE), ["doc_id", "print"], "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return joined.select(
        "doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.array_join(removed.cast("array<string>"), ",").alias("removed_lines"))
