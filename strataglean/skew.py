"""Building blocks that keep one hot key from becoming one slow task.

All of them are exact: hot groups are split or counted another way, never
dropped, capped or sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataglean.session import cut_lineage

# Members of one group handled by one task before the group is split.
GROUP_ROWS = 4096
# Pairs, or rows of a wide join, that one task takes: with more of them there are more tasks.
TASK_ROWS = 2_000_000


def spread_scan(df: DataFrame) -> DataFrame:
    """Spread rows over the cores if the scan yields fewer tasks than there are cores.

    A Parquet file with one row group is read by one task. Large inputs have
    tasks enough and pass unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def fits(df: DataFrame, max_rows: int) -> bool:
    """True if ``df`` has at most ``max_rows`` rows; reads no more than that plus one."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_checked(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Mark ``df`` for broadcast if its row count is small, else leave the join to Catalyst."""
    return F.broadcast(df) if fits(df, max_rows) else df


def hot_parts(df: DataFrame, keys: list[str], rows_per_part: int) -> DataFrame | None:
    """``keys, parts`` of the groups that need splitting, or None if there are none.

    One pre-aggregated pass; there are at most rows / rows_per_part such groups.
    """
    hot = cut_lineage(
        df.groupBy(*keys)
        .agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_part)).cast("int").alias("parts"))
        .filter("parts > 1")
    )
    return None if hot.isEmpty() else broadcast_checked(hot)


def add_part(df: DataFrame, hot: DataFrame | None, keys: list[str], by: str) -> DataFrame:
    """Add ``parts`` and ``part``: rows of a hot group are spread by a hash of ``by``."""
    if hot is None:
        return df.withColumn("parts", F.lit(1)).withColumn("part", F.lit(0))
    return (
        df.join(hot, keys, "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.pmod(F.xxhash64(by), F.col("parts").cast("bigint")).cast("int"))
    )


def spread_join(
    left: DataFrame, right: DataFrame, keys: list[str], by: str, rows_per_part: int = GROUP_ROWS, tasks: int | None = None
) -> DataFrame:
    """Inner join whose output is large where ``right`` has hot keys.

    Hot groups of ``right`` are cut into parts by a hash of ``by``; only their
    partners on the left are repeated, once per part. ``tasks``: as many tasks join, see :func:`tasks_beyond`.
    """
    hot = hot_parts(right, keys, rows_per_part)
    if hot is None:
        return _dealt(left, tasks, keys).join(_dealt(right, tasks, keys), keys)
    parted = add_part(right, hot, keys, by).drop("parts")
    repeated = left.join(hot, keys, "left").withColumn(
        "part", F.explode(F.expr("sequence(0, coalesce(parts, 1) - 1)"))
    ).drop("parts")
    keys = [*keys, "part"]
    return _dealt(repeated, tasks, keys).join(_dealt(parted, tasks, keys), keys).drop("part")


def _dealt(df: DataFrame, tasks: int | None, keys: list[str]) -> DataFrame:
    return df if tasks is None else df.repartition(tasks, *keys)


def pairs_in_small_groups(
    df: DataFrame, keys: list[str], member: str, carry: tuple[str, ...] = (), tasks: int | None = None
) -> DataFrame:
    """Like :func:`pairs_within` for groups whose size is already bounded."""
    row = F.struct(F.col(member), *[F.col(c) for c in carry])
    left = _dealt(df.select(*keys, row.alias("a")), tasks, keys)
    right = _dealt(df.select(*keys, row.alias("b")), tasks, keys)
    return left.join(right, keys).filter(F.col(f"a.{member}") < F.col(f"b.{member}"))


def pairs_within(
    df: DataFrame,
    keys: list[str],
    member: str,
    carry: tuple[str, ...] = (),
    rows_per_part: int = GROUP_ROWS,
    tasks: int | None = None,
) -> DataFrame:
    """Unordered pairs of members that share a group: ``keys, a, b`` with a.member < b.member.

    ``a`` and ``b`` are structs of the member and the carried columns. A group
    with more than ``rows_per_part`` members is cut into parts and every pair of
    parts becomes its own join key, so its pairs are made by many tasks.
    Rows have to be distinct in (keys, member). ``tasks``: as many tasks make the pairs, see :func:`tasks_beyond`.
    """
    rows = df.select(*keys, member, *carry)
    hot = hot_parts(rows, keys, rows_per_part)
    if hot is None:
        return pairs_in_small_groups(rows, keys, member, carry, tasks)
    row = F.struct(F.col(member), *[F.col(c) for c in carry])
    parted = add_part(rows, hot, keys, member)
    left = parted.select(
        *keys, row.alias("x"), F.col("part").alias("lo"),
        F.explode(F.expr("sequence(part, parts - 1)")).alias("hi"),
    )
    right = parted.select(
        *keys, row.alias("y"), F.col("part").alias("hi"),
        F.explode(F.expr("sequence(0, part)")).alias("lo"),
    )
    parts = [*keys, "lo", "hi"]
    joined = _dealt(left, tasks, parts).join(_dealt(right, tasks, parts), parts).filter(
        (F.col("lo") < F.col("hi")) | (F.col(f"x.{member}") < F.col(f"y.{member}"))
    )
    ordered = F.col(f"x.{member}") < F.col(f"y.{member}")
    return joined.select(
        *keys,
        F.when(ordered, F.col("x")).otherwise(F.col("y")).alias("a"),
        F.when(ordered, F.col("y")).otherwise(F.col("x")).alias("b"),
    )


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks among which ``rows`` are dealt, so that a task's memory does not grow with the table."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


def tasks_beyond(spark: SparkSession, rows: int) -> int | None:
    """Like :func:`tasks_for`; None if a shuffle's own number of tasks suffices."""
    tasks = tasks_for(spark, rows)
    return tasks if tasks > tasks_for(spark, 0) else None


def pair_sums(
    df: DataFrame, group: str, member: str, carry: str | None, sums: dict[str, Column], task_rows: int = TASK_ROWS
) -> DataFrame:
    """``member_1, member_2`` and ``sums`` over the groups that two members share, member_1 < member_2.

    For groups whose size is already bounded. ``sums`` are expressions of ``x`` and ``y``, the column
    ``carry`` of the two. A member goes to its task with the later members of each of its groups as one array, so that
    all pairs of a member are added up where they are made and no task holds the pairs of
    many members. A member with more than ``task_rows`` pairs is dealt to several tasks by the group.
    """
    known = df.filter(F.col(group).isNotNull() & F.col(member).isNotNull())
    entry = F.struct(F.col(member).alias("m"), *([F.col(carry).alias("c")] if carry else []))
    sets = known.groupBy(F.col(group).alias("g")).agg(F.array_sort(F.collect_list(entry)).alias("row"))
    sets = cut_lineage(sets.filter(F.size("row") > 1).select(
        "g", F.col("row.m").alias("m"), *([F.col("row.c").alias("c")] if carry else [])))
    load = cut_lineage(
        sets.select(F.posexplode("m").alias("at", "member_1"), F.size("m").alias("n"))
        .groupBy("member_1").agg(F.sum(F.col("n") - F.col("at") - 1).alias("load")))
    total = load.agg(F.sum("load")).first()[0] or 0
    hot = load.filter(F.col("load") > task_rows).select(
        "member_1", F.ceil(F.col("load") / task_rows).cast("int").alias("parts"))
    any_hot = not hot.isEmpty()

    def later(name: str) -> Column:
        return F.slice(name, F.col("at") + 2, F.size("m"))

    first = sets.select("g", *(["c"] if carry else []), "m", F.posexplode("m").alias("at", "member_1")).select(
        "g", "member_1", later("m").alias("m"),
        *([F.get("c", F.col("at")).alias("x"), later("c").alias("c")] if carry else [])).filter(F.size("m") > 0)
    by, tasks = ["member_1"], max(df.sparkSession.sparkContext.defaultParallelism, -(-total // task_rows))
    if any_hot:
        first, by = add_part(first, broadcast_checked(hot), by, "g").drop("parts"), ["member_1", "part"]
    dealt = first.drop("g").repartition(tasks, *by)
    if carry:
        pairs = dealt.select(*by, "x", F.explode(F.arrays_zip("m", "c")).alias("y")).select(
            *by, "x", F.col("y.m").alias("member_2"), F.col("y.c").alias("y"))
    else:
        pairs = dealt.select(*by, F.explode("m").alias("member_2"))
    found = pairs.filter("member_1 < member_2").groupBy(*by, "member_2").agg(
        *[F.sum(c).alias(name) for name, c in sums.items()])
    if any_hot:
        found = found.repartition(tasks, "member_1", "member_2").groupBy("member_1", "member_2").agg(
            *[F.sum(name).alias(name) for name in sums])
    return found


def hot_groups(df: DataFrame, key: str, rows: int, at_most: int | None = None) -> DataFrame:
    """``key, n`` of groups with more than ``rows`` rows, ``at_most`` of them, largest first.

    If there are more than allowed, the bar on their size rises until there are not; the
    bar is found from the number of groups per size, nothing is sorted.
    """
    hot = cut_lineage(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows))
    if at_most is None or hot.count() <= at_most:
        return hot
    sizes = hot.groupBy("n").agg(F.count(F.lit(1)).alias("groups"))
    largest = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bar = sizes.withColumn("upto", F.sum("groups").over(largest)).filter(F.col("upto") <= at_most).agg(
        F.min("n").alias("bar"))  # no row if even the largest size has too many
    return cut_lineage(hot.join(F.broadcast(bar), F.col("n") >= F.col("bar")).select(key, "n"))


def co_occurrence(
    pairs: DataFrame, group: str, member: str, at_least: int = 1, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """``member_1, member_2, shared`` for members that share >= ``at_least`` groups, exactly.

    ``pairs`` holds distinct (group, member) rows. Ordinary groups are joined
    with themselves. The hottest groups, at most ``at_least - 1`` of them, are
    not: a pair that reaches ``at_least`` must then also meet in an ordinary
    group, often enough that the hot ones can make up the rest. Only such pairs
    are looked up in the hot groups, so no hot group emits all its pairs.
    """
    hot, n_hot = None, 0
    if at_least > 1:
        hot = hot_groups(pairs, group, group_rows, at_least - 1)
        n_hot = hot.count()
    light = pairs if n_hot == 0 else pairs.join(hot, group, "left_anti")
    # With fewer hot groups than allowed, every other group is known to be small.
    if n_hot < at_least - 1:
        counted = pair_sums(light, group, member, None, {"shared": F.lit(1)})
    else:
        counted = (
            pairs_within(light, [group], member)
            .groupBy(F.col(f"a.{member}").alias("member_1"), F.col(f"b.{member}").alias("member_2"))
            .agg(F.count(F.lit(1)).alias("shared"))
        )
    if n_hot == 0:
        return counted.filter(F.col("shared") >= at_least)
    open_pairs = cut_lineage(counted.filter(F.col("shared") >= at_least - n_hot))
    in_hot = pairs.join(hot, group, "left_semi")
    extra = (
        open_pairs.join(in_hot.withColumnRenamed(member, "member_1"), "member_1")
        .join(in_hot.withColumnRenamed(member, "member_2"), [group, "member_2"])
        .groupBy("member_1", "member_2")
        .agg(F.count(F.lit(1)).alias("extra"))
    )
    return (
        open_pairs.join(extra, ["member_1", "member_2"], "left")
        .withColumn("shared", F.col("shared") + F.coalesce("extra", F.lit(0)))
        .drop("extra")
        .filter(F.col("shared") >= at_least)
    )


def shared_members(pairs: DataFrame, sets: DataFrame, set_id: str, member: str) -> DataFrame:
    """``a, b, shared``: exact overlap of the given pairs of sets.

    ``pairs`` has ``a, b, n_a, n_b``; the smaller set of each pair is expanded
    and looked up in the larger one.
    """
    first_small = F.col("n_a") <= F.col("n_b")
    probe = pairs.select(
        "a", "b",
        F.when(first_small, F.col("a")).otherwise(F.col("b")).alias("small"),
        F.when(first_small, F.col("b")).otherwise(F.col("a")).alias("large"),
    )
    small = sets.select(F.col(set_id).alias("small"), F.col(member).alias("m"))
    large = sets.select(F.col(set_id).alias("large"), F.col(member).alias("m"))
    return (
        probe.join(small, "small")
        .join(large, ["large", "m"])
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("shared"))
    )


def _ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows kept in range partitions, named by ``_range``.

    They are materialised: sampling may choose other ranges in another run.
    """
    return cut_lineage(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    )


def running_sum(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` up to each row in the order of distinct ``order``, without one global window.

    Each range is summed by itself and shifted by the totals of the ranges
    before it; that table has one row per partition.
    """
    ranged = _ranged(df, order)
    totals = ranged.groupBy("_range").agg(F.sum(value).alias("_t"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("_own", F.sum(value).over(inside))
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_before") + F.col("_own"))
        .drop("_range", "_own", "_before")
    )


def dense_number(df: DataFrame, order: list[str], name: str, start: int = 1) -> DataFrame:
    """Number rows start, start + 1, .. in the order of distinct ``order``."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    numbered = running_sum(ones, order, "_one", name).drop("_one")
    return numbered.withColumn(name, F.col(name) + F.lit(start - 1))


def pieces(
    df: DataFrame, keys: list[str], member: str, out: str, piece_rows: int = 100_000
) -> DataFrame:
    """Sorted member arrays per group: ``keys, piece, n, out``.

    ``n`` is the size of the whole group. Piece p holds the members with ranks from
    p * ``piece_rows`` on, so the pieces in order concatenate to the sorted group and no
    array grows without bound. Rows have to be distinct in (keys, member).
    """
    numbered = cut_lineage(dense_number(df.select(*keys, member), [*keys, member], "_no", 0))
    whole = numbered.groupBy(*keys).agg(F.min("_no").alias("_first"), F.count(F.lit(1)).alias("n"))
    ranked = numbered.join(whole, keys).withColumn(
        "piece", F.floor((F.col("_no") - F.col("_first")) / piece_rows).cast("bigint"))
    return (
        # Partitioned by the piece too: grouping alone would keep a group's pieces together.
        ranked.repartition(*keys, "piece").groupBy(*keys, "piece")
        .agg(F.max("n").alias("n"), F.array_sort(F.collect_list(member)).alias(out))
    )


def cumulative_before(value: str, keys: list[str], order: list[str]) -> Column:
    """Sum of ``value`` over the earlier rows of a group that is known to be short."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return F.coalesce(
        F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
