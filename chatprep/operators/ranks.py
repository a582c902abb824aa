"""Exact order statistics without sorting a whole table in one task.

The functions here narrow down: count rows per bucket (a partial aggregate with a fixed number of
buckets), find the one bucket that holds the wanted rank, look only inside it, repeat. What is
finally ranked is the content of one bucket of the last level. The tables handed back to the rows
hold one row per group and level, and are broadcast only where the number of groups is fixed by the
caller.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatprep.operators.joins import null_safe_join

#: Bits of an id that one level of ``nth_id`` looks at.
ID_BITS = 16
#: Groups of which a table with one row each is broadcast.
FEW_GROUPS = 10_000
#: Quantiles that one level of ``summarize`` asks for; their rank error is 1 / ACCURACY at most.
QUANTILES = 1024
ACCURACY = 65536
#: Quantiles that the range left is wider than needed, on each side: many times that error.
MARGIN = 2


def order_hash(key: Sequence[str], seed: int) -> Column:
    """A repeatable pseudo-random order of rows: the md5 of the key and the seed."""
    parts = [F.col(k).cast("string") for k in key]
    return F.md5(F.concat_ws(":", *parts, F.lit(str(seed))))


def _holding_rank(
    counts: DataFrame, group: Sequence[str], order: Sequence[str | Column], keep_size: bool = False
) -> DataFrame:
    """The bucket that holds rank ``k`` of its group; ``k`` becomes the rank inside the bucket."""
    running = Window.partitionBy(*group).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = (
        counts.withColumn("upto", F.sum("n").over(running))
        .where((F.col("k") > F.col("upto") - F.col("n")) & (F.col("k") <= F.col("upto")))
        .withColumn("k", F.col("k") - (F.col("upto") - F.col("n")))
    )
    return found.drop("upto") if keep_size else found.drop("upto", "n")


def hash_cut(
    df: DataFrame,
    key: Sequence[str],
    take: Callable[[Column], Column],
    seed: int,
    by: str | None = None,
    groups: int | None = None,
) -> DataFrame:
    """Where to cut the hash order of ``df`` so that exactly ``take(n)`` of its ``n`` rows lie
    before the cut.

    ``key`` identifies a row. Gives one row ``(by, cut)`` per group, with ``cut`` the struct
    ``(h, *key)`` of the last row taken; a group of which nothing is taken has no row. ``by`` must
    name data sets, which the table of cuts has one row each of; if they are known to be ``groups``
    at most, that table is broadcast. More or fewer rows than a group has, or less than none, cannot
    be taken: the job fails.

    Rows are counted per prefix of their hash, and those of one prefix ranked: one of ``16 ** 4``, or
    of ``16 ** 3`` per group, in all.
    """
    digits = 3 if by else 4
    group = [by] if by else []
    rows = df.select(*group, *key, order_hash(key, seed).alias("h"))

    def small(frame: DataFrame) -> DataFrame:
        # One row, or one per group, of which there are few; else Spark decides by the size.
        few = by is None or (groups is not None and groups <= FEW_GROUPS)
        return F.broadcast(frame) if few else frame

    prefix = F.substring("h", 1, digits).alias("bucket")
    first = rows.groupBy(*group, prefix).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*group))
    possible = F.when(
        (F.col("k") < 0) | (F.col("k") > F.col("total")),
        F.raise_error(
            F.format_string("cannot take %d of %d rows", F.col("k"), F.col("total"))
        ).cast("bigint"),
    ).otherwise(F.col("k"))
    wanted = first.withColumn("total", total).withColumn("k", take(F.col("total")))
    goal = _holding_rank(wanted.withColumn("k", possible).drop("total"), group, ["bucket"])

    # Copies of a key, which there should be none of, are counted and not ranked one by one.
    inside = rows.withColumn("bucket", prefix).join(small(goal), [*group, "bucket"])
    second = inside.groupBy(*group, "bucket", "h", *key, "k").agg(F.count(F.lit(1)).alias("n"))
    last = _holding_rank(second, [*group, "bucket"], ["h", *key], keep_size=True)
    unique = F.when(
        F.col("k") < F.col("n"), F.raise_error(F.lit("the key does not identify a row"))
    ).otherwise(F.struct("h", *key))
    return last.select(*group, unique.alias("cut"))


def before_cut(
    df: DataFrame,
    key: Sequence[str],
    cut: DataFrame,
    seed: int,
    by: str | None = None,
    groups: int | None = None,
) -> tuple[DataFrame, Column]:
    """``df`` and the boolean column that tells whether a row lies before the cut; ``groups`` as
    for ``hash_cut``."""
    place = F.struct(order_hash(key, seed).alias("h"), *[F.col(k) for k in key])
    if by is None:
        return df, F.coalesce(place <= cut.scalar(), F.lit(False))
    few = groups is not None and groups <= FEW_GROUPS
    joined = null_safe_join(df, F.broadcast(cut) if few else cut, [by], "left")
    return joined, F.coalesce(place <= F.col("cut"), F.lit(False))


def hash_rank(df: DataFrame, key: Sequence[str], seed: int, digits: int = 4) -> DataFrame:
    """Adds ``rank``, from 0, in the hash order of the rows.

    Rows are counted per prefix of their hash, of ``digits`` hex digits; a window ranks those of one
    prefix. The counts, ``16 ** digits`` at most, are summed up in one task.
    """
    rows = df.withColumn("_h", order_hash(key, seed)).withColumn("_prefix", F.substring("_h", 1, digits))
    counts = rows.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(
        "_prefix", (F.sum("_n").over(Window.orderBy("_prefix")) - F.col("_n")).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy("_prefix").orderBy("_h", *key)) - 1
    # A proven size: 16 ** digits rows.
    ranked = rows.withColumn("_inside", inside).join(F.broadcast(before), "_prefix")
    return ranked.withColumn("rank", F.col("_before") + F.col("_inside")).drop(
        "_h", "_prefix", "_inside", "_before"
    )


def group_cut(
    df: DataFrame, group: Sequence[str], take: Callable[[Column], Column], seed: int
) -> DataFrame:
    """Where to cut the hash order of the groups of ``df`` so that the number of rows before the cut
    is as near as possible to ``take(n)`` of all ``n`` rows; of two equally near cuts the earlier one.

    One row ``cut``, the struct ``(h, *group)`` of the last group taken, or none if nothing is. Groups
    are counted first, then summed per prefix of their hash; only the groups of one prefix of six
    digits are ordered one by one. A group of any size is one row there.
    """
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("h", order_hash(group, seed))

    def summed(frame: DataFrame, digits: int, *carry: str) -> DataFrame:
        prefix = F.substring("h", 1, digits).alias("bucket")
        return frame.groupBy(*carry, prefix).agg(F.sum("n").alias("n"))

    first = summed(sizes, 3)
    wanted = first.withColumn("k", take(F.sum("n").over(Window.partitionBy())))
    # The rank just behind the last row that is wanted lies in the group that may be cut off.
    behind = F.least(F.greatest(F.col("k"), F.lit(0)) + 1, F.sum("n").over(Window.partitionBy()))
    wanted = wanted.withColumn("goal", behind).drop("k").withColumnRenamed("goal", "k")
    goal = _holding_rank(wanted, [], ["bucket"])
    inside = sizes.withColumn("bucket", F.substring("h", 1, 3)).join(F.broadcast(goal), "bucket")
    goal = _holding_rank(summed(inside, 6, "k"), [], ["bucket"])
    inside = sizes.withColumn("bucket", F.substring("h", 1, 6)).join(F.broadcast(goal), "bucket")
    place = F.struct("h", *group)
    reached = _holding_rank(inside, [], ["h", *group], keep_size=True).select(place.alias("at"))
    # Rows up to that group and before it, from the groups' sizes.
    upto = sizes.where(place <= reached.scalar()).agg(
        F.sum("n").alias("upto"),
        F.max_by("n", place).alias("last_n"),
        F.max(place).alias("at"),
        F.max(F.when(place < reached.scalar(), place)).alias("before"),
    )
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    goal = take(F.lit(total.scalar()))
    over, short = F.col("upto") - goal, goal - (F.col("upto") - F.col("last_n"))
    return upto.select(F.when(over < short, F.col("at")).otherwise(F.col("before")).alias("cut")).where(
        "cut IS NOT NULL"
    )


def nth_id(df: DataFrame, row_id: str, n: int) -> DataFrame:
    """One row ``cut``: the ``n``-th smallest of the integer ids, no row if there are fewer.

    Each level counts the ids per value of the next 16 bits, among those that share the bits found
    so far; so at most 65,536 counts are ranked at a time, whatever ``n`` is.
    """
    # With the sign bit turned, ids are in the order of their bits.
    turned = F.col(row_id).cast("bigint").bitwiseXOR(F.lit(-(1 << 63)).cast("bigint"))
    ids = df.where(F.col(row_id).isNotNull()).select(turned.alias("x"))
    goal = None
    for shift in range(64 - ID_BITS, -1, -ID_BITS):
        if goal is None:
            rows = ids.withColumn("k", F.lit(n).cast("bigint"))
        else:
            above = F.shiftrightunsigned("x", shift + ID_BITS)
            rows = ids.withColumn("bucket", above).join(F.broadcast(goal), "bucket").drop("bucket")
        counts = rows.groupBy("k", F.shiftrightunsigned("x", shift).alias("bucket")).agg(
            F.count(F.lit(1)).alias("n")
        )
        # Buckets hold unsigned numbers; only the last level uses the sign bit.
        order = F.col("bucket").bitwiseXOR(F.lit(-(1 << 63)).cast("bigint")) if shift == 0 else "bucket"
        goal = _holding_rank(counts, [], [order])
    return goal.select(
        F.col("bucket").bitwiseXOR(F.lit(-(1 << 63)).cast("bigint")).alias("cut")
    )


def _narrowed(measured: DataFrame) -> DataFrame:
    """``(metric, goal, lo, hi)``: the range between two quantiles that holds the wanted rank.

    ``measured`` tells how many values lie ``below`` the range looked at so far, how many (``n``)
    inside, and the quantiles of the latter.
    """
    share = F.lit(float(QUANTILES)) / F.col("n")
    rank = F.col("goal") - F.col("below")
    low = F.greatest(F.floor((rank - 1) * share) - MARGIN, F.lit(0))
    high = F.least(F.ceil(rank * share) + MARGIN, F.lit(QUANTILES))
    return measured.select(
        "metric",
        "goal",
        F.get("quantiles", low.cast("int")).alias("lo"),
        F.get("quantiles", high.cast("int")).alias("hi"),
    )


def summarize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(metric, n, total, mean, lo, hi, median)``, one row per column.

    The median is exact, the mean of the two middle values if ``n`` is even. The built-in one keeps
    every distinct value in one task; here approximate quantiles, whose rank error is known, give a
    range around the middle, and those inside it a narrower one. Each of the two levels leaves about
    one value in 200, whatever the values' distribution, and only those are ranked. ``df`` is read
    once per level: hand in a stored table, not a costly computation.
    """
    pairs = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    values = (
        df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where("value IS NOT NULL")
    )
    percents = ", ".join(f"{i / QUANTILES!r}D" for i in range(QUANTILES + 1))

    def quantiles(value: str) -> Column:
        return F.expr(f"percentile_approx({value}, array({percents}), {ACCURACY})").alias("quantiles")

    summary = values.groupBy("metric").agg(
        F.count("value").alias("n"),
        F.sum("value").alias("total"),
        F.avg("value").alias("mean"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
    )
    middle = F.array_distinct(F.array(F.expr("(n + 1) div 2"), F.expr("(n + 2) div 2")))
    whole = values.groupBy("metric").agg(F.count("value").alias("n"), quantiles("value"))
    goals = _narrowed(
        whole.select("*", F.explode(middle).alias("goal"), F.lit(0).cast("bigint").alias("below"))
    )

    def up_to_range(goals: DataFrame) -> DataFrame:
        # At most two goals per column: a proven size.
        inside = F.when(F.col("value") >= F.col("lo"), F.col("value"))
        joined = values.join(F.broadcast(goals), "metric").where(F.col("value") <= F.col("hi"))
        return joined.select("metric", "goal", inside.alias("inside"))

    measured = up_to_range(goals).groupBy("metric", "goal").agg(
        F.count_if(F.col("inside").isNull()).alias("below"),
        F.count("inside").alias("n"),
        quantiles("inside"),
    )
    # Values below the range are one group, the first one.
    counts = (
        up_to_range(_narrowed(measured))
        .groupBy("metric", "goal", "inside")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("k", F.col("goal"))
    )
    found = _holding_rank(counts, ["metric", "goal"], [F.asc_nulls_first("inside")])
    medians = found.groupBy("metric").agg(
        F.avg("inside").alias("median"), F.count("inside").alias("found")
    )
    missed = F.raise_error(F.lit("a median lies outside its range")).cast("double")
    wanted = F.when(F.col("n") % 2 == 1, 1).otherwise(2)
    median = F.when(F.col("found") == wanted, F.col("median")).otherwise(missed)
    return summary.join(F.broadcast(medians), "metric", "left").select(
        *summary.columns, median.alias("median")
    )
