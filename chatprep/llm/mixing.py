"""Mixing sources to target weights: Sainte-Lague blocks for sources and shards, then seeded selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatprep.llm.common import WORD, stored, text_of

WEIGHTS = (5, 2, 1)
#: How often a word may be repeated at most.
REPEATS = 3
#: Words of a block.
BLOCK = 4
#: Words (and rows) that a shard of a source holds, roughly, and shards in all beside one per source;
#: in larger tables shards are larger.
SHARD = 1 << 17
SHARDS = 1 << 16
#: A plan of so many sources or shards is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 100_000


def seeded(seed: int, *parts: Column) -> Column:
    """A repeatable hash as 32 hexadecimal digits."""
    text = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *text))


def seeded_number(digits: Column) -> Column:
    return F.conv(F.substring(digits, 1, 8), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int], repeats: int) -> DataFrame:
    """``target`` for each row ``(source, source_size)``.

    Sources in code-point order (null last) take the weights in turn and share the total size. A
    target stops at ``repeats`` times its source's size; by ascending cap per weight, a source is
    capped as long as the share left for its weight reaches its cap, and the others share the rest.
    ``mix_size`` is the sum of all targets, a whole number.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    everything = by_name.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    big = "decimal(38,0)"
    cap = F.col("source_size") * repeats
    by_cap = Window.orderBy(cap / F.col("weight"), F.asc_nulls_last("source"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    reaches = (F.col("total") - F.col("capped_before")).cast(big) * F.col("weight") >= cap.cast(
        big
    ) * F.col("weight_left")
    stop = F.col("capped")
    rest = F.col("total") - F.sum(F.when(stop, cap).otherwise(0)).over(everything)
    share = F.sum(F.when(stop, 0).otherwise(F.col("weight"))).over(everything)
    return (
        sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("capped_before", F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(after))
        .withColumn("capped", reaches)
        .withColumn("rest", rest)
        .withColumn("share", share)
        .withColumn(
            "target",
            F.when(stop, cap.cast("double")).otherwise(
                (F.col("rest") * F.col("weight")).cast("double") / F.col("share")
            ),
        )
        .withColumn("mix_size", F.when(F.col("share") > 0, F.col("total")).otherwise(F.col("total") - F.col("rest")))
        .drop("total", "capped_before", "weight_left", "capped", "rest", "share", "weight")
    )


def apportioned(
    rows: DataFrame, votes: str, house: Column, within: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Adds ``seats``: each group's ``house`` of seats, given to its rows by Sainte-Lague's rule.

    A row's k-th seat has the quotient ``votes / (2 k - 1)``, and the highest quotients of the group
    get seats; of equal ones those that come first by ``order``. Rounding each row's exact share gives
    nearly the whole house. The seats that are missing have the highest quotients behind these, the
    ones too many the lowest among them, so only the few around the rounded share are listed: with
    ``n`` rows and ``d`` seats of difference, a row of share ``s`` gains or loses ``1 + s * (d + n)``
    at most, which makes ``d + 3 n`` in all.
    """
    group = Window.partitionBy(*within)
    whole = F.sum(votes).over(group)
    shared = (
        rows.withColumn("house", house)
        .withColumn("part", F.when(whole > 0, F.col(votes) / whole).otherwise(0.0))
        .withColumn("base", F.floor(F.col("part") * F.col("house") + 0.5))
        .withColumn("missing", F.col("house") - F.sum("base").over(group))
        .withColumn("listed", F.count(F.lit(1)).over(group))
        .withColumn("spot", F.row_number().over(group.orderBy(*map(F.asc_nulls_last, order))))
    )
    more = F.col("missing") > 0
    reach = 1 + F.ceil(F.col("part") * (F.abs("missing") + F.col("listed")))
    reach = F.when(more, reach).otherwise(F.least(reach, F.col("base")))
    nth = F.when(F.col("missing") != 0, F.sequence(F.lit(1).cast("long"), reach))
    nth = F.when(reach > 0, nth)
    listed = shared.where(F.col(votes) > 0).select("*", F.explode(nth).alias("nth"))
    seat = F.when(more, F.col("base") + F.col("nth")).otherwise(F.col("base") - F.col("nth") + 1)
    quotient = F.col(votes) / (2 * seat - 1)
    # Highest first if seats are missing, lowest first if there are too many.
    best = F.when(more, -quotient).otherwise(quotient)
    tie = F.when(more, F.col("spot")).otherwise(-F.col("spot"))
    turn = Window.partitionBy(*within).orderBy("best", tie)
    moved = (
        listed.withColumn("best", best)
        .withColumn("turn", F.row_number().over(turn))
        .where(F.col("turn") <= F.abs("missing"))
        .groupBy(*[F.col(c).alias(f"_{c}") for c in order])
        .agg(F.count(F.lit(1)).alias("moved"))
    )
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in order])
    seats = F.col("base") + F.coalesce("moved", F.lit(0)) * F.signum("missing").cast("long")
    return (
        shared.join(moved, same, "left")
        .withColumn("seats", seats)
        .drop("house", "part", "base", "missing", "listed", "spot", "moved", *[f"_{c}" for c in order])
    )


def _overlap(start: Column, end: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.least(end, high) - F.greatest(start, low), F.lit(0))


def _sizes(docs: DataFrame, columns: Sequence[str], *more: Column) -> DataFrame:
    text = text_of(F.col(columns[2]))
    return stored(
        docs.select(
            F.col(columns[0]).alias("id"),
            F.col(columns[1]).alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(text).alias("digest"),
            F.when(F.col(columns[0]).isNull(), F.md5(text)).alias("text_key"),
            *more,
        ),
        "mix-sizes",
    )


def _small(plan: DataFrame) -> DataFrame:
    return F.broadcast(plan) if plan.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else plan


def _placed(sizes: DataFrame, weights, repeats, block, shard, seed, key: Column) -> DataFrame:
    sources = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    targets = source_targets(sources, weights, repeats)
    everything = Window.partitionBy()
    load = F.col("source_size") + F.col("rows")
    per_shard = F.greatest(F.lit(shard), F.ceil(F.sum(load).over(everything) / SHARDS))
    targets = targets.withColumn("shards", F.greatest(F.ceil(load / per_shard), F.lit(1)))
    house = F.floor(F.col("mix_size") / block + 0.5)
    plan = stored(apportioned(targets, "target", house, [], ["source"]), "mix-sources")
    by_source = _small(
        plan.select(F.col("source").alias("plan_source"), "source_size", "target", "shards", "seats")
    )
    dealt = (
        sizes.join(by_source, F.col("source").eqNullSafe(F.col("plan_source")))
        .withColumn("key", key)
        .withColumn("shard", F.pmod(seeded_number(F.col("key")), F.col("shards")))
    )
    cells = dealt.groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.max("seats").alias("source_seats")
    )
    cells = apportioned(cells, "shard_size", F.col("source_seats"), ["source"], ["source", "shard"])
    words = F.least(F.col("seats") * block, F.col("shard_size") * repeats)
    cells = cells.select(
        F.col("source").alias("cell_source"),
        F.col("shard").alias("cell"),
        "shard_size",
        F.when(F.col("shard_size") > 0, words).otherwise(0).alias("words"),
    )
    cells = _small(stored(cells, "mix-shards"))

    # Rows of one identifier go by their texts, so that only equal ones can change places.
    order = Window.partitionBy("source", "shard").orderBy("key", "id", "digest")
    order = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = F.col("source").eqNullSafe(F.col("cell_source")) & (F.col("shard") == F.col("cell"))
    blocks = F.greatest(F.ceil(F.col("shard_size") / block), F.lit(1))
    drawn = seeded_number(seeded(seed, F.col("source"), F.col("shard"), F.lit("offset")))
    turns = F.greatest(F.col("shard_size"), F.lit(1))
    return (
        dealt.drop("seats")
        .join(cells, same)
        .withColumn("end", F.sum("size").over(order))
        .withColumn("start", F.col("end") - F.col("size"))
        .withColumn("passes", F.floor(F.col("words") / turns))
        .withColumn("extra", F.pmod(F.col("words"), turns))
        .withColumn("low", F.pmod(drawn, blocks) * block)
        .withColumn("high", F.least(F.col("low") + F.col("extra"), F.col("shard_size")))
        .withColumn("wrap", F.greatest(F.col("low") + F.col("extra") - F.col("shard_size"), F.lit(0)))
        .withColumn("late", _overlap(F.col("start"), F.col("end"), F.col("low"), F.col("high")))
        .withColumn("early", _overlap(F.col("start"), F.col("end"), F.lit(0), F.col("wrap")))
    )


def _key(seed: int) -> Column:
    """Rows go by their identifier, or by their text if they have none."""
    return seeded(seed, F.coalesce(F.col("id").cast("string"), F.col("text_key")))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    repeats: int = REPEATS,
    block: int = BLOCK,
    shard: int = SHARD,
    seed: int = 5,
    columns: tuple[str, str, str] = ("doc_id", "source", "text"),
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row per input row.

    The mix is a house of blocks of ``block`` words each, as many as the targets make up. Sainte-Lague's
    rule gives the blocks to the sources by the highest quotients of their targets, and a source's
    blocks to its shards by those of their sizes. A source is dealt over shards of ``shard`` words or
    more by a seeded hash of the identifier (of the text where there is none), which also orders the
    documents of a shard. A shard takes all its words as often as its blocks allow, and the remaining
    blocks as a run from a seeded block on, which goes on at the shard's start; nothing is taken more
    than ``repeats`` times. ``taken`` counts a document's words in the chosen blocks, repeats
    included, so a source comes within about half a block, and half a block per shard, of its target.

    Null texts have size 0, a null source is a source of its own, empty tables give no rows, and
    repeated rows count one by one. Only small columns are shuffled.
    """
    placed = _placed(_sizes(docs, columns), weights, repeats, block, shard, seed, _key(seed))
    taken = F.col("passes") * F.col("size") + F.col("late") + F.col("early")
    return placed.select(
        F.col("id").alias(columns[0]), "size", "source_size", "target", taken.alias("taken")
    )


def mixed_texts(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    repeats: int = REPEATS,
    block: int = BLOCK,
    shard: int = SHARD,
    seed: int = 5,
) -> DataFrame:
    """The documents that the mix takes, as often as it takes them, with the columns of ``docs``.

    A document taken whole keeps its text; one at the edge of a run of blocks keeps the words in
    them, joined by one space, as a row of its own. ``n_chars``, if there, is the new length.

    The rows are stored with a number each, by which the decisions are joined back: rows with a null
    or a repeated identifier are documents like others.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = stored(docs.select(F.monotonically_increasing_id().alias("mix_row"), row), "mix-rows")
    sizes = _sizes(rows, ("row.doc_id", "row.source", "row.text"), F.col("mix_row"))
    placed = _placed(sizes, weights, repeats, block, shard, seed, _key(seed))
    whole = F.array_repeat(
        F.struct(F.lit(0).cast("long").alias("skip"), F.col("size").alias("words")),
        F.col("passes").cast("int"),
    )

    def part(low: Column, words: Column) -> Column:
        skip = F.greatest(low - F.col("start"), F.lit(0))
        return F.when(
            words > 0, F.array(F.struct(skip.alias("skip"), words.alias("words")))
        ).otherwise(F.array().cast("array<struct<skip:bigint,words:bigint>>"))

    pieces = F.concat(
        whole, part(F.col("low"), F.col("late")), part(F.lit(0).cast("long"), F.col("early"))
    )
    decisions = placed.where("size > 0").select(
        "mix_row", F.col("size").alias("mix_size"), pieces.alias("mix_pieces")
    ).where(F.size("mix_pieces") > 0)
    words = F.regexp_extract_all("row.text", F.lit(WORD), F.lit(0))
    cut = F.array_join(
        F.slice(words, (F.col("piece.skip") + 1).cast("int"), F.col("piece.words").cast("int")), " "
    )
    text = F.when(F.col("piece.words") == F.col("mix_size"), F.col("row.text")).otherwise(cut)
    out = (
        rows.join(decisions, "mix_row")
        .select("row", "mix_size", F.explode("mix_pieces").alias("piece"))
        .select(F.col("row").withField("text", text).alias("row"))
    )
    if "n_chars" in docs.columns:
        length = F.length("row.text").cast(docs.schema["n_chars"].dataType)
        out = out.select(F.col("row").withField("n_chars", length).alias("row"))
    return out.select("row.*")
