"""Token packing and length grouping of training examples."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatprep.operators.ranks import hash_rank

#: Ranges that a wider range holds, and how often ranges are joined into wider ones.
RANGES = 1 << 16
LEVELS = 2


def _offsets(sums: DataFrame, levels: int) -> DataFrame:
    """``(_range, _offset)``: the sum of all ranges before each one, by their first ids."""
    own = F.sum("_sum").over(
        (Window.partitionBy("_wide") if levels else Window.partitionBy()).orderBy("_first")
    ) - F.col("_sum")
    if not levels:
        return sums.select("_range", own.alias("_offset"))
    wide = sums.withColumn("_wide", F.expr(f"_range div {RANGES}"))
    wider = wide.groupBy(F.col("_wide").alias("_range")).agg(
        F.sum("_sum").alias("_sum"), F.min("_first").alias("_first")
    )
    before = _offsets(wider, levels - 1).select(
        F.col("_range").alias("_wide"), F.col("_offset").alias("_before")
    )
    inside = wide.withColumn("_inside", own)
    return inside.join(before, "_wide", "left").select(
        "_range", (F.col("_inside") + F.col("_before")).alias("_offset")
    )


def running_total(df: DataFrame, row_id: str, value: str, width: int = 1 << 16) -> DataFrame:
    """Adds ``before``, the sum of ``value`` over all rows with a smaller id.

    Ids are unique integers. Ranges of ``width`` ids are summed first, then ranges of ``RANGES``
    such ranges, and so on for a fixed number of levels that covers 64-bit ids. A window inside the
    next wider range gives each range its offset, so no window has more than ``width`` rows or
    ``RANGES`` sums, however sparse the ids are. The rows have one exchange, by range.
    """
    ranged = df.withColumn("_range", F.expr(f"`{row_id}` div {width}")).repartition("_range")
    # Ordered by first id, so that all uses of the exchange read the same columns.
    sums = ranged.groupBy("_range").agg(F.sum(value).alias("_sum"), F.min(row_id).alias("_first"))
    offsets = _offsets(sums, LEVELS)
    inside = Window.partitionBy("_range").orderBy(row_id).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # Every range has its offset; an inner join would only add a null check that spoils the reuse.
    totals = ranged.join(offsets, "_range", "left").withColumn(
        "before", F.col("_offset") + F.sum(value).over(inside) - F.col(value)
    )
    return totals.drop("_range", "_offset")


def pack_sequences(
    df: DataFrame, row_id: str, n_tokens: str, block_size: int, width: int = 1 << 16
) -> DataFrame:
    """Lay all examples end to end and cut the line into blocks of ``block_size`` tokens.

    One row per piece: ``(row_id, block, block_offset, token_from, n)`` says that ``n`` tokens of
    the example, from ``token_from`` on, stand at ``block_offset`` of the block.
    """
    sized = df.select(row_id, F.col(n_tokens).cast("bigint").alias("_n"))
    placed = running_total(sized, row_id, "_n", width).where("_n > 0")
    end = F.col("before") + F.col("_n")
    first = F.expr(f"before div {block_size}")
    last = F.expr(f"(before + _n - 1) div {block_size}")
    pieces = placed.select("*", F.explode(F.sequence(first, last)).alias("block"))
    start_of = F.greatest(F.col("before"), F.col("block") * block_size)
    end_of = F.least(end, (F.col("block") + 1) * block_size)
    return pieces.select(
        row_id,
        "block",
        (start_of - F.col("block") * block_size).alias("block_offset"),
        (start_of - F.col("before")).alias("token_from"),
        (end_of - start_of).alias("n"),
    )


class Allotment(NamedTuple):
    """Examples of one length, ``first_rank`` to before ``end_rank``, in consecutive blocks:
    ``per_block`` in each from ``first_block`` on, the first of them at ``offset``."""

    length: int
    first_rank: int
    end_rank: int
    first_block: int
    per_block: int
    offset: int


def best_fit_plan(counts: Mapping[int, int], block_size: int) -> list[Allotment]:
    """Best-fit decreasing, worked out on how many examples each length has.

    Long examples come first; each goes to the block with the least room that is enough, and a new
    block is opened if there is none. Blocks that hold the same lengths are one entry with a count, so
    the work depends on the number of different lengths, ``block_size`` at most, and not on how many
    examples there are.
    """
    # Room left -> groups of equal blocks: (number of blocks, their content as (length, per block)).
    groups: dict[int, list[tuple[int, tuple[tuple[int, int], ...]]]] = {}
    rooms: list[int] = []

    def put(room: int, blocks: int, content: tuple[tuple[int, int], ...]) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((blocks, content))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        if not 0 < length <= block_size:
            raise ValueError(f"examples of 1 to {block_size} tokens can be packed: {length}")
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fits = block_size // length
                blocks, rest = divmod(left, fits)
                if blocks:
                    put(block_size - fits * length, blocks, ((length, fits),))
                if rest:
                    put(block_size - rest * length, 1, ((length, rest),))
                break
            room = rooms[at]
            blocks, content = groups[room].pop()
            taken = min(blocks, left)
            if taken < blocks:
                groups[room].append((blocks - taken, content))
            if not groups[room]:
                del groups[room], rooms[at]
            # The room that is left may still be the least that is enough.
            put(room - length, taken, (*content, (length, 1)))
            left -= taken
    plan, block = [], 0
    ranks = dict.fromkeys(counts, 0)
    for room in rooms:
        for blocks, content in groups[room]:
            offset = 0
            for length, per_block in content:
                end = ranks[length] + blocks * per_block
                plan.append(Allotment(length, ranks[length], end, block, per_block, offset))
                ranks[length] = end
                offset += per_block * length
            block += blocks
    return plan


#: Examples of one length that are ranked together.
RANKED_TOGETHER = 1 << 16


def pack_whole(df: DataFrame, row_id: str, n_tokens: str, block_size: int) -> DataFrame:
    """``(row_id, n_tokens, block, block_offset)``: blocks of ``block_size`` tokens that hold whole
    examples, none of them cut.

    The counts per length, ``block_size`` of them at most, go to the driver, which plans the blocks by
    best-fit decreasing. An example finds its place by its rank among those of its length, which
    comes from counts per bucket of ids, so no task ranks more than about ``RANKED_TOGETHER`` examples
    even if all have one length. Ids identify examples; rows that share one get a place each. Examples
    without tokens, or with more than a block holds, have no block (null).
    """
    sized = df.select(row_id, F.col(n_tokens).cast("bigint").alias("n_tokens"))
    fits = F.col("n_tokens").between(1, block_size)
    counted = sized.where(fits).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r.n_tokens: r.n for r in counted}
    spark = df.sparkSession
    # Both tables have a row per length, or a few: their size is bounded by that of a block.
    widths = [(n, -(-count // RANKED_TOGETHER)) for n, count in counts.items()]
    width = spark.createDataFrame(widths, "n_tokens bigint, _width bigint")
    plan = spark.createDataFrame(
        best_fit_plan(counts, block_size),
        "_length bigint, _first bigint, _end bigint, _block bigint, _per_block bigint, _offset bigint",
    )
    dealt = sized.join(F.broadcast(width), "n_tokens", "left").withColumn(
        "_bucket", F.pmod(F.xxhash64(row_id), F.col("_width"))
    )
    dealt = dealt.where("_width IS NOT NULL")
    buckets = dealt.groupBy("n_tokens", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    by_length = Window.partitionBy("n_tokens").orderBy("_bucket")
    before = buckets.select(
        "n_tokens", "_bucket", (F.sum("_n").over(by_length) - F.col("_n")).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy("n_tokens", "_bucket").orderBy(row_id)) - 1
    ranked = dealt.withColumn("_inside", inside).join(before, ["n_tokens", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_inside"))
    placed = ranked.join(
        F.broadcast(plan),
        (F.col("n_tokens") == F.col("_length"))
        & (F.col("_rank") >= F.col("_first"))
        & (F.col("_rank") < F.col("_end")),
    )
    nth = F.col("_rank") - F.col("_first")
    packed = placed.select(
        row_id,
        "n_tokens",
        (F.col("_block") + F.floor(nth / F.col("_per_block"))).alias("block"),
        (F.col("_offset") + nth % F.col("_per_block") * F.col("n_tokens")).alias("block_offset"),
    )
    nowhere = F.lit(None).cast("bigint")
    others = sized.where(~F.coalesce(fits, F.lit(False)))
    return packed.unionByName(
        others.select(row_id, "n_tokens", nowhere.alias("block"), nowhere.alias("block_offset"))
    )


def packing_fill(packed: DataFrame, block_size: int) -> DataFrame:
    """``(n_blocks, n_packed, n_left_out, n_tokens, fill)``: how well blocks are filled."""
    packed_tokens = F.coalesce(F.sum(F.when(F.col("block").isNotNull(), F.col("n_tokens"))), F.lit(0))
    blocks = F.coalesce(F.max("block") + 1, F.lit(0))
    return packed.agg(
        blocks.alias("n_blocks"),
        F.count("block").alias("n_packed"),
        F.count_if(F.col("block").isNull()).alias("n_left_out"),
        packed_tokens.alias("n_tokens"),
        F.try_divide(packed_tokens, blocks * block_size).alias("fill"),
    )


def length_batches(
    df: DataFrame,
    row_id: str,
    length: str,
    token_budget: int,
    mega_batch: int = 1024,
    seed: int = 42,
) -> DataFrame:
    """``(row_id, length, mega, batch, place)``: batches of examples of like length.

    A seeded permutation of the examples is cut into mega-batches of ``mega_batch`` examples. Each is
    sorted by length, long ones first, and cut into batches so that a batch, padded to its longest
    example, has at most ``token_budget`` tokens; an example larger than that is a batch of its own.
    So batches have little padding, and are random otherwise. ``batch`` counts all batches from 0,
    ``place`` the examples of a batch. Ids are unique; a null length counts as 0.

    Reruns agree, since the permutation is an order of hashes. Its ranks come from counts per prefix
    of the hash, and batches are cut inside a mega-batch, so no task sees more rows than a prefix or a
    mega-batch has.
    """
    sized = df.select(row_id, F.coalesce(F.col(length).cast("bigint"), F.lit(0)).alias("length"))
    ranked = hash_rank(sized, [row_id], seed).withColumn("mega", F.expr(f"rank div {mega_batch}"))
    member = F.struct((-F.col("length")).alias("order"), row_id, "length")
    megas = ranked.groupBy("mega").agg(F.array_sort(F.collect_list(member)).alias("members"))

    # Where batches begin: a batch that begins with its longest example has room for a known number.
    state = "struct<left bigint, at int, starts array<int>>"
    none = F.struct(
        F.lit(0).cast("bigint").alias("left"), F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")
    )

    def step(walk, member):
        room = F.greatest(F.floor(F.lit(token_budget) / F.greatest(member["length"], F.lit(1))), F.lit(1))
        begin = F.struct(
            (room - 1).alias("left"),
            (walk["at"] + 1).alias("at"),
            F.concat(walk["starts"], F.array(walk["at"])).alias("starts"),
        ).cast(state)
        go_on = F.struct(
            (walk["left"] - 1).alias("left"), (walk["at"] + 1).alias("at"), walk["starts"].alias("starts")
        ).cast(state)
        return F.when(walk["left"] == 0, begin).otherwise(go_on)

    cut = megas.withColumn("starts", F.aggregate("members", none.cast(state), step)["starts"])
    numbers = running_total(cut.select("mega", F.size("starts").cast("bigint").alias("_batches")), "mega", "_batches")
    numbered = cut.join(numbers.select("mega", "before"), "mega")
    rows = numbered.select("mega", "before", "starts", F.posexplode("members").alias("_at", "_m"))
    begun = F.filter("starts", lambda s: s <= F.col("_at"))
    return rows.select(
        F.col(f"_m.{row_id}").alias(row_id),
        F.col("_m.length").alias("length"),
        "mega",
        (F.col("before") + F.size(begun) - 1).alias("batch"),
        (F.col("_at") - F.array_max(begun)).alias("place"),
    )


def padding_share(batches: DataFrame) -> DataFrame:
    """``(n_batches, n_tokens, n_padded, padding)``: tokens, tokens of padded batches, and the share
    of the latter that is padding."""
    sums = batches.groupBy("batch").agg(
        F.sum("length").alias("own"), (F.max("length") * F.count(F.lit(1))).alias("padded")
    )
    return sums.agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.sum("own").alias("n_tokens"),
        F.sum("padded").alias("n_padded"),
        (1 - F.try_divide(F.sum("own"), F.sum("padded"))).alias("padding"),
    )


def length_buckets(df: DataFrame, length: str, width: int) -> DataFrame:
    """How many examples fall into each range of ``width`` lengths."""
    bucket = F.expr(f"`{length}` div {width}").alias("bucket")
    return df.groupBy(bucket).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(length).alias("min_length"),
        F.max(length).alias("max_length"),
    )
