"""Contiguous shards of equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatprep.llm.common import stored, text_of

#: A group of equal texts on a cut goes to one side whole if it has at most this share of a shard.
GROUP_SHARE = 0.01


def balanced_shards(
    docs: DataFrame,
    shards: int = 8,
    id_column: str = "doc_id",
    text_column: str = "text",
    group_share: float = GROUP_SHARE,
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row per input row.

    ``size`` is the text's UTF-8 bytes plus 1 (a null text has none and counts as empty). Rows are
    put in one global order, by text hash, identifier and then a stored number of the row, so that
    equal texts are neighbours and many equal rows still fill several partitions; Spark's sampled range partitions hold it. Totals per partition give each partition's offset, a
    running sum inside it gives each row's place in the bytes of all rows, and the middle of the
    row decides between the equal targets. Law ``bytes``: sizes are near equal. A group of equal
    texts that lies on a cut stays together if it has at most ``group_share`` of a shard's bytes.
    ``slot`` counts the rows of a shard from 0; ``grown_shard`` belongs to another law and is null.

    Equal rows are placed one by one; a text larger than a shard's target can leave a neighbouring
    shard empty; an empty table gives no rows.
    """
    text = text_of(F.col(text_column))
    keyed = docs.select(
        F.col(id_column).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("digest"),
        F.monotonically_increasing_id().alias("line"),
    )
    order = ["text_crc32", "digest", F.asc_nulls_last("id"), "line"]
    ranged = stored(keyed, "shard-rows").repartitionByRange(*order)
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "shard-ranges")

    # One row per partition: its size is bounded by their number.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("part").agg(
        F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows")
    )
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("part_bytes")
        .over(earlier.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("bytes_before") + F.sum("size").over(running)
    middle = F.col("end") - F.col("size") / 2
    placed = stored(
        ranged.join(F.broadcast(offsets), "part")
        .withColumn("end", end)
        .withColumn("place", F.col("rows_before") + F.row_number().over(inside))
        .withColumn(
            "own", F.least(F.floor(middle * shards / F.col("all_bytes")), F.lit(shards - 1))
        )
        .select("id", "size", "text_crc32", "digest", "place", "own", "all_bytes"),
        "shard-places",
    )

    # At most one group lies on each cut.
    group = F.struct("text_crc32", "digest")
    edges = placed.groupBy("own").agg(F.min(group).alias("first"), F.max(group).alias("last"))
    cut = [r for r in edges.select("first.digest", F.col("last.digest").alias("end")).collect()]
    names = {bytes(d) for r in cut for d in r}
    groups = (
        placed.where(F.col("digest").isin([bytearray(n) for n in names]) if names else F.lit(False))
        .groupBy(F.col("digest").alias("cut_digest"))
        .agg(
            F.sum("size").alias("bytes"),
            F.min("own").alias("cut_shard"),
            F.max("own").alias("cut_end"),
            F.max("all_bytes").alias("total"),
        )
        .where("cut_shard < cut_end")
        .where(F.col("bytes") <= F.col("total") / shards * group_share)
        .select("cut_digest", "cut_shard")
    )
    sharded = placed.join(
        F.broadcast(groups), F.col("digest") == F.col("cut_digest"), "left"
    ).withColumn("shard", F.coalesce("cut_shard", "own").cast("int"))
    firsts = sharded.groupBy(F.col("shard").alias("in_shard")).agg(F.min("place").alias("first"))
    return sharded.join(F.broadcast(firsts), F.col("shard") == F.col("in_shard")).select(
        F.col("id").alias(id_column),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
