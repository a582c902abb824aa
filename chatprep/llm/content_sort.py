"""Exact dedup by content sort: equal texts become neighbours in one global order of their bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatprep.llm.common import SPACE, shuffle_partitions, stored, text_of

#: A text with more rows than this share of an even partition is spread over several cells.
CELL_SHARE = 0.25
#: Characters of a text that a splitter has.
HEAD = 32


def normalised(text: Column) -> Column:
    """The text without ASCII white space; two texts are equal if these are."""
    return F.regexp_replace(text_of(text), SPACE, "")


def _sorted_cells(docs: DataFrame, id_column: str, text_column: str, carry: bool) -> DataFrame:
    """Each row with what its text's group says: ``keep_id``, ``group_size`` and ``kept``.

    Splitters sampled by Spark range-partition the normalised bytes: their first ``HEAD`` characters
    and, among texts that share those, a hash, so that samples and splitters stay small whatever
    the texts' lengths. Each partition is sorted externally by all bytes, and the window compares
    every row's full bytes with its neighbour's. A text that
    has many rows would fill a partition: it is cut into cells by a hash of the row's number, each
    cell is sorted like a text of its own, and the cells' common result comes from a map-side
    aggregate. At most ``partitions / CELL_SHARE`` texts can be that frequent, which bounds what
    is broadcast.

    Texts are normalised and rows numbered once, in a stored table: a number is unique and does not
    change when a task is repeated, so rows that share an identifier, or have none, are spread too.
    """
    spark = docs.sparkSession
    limit_share = CELL_SHARE / shuffle_partitions(spark)
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    rows = docs.select(
        F.col(id_column).alias("id"),
        normalised(F.col(text_column)).alias("norm"),
        F.length(text_of(F.col(text_column))).alias("points"),
        F.monotonically_increasing_id().alias("line"),
        *row,
    )
    rows = stored(rows.withColumn("hash", F.xxhash64("norm")), "exact-rows")

    limit = max(1, int(rows.count() * limit_share))
    frequent = (
        rows.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > limit)
        .select("hash", F.ceil(F.col("n") / limit).alias("cells"))
    )
    frequent = F.broadcast(stored(frequent, "exact-frequent"))

    best = F.struct((-F.col("points")).alias("less"), F.col("id").isNull().alias("none"), "id", "line")
    digest = F.sha2("norm", 256)
    groups = (
        rows.drop("row")
        .join(frequent, "hash")
        .groupBy(digest.alias("text_sha256"))
        .agg(F.min(best).alias("winner"), F.count(F.lit(1)).alias("total"))
    )

    cell = F.when(F.col("cells").isNull(), 0).otherwise(F.pmod(F.xxhash64("line"), F.col("cells")))
    within = Window.partitionBy("head", "hash", "cell", "norm")
    order = within.orderBy(F.desc("points"), F.asc_nulls_last("id"), "line")
    cells = (
        rows.join(frequent, "hash", "left")
        .withColumn("cell", cell)
        .withColumn("head", F.substring("norm", 1, HEAD))
        .repartitionByRange("head", "hash", "cell")
        .select(
            "*",
            F.row_number().over(order).alias("place"),
            F.first("id").over(order).alias("first_id"),
            F.count(F.lit(1)).over(within).alias("cell_size"),
        )
        .withColumn("text_sha256", digest)
        .drop("norm", "head", "hash")
    )
    merged = cells.join(F.broadcast(groups), "text_sha256", "left")
    spread = F.col("winner").isNotNull()
    first = F.col("place") == 1
    return merged.select(
        "id",
        F.when(spread, F.col("winner.id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.coalesce("total", "cell_size").alias("group_size"),
        F.when(spread, F.col("line") == F.col("winner.line")).otherwise(first).alias("kept"),
        "text_sha256",
        *(["row"] if carry else []),
    )


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per input row.

    Texts are equal if they are identical without ASCII white space; null counts as empty. Of equal
    texts the row with most code points stays, then the smallest identifier (a null one comes
    last); of rows that agree in all of that, exactly one is ``kept``. ``text_sha256`` is of the
    normalised text. An empty table gives no rows; other columns are not read.
    """
    return _sorted_cells(docs, id_column, text_column, carry=False).withColumnRenamed("id", id_column)


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that ``exact_dedup`` keeps, with all their columns."""
    return _sorted_cells(docs, id_column, text_column, carry=True).where("kept").select("row.*")
