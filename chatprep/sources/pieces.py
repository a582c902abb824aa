"""Large text files read by many tasks: numbered lines, and records that span lines and blocks.

Spark cuts a large file into blocks and each block into pieces at a separator. A record may consist of
several pieces, and may go on in the next block. Here a first scan sums up each block (a few numbers),
prefix sums over the blocks of a file tell in which state each block begins, and so which of its first
pieces belong to a record of an earlier block. These pieces are sent there; no record is cut and no
file is read by one task. Of CSV only records that lie in several blocks are exchanged, of JSON all
pieces, once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatprep.sources.scratch import scratch_path

_BLOCK = ["file", "block"]


def read_pieces(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """``(file, block, id, value)``: the pieces between the separators (line breaks without one).

    ``block`` is the byte at which the block begins, ``id`` grows from piece to piece in it.
    """
    reader = spark.read.option("lineSep", separator) if separator else spark.read
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )


def _blocks(pieces: DataFrame, *sums: Column) -> DataFrame:
    """One row per block: its first id, its number of pieces, and ``sums``."""
    return pieces.groupBy(*_BLOCK).agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n"), *sums
    )


def _earlier_blocks() -> Window:
    return Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def _in_blocks(pieces: DataFrame, blocks: DataFrame) -> DataFrame:
    """The pieces with what is known of their blocks.

    There are few blocks, so every task gets them all and the pieces stay where they are read. Pieces
    and blocks come from two scans. If Spark cut the files differently in them (because the
    number of cores changed in between), ids do not fit, and the job fails instead of mixing them up.
    """
    joined = pieces.join(F.broadcast(blocks), _BLOCK, "left")
    fits = F.col("id").between(F.col("first"), F.col("first") + F.col("n") - 1)
    problem = F.raise_error(F.lit("two scans cut the files differently: run the job again"))
    return joined.withColumn(
        "id", F.when(F.coalesce(fits, F.lit(False)), F.col("id")).otherwise(problem.cast("long"))
    )


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line, value)``: all lines of the files with their number in the file, from 1.

    Lines stay where they are read: what is added is the number of lines in the file's earlier blocks,
    one row per block.
    """
    pieces = read_pieces(spark, path)
    before = F.coalesce(F.sum("n").over(_earlier_blocks()), F.lit(0))
    placed = _in_blocks(pieces, _blocks(pieces).withColumn("before", before))
    line = F.col("before") + F.col("id") - F.col("first") + 1
    return placed.select("file", line.alias("line"), "value")


def _homes(blocks: DataFrame) -> DataFrame:
    """Adds ``earlier``, the block to which a block's first pieces, up to ``head_end``, belong: the
    nearest one before it that has pieces of its own."""
    own = F.when(F.col("head_end") < F.col("first") + F.col("n") - 1, F.col("block"))
    return blocks.withColumn("earlier", F.last(own, ignorenulls=True).over(_earlier_blocks()))


def _at_home(pieces: DataFrame, blocks: DataFrame) -> DataFrame:
    """The pieces with ``home``, the block in which their record begins, and their blocks' columns."""
    home = F.when(F.col("id") <= F.col("head_end"), F.col("earlier")).otherwise(F.col("block"))
    return _in_blocks(pieces, _homes(blocks)).withColumn("home", home)


def _up_to_here() -> Window:
    """The pieces of a home block in order, up to the current one."""
    return (
        Window.partitionBy("file", "home")
        .orderBy("block", "id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _before(value: str | Column) -> Column:
    """Sum over the pieces of a home block before the current one."""
    earlier = (
        Window.partitionBy("file", "home")
        .orderBy("block", "id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(value).over(earlier), F.lit(0))


def _joined(separator: str) -> Column:
    """The pieces of a group in order, as one text."""
    pieces = F.array_sort(F.collect_list(F.struct("block", "id", "value")))
    return F.array_join(pieces["value"], separator)


def _number_of(sign: str, text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


# ---- CSV ---------------------------------------------------------------------------------------


def _closed_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive lines of whole records as those records: each ends with the line that makes its
    quotes even in number."""
    held: list[str] = []
    begun: tuple = ()
    for batch in batches:
        quotes = batch.column("quotes").to_numpy()
        ends = np.flatnonzero((np.cumsum(quotes) + bool(held)) % 2 == 0) + 1
        done = int(ends[-1]) if len(ends) else 0
        if done:
            starts = np.concatenate([[0], ends[:-1]])
            offsets = pa.array(np.append(starts, done), pa.int32())
            values = pc.binary_join(pa.ListArray.from_arrays(offsets, batch.column("value")), "\n").to_pylist()
            firsts = batch.select(["file", "is_first"]).take(pa.array(starts))
            files, is_first = firsts.column("file").to_pylist(), firsts.column("is_first").to_pylist()
            if held:
                files[0], is_first[0] = begun
                values[0] = "\n".join([*held, values[0]])
                held = []
            yield pa.RecordBatch.from_pydict({"file": files, "is_first": is_first, "value": values})
        if done < batch.num_rows:
            if not held:
                begun = tuple(batch.column(c)[done].as_py() for c in ("file", "is_first"))
            held += batch.column("value").slice(done).to_pylist()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, is_first, value)``: the records of CSV files, line breaks in quoted cells included.

    A line begins a record exactly if the quotes before it, in the whole file, are even in number.
    Quotes inside a cell are doubled, and cells that hold quotes are quoted, as RFC 4180 has it.

    Records inside a block are put together where they are read. At most two records of a block lie
    in other blocks too; only their lines are exchanged.
    """
    lines = read_pieces(spark, path, "\n").withColumn("quotes", _number_of('"', F.col("value")) % 2)
    odd = F.when(F.col("quotes") == 1, F.col("id"))
    blocks = _blocks(
        lines,
        F.sum("quotes").alias("all_quotes"),
        # The line that leaves the quoted cell in which the block begins, if it begins in one, and the
        # line that enters the one in which it ends.
        F.min(odd).alias("turn"),
        F.max(odd).alias("last_turn"),
    )
    before = F.coalesce(F.sum("all_quotes").over(_earlier_blocks()), F.lit(0))
    last = F.col("first") + F.col("n") - 1
    head_end = F.when(before % 2 == 1, F.coalesce("turn", last)).otherwise(F.col("first") - 1)
    open_end = (before + F.col("all_quotes")) % 2 == 1
    tail = F.when(open_end, F.coalesce("last_turn", last + 1)).otherwise(last + 1)
    homed = _at_home(lines, blocks.withColumns({"head_end": head_end, "tail": tail})).withColumn(
        "is_first", (F.col("block") == 0) & (F.col("id") == F.col("first"))
    )
    crosses = (F.col("id") <= F.col("head_end")) | (F.col("id") >= F.col("tail"))
    schema = "file string, is_first boolean, value string"
    closed = homed.where(~crosses).select("file", "is_first", "quotes", "value")
    # The lines of a home block that others share are those of its last record.
    shared = homed.where(crosses).groupBy("file", "home").agg(
        F.max("is_first").alias("is_first"), _joined("\n").alias("value")
    )
    records = closed.mapInArrow(_closed_records, schema).unionByName(shared.drop("home"))
    # Lines may end with a carriage return too.
    return records.withColumn("value", F.regexp_replace("value", "\r\\z", ""))


# ---- JSON --------------------------------------------------------------------------------------

# A character after a backslash, and a string or the start of one, in JSON.
_ESCAPED = r"(?s)\\."
_STRING = r'"[^"]*(?:"|\z)'


def _depth(text: Column) -> Column:
    """By how much a piece that begins outside of strings goes deeper, without the brace behind it."""
    outside = F.regexp_replace(text, _STRING, "")
    return _number_of("{", outside) + _number_of("[", outside) - _number_of("]", outside)


def _walked(pieces: DataFrame, before: Column) -> DataFrame:
    """Adds ``delta``: how much deeper each piece and the brace behind it go, given the number of
    quotes ``before`` it. ``ends_outside`` tells that this brace is not part of a string."""
    inside = F.col("quotes_before") % 2
    after = (F.col("quotes_before") + F.col("quotes")) % 2
    return (
        pieces.withColumn("quotes_before", before)
        .withColumn("ends_outside", after == 0)
        .withColumn(
            "delta",
            F.when(inside == 0, F.col("from_outside")).otherwise(F.col("from_inside"))
            - F.when(after == 0, 1).otherwise(0),
        )
    )


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """``(file, value)``: the objects of JSON files that hold one array of objects each, as text.

    Files are cut at closing braces. Whether such a brace ends an element depends on two numbers that
    are carried from piece to piece: whether the piece begins inside a string, and how deep. Both add
    up over the pieces of a block, whatever the block begins with, so blocks are summed up on their
    own, by a scan that exchanges numbers only. Anything but an array of objects fails the job.
    """
    bare = F.regexp_replace("value", _ESCAPED, "")
    pieces = (
        read_pieces(spark, path, "}")
        .withColumn("bare", bare)
        .withColumn("quotes", _number_of('"', F.col("bare")))
        .withColumn("from_outside", _depth(F.col("bare")))
        .withColumn("from_inside", _depth(F.concat(F.lit('"'), F.col("bare"))))
        .drop("bare")
    )
    # Numbers only: each block is walked twice, as if it began outside and inside of a string.
    in_block = Window.partitionBy(*_BLOCK).orderBy("id")
    earlier = in_block.rowsBetween(Window.unboundedPreceding, -1)
    upto = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbers = pieces.drop("value").withColumn("own", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)))
    for start in (0, 1):
        numbers = (
            _walked(numbers, F.col("own") + start)
            .withColumn(f"depth_{start}", F.sum("delta").over(upto))
            .withColumn(f"outside_{start}", F.col("ends_outside"))
            .drop("quotes_before", "ends_outside", "delta")
        )
    # Few rows per block, one for each depth that it reaches, which two more steps need.
    reached = ["depth_0", "outside_0", "depth_1", "outside_1"]
    levels = numbers.groupBy(*_BLOCK, *reached).agg(
        F.min("id").alias("id"),
        F.max("id").alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.sum("quotes").alias("quotes"),
    )
    stored = scratch_path(spark, "levels")
    levels.write.parquet(stored)
    levels = spark.read.schema(levels.schema).parquet(stored)

    sums = levels.groupBy(*_BLOCK).agg(
        F.min("id").alias("first"),
        F.sum("n").alias("n"),
        F.sum("quotes").alias("quotes"),
        F.max(F.struct("last", "depth_0", "depth_1")).alias("last"),
    )
    sums = sums.withColumn("began", F.coalesce(F.sum("quotes").over(_earlier_blocks()), F.lit(0)) % 2)
    change = F.when(F.col("began") == 0, F.col("last.depth_0")).otherwise(F.col("last.depth_1"))
    sums = sums.withColumn("change", change).withColumn(
        "depth", F.coalesce(F.sum("change").over(_earlier_blocks()), F.lit(0))
    )
    # The end of the file counts as a brace, so the array's own bracket leads to -1.
    later = F.lead("block").over(Window.partitionBy("file").orderBy("block"))
    sound = later.isNotNull() | (
        (F.col("depth") + F.col("change") == -1) & ((F.col("began") + F.col("quotes")) % 2 == 0)
    )
    problem = F.raise_error(F.concat(F.lit("not an array of records: "), F.col("file")))
    sums = sums.withColumn("depth", F.when(sound, F.col("depth")).otherwise(problem.cast("long")))

    known = levels.drop("n", "quotes").join(sums.select(*_BLOCK, "began", "depth"), _BLOCK)
    outside = F.when(F.col("began") == 0, F.col("outside_0")).otherwise(F.col("outside_1"))
    level = F.col("depth") + F.when(F.col("began") == 0, F.col("depth_0")).otherwise(F.col("depth_1"))
    ends = known.groupBy(*_BLOCK).agg(F.min(F.when(outside & (level == 1), F.col("id"))).alias("turn"))
    blocks = sums.select(*_BLOCK, "first", "n", "depth").join(ends, _BLOCK)
    head_end = F.when(
        F.col("depth") > 1, F.coalesce("turn", F.col("first") + F.col("n") - 1)
    ).otherwise(F.col("first") - 1)
    homed = _at_home(pieces, blocks.withColumn("head_end", head_end)).drop(
        "first", "n", "depth", "turn", "head_end", "earlier"
    )

    # A home block begins between two elements, or with the file.
    depth = F.sum("delta").over(_up_to_here()) + F.when(F.col("home") == 0, 0).otherwise(1)
    walked = _walked(homed, _before("quotes"))
    closed = walked.withColumn("closes", (F.col("ends_outside") & (depth == 1)).cast("int"))
    numbered = closed.withColumn("element", _before("closes"))
    elements = numbered.groupBy("file", "home", "element").agg(
        _joined("}").alias("value"), F.max("closes").alias("closed")
    )
    first = (F.col("home") == 0) & (F.col("element") == 0)
    lead = F.when(first, r"^\x{feff}?\s*\[\s*").otherwise(r"^\s*,\s*")
    body = F.regexp_replace("value", lead, F.lit(""))
    right = F.regexp_like("value", lead) & body.startswith("{")
    checked = elements.select(
        "file",
        F.when(F.col("closed") == 1, F.when(right, F.concat(body, F.lit("}"))).otherwise(problem))
        .when(~F.regexp_like("value", F.when(first, r"^\x{feff}?\s*\[\s*\]\s*\z").otherwise(r"^\s*\]\s*\z")), problem)
        .alias("value"),
    )
    return checked.where("value IS NOT NULL")
