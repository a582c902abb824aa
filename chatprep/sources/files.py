"""Files of records as DataFrames and back.

Paths go through Hadoop file systems, so any store the cluster knows works. Readers take a schema
where the format is known; without one Spark infers it in a pass over the files.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from chatprep.functions.chat import alpaca_to_chat, qa_to_chat
from chatprep.functions.text import WHITESPACE
from chatprep.operators.runs import RUN_ID
from chatprep.schema import ALPACA, CHAT
from chatprep.sources import store
from chatprep.sources.pieces import csv_records, json_elements, read_pieces
from chatprep.sources.scratch import scratch_path

# Cells that common CSV tools take as missing.
NA_VALUES = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """One JSON object per line; a line that is not JSON is an error. Blank lines are no records and
    are skipped, as Spark's reader does; ``validate_chat`` reports them."""
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The raw lines, for validation."""
    return spark.read.text(path)


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def _in_pieces(spark: SparkSession, path: str, pieces: bool | None) -> bool:
    """Whether to cut files that Spark would read whole: if asked to, or if one of them is larger than
    what a task reads at most. Only the files' sizes are looked up."""
    if pieces is not None:
        return pieces
    number, unit = re.fullmatch(
        r"(\d+)\s*([a-z]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()
    ).groups()
    sizes = spark.read.format("binaryFile").load(path).agg(F.max("length").alias("size"))
    return (sizes.first().size or 0) > int(number) * _UNITS[unit]


def _struct(spark: SparkSession, schema: StructType | str) -> StructType:
    return spark.createDataFrame([], schema).schema


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    multi_line: bool = True,
    na_values: Sequence[str] = NA_VALUES,
    pieces: bool | None = None,
) -> DataFrame:
    """CSV with a header line; all columns are text unless a schema is given, and cells that read
    like a missing value are null.

    Cells may hold line breaks. Spark reads each such file in one task; files larger than a task
    should read are cut into pieces instead (see ``sources.pieces``, which also says how quotes must
    be written). ``pieces`` asks for one way or the other. Files whose cells hold no line breaks
    need neither with ``multi_line=False``."""
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    df = (reader.schema(schema) if schema else reader).csv(path)
    if multi_line and _in_pieces(spark, path, pieces):
        records = csv_records(spark, path).where("NOT is_first AND value <> ''")
        cells = F.from_csv("value", df.schema.toDDL(), {"escape": '"'})
        df = records.select(F.inline(F.array(cells)))
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    present = {c: F.when(~F.col(f"`{c}`").isin(*na_values), F.col(f"`{c}`")) for c in texts}
    return df.withColumns(present) if na_values and texts else df


def _first_characters(spark: SparkSession, path: str) -> set[str]:
    """The first non-blank characters of the files.

    Files are read up to commas, of which there is none before that character, so that a file of one
    line is not held whole. Only a character and its place leave the scan, and one row per file is
    kept.
    """
    start = F.ltrim("value", F.lit(WHITESPACE + "\ufeff"))
    found = read_pieces(spark, path, ",").withColumn("c", F.substring(start, 1, 1)).where("c <> ''")
    # A block of a file is read by one task, piece after piece.
    first = found.groupBy("file").agg(F.min_by("c", F.struct("block", "id")).alias("c"))
    return {r.c for r in first.select("c").distinct().collect()}


def _read_json_elements(spark: SparkSession, path: str, schema: StructType | str | None) -> DataFrame:
    elements = json_elements(spark, path)
    if schema:
        schema = _struct(spark, schema)
        record = F.from_json("value", schema, {"mode": "FAILFAST"})
        return elements.select(F.inline(F.array(record)))
    # Spark infers a schema from files; line breaks stand between values only, where blanks do too.
    lines = scratch_path(spark, "elements")
    elements.select(F.regexp_replace("value", r"[\r\n]", " ").alias("value")).write.text(lines)
    return read_jsonl(spark, lines)


def read_json(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    pieces: bool | None = None,
) -> DataFrame:
    """Files that hold one JSON value each: an array of objects, or an object of equally long
    arrays, one per column. All files of a path must have one form.

    Arrays in files larger than a task should read are cut into pieces; ``pieces`` asks for one way or
    the other. An object of columns has the values of a row far apart, and is read by one task.
    """
    return _read_json(spark, path, schema, pieces, _first_characters(spark, path))


def _read_json(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None,
    pieces: bool | None,
    forms: set[str],
) -> DataFrame:
    if not forms or not forms <= {"[", "{"}:
        raise ValueError(f"neither an array of records nor an object of columns: {path}")
    if len(forms) > 1:
        raise ValueError(f"some files hold records, others columns: {path}")
    if forms == {"["} and _in_pieces(spark, path, pieces):
        return _read_json_elements(spark, path, schema)
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    df = (reader.schema(schema) if schema else reader).json(path)
    return columns_to_rows(df) if forms == {"{"} else df


def columns_to_rows(df: DataFrame) -> DataFrame:
    """Rows out of records whose fields are equally long arrays."""
    arrays = [F.col(f"`{c}`") for c in df.columns]
    same = [F.size(a) == F.size(arrays[0]) for a in arrays]
    checked = F.when(
        F.array_min(F.array(*same)), F.arrays_zip(*arrays)
    ).otherwise(F.raise_error(F.lit("columns of different lengths")))
    return df.select(F.inline(checked)).toDF(*df.columns)


def read_json_array(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    pieces: bool | None = None,
) -> DataFrame:
    """Files that hold an array of objects each; any other value is an error."""
    forms = _first_characters(spark, path)
    if forms != {"["}:
        raise ValueError(f"not an array of records: {path}")
    return _read_json(spark, path, schema, pieces, forms)


def load_data(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Choose the reader by suffix. With a schema (``chatprep.schema`` has those of the known
    formats) JSON is read once; without one Spark reads it a first time to infer it."""
    readers = {".jsonl": read_jsonl, ".csv": read_csv, ".json": read_json}
    suffix = PurePosixPath(path).suffix
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
    if suffix not in readers:
        raise ValueError(f"no reader for '{suffix}' files")
    return readers[suffix](spark, path, schema)


def load_named_dataset(
    spark: SparkSession, mirrors: Mapping[str, str], name: str, split: str | None = None
) -> DataFrame:
    """A published data set by name, from the folder it is mirrored in; splits are subfolders."""
    if name not in mirrors:
        raise ValueError(f"unknown data set: {name}")
    path = f"{mirrors[name]}/{split}" if split else mirrors[name]
    return spark.read.parquet(path)


# ---- writers -----------------------------------------------------------------------------------


def write_jsonl(df: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON object per line, nulls included; a folder of part files."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def json_to_jsonl(
    spark: SparkSession, json_path: str, output_path: str, schema: StructType | None = None
) -> None:
    write_jsonl(read_json_array(spark, json_path, schema), output_path)


def csv_to_jsonl(
    spark: SparkSession,
    csv_path: str,
    output_path: str,
    user_column: str = "user_prompt",
    assistant_column: str = "agent_reply",
    **options,
) -> None:
    df = read_csv(spark, csv_path)
    chat = qa_to_chat(F.col(user_column), F.col(assistant_column), **options)
    write_jsonl(df.select(chat.alias("messages")), output_path)


def alpaca_to_jsonl(spark: SparkSession, input_path: str, output_path: str, **options) -> None:
    if PurePosixPath(input_path).suffix not in (".json", ".jsonl"):
        raise ValueError(f"instruction records come as .json or .jsonl: {input_path}")
    df = load_data(spark, input_path, ALPACA)
    chat = alpaca_to_chat(F.col("instruction"), F.col("input"), F.col("output"), **options)
    write_jsonl(df.select(chat.alias("messages")), output_path)


def write_split(split: DataFrame, train_path: str, val_path: str) -> None:
    """The two parts of a split data set as JSON lines.

    The split, which costs several scans, is worked out once and stored; the parts are written from
    there."""
    stored = scratch_path(split.sparkSession, "split")
    split.write.partitionBy("split").parquet(stored)
    parts = split.sparkSession.read.schema(split.schema).parquet(stored)
    for name, path in (("train", train_path), ("validation", val_path)):
        write_jsonl(parts.where(F.col("split") == name).drop("split"), path)


def write_eval_report(
    details: DataFrame, metrics: DataFrame, path: str, run_id: str, model: str, dataset: str
) -> None:
    """Details as Parquet and metrics as one JSON line, both below ``run_id=...``."""
    details.write.mode("overwrite").parquet(f"{path}/details/run_id={run_id}")
    labelled = metrics.select(
        F.lit(model).alias("model_path"),
        F.lit(dataset).alias("evaluation_dataset"),
        F.current_timestamp().alias("timestamp"),
        *metrics.columns,
    )
    labelled.write.mode("overwrite").option("ignoreNullFields", False).json(
        f"{path}/metrics/run_id={run_id}"
    )


def read_eval_report(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(details, metrics)`` of all runs stored below ``path``."""
    return spark.read.parquet(f"{path}/details"), spark.read.json(f"{path}/metrics")


#: Folders that a table of runs is spread over by a hash of its key.
BUCKETS = 64


def replace_rows(rows: DataFrame, path: str, key: Sequence[str], buckets: int = BUCKETS) -> None:
    """Write rows to a table, in place of those it has with the same ``key``.

    A job that is run again leaves one copy, and several rows of one key are replaced together. Rows
    are kept in folders by a hash of their key; only folders with new rows are read and written. What
    they will hold is stored first, so a run that fails in between can be repeated. Runs that write
    to one table go one after the other.
    """
    spark = rows.sparkSession
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
    merged = new = rows.withColumn("_bucket", bucket)
    if store.exists(spark, path):
        # At most ``buckets`` numbers.
        touched = [r[0] for r in new.select("_bucket").distinct().collect()]
        old = spark.read.parquet(path).where(F.col("_bucket").isin(touched))
        keys = new.select(*[F.col(c).alias(f"_new_{c}") for c in key]).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in key]
        kept = old.join(keys, reduce(Column.__and__, same), "left_anti")
        merged = new.unionByName(kept, allowMissingColumns=True)
    staged = scratch_path(spark, "replaced")
    merged.write.parquet(staged)
    whole = spark.read.schema(merged.schema).parquet(staged).repartition("_bucket")
    writer = whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("_bucket").parquet(path)


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``replace_rows`` wrote."""
    return spark.read.option("mergeSchema", True).parquet(path).drop("_bucket")


def append_notes(notes: DataFrame, path: str, key: Sequence[str] = (*RUN_ID, "key")) -> None:
    """Put notes of runs, rows ``(*run, key, text)``, into the notes table; those of the same run and
    key are replaced."""
    replace_rows(notes, path, key)


def write_run_stats(stats: DataFrame, path: str, run: Sequence[str] = RUN_ID) -> None:
    """Put the rows of finished runs, configuration and statistics, into the runs table; a run that
    is written again replaces itself."""
    replace_rows(stats, path, run)


def read_chat(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, CHAT)
