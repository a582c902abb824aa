"""Queries: readers and writers, each as a round trip of a whole table through files."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatprep.functions import chat as ch
from chatprep.functions.text import strip
from chatprep.operators import evaluate as ev
from chatprep.operators import sample
from chatprep.plans import evaluation, inputs, sql
from chatprep.plans.registry import query
from chatprep.schema import MESSAGES
from chatprep.sources import files
from chatprep.sources.scratch import scratch_path

_RENDERED = f"WITH {sql.CHAT} SELECT doc_id, {sql.render('messages')} AS text FROM chat"
_CHAT_ROW = f"doc_id bigint, messages {MESSAGES.simpleString()}"


def _cell(column):
    return F.nullif(F.col(column), F.lit(""))


def _rendered(df):
    return df.select("doc_id", ch.render_chat(F.col("messages")).alias("text"))


@query("read_jsonl", _RENDERED)
def read_jsonl(spark, sf_dir):
    path = scratch_path(spark, "chat") + ".jsonl"
    files.write_jsonl(inputs.chat(spark, sf_dir), path)
    return _rendered(files.read_jsonl(spark, path, _CHAT_ROW))


@query(
    "write_jsonl",
    f"WITH {sql.CHAT} SELECT {sql.as_json('{doc_id: doc_id, messages: messages}')} AS value "
    "FROM chat",
)
def write_jsonl(spark, sf_dir):
    path = scratch_path(spark, "chat") + ".jsonl"
    files.write_jsonl(inputs.chat(spark, sf_dir), path)
    return files.read_lines(spark, path)


@query(
    "read_csv",
    f"""WITH {sql.ALPACA} SELECT doc_id::VARCHAR AS doc_id, instruction,
  nullif(input, '') AS input, nullif(output, '') AS output FROM alpaca""",
)
def read_csv(spark, sf_dir):
    """Cells hold quotes, commas and line breaks."""
    path = scratch_path(spark, "alpaca") + ".csv"
    rows = inputs.alpaca(spark, sf_dir)
    rows.write.option("header", True).option("escape", '"').csv(path)
    return files.read_csv(spark, path)


@query(
    "read_csv_pieces",
    f"""WITH {sql.ALPACA} SELECT doc_id::VARCHAR AS doc_id, instruction,
  nullif(input, '') AS input, nullif(output, '') AS output FROM alpaca""",
)
def read_csv_pieces(spark, sf_dir):
    """The same files, cut into pieces whatever their size."""
    path = scratch_path(spark, "alpaca") + ".csv"
    rows = inputs.alpaca(spark, sf_dir)
    rows.write.option("header", True).option("escape", '"').csv(path)
    return files.read_csv(spark, path, pieces=True)


#: Files of JSON values, one value each, at least; more if the texts have more bytes than fit.
JSON_FILES = 16
JSON_FILE_BYTES = 32 << 20


def _write_json_arrays(spark, sf_dir, path, as_columns):
    """Files of about ``JSON_FILE_BYTES`` of text: an array of documents, or their columns, in each.

    One value per file is what this format asks for, so a file is one row here, whose size must not
    grow with the table. Any document may go to any file, so they are dealt by the rows' numbers,
    evenly also where identifiers are null or repeated.
    """
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = max(JSON_FILES, -(-size // JSON_FILE_BYTES))
    dealt = docs.withColumn("row", F.monotonically_increasing_id()).withColumn(
        "part", F.pmod(F.xxhash64("row"), F.lit(number))
    )
    record = F.struct("doc_id", "lang", "text")
    grouped = dealt.repartition(number, "part").groupBy("part").agg(
        F.array_sort(F.collect_list(record)).alias("rows")
    )
    columns = F.struct(*[F.col(f"rows.{c}").alias(c) for c in ("doc_id", "lang", "text")])
    value = F.to_json(columns if as_columns else F.col("rows"))
    grouped.select("part", value.alias("value")).write.partitionBy("part").text(path)


_DOCS = "SELECT doc_id, lang, text FROM documents"


@query("read_json", _DOCS)
def read_json(spark, sf_dir):
    path = scratch_path(spark, "arrays") + ".json"
    _write_json_arrays(spark, sf_dir, path, as_columns=False)
    rows = files.read_json(spark, path, "doc_id bigint, lang string, text string")
    return rows.select("doc_id", "lang", "text")


@query("read_json_pieces", _DOCS)
def read_json_pieces(spark, sf_dir):
    """The same files, of one line each, cut into pieces whatever their size."""
    path = scratch_path(spark, "arrays") + ".json"
    _write_json_arrays(spark, sf_dir, path, as_columns=False)
    rows = files.read_json(spark, path, "doc_id bigint, lang string, text string", pieces=True)
    return rows.select("doc_id", "lang", "text")


@query("read_json_columns", _DOCS)
def read_json_columns(spark, sf_dir):
    path = scratch_path(spark, "columns") + ".json"
    _write_json_arrays(spark, sf_dir, path, as_columns=True)
    schema = "doc_id array<bigint>, lang array<string>, text array<string>"
    return files.read_json(spark, f"{path}/*", schema)


@query("json_to_jsonl", _DOCS)
def json_to_jsonl(spark, sf_dir):
    base = scratch_path(spark, "arrays")
    _write_json_arrays(spark, sf_dir, base + ".json", as_columns=False)
    schema = "doc_id bigint, lang string, text string"
    files.json_to_jsonl(spark, base + ".json", base + ".jsonl", schema)
    return files.read_jsonl(spark, base + ".jsonl", schema)


@query(
    "load_data",
    f"""WITH {sql.CHAT}, {sql.ALPACA}
SELECT 'chat' AS kind, doc_id, {sql.render("messages")} AS text FROM chat
UNION ALL SELECT 'table', doc_id, instruction FROM alpaca
UNION ALL SELECT 'arrays', doc_id, text FROM documents""",
)
def load_data(spark, sf_dir):
    base = scratch_path(spark, "mixed")
    files.write_jsonl(inputs.chat(spark, sf_dir), f"{base}/chat.jsonl")
    rows = inputs.alpaca(spark, sf_dir)
    rows.write.option("header", True).option("escape", '"').csv(f"{base}/table.csv")
    _write_json_arrays(spark, sf_dir, f"{base}/arrays.json", as_columns=False)
    chat = _rendered(files.load_data(spark, f"{base}/chat.jsonl", _CHAT_ROW))
    table = files.load_data(spark, f"{base}/table.csv").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("instruction").alias("text")
    )
    schema = "doc_id bigint, lang string, text string"
    arrays = files.load_data(spark, f"{base}/arrays.json", schema).select("doc_id", "text")
    kinds = {"chat": chat, "table": table, "arrays": arrays}
    parts = [df.select(F.lit(kind).alias("kind"), "doc_id", "text") for kind, df in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "write_split",
    """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5(doc_id::VARCHAR || ':42'), doc_id)
    <= floor(count(*) OVER () * (1::DOUBLE - 0.15::DOUBLE))
  THEN 'train' ELSE 'validation' END AS split FROM documents""",
)
def write_split(spark, sf_dir):
    base = scratch_path(spark, "parts")
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", "text")
    split = sample.split_dataset(docs, ["doc_id"], val_ratio=0.15)
    paths = {"train": f"{base}/train.jsonl", "validation": f"{base}/validation.jsonl"}
    files.write_split(split, *paths.values())
    read = [
        files.read_jsonl(spark, path, "doc_id bigint, text string").select(
            "doc_id", F.lit(name).alias("split")
        )
        for name, path in paths.items()
    ]
    return read[0].unionByName(read[1])


@query(
    "csv_to_jsonl",
    f"""WITH {sql.ALPACA}
SELECT doc_id, {sql.strip("coalesce(nullif(instruction, ''), 'nan')")} AS said,
  {sql.strip("coalesce(nullif(output, ''), 'nan')")} AS answered FROM alpaca""",
)
def csv_to_jsonl(spark, sf_dir):
    """Questions carry their document's number in front, since a chat has no place for it."""
    base = scratch_path(spark, "qa")
    number = F.concat(F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit("\n"))
    rows = inputs.alpaca(spark, sf_dir).select(
        F.concat(number, F.coalesce(_cell("instruction"), F.lit("nan"))).alias("user_prompt"),
        _cell("output").alias("agent_reply"),
    )
    rows.write.option("header", True).option("escape", '"').csv(f"{base}/qa.csv")
    files.csv_to_jsonl(spark, f"{base}/qa.csv", f"{base}/qa.jsonl")
    said = F.get("messages", F.lit(1))["content"]
    return files.read_chat(spark, f"{base}/qa.jsonl").select(
        F.substring(said, 1, 12).cast("bigint").alias("doc_id"),
        strip(F.substr(said, F.lit(14))).alias("said"),
        F.get("messages", F.lit(2))["content"].alias("answered"),
    )


@query(
    "alpaca_to_jsonl",
    f"""WITH {sql.ALPACA} SELECT doc_id, coalesce(output, '') AS answered FROM alpaca""",
)
def alpaca_to_jsonl(spark, sf_dir):
    """As above, with the number in front of the instruction."""
    base = scratch_path(spark, "instructions")
    number = F.concat(F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit("\n"))
    rows = inputs.alpaca(spark, sf_dir).select(
        F.concat(number, F.coalesce("instruction", F.lit(""))).alias("instruction"),
        "input",
        "output",
    )
    files.write_jsonl(rows, f"{base}/in.jsonl")
    files.alpaca_to_jsonl(spark, f"{base}/in.jsonl", f"{base}/out.jsonl")
    said = F.get("messages", F.lit(1))["content"]
    return files.read_chat(spark, f"{base}/out.jsonl").select(
        F.substring(said, 1, 12).cast("bigint").alias("doc_id"),
        F.get("messages", F.lit(2))["content"].alias("answered"),
    )


@query("load_named_dataset", "SELECT item_id, text FROM benchmark")
def load_named_dataset(spark, sf_dir):
    mirrors = {"benchmark-items": sf_dir}
    return files.load_named_dataset(spark, mirrors, "benchmark-items", "benchmark.parquet")


@query(
    "write_eval_report",
    f"""WITH {sql.TIMINGS}, metrics AS ({evaluation.METRICS_SQL})
SELECT 'run-1' AS run_id, 'echo' AS model_path, 'conversations' AS evaluation_dataset,
  (SELECT count(*) FROM timings) AS n_details, * FROM metrics""",
)
def write_eval_report(spark, sf_dir):
    path = scratch_path(spark, "report")
    stored_at = scratch_path(spark, "timings")
    inputs.timings(spark, sf_dir).write.parquet(stored_at)
    details = spark.read.parquet(stored_at)
    metrics = evaluation.rounded(ev.eval_metrics(details))
    files.write_eval_report(details, metrics, path, "run-1", "echo", "conversations")
    stored, report = files.read_eval_report(spark, path)
    counts = stored.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_details"))
    return report.join(counts, "run_id").select(
        "run_id", "model_path", "evaluation_dataset", "n_details", *metrics.columns
    )
