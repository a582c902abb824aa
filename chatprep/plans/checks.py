"""Queries: validation and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatprep.functions import chat as ch
from chatprep.functions import text as tx
from chatprep.operators import evaluate as ev
from chatprep.operators import examples as ex
from chatprep.operators import runs as rn
from chatprep.operators import validate as va
from chatprep.plans import inputs, sql
from chatprep.plans.registry import query
from chatprep.sources.pieces import numbered_lines
from chatprep.sources.scratch import scratch_path

# The same broken lines as in the input, one rule per remainder.
_LINES = f"""{sql.CHAT}, lines AS (
  SELECT doc_id, messages, n_chars % 8 AS kind, CASE n_chars % 8
    WHEN 0 THEN substr({sql.as_json("{'messages': messages}")}, 1, 12)
    WHEN 1 THEN {sql.as_json("{'turns': messages}")}
    WHEN 2 THEN '{{"messages":[]}}'
    WHEN 3 THEN {sql.as_json("{'messages': list_transform(messages, lambda m: m.content)}")}
    WHEN 4 THEN {sql.as_json(
        "{'messages': list_transform(messages, lambda m: {'role': m.role})}")}
    WHEN 5 THEN {sql.as_json(
        "{'messages': list_transform(messages, lambda m: {'role': CASE WHEN m.role = 'assistant' "
        "THEN 'bot' ELSE m.role END, 'content': m.content})}")}
    ELSE {sql.as_json("{'messages': messages}")} END AS value FROM chat)"""


@query(
    "validate_required_fields",
    f"""WITH {_LINES}, parsed AS (
  SELECT CASE WHEN json_valid(value) THEN json_keys(value) END AS keys FROM lines)
SELECT format, field, count(*) AS n_records,
  count(*) FILTER (list_contains(keys, field)) AS n_with_field,
  coalesce(bool_or(list_contains(keys, field)), false) AS present
FROM parsed JOIN (VALUES ('chatml', 'messages'), ('alpaca', 'instruction'), ('alpaca', 'output'))
  AS needed(format, field) ON true GROUP BY format, field""",
)
def validate_required_fields(spark, sf_dir):
    return va.required_field_report(inputs.chat_lines(spark, sf_dir))


_USEFUL = (
    f"list_filter(string_split(text, chr(10)), lambda c: length({sql.strip('c')}) > 50 "
    f"AND {sql.contains_any('c', inputs.TEST_WORDS)})"
)


@query(
    "validate_nonempty_messages",
    f"""SELECT count(*) AS n_empty, min(doc_id) AS first_empty
FROM documents WHERE len({_USEFUL}) = 0""",
)
def validate_nonempty_messages(spark, sf_dir):
    """Documents as chats of their useful lines; many have none."""
    chunks = tx.useful_chunks(tx.chunk_text(F.col("text"), "\n"), inputs.TEST_WORDS)
    messages = F.transform(chunks, lambda c: ch.message("user", c))
    docs = inputs.table(spark, sf_dir, "documents")
    return va.validate_nonempty_messages(
        docs.select("doc_id", messages.alias("messages")), "doc_id"
    )


_VIOLATIONS = f"""{_LINES}, found AS (
  SELECT doc_id AS line, CASE
      WHEN kind IN (3, 4) THEN 0
      WHEN kind = 5 THEN list_position(list_transform(messages, lambda m: m.role), 'assistant') - 1
    END::INTEGER AS msg_idx,
    CASE kind WHEN 0 THEN 'parse_error' WHEN 1 THEN 'missing_messages'
      WHEN 2 THEN 'messages_not_nonempty_list' WHEN 3 THEN 'message_not_object'
      WHEN 4 THEN 'missing_role_or_content' ELSE 'invalid_role' END AS reason
  FROM lines WHERE kind < 5
    OR (kind = 5 AND list_contains(list_transform(messages, lambda m: m.role), 'assistant')))"""


@query("validate_chat", f"WITH {_VIOLATIONS} SELECT line, msg_idx, reason FROM found")
def validate_chat(spark, sf_dir):
    return va.validate_chat(inputs.chat_lines(spark, sf_dir), "doc_id")


#: Documents of each file of chat lines.
LINES_PER_FILE = 500


@query(
    "validate_chat_files",
    f"""WITH {_VIOLATIONS}, places AS (
  SELECT doc_id, doc_id // {LINES_PER_FILE} AS part, row_number() OVER (
      PARTITION BY doc_id // {LINES_PER_FILE} ORDER BY doc_id) AS number FROM documents)
SELECT part, number AS line, msg_idx, reason FROM found JOIN places ON doc_id = found.line""",
)
def validate_chat_files(spark, sf_dir):
    """The records as lines of files, in the order of their documents; found by file and line."""
    path = scratch_path(spark, "chat-files")
    part = F.expr(f"doc_id div {LINES_PER_FILE}")
    lines = inputs.chat_lines(spark, sf_dir).withColumn("part", part)
    ordered = lines.repartition("part").sortWithinPartitions("part", "doc_id")
    ordered.drop("doc_id").write.partitionBy("part").text(path)
    found = va.validate_chat_files(numbered_lines(spark, f"{path}/*"))
    return found.select(
        F.regexp_extract("file", r"part=(\d+)", 1).cast("bigint").alias("part"),
        "line",
        "msg_idx",
        "reason",
    )


@query(
    "validate_chat_verdict",
    f"""WITH {_VIOLATIONS} SELECT count(*) AS n_violations, min(line) AS line,
  first(msg_idx ORDER BY line) AS msg_idx, first(reason ORDER BY line) AS reason FROM found""",
)
def validate_chat_verdict(spark, sf_dir):
    return va.first_violation(va.validate_chat(inputs.chat_lines(spark, sf_dir), "doc_id"))


@query(
    "filter_nonempty_text",
    f"""SELECT doc_id, cleaned FROM (
  SELECT doc_id, {sql.clean("regexp_replace(text, '[a-z]+', '', 'g')")} AS cleaned FROM documents)
WHERE cleaned <> ''""",
)
def filter_nonempty_text(spark, sf_dir):
    """What is left of each document without its plain small letters, where that is anything."""
    docs = inputs.table(spark, sf_dir, "documents")
    rest = tx.clean_text(F.regexp_replace("text", "[a-z]+", ""))
    return ex.filter_nonempty_text(docs.select("doc_id", rest.alias("cleaned")), "cleaned")


@query(
    "filter_has_expected",
    f"""WITH {sql.PAIRS} SELECT doc_id, expected AS expected_response FROM pairs""",
)
def filter_has_expected(spark, sf_dir):
    pairs = ev.eval_pairs(inputs.chat(spark, sf_dir), keep_all=True)
    return va.filter_has_expected(pairs).select("doc_id", "expected_response")


@query(
    "skipped_samples",
    f"""WITH {sql.PAIRS}, counted AS (SELECT count(*) AS n FROM pairs)
SELECT (SELECT count(*) FROM documents) AS n_samples,
  (SELECT count(*) FROM documents) - n AS n_skipped FROM counted""",
)
def skipped_samples(spark, sf_dir):
    return va.skipped_samples(ev.eval_pairs(inputs.chat(spark, sf_dir), keep_all=True))


@query(
    "filter_numeric_metrics",
    """SELECT event_id AS step, unnest(['loss', 'k', 'failed']) AS key,
  unnest([value, (props->>'$.k')::DOUBLE, (event_type = 'error')::INTEGER::DOUBLE]) AS value
FROM events""",
)
def filter_numeric_metrics(spark, sf_dir):
    return rn.filter_numeric_metrics(inputs.log_entries(spark, sf_dir), keep=("step",))
