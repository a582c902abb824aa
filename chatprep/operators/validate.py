"""Checks on records. Violations come back as rows; a data set is valid if there are none."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatprep.functions.chat import is_empty
from chatprep.schema import REQUIRED_FIELDS, ROLES, required_fields


def check_required_fields(columns: Iterable[str], data_format: str) -> None:
    """Raise for the first required column that is missing. Needs no job."""
    columns = set(columns)
    for field in required_fields(data_format):
        if field not in columns:
            raise ValueError(f"column '{field}' is required by format '{data_format}'")


def required_field_report(lines: DataFrame, value: str = "value") -> DataFrame:
    """``(format, field, n_records, n_with_field, present)`` for a table of JSON lines.

    A field is present if any record has it, whatever its value.
    """
    fields = sorted({f for needed in REQUIRED_FIELDS.values() for f in needed})
    keys = F.json_object_keys(F.col(value))
    counts = lines.agg(
        F.count(F.lit(1)).alias("n_records"),
        *[F.count_if(F.array_contains(keys, f)).alias(f) for f in fields],
    )
    report = [
        F.struct(
            F.lit(data_format).alias("format"),
            F.lit(field).alias("field"),
            F.col(field).alias("n_with_field"),
        )
        for data_format, needed in REQUIRED_FIELDS.items()
        for field in needed
    ]
    return counts.select("n_records", F.inline(F.array(*report))).withColumn(
        "present", F.col("n_with_field") > 0
    )


def validate_nonempty_messages(
    df: DataFrame, row_id: str, messages: str = "messages"
) -> DataFrame:
    """``(n_empty, first_empty)``: how many records have no messages, and the least id of them."""
    empty = df.where(is_empty(F.col(messages)))
    return empty.agg(F.count(F.lit(1)).alias("n_empty"), F.min(row_id).alias("first_empty"))


def check_nonempty_messages(df: DataFrame, row_id: str, messages: str = "messages") -> None:
    found = validate_nonempty_messages(df, row_id, messages).first()
    if found.n_empty:
        raise ValueError(
            f"{found.n_empty} records without messages, the first with id {found.first_empty}"
        )


def _variant(value: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(value, path, kind)


def _type_of(value: Column) -> Column:
    return F.schema_of_variant(value)


def _message_reason(message: Column) -> Column:
    # A key that is absent gives null; one that is JSON null gives a variant that is not null.
    incomplete = _variant(message, "$.role").isNull() | _variant(message, "$.content").isNull()
    known = F.coalesce(_variant(message, "$.role", "string").isin(*ROLES), F.lit(False))
    return (
        F.when(~_type_of(message).startswith("OBJECT"), "message_not_object")
        .when(incomplete, "missing_role_or_content")
        .when(~known, "invalid_role")
    )


def validate_chat(
    lines: DataFrame, line_id: str, value: str = "value", all_messages: bool = False
) -> DataFrame:
    """``(line, msg_idx, reason)`` of the lines that are not valid chat records.

    Each line is judged by its first failing rule; ``msg_idx`` is null if that concerns the whole
    line. ``all_messages`` reports every failing message of a line instead of the first.
    """
    parsed = lines.select(
        F.col(line_id).alias("line"), F.try_parse_json(F.col(value)).alias("record")
    )
    kind = _type_of(F.col("record"))
    has_keys = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    parsed = parsed.select(
        "line",
        (F.col("record").isNotNull() & has_keys).alias("parsed"),
        _variant(F.col("record"), "$.messages").alias("m"),
        _variant(F.col("record"), "$.messages", "array<variant>").alias("items"),
    )
    line_reason = (
        F.when(~F.col("parsed") | F.col("parsed").isNull(), "parse_error")
        .when(F.col("m").isNull(), "missing_messages")
        .when(F.col("items").isNull() | (F.size("items") == 0), "messages_not_nonempty_list")
    )
    indexed = F.filter(
        F.transform(
            F.col("items"),
            lambda m, i: F.struct(i.alias("msg_idx"), _message_reason(m).alias("reason")),
        ),
        lambda r: r["reason"].isNotNull(),
    )
    shown = indexed if all_messages else F.slice(indexed, 1, 1)
    whole_line = F.array(
        F.struct(F.lit(None).cast("int").alias("msg_idx"), F.col("line_reason").alias("reason"))
    )
    judged = parsed.withColumn("line_reason", line_reason)
    found = F.when(F.col("line_reason").isNotNull(), whole_line).otherwise(shown)
    return judged.select("line", F.inline(found))


def validate_chat_files(lines: DataFrame, all_messages: bool = False) -> DataFrame:
    """``(file, line, msg_idx, reason)`` of the lines of files that are not valid chat records.

    ``lines`` has ``(file, line, value)``, as ``sources.pieces.numbered_lines`` gives them. A blank
    line is no record, and so a violation too.
    """
    placed = lines.select(F.struct("file", "line").alias("place"), "value")
    found = validate_chat(placed, "place", all_messages=all_messages)
    return found.select("line.file", "line.line", "msg_idx", "reason")


def first_violation(violations: DataFrame) -> DataFrame:
    """The violation a reader going line by line would meet first."""
    place = F.struct("line", F.coalesce("msg_idx", F.lit(-1)))
    return violations.agg(
        F.count(F.lit(1)).alias("n_violations"),
        F.min("line").alias("line"),
        F.min_by("msg_idx", place).alias("msg_idx"),
        F.min_by("reason", place).alias("reason"),
    )


def filter_has_expected(df: DataFrame, expected: str = "expected_response") -> DataFrame:
    return df.where(F.length(expected) > 0)


def skipped_samples(df: DataFrame, expected: str = "expected_response") -> DataFrame:
    """``(n_samples, n_skipped)``: samples in all and those without an expected answer."""
    return df.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count_if(F.coalesce(F.length(expected), F.lit(0)) == 0).alias("n_skipped"),
    )
