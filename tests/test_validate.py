import pytest

from chatprep.operators import validate as va
from tests.test_chat import KIND, chat

LINES = {
    '{"messages":[{"role":"user","content":"a"}]}': None,
    '{"x":1}': "missing_messages",
    '{"messages":null}': "messages_not_nonempty_list",
    '{"messages":[]}': "messages_not_nonempty_list",
    '{"messages":"s"}': "messages_not_nonempty_list",
    '{"messages":{"a":1}}': "messages_not_nonempty_list",
    '{"messages":["m"]}': "message_not_object",
    '{"messages":[{"role":"bot","content":1}]}': "invalid_role",
    '{"messages":[{"role":null,"content":1}]}': "invalid_role",
    '{"messages":[{"role":["user"],"content":1}]}': "invalid_role",
    '{"messages":[{"role":"user","content":null}]}': None,
    '{"messages":[{"role":"user","content":{"a":[1]}}]}': None,
    '{"messages":[{"role":"user"}]}': "missing_role_or_content",
    '{"messages":[{"content":"user"}]}': "missing_role_or_content",
    "bad": "parse_error",
    "": "parse_error",
    "1": "parse_error",
    "null": "parse_error",
    "[1]": "missing_messages",
}


def test_reasons(spark):
    df = spark.createDataFrame(list(enumerate(LINES, 1)), "line_id int, value string")
    got = {r.line: r.reason for r in va.validate_chat(df, "line_id").collect()}
    assert got == {i: r for i, r in enumerate(LINES.values(), 1) if r}


def test_first_and_all_violations(spark):
    good = '{"role":"user","content":"a"}'
    rows = [
        (1, f'{{"messages":[{good}]}}'),
        (2, f'{{"messages":[{good}, 3, {good}, {{"role":"x","content":""}}]}}'),
        (3, "bad"),
    ]
    df = spark.createDataFrame(rows, "line_id int, value string")
    first = va.validate_chat(df, "line_id")
    assert {tuple(r) for r in first.collect()} == {
        (2, 1, "message_not_object"), (3, None, "parse_error"),
    }
    every = va.validate_chat(df, "line_id", all_messages=True)
    assert {tuple(r) for r in every.collect()} == {
        (2, 1, "message_not_object"), (2, 3, "invalid_role"), (3, None, "parse_error"),
    }
    assert tuple(va.first_violation(first).first()) == (2, 2, 1, "message_not_object")
    assert va.first_violation(first.where("line > 9")).first().n_violations == 0


def test_required_fields(spark):
    va.check_required_fields(["messages", "x"], "chatml")
    va.check_required_fields([], "other")
    with pytest.raises(ValueError, match="column 'output'"):
        va.check_required_fields(["instruction"], "alpaca")
    lines = spark.createDataFrame([('{"messages":1}',), ('{"output":null}',), ("bad",)], "value string")
    got = {(r.format, r.field): (r.n_with_field, r.present)
           for r in va.required_field_report(lines).collect()}
    assert got == {
        ("chatml", "messages"): (1, True),
        ("alpaca", "instruction"): (0, False),
        ("alpaca", "output"): (1, True),
    }


def test_nonempty_messages(spark):
    rows = [(0, chat("u")), (1, []), (2, None)]
    df = spark.createDataFrame(rows, f"id int, messages {KIND}")
    assert tuple(va.validate_nonempty_messages(df, "id").first()) == (2, 1)
    with pytest.raises(ValueError, match="first with id 1"):
        va.check_nonempty_messages(df, "id")
    va.check_nonempty_messages(df.where("id = 0"), "id")
